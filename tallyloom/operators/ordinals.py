"""Numbering rows and taking the first N of them without a one-task window.

A ``row_number`` over a group, or over everything, sorts that group in a single task.
These operators spread the work instead, so a group may hold any share of the table.  Where
only the order counts, rows stay where they are: their keys alone are sorted, and rows are
compared with the keys at the edges.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import stored

# ``monotonically_increasing_id`` puts the partition above this bit and the row below it.
_PARTITION_SHIFT = 33
# Tables with one row per group, partition or block edge are sent to every task up to this many rows.
MAX_BROADCAST_ROWS = 200_000
# Ordinals in one range of a running total.
_RANGE = 4096


def small(df: DataFrame, rows: int) -> DataFrame:
    """The table itself, marked for broadcast where its counted rows allow."""
    return F.broadcast(df) if rows <= MAX_BROADCAST_ROWS else df


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Null-safe join that keeps the left copy of the keys."""
    renamed = right.select(
        *[F.col(k).alias(f"__{k}") for k in keys], *[c for c in right.columns if c not in keys]
    )
    condition = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    )
    joined = left.join(renamed, condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"__{k}" for k in keys])


def with_ordinal(
    df: DataFrame, order: Sequence[Column], group: Sequence[str] = (), name: str = "ordinal"
) -> DataFrame:
    """Number rows 1, 2, ... in ``order``, within ``group`` or overall.

    Rows are range-partitioned and sorted once and written with their place in the sorted
    data.  A row's number is then its offset inside its partition plus the rows of the same
    group in earlier partitions; that second part comes from one count per group and
    partition, for which only the place and the group are read back.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    keys = [*[F.col(g).asc() for g in group], *order, F.col("__tie").asc()]
    # The hash of the whole row lets rows with equal keys land in different partitions.
    laid_out = (
        df.withColumn("__tie", F.xxhash64(*columns))
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .drop("__tie")
    )
    placed = stored(laid_out.withColumn("__slot", F.monotonically_increasing_id()))
    placed = placed.withColumn("__part", F.shiftright("__slot", _PARTITION_SHIFT))
    pieces = placed.groupBy(*group, "__part").agg(
        F.count(F.lit(1)).alias("__rows"), F.min("__slot").alias("__first")
    )
    # At most one row per partition of the sorted data inside any one window.
    earlier = W.partitionBy(*group).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    starts = stored(
        pieces.select(
            *group,
            "__part",
            (F.col("__first") - F.coalesce(F.sum("__rows").over(earlier), F.lit(0))).alias("__start"),
        )
    )
    numbered = join_on(placed, small(starts, starts.count()), [*group, "__part"])
    return numbered.select(*columns, (F.col("__slot") - F.col("__start") + 1).alias(name))


def with_block(
    df: DataFrame, order: Sequence[Column], group: Sequence[str], size: int, name: str = "block"
) -> DataFrame:
    """Number stretches of ``size`` rows 1, 2, ... in each group, in ascending ``order``.

    Only keys are sorted.  The first key of every block bounds it from below, and a row finds
    its block among its group's bounds by binary search, wherever the row lies.  Rows that are
    equal in all columns and stand on both sides of a bound, or more bounds than may be
    broadcast, need the rows themselves to be numbered.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    keyed = df.withColumn("__place", F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)], F.xxhash64(*columns).alias("tie")))
    numbered = with_ordinal(keyed.select(*group, "__place"), [F.col("__place").asc()], group, "__no")
    no = F.col("__no")
    first = F.when((no - 1) % size == 0, F.struct((F.floor((no - 1) / size) + 1).alias("__block"), F.lit(True).alias("__first")))
    after = F.when(no % size == 0, F.struct((F.floor(no / size) + 1).alias("__block"), F.lit(False).alias("__first")))
    edges = stored(numbered.select(*group, "__place", F.inline(F.array_compact(F.array(first, after)))))
    n_bounds = edges.where("__first").count()
    torn = edges.groupBy(*group, "__block", "__place").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    if n_bounds > MAX_BROADCAST_ROWS or not torn.isEmpty():
        numbered = with_ordinal(keyed, [F.col("__place").asc()], group, "__no")
        return numbered.select(*columns, (F.floor((no - 1) / size) + 1).alias(name))
    bounds = edges.where("__first").groupBy(*group).agg(F.sort_array(F.collect_list("__place")).alias("__bounds"))
    found = join_on(keyed, F.broadcast(bounds), group)
    return found.select(*columns, _count_up_to(F.col("__bounds"), F.col("__place"), n_bounds.bit_length()).alias(name))


def _count_up_to(bounds: Column, place: Column, steps: int) -> Column:
    """How many of the sorted bounds are not above a place, by halving in so many steps."""
    def halve(state: Column, _: Column) -> Column:
        middle = F.floor((state["low"] + state["high"] + 1) / 2).cast("int")
        above = F.element_at(bounds, middle) > place
        return F.when(state["low"] == state["high"], state).otherwise(
            F.struct(
                F.when(above, state["low"]).otherwise(middle).alias("low"),
                F.when(above, middle - 1).otherwise(state["high"]).alias("high"),
            )
        )

    start = F.struct(F.lit(0).alias("low"), F.size(bounds).alias("high"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, halve, lambda s: s["low"].cast("bigint"))


def first_in_order(
    df: DataFrame, n: int, lead: Sequence[str], lead_order: Sequence[Column], order: Sequence[Column]
) -> DataFrame:
    """The first ``n`` rows by (``lead_order``, ascending ``order``), for an ``n`` too large for a top-N.

    One pass counts rows per ``lead`` value; running sums of the counts say which blocks are
    in and which one holds the cut.  Of that block the keys are sorted to find the cut-off key.
    One pass then filters rows by their block and that key; no row is sorted or numbered.
    """
    if n <= 0:
        return df.limit(0)
    columns = [F.col(f"`{c}`") for c in df.columns]
    blocks = with_ordinal(df.groupBy(*lead).agg(F.count(F.lit(1)).alias("__rows")), lead_order, name="__no")
    blocks = running_total(blocks, "__no", "__rows", "__before")
    kept = stored(blocks.where(F.col("__before") < n).select(*lead, "__before", "__rows"))
    n_kept = kept.count()
    cut = kept.where(F.col("__before") + F.col("__rows") > n).first()
    if cut is None:
        return join_on(df, small(kept.select(*lead), n_kept), lead, "left_semi")
    wanted = n - cut["__before"]
    placed = df.withColumn("__place", F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)], F.xxhash64(*columns).alias("tie")))
    in_cut = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(cut[c])) for c in lead])
    keys = with_ordinal(placed.where(in_cut).select("__place"), [F.col("__place").asc()], name="__no")
    edge = stored(keys.where(F.col("__no").between(wanted, wanted + 1)))
    cut_off = edge.where(F.col("__no") == wanted).select("__place").scalar()
    inside = join_on(placed, small(kept.select(*lead), n_kept), lead, "left_semi")
    if edge.select("__place").distinct().count() == 2:
        return inside.where(~in_cut | (F.col("__place") <= cut_off)).select(*columns)
    # Equal rows stand on both sides of the cut: as many of them as are still wanted.
    copies = wanted - keys.where(F.col("__place") < cut_off).count()
    equal = with_ordinal(placed.where(in_cut & (F.col("__place") == cut_off)), [F.col("__place").asc()], name="__no")
    return inside.where(~in_cut | (F.col("__place") < cut_off)).select(*columns).unionByName(
        equal.where(F.col("__no") <= copies).select(*columns)
    )


def running_total(df: DataFrame, ordinal: str, value: str, name: str) -> DataFrame:
    """Sum of ``value`` over all rows with a smaller ``ordinal`` (1, 2, 3, ... without gaps).

    Inside fixed ranges of ordinals, and in the same way over one total per range, until
    one range holds all of them: no window is ever longer than a range.
    """
    inner = W.partitionBy("__range").orderBy(ordinal).rowsBetween(W.unboundedPreceding, -1)
    ranged = df.withColumn("__range", F.floor((F.col(ordinal) - 1) / _RANGE))
    within = ranged.withColumn(name, F.coalesce(F.sum(value).over(inner), F.lit(0)))
    last = ranged.agg(F.max("__range").alias("last")).first()["last"]
    if not last:
        return within.select(*df.columns, name)
    # Names grow by level, so that no level's columns clash with those of the one below.
    upper, above = f"{name}_range", f"{name}_above"
    totals = ranged.groupBy("__range").agg(F.sum(value).alias("__sum"))
    totals = totals.select(F.col("__range").alias(upper), (F.col("__range") + 1).alias(f"{upper}_no"), "__sum")
    bases = running_total(totals, f"{upper}_no", "__sum", above).select(upper, above)
    return within.join(small(bases, last + 1), F.col("__range") == F.col(upper)).select(
        *df.columns, (F.col(above) + F.col(name)).alias(name)
    )
