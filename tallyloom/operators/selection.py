"""The first rows of each group in a random order, exactly, without sorting or moving a row.

A row's place in the order is a digest of its id.  Histograms of the digests find each group's
cut-off value: 4,096 bins per group, then as many inside the one bin that holds the cut, until
it is a bin's edge.  A row is chosen by comparing its digest with its group's cut-off.  What is
shuffled are counts per group and bin, whatever share of the table a group holds.

Rows of equal digests (a repeated or missing id) at the cut are ordered by a digest of the
whole row in the same way; equal rows beyond that are numbered, only those at the cut.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.randomness import leading_bits, seeded_hash
from ..session import stored
from .ordinals import join_on, small, with_ordinal

# Keys have 60 bits, of which each round tells 12 apart.
_KEY_DIGITS, _KEY_BITS, _ROUND_BITS = 15, 60, 12
Quota = Callable[[DataFrame], DataFrame]


def _bins(keys: DataFrame, group: str, shift: int) -> DataFrame:
    """Rows, smallest and largest key of every bin of every group."""
    return keys.groupBy(group, F.shiftright("__key", shift).alias("__bin")).agg(
        F.count(F.lit(1)).alias("__n"), F.min("__key").alias("__low"), F.max("__key").alias("__high")
    )


def _cut_bins(bins: DataFrame, quotas: DataFrame, group: str) -> DataFrame:
    """The bin of each group in which its quota ends, and how many rows of it are still wanted.

    A group has at most 4,096 bins, so the fold runs over a short array.
    """
    item = F.struct("__bin", "__n", "__low", "__high")
    kind = "struct<__bin:bigint,__n:bigint,__low:bigint,__high:bigint>"
    none = F.struct(F.lit(0).cast("bigint").alias("before"), F.lit(None).cast(kind).alias("found"))

    def step(state: Column, x: Column) -> Column:
        after = state["before"] + x["__n"]
        passed = F.struct(after.alias("before"), F.lit(None).cast(kind).alias("found"))
        ends = F.struct(state["before"].alias("before"), x.alias("found"))
        return F.when(state["found"].isNotNull(), state).when(after >= F.col("quota"), ends).otherwise(passed)

    listed = bins.groupBy(group).agg(F.sort_array(F.collect_list(item)).alias("__bins"))
    folded = join_on(listed, quotas.select(group, "quota"), [group]).withColumn("__end", F.aggregate("__bins", none, step))
    wanted = F.col("quota") - F.col("__end.before")
    found = F.col("__end.found")
    return folded.where(found.isNotNull()).select(
        group, wanted.alias("quota"), found["__bin"].alias("__bin"), found["__n"].alias("__n"),
        found["__low"].alias("__low"), found["__high"].alias("__high"),
    )


def cut_offs(keys: DataFrame, group: str, quotas: DataFrame, bins: DataFrame | None = None) -> tuple[DataFrame, int, bool]:
    """(group, cut, ties), its number of rows, and whether any group has ties.

    ``keys`` has the group and ``__key``, a number of 60 bits; a quota is at least 1 and at most
    the group's rows.  Rows below ``cut`` are in; of those equal to it ``ties`` are, or all if null.
    """
    shift = _KEY_BITS - _ROUND_BITS
    current = stored(_cut_bins(_bins(keys, group, shift) if bins is None else bins, quotas, group))
    groups = current.count()
    whole, same = F.col("quota") == F.col("__n"), F.col("__low") == F.col("__high")
    rounds = []
    while True:
        rounds.append(
            current.where(whole | same).select(
                group, F.col("__high").alias("cut"), F.when(~whole, F.col("quota")).alias("ties")
            )
        )
        open_ = current.where(~whole & ~same).select(group, "quota", "__bin")
        n_open = open_.count() if shift else 0
        if not n_open:
            break
        inside = join_on(keys, small(open_.select(group, "__bin"), n_open), [group]).where(
            F.shiftright("__key", shift) == F.col("__bin")
        )
        shift -= _ROUND_BITS
        current = stored(_cut_bins(_bins(inside.drop("__bin"), group, shift), open_, group))
    cuts = stored(reduce(DataFrame.unionByName, rounds))
    return cuts, groups, not cuts.where("ties IS NOT NULL").isEmpty()


def with_chosen(df: DataFrame, group: str, seed: int | str, ids: Sequence[str], quota: Quota, name: str = "chosen") -> DataFrame:
    """Add whether a row is among the first rows of its group, as many as the group's quota.

    ``quota`` turns (group, rows) into (group, quota); a group without one has no row chosen,
    one that wants more rows than it has them all.  A missing group is a group like others.
    Ids may be missing or repeat; rows equal in all columns are chosen as often as their share.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    key = leading_bits(seeded_hash(seed, *[F.col(i) for i in ids]), _KEY_DIGITS)
    bins = stored(_bins(df.select(group, key.alias("__key")), group, _KEY_BITS - _ROUND_BITS))
    sizes = bins.groupBy(group).agg(F.sum("__n").alias("rows"))
    quotas = join_on(quota(sizes).select(group, "quota"), sizes, [group])
    quotas = quotas.select(group, F.least("quota", "rows").alias("quota")).where("quota > 0")
    keyed = df.withColumn("__key", key)
    cuts, groups, tied = cut_offs(keyed.select(group, "__key"), group, stored(quotas), bins)
    marked = join_on(keyed, small(cuts, groups), [group], "left")
    below, at = F.col("__key") < F.col("cut"), F.col("__key") == F.col("cut")
    if not tied:
        return marked.select(*columns, F.coalesce(below | at, F.lit(False)).alias(name))
    # Rows with the digest of the cut, where not all of them are in: by a digest of the whole row.
    whole_row = F.shiftrightunsigned(F.xxhash64(*columns), 64 - _KEY_BITS)
    rest = join_on(keyed, small(cuts.where("ties IS NOT NULL"), groups), [group]).where(at)
    second, _, copies = cut_offs(
        rest.select(group, whole_row.alias("__key")), group,
        cuts.where("ties IS NOT NULL").select(group, F.col("ties").alias("quota")),
    )
    second = second.select(group, F.col("cut").alias("__cut2"), F.col("ties").alias("__ties2"))
    marked = join_on(marked, small(second, groups), [group], "left").withColumn("__key2", whole_row)
    among = at & F.col("ties").isNotNull()
    equal = among & (F.col("__key2") == F.col("__cut2")) & F.col("__ties2").isNotNull()
    taken = below | (at & F.col("ties").isNull()) | (among & (F.col("__key2") <= F.col("__cut2")))
    if not copies:
        return marked.select(*columns, F.coalesce(taken, F.lit(False)).alias(name))
    equal = F.coalesce(equal, F.lit(False))
    others = marked.where(~equal).select(*columns, F.coalesce(taken, F.lit(False)).alias(name))
    numbered = with_ordinal(marked.where(equal), [F.col("__key").asc()], [group], "__no")
    return others.unionByName(numbered.select(*columns, (F.col("__no") <= F.col("__ties2")).alias(name)))
