"""Mixing sources to target weights, as a curriculum that changes over training time.

Each source has a weight, which fixes how many words the mix takes from it, and a schedule,
which says when.  A schedule is an intensity that changes linearly over training time 0..1.
Its integral is the source's cumulative demand for words; inverting it turns a document's
place in its source's own (hashed) order into a training position.

Defined cases: null text has size 0; a null source is a source of its own and comes last; a
source without words has target 0; documents of size 0 are never taken; rows repeated in
full are documents of their own; an empty table gives an empty table.  Extra columns may
have any name: ``mix`` reads only ``doc_id``, ``text`` and ``source``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.randomness import leading_bits, seeded_hash
from ..operators.ordinals import join_on, with_ordinal
from ..session import stored
from .common import columns_of, n_words

WEIGHTS = (1, 2, 3)
# (intensity at the start, intensity at the end) of sources in turn: early, even, late.
SCHEDULES = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))
MAX_REPEATS = 3
SEED = "mix"

_BIG = "decimal(38,0)"


def source_targets(
    sources: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    schedules: Sequence[tuple[float, float]] = SCHEDULES,
    max_repeats: int = MAX_REPEATS,
) -> DataFrame:
    """Targets of sources, from a table (source, source_size).

    All words are shared by weight; a target stops at ``max_repeats`` times its source's
    size and the rest is shared again among the others.  Each round is one small
    aggregation that yields two numbers; the share per weight only grows, so rounds end
    when no further source reaches its cap.
    """
    ranked = with_ordinal(sources, [F.col("source").asc_nulls_last()], name="source_no")
    turn = F.col("source_no") - 1
    pick = lambda values: F.element_at(
        F.array(*[F.lit(v) for v in values]), (turn % len(values) + 1).cast("int")
    )
    ranked = stored(
        ranked.select(
            "source",
            "source_size",
            "source_no",
            *[c for c in sources.columns if c not in ("source", "source_size")],
            pick(weights).cast("long").alias("weight"),
            pick([float(a) for a, _ in schedules]).alias("rise_from"),
            pick([float(b) for _, b in schedules]).alias("rise_to"),
            (F.lit(max_repeats) * F.col("source_size")).alias("cap"),
        )
    )
    total, free = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    left, free = total or 0, free or 1
    while True:
        over = F.col("weight").cast(_BIG) * F.lit(left).cast(_BIG) > F.col("cap").cast(_BIG) * F.lit(free).cast(_BIG)
        capped, weight = ranked.agg(
            F.coalesce(F.sum(F.when(over, F.col("cap"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)),
        ).first()
        if ((total or 0) - capped, weight) == (left, free) or weight == 0:
            break
        left, free = (total or 0) - capped, weight
    share = F.col("weight").cast(_BIG) * F.lit(left).cast(_BIG)
    return ranked.select(
        "*",
        F.when(over, F.col("cap").cast("double")).otherwise(share.cast("double") / F.lit(float(free))).alias("target"),
        F.when(over, F.col("cap")).otherwise(F.expr(f"(cast(weight as {_BIG}) * {left}BD) div {free}BD")).cast("long").alias("quota"),
    )


def position(start: Column, quota: Column, rise_from: Column, rise_to: Column) -> Column:
    """Training time at which a source's cumulative demand reaches ``start`` words.

    With intensity a at time 0 and b at time 1, demand(t) / quota = (2at + (b-a)t^2) / (a+b).
    """
    share = start.cast("double") / quota.cast("double")
    root = F.sqrt(rise_from * rise_from + (rise_to * rise_to - rise_from * rise_from) * share)
    return share * (rise_from + rise_to) / (rise_from + root)


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    schedules: Sequence[tuple[float, float]] = SCHEDULES,
    max_repeats: int = MAX_REPEATS,
    seed: str = SEED,
    keep: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """How often and when the mix takes each document.

    Adds to the columns ``keep``: ``size``, ``source_size``, ``target``, ``taken`` (words;
    only the one document on which a source's quota ends is taken in part), ``copies``
    (``taken`` in whole documents, halves up), ``first_position`` (null if not taken), and
    ``places``: copy number, position of every copy.

    Only ids, sizes and sources are shuffled.  A source's documents stand in hashed order;
    the order is cut into about sqrt(documents) equal buckets per source, so neither a
    bucket nor the list of a source's buckets is ever large.
    """
    draw = leading_bits(seeded_hash(seed, F.col("doc_id")), 8)
    rows = stored(
        docs.select(
            *[F.col(f"`{c}`") for c in keep], F.col("source").alias("__source"), n_words(F.col("text")).alias("size"),
            draw.alias("__draw"), F.col("doc_id").alias("__id"),
        )
    )
    sources = rows.groupBy(F.col("__source").alias("source")).agg(
        F.sum("size").alias("source_size"), F.ceil(F.sqrt(F.count(F.lit(1)))).alias("buckets")
    )
    plan = source_targets(sources, weights, schedules, max_repeats).withColumnRenamed("source", "__source")
    placed = join_on(rows, plan, ["__source"]).withColumn(
        "__bucket", F.floor(F.col("__draw") * F.col("buckets") / F.lit(4294967296.0))
    )
    block = ["source_no", "__bucket"]
    before = W.partitionBy("source_no").orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    bases = placed.groupBy(*block).agg(F.sum("size").alias("__sum")).select(
        *block, F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__base")
    )
    inside = W.partitionBy(*block).orderBy("__draw", "__id", "size").rowsBetween(W.unboundedPreceding, -1)
    ordered = (
        placed.withColumn("__inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(bases, block)
        .withColumn("__start", F.col("__base") + F.col("__inner"))
    )
    whole = F.when(F.col("source_size") > 0, F.expr("quota div source_size")).otherwise(0)
    rest = F.col("quota") - F.col("__whole") * F.col("source_size")
    part = F.least(F.greatest(rest - F.col("__start"), F.lit(0)), F.col("size"))
    taken = ordered.withColumn("__whole", whole).withColumn("taken", F.col("__whole") * F.col("size") + part)
    copies = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(0).cast("int")
    at = lambda start: position(start, F.col("quota"), F.col("rise_from"), F.col("rise_to"))
    places = F.transform(
        F.when(F.col("copies") > 0, F.sequence(F.lit(1), F.col("copies"))).otherwise(F.array().cast("array<int>")),
        lambda k: F.struct(
            k.alias("copy"), at(F.col("__start") + (k - 1) * F.col("source_size")).alias("position")
        ),
    )
    return taken.withColumn("copies", copies).select(
        *keep, "size", "source_size", "target", F.col("taken").cast("long").alias("taken"), "copies",
        F.when(F.col("taken") > 0, at(F.col("__start"))).alias("first_position"), places.alias("places"),
    )


def in_training_order(mixed: DataFrame) -> DataFrame:
    """The result of ``mix``, range-partitioned and sorted by first position, untaken documents last."""
    keys = [F.col("first_position").asc_nulls_last(), F.col("doc_id").asc_nulls_last()]
    return mixed.repartitionByRange(*keys).sortWithinPartitions(*keys)


def training_order(docs: DataFrame, **options) -> DataFrame:
    """Every copy the mix takes, with the columns of ``docs`` and ``copy`` and ``position``, sorted by position.

    A document whose last copy is taken by less than half loses that copy.  Rows with equal
    id and text count as so many documents; one of them stands for all their copies.
    Texts travel twice: to meet their places, and to their final order.
    """
    columns = columns_of(docs, ("copy", "position"))
    key = ["__doc", "__text"]
    keyed = docs.withColumn("__doc", F.coalesce("doc_id", F.lit(-(2**63)))).withColumn("__text", F.xxhash64("text"))
    places = mix(keyed, keep=key, **options).where("copies > 0").groupBy(*key).agg(
        F.flatten(F.collect_list("places")).alias("__places")
    )
    first = F.row_number().over(W.partitionBy(*key).orderBy(*key))
    one = keyed.withColumn("__first", first).where("__first = 1")
    copies = one.join(places, key).select(*columns, F.explode("__places").alias("__place")).select(
        *columns, F.col("__place.copy").alias("copy"), F.col("__place.position").alias("position")
    )
    keys = [F.col("position").asc(), F.col("doc_id").asc_nulls_last(), F.col("copy").asc()]
    return copies.repartitionByRange(*keys).sortWithinPartitions(*keys)
