"""Scoring n-gram models on held-out rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.bands import as_percent, band_position, complexity_band
from ..session import stored, stored_parts
from .ngrams import (
    LONG_CONTEXTS,
    FittedNGramModel,
    NGramModel,
    Part,
    candidate_lists,
    context_totals,
    count_windows,
    extract_ngrams,
    fingerprints,
    first_seen,
    gathered,
    lookup_counts,
    lookup_topk,
    parts_of,
    restrict_to_contexts,
    smoothed_probability,
    vocabulary_size,
)
from .ordinals import MAX_BROADCAST_ROWS, join_on, with_ordinal

# Fixed value: stand-in for ln(0).
ZERO_PROBABILITY = 1e-10
TOP = (1, 3, 5)


@dataclass(frozen=True)
class Configuration:
    n: int
    smoothing: str
    k: float | None = None


# The grid of the experiment, in order.
CONFIGURATIONS = (
    Configuration(3, "none"),
    Configuration(3, "laplace"),
    Configuration(3, "add-k", 0.1),
    Configuration(3, "add-k", 0.5),
    Configuration(5, "none"),
    Configuration(5, "laplace"),
    Configuration(5, "add-k", 0.1),
    Configuration(7, "laplace"),
    Configuration(7, "add-k", 0.1),
    Configuration(11, "laplace"),
)


def select_split(df: DataFrame, split: str) -> DataFrame:
    """F7."""
    return df.where(F.col("dataset_split") == split)


def head_n(df: DataFrame, n: int | None, order: str = "row_ord") -> DataFrame:
    """The first ``n`` rows; all of them for ``None``.  ``order`` must tell rows apart.

    Only the order is numbered; rows are then compared with the last one that is in, a single
    value, so the plan is the same for every ``n`` and no row is moved.
    """
    if n is None:
        return df
    if n <= 0:
        return df.limit(0)
    last = with_ordinal(df.select(order), [F.col(order)], name="__no").where(F.col("__no") <= n)
    return df.where(F.col(order) <= F.lit(last.agg(F.max(order)).first()[0]))


def head_per_group(df: DataFrame, group: str, n: int | None = None, order: str = "row_ord") -> DataFrame:
    """The first ``n`` rows of each group; all of them for ``None``.  ``order`` must tell rows apart.

    Groups and orders are numbered without sorting a group in one task.  The last order that
    is in, one row per group, then filters the rows where they are.
    """
    if n is None:
        return df
    numbered = with_ordinal(df.select(group, order), [F.col(order)], [group], "__no").where(F.col("__no") <= n)
    last = stored(numbered.groupBy(group).agg(F.max(order).alias("__last")))
    return join_on(df, last, [group]).where(F.col(order) <= F.col("__last")).drop("__last")


def _log_probability(p: Column) -> Column:
    return F.ln(F.when(p > 0, p).otherwise(F.lit(ZERO_PROBABILITY)))


def _perplexity(log_probability: Column, weight: Column) -> Column:
    """``exp`` of minus the weighted mean; null when nothing was scored."""
    return F.exp(-F.try_divide(F.sum(weight * log_probability), F.sum(weight)))


def _hits(weight: Column, place: Column, k: int) -> Column:
    return F.coalesce(F.sum(F.when(place.between(1, k), weight)), F.lit(0))


def _within(max_positions: int | None, n: Column | int) -> Column:
    """A limit on positions of the padded sequence; longer contexts leave fewer of them."""
    return F.lit(True) if max_positions is None else F.col("pos") <= F.lit(max_positions + 1) - n


def contexts_of(df: DataFrame, n: int | Sequence[int], tokens: str = "code_tokens") -> DataFrame:
    """(n, ctx) of every position of some rows, to restrict a model to."""
    return extract_ngrams(df, n, tokens).select("n", "ctx")


def count_together(
    train: DataFrame, asked: DataFrame, sizes: Sequence[int], tokens: str = "code_tokens", order: str = "row_ord",
    by: Sequence[str] = (), max_positions: int | None = None, in_first: Sequence[str] = (),
    context: bool = False, contexts_only: bool = False, nulls_match: bool = False, within_only: bool = False,
    part: Part = (0, 1), windows: int = 0,
) -> DataFrame:
    """Positions of ``asked`` beside what ``train`` has of their contexts, for n of ``LONG_CONTEXTS`` and more.

    Gives (n, nxt, c, ct, w, w_acc, place) per different position and ``by``: counts of the pair
    and of its context in training, positions, those of them within ``max_positions``, and the
    token's place among the best candidates.  ``in_first`` names two flags of the rows of
    ``asked`` that count for ``w`` and ``w_acc``.  ``context`` adds ``ctx``; ``contexts_only`` leaves
    out which tokens were asked and gives (n, ct, best) instead, the best candidates in order.
    ``within_only`` asks nothing about positions beyond ``max_positions``, for callers who use ``w_acc`` alone.
    ``part`` gives the positions of one part, and ``windows``, where known, says how many meet there.

    All windows move once, as hashes of their contexts, to where their shortest contexts meet.
    Counts, totals and ranks are taken there.  Where few positions are asked about, only windows
    of their contexts move, and they are counted in the tasks first: a start of a sequence is the
    context of a window in every row.
    """
    sizes, keep = sorted(sizes), [*by, *in_first]
    by = [*by, "ctx"] if context else list(by)
    longer = ["longer"] if len(sizes) > 1 else []
    positions = fingerprints(asked, sizes, tokens, keep, context, part)
    n_asked = F.size(tokens) + 1
    if within_only and max_positions is not None:
        positions = positions.where(_within(max_positions, sizes[0]))
        n_asked = F.least(n_asked, F.lit(max(max_positions + 1 - sizes[0], 0)))
    if contexts_only:
        positions = positions.withColumn("nxt", F.lit(None).cast("string"))
    # One small number per row: 0 in training, else 4 with a bit for each flag.
    counts_for = [F.coalesce(F.col(f), F.lit(False)).cast("tinyint") for f in in_first] or [F.lit(1), F.lit(1)]
    kind = (F.lit(4) + counts_for[0] + 2 * counts_for[1]).cast("tinyint").alias("kind")
    moved = ["a", "b", F.col("pos").cast("int").alias("pos")]
    seen = fingerprints(train, sizes, tokens, [order], part=part).select(
        *moved, F.col(order).alias("order"), F.lit(0).cast("tinyint").alias("kind"), "nxt", *longer,
        *[F.lit(None).cast(positions.schema[c].dataType).alias(c) for c in by],
    )
    tested = positions.select(
        *moved, F.lit(None).cast(train.schema[order].dataType).alias("order"), kind, "nxt", *longer, *by
    )
    each_size = F.array(
        *[
            F.struct(F.lit(size).alias("n"), (F.get("longer", F.lit(i - 1)) if i else F.lit(0).cast("bigint")).alias("rest"))
            for i, size in enumerate(sizes)
        ]
    )
    few = (asked.agg(F.sum(n_asked)).first()[0] or 0) <= MAX_BROADCAST_ROWS
    if few:
        seen = seen.join(F.broadcast(stored(tested.select("a").distinct())), "a", "left_semi").select(seen.columns)
    met = seen.unionByName(tested)
    met = (met if few else gathered(met, windows, "a")).select("a", "b", "pos", "order", "kind", "nxt", *by, F.inline(each_size))
    group, trained = ["a", "n", "b", "rest"], F.col("trained")
    counted = met.groupBy(*group, "nxt", (F.col("kind") == 0).alias("trained"), *by).agg(
        F.count(F.lit(1)).alias("c"), F.min(first_seen(F.col("order"), F.col("pos"))).alias("first_seen"),
        F.count_if(F.col("kind").isin(5, 7)).alias("w"),
        F.count_if(F.col("kind").isin(6, 7) & _within(max_positions, F.col("n"))).alias("w_acc"),
    )
    of_context = W.partitionBy(*group)
    ranked = of_context.orderBy(F.desc("trained"), F.desc("c"), F.asc_nulls_last("first_seen"), F.asc("nxt"))
    of_pair = W.partitionBy(*group, "nxt")
    c = F.when(trained, F.col("c"))
    placed = counted.withColumn("place", F.row_number().over(ranked)).withColumn(
        "place", F.when(trained & (F.col("place") <= max(TOP)), F.col("place"))
    )
    totals = {"ct": F.coalesce(F.sum(c).over(of_context), F.lit(0)), "__asked": F.max(~trained).over(of_context)}
    if contexts_only:
        listed = F.collect_list(F.when(F.col("place").isNotNull(), F.struct("place", "nxt"))).over(of_context)
        totals["best"] = F.transform(F.sort_array(listed), lambda x: x["nxt"])
        return placed.withColumns(totals).where(~trained).select("n", "ct", "best", *by)
    known = F.col("nxt").isNotNull()
    pair = F.max(c).over(of_pair)
    matched = placed.withColumns(totals).where("__asked").withColumns(
        {
            "__c": F.coalesce(pair if nulls_match else F.when(known, pair), F.lit(0)),
            "__place": F.when(known, F.max("place").over(of_pair)),
        }
    )
    return matched.where(~trained).select(
        "n", "nxt", F.col("__c").alias("c"), "ct", "w", "w_acc", F.col("__place").alias("place"), *by
    )


@dataclass(frozen=True)
class AskedModel:
    """A model of ``train`` for the contexts of ``asked``; whatever evaluation does not need is fitted when used."""

    settings: NGramModel
    train: DataFrame
    asked: DataFrame
    tokens: str = "code_tokens"
    order: str = "row_ord"

    @property
    def n(self) -> int:
        return self.settings.n

    @cached_property
    def vocab_size(self) -> int:
        return vocabulary_size(self.train, self.n, self.tokens).first()["v"]

    @cached_property
    def fitted(self) -> FittedNGramModel:
        contexts = contexts_of(self.asked, self.n, self.tokens)
        return self.settings.fit(self.train, self.tokens, self.order, contexts)

    def __getattr__(self, name: str):
        if name.startswith("__"):
            raise AttributeError(name)
        return getattr(self.fitted, name)

    def with_smoothing(self, smoothing: str, k: float = 1.0) -> AskedModel:
        return replace(self, settings=NGramModel(self.n, smoothing, k))

    def probability(self, c: Column, ct: Column) -> Column:
        v = F.lit(None if self.settings.smoothing == "none" else self.vocab_size)
        return smoothed_probability(c, ct, v, self.settings.smoothing, self.settings.k)

    def look_up(self, df: DataFrame, by: Sequence[str] = (), **options) -> DataFrame:
        """``count_together`` with rows that may be fewer than those the model is for."""
        return count_together(self.train, df, [self.n], self.tokens, self.order, by, **options)


def _together(model: FittedNGramModel | AskedModel) -> bool:
    return isinstance(model, AskedModel) and model.n >= LONG_CONTEXTS


def perplexity(
    model: FittedNGramModel | AskedModel, df: DataFrame, max_samples: int | None = None,
    tokens: str = "code_tokens", order: str = "row_ord",
) -> DataFrame:
    """Perplexity over every position, and the number of positions.

    Equal (context, token) pairs are counted together before they meet the model.
    """
    rows = head_n(df, max_samples, order)
    if _together(model):
        scored = model.look_up(rows).withColumn("p", model.probability(F.col("c"), F.col("ct")))
    else:
        pairs = extract_ngrams(rows, model.n, tokens).groupBy("ctx", "nxt").agg(F.count(F.lit(1)).alias("w"))
        scored = model.score(pairs)
    return scored.agg(
        _perplexity(_log_probability(F.col("p")), F.col("w")).alias("perplexity"),
        F.coalesce(F.sum("w"), F.lit(0)).alias("positions"),
    )


def topk_accuracy(
    model: FittedNGramModel | AskedModel, df: DataFrame, max_samples: int | None = None,
    by: Sequence[str] = (), tokens: str = "code_tokens", order: str = "row_ord", max_positions: int | None = None,
) -> DataFrame:
    """Share of positions whose token is among the 1, 3 or 5 best candidates.

    Only positions with a context seen in training count.  ``by`` scores groups of rows.
    All rows and positions are scored unless the caller limits either.
    """
    rows = head_n(df, max_samples, order)
    if _together(model):
        looked_up = model.look_up(rows, by, max_positions=max_positions, within_only=True).where("ct > 0 and w_acc > 0")
        found = looked_up.withColumn("w", F.col("w_acc"))
    else:
        pairs = (
            extract_ngrams(rows, model.n, tokens, by)
            .where(_within(max_positions, model.n))
            .groupBy(*by, "n", "ctx", "nxt")
            .agg(F.count(F.lit(1)).alias("w"))
        )
        best = candidate_lists(model.counts, max(TOP))
        found = lookup_topk(pairs, best).withColumn(
            "place", F.array_position(F.col("candidates.nxt"), F.col("nxt"))
        )
    w, place = F.col("w"), F.col("place")
    total = F.coalesce(F.sum(w), F.lit(0))
    return found.groupBy(*by).agg(
        *[
            F.coalesce(F.try_divide(_hits(w, place, k), F.sum(w)), F.lit(0.0)).alias(f"top{k}_accuracy")
            for k in TOP
        ],
        *[_hits(w, place, k).alias(f"top{k}_hits") for k in TOP],
        total.alias("total_predictions"),
    )


def accuracy_by_complexity(
    model: FittedNGramModel | AskedModel, test: DataFrame, rows_per_band: int | None = None,
    complexity: str = "metrics_cyclomatic_complexity", tokens: str = "code_tokens", order: str = "row_ord",
    max_positions: int | None = None,
) -> DataFrame:
    """Rows and accuracy in percent for each complexity band that has test rows."""
    banded = test.withColumn("complexity", complexity_band(F.col(complexity))).where(
        F.col("complexity").isNotNull()
    )
    # Read twice: for the number of rows, and for the accuracy.
    rows = stored(head_per_group(banded.select(order, tokens, "complexity"), "complexity", rows_per_band, order))
    samples = rows.groupBy("complexity").agg(F.count(F.lit(1)).alias("samples"))
    accuracy = topk_accuracy(model, rows, by=["complexity"], tokens=tokens, order=order, max_positions=max_positions)
    percent = [
        as_percent(F.coalesce(f"top{k}_accuracy", F.lit(0.0))).alias(f"top{k}_acc") for k in (1, 5)
    ]
    return (
        samples.join(accuracy, "complexity", "left")
        .orderBy(band_position(F.col("complexity")))
        .select("complexity", "samples", *percent)
    )


def large_scale_eval(
    model: FittedNGramModel | AskedModel, test: DataFrame, rows: int | None = None, max_positions: int | None = None
) -> DataFrame:
    """A13 on all test rows, or the first ``rows`` of them."""
    return topk_accuracy(model, test, rows, max_positions=max_positions)


def _short_contexts(
    train: DataFrame, flagged: DataFrame, sizes: Sequence[int], tokens: str, order: str, max_positions: int | None
) -> DataFrame:
    """What ``count_together`` gives, for contexts so short that one may hold any share of the windows."""
    positions = extract_ngrams(flagged, sizes, tokens, ["__w", "__w_acc"])
    pairs = stored(
        positions.groupBy("n", "ctx", "nxt").agg(
            F.count_if("__w").alias("w"), F.count_if(F.col("__w_acc") & _within(max_positions, F.col("n"))).alias("w_acc")
        )
    )
    none = F.lit(0).cast("bigint")
    windows = restrict_to_contexts(extract_ngrams(train, sizes, tokens, [order]), pairs)
    seen = windows.select(
        "n", "ctx", "nxt", F.lit(1).cast("bigint").alias("c"),
        first_seen(F.col(order), F.col("pos")).alias("first_seen"), none.alias("w"), none.alias("w_acc"),
    )
    asked = pairs.select(
        "n", "ctx", "nxt", none.alias("c"), F.lit(None).cast("decimal(38,0)").alias("first_seen"), "w", "w_acc"
    )
    merged = stored(
        seen.unionByName(asked)
        .groupBy("n", "ctx", "nxt")
        .agg(*[F.sum(x).alias(x) for x in ("c", "w", "w_acc")], F.min("first_seen").alias("first_seen"))
    )
    trained = merged.where("c > 0").select("n", "ctx", "nxt", "c", "first_seen")
    tested = merged.where("w > 0 or w_acc > 0").select("n", "ctx", "nxt", "c", "w", "w_acc")
    best = candidate_lists(trained, max(TOP))
    return (
        tested.join(context_totals(trained), ["n", "ctx"], "left")
        .join(best, ["n", "ctx"], "left")
        .select(
            "n", "c", F.coalesce("ct", none).alias("ct"), "w",
            F.when(F.col("candidates").isNotNull(), F.col("w_acc")).otherwise(none).alias("w_acc"),
            F.array_position("candidates.nxt", F.col("nxt")).alias("place"),
        )
    )


def score_grid(
    train: DataFrame,
    test: DataFrame,
    configurations: Sequence[Configuration] = CONFIGURATIONS,
    perplexity_rows: int | None = None,
    accuracy_rows: int | None = None,
    tokens: str = "code_tokens",
    order: str = "row_ord",
    max_positions: int | None = None,
) -> DataFrame:
    """Perplexity and accuracy of every configuration, over all rows and positions by default.

    The test rows are known, so only their contexts matter.  Training windows and test positions
    of all longer sizes are counted together, one row per position wherever it goes, and part by
    part, of which only the profile stays; windows of the short sizes are counted before they move.  Smoothing is arithmetic on the result, and
    accuracy is computed once per size.
    """
    sizes = sorted({c.n for c in configurations})
    limits = (perplexity_rows, accuracy_rows)
    widest = None if None in limits else max(limits)
    scored = stored(head_n(test, widest, order).select(order, tokens))

    def in_first(rows: int | None) -> Column:
        if rows == widest:
            return F.lit(True)
        last = head_n(scored, rows, order).agg(F.max(order)).first()[0]
        return F.coalesce(F.col(order) <= F.lit(last), F.lit(False))

    flagged = scored.select(tokens, in_first(perplexity_rows).alias("__w"), in_first(accuracy_rows).alias("__w_acc"))
    short = [n for n in sizes if n < LONG_CONTEXTS]
    # Gone through several times below, so the token lists are made once.
    train = stored(train.select(order, tokens))

    def looked_up() -> Iterator[DataFrame]:
        if short:
            yield _short_contexts(train, flagged, short, tokens, order, max_positions)
        if len(short) == len(sizes):
            return
        n_asked = count_windows(flagged, tokens)
        windows = count_windows(train, tokens) + n_asked
        parts = parts_of(windows) if n_asked > MAX_BROADCAST_ROWS else [(0, 1)]
        for part in parts:
            long = count_together(
                train, flagged, sizes[len(short) :], tokens, order, max_positions=max_positions,
                in_first=["__w", "__w_acc"], nulls_match=True, part=part, windows=windows // len(parts),
            ).where("w > 0 or w_acc > 0")
            yield long.withColumn("w_acc", F.when(F.col("ct") > 0, F.col("w_acc")).otherwise(F.lit(0)))

    # Few distinct (c, ct, place) remain, whatever the number of positions.
    kinds = ["n", "c", "ct", F.col("place").cast("int").alias("place")]
    profile = stored_parts(
        found.groupBy(*kinds).agg(F.sum("w").alias("w"), F.sum("w_acc").alias("w_acc")) for found in looked_up()
    )
    # Without a context there is no start sentinel, so n = 1 has a vocabulary of its own.
    known = {n: vocabulary_size(train, n, tokens).first()["v"] for n in {min(s, 2) for s in sizes}}
    size = F.when(F.col("n") == 1, F.lit(known.get(1))).otherwise(F.lit(known.get(2)))
    settings = F.array(
        *[
            F.struct(
                F.lit(i).alias("config_ord"), F.lit(c.n).alias("config_n"), F.lit(c.smoothing).alias("smoothing"),
                F.lit(c.k).cast("double").alias("k"),
            )
            for i, c in enumerate(configurations)
        ]
    )
    rows = profile.select("*", F.inline(F.filter(settings, lambda s: s["config_n"] == F.col("n"))))
    c, ct, w, w_acc, place = (F.col(x) for x in ("c", "ct", "w", "w_acc", "place"))
    p = F.lit(None).cast("double")
    for config in {(x.smoothing, x.k) for x in configurations}:
        same = (F.col("smoothing") == config[0]) & F.col("k").eqNullSafe(F.lit(config[1]).cast("double"))
        p = F.when(same, smoothed_probability(c, ct, size, config[0], config[1] or 1.0)).otherwise(p)
    return (
        rows.withColumn("p", p)
        .groupBy("config_ord", "n", "smoothing", "k")
        .agg(
            _perplexity(_log_probability(F.col("p")), w).alias("perplexity"),
            *[
                F.coalesce(F.try_divide(_hits(w_acc, place, t), F.sum(w_acc)), F.lit(0.0)).alias(f"top{t}_acc")
                for t in TOP
            ],
            F.sum(w_acc).alias("total_predictions"),
        )
        .orderBy("config_ord")
    )


def best_configs(results: DataFrame) -> DataFrame:
    """The configuration of lowest perplexity and that of highest top-1 accuracy.

    Ties go to the first configuration.  ``model_k`` is the k a model of that configuration
    is built with afterwards.
    """
    lowest = F.struct(F.col("perplexity"), F.col("config_ord"))
    highest = F.struct(-F.col("top1_acc"), F.col("config_ord"))
    row = F.struct("config_ord", "n", "smoothing", "k", "perplexity", "top1_acc", "top3_acc", "top5_acc")
    best = results.agg(
        F.min_by(row, F.when(F.col("perplexity").isNotNull(), lowest)).alias("lowest_perplexity"),
        F.min_by(row, highest).alias("highest_accuracy"),
    )
    listed = best.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("criterion"), F.col(c).alias("best"))
                    for c in ("lowest_perplexity", "highest_accuracy")
                ]
            )
        )
    )
    model_k = F.when(F.col("smoothing") == "add-k", 0.1).otherwise(1.0)
    return listed.select("criterion", "best.*").withColumn("model_k", model_k)


def fit_for(
    settings: NGramModel, train: DataFrame, asked: DataFrame,
    tokens: str = "code_tokens", order: str = "row_ord",
) -> AskedModel:
    """A model of ``train`` restricted to the contexts of the rows it will be asked about."""
    return AskedModel(settings, train, asked, tokens, order)
