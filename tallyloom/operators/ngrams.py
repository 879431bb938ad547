"""Count-based n-gram models.

A model is three tables: counts per (context, next token), totals per context and the
size of the vocabulary.  Contexts are arrays of tokens, so no separator can clash.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql import WindowSpec

from ..session import stored, stored_parts
from .ordinals import MAX_BROADCAST_ROWS

# The sentinels of a padded sequence.
START, END = "<START>", "<END>"
SMOOTHINGS = ("none", "laplace", "add-k")
# Arrays hold fewer positions than this, so ``first_seen`` packs any row order with any position.
_POSITIONS = 1 << 31
_PACKED = "decimal(38,0)"
# Windows of so many tokens and more are gathered by context before they are counted.
LONG_CONTEXTS = 3
# Windows that are gathered in one task, and windows that lie in shuffle files at once.  A table is
# gone through in so many parts at most, so the work grows with the table and no faster.
TASK_WINDOWS, PART_WINDOWS, MAX_PARTS = 250_000, 30_000_000, 4
# (number, of): the windows of one of several parts.
Part = tuple[int, int]


def count_windows(df: DataFrame, tokens: str = "code_tokens") -> int:
    """Windows of any one size, which no table of counts of that size has more rows than."""
    return df.agg(F.sum(F.size(tokens) + 1)).first()[0] or 0


def parts_of(windows: int) -> list[Part]:
    """The parts in which so many windows are gathered."""
    of = min(max(-(-windows // PART_WINDOWS), 1), MAX_PARTS)
    return [(number, of) for number in range(of)]


def gathered(df: DataFrame, windows: int, *keys: str) -> DataFrame:
    """``df`` moved by ``keys`` to so many tasks that none has to spill what it gathers."""
    tasks = -(-windows // TASK_WINDOWS)
    if tasks <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return df.repartition(*keys)
    return df.repartition(tasks, *keys)


def in_part(context: Column, length: Column, part: Part) -> Column:
    """Whether a context is of this part, by the last two of its tokens; ``length`` is where it ends in ``context``."""
    number, of = part
    if of == 1:
        return F.lit(True)
    # Hashing skips nulls, which only brings a few contexts together.
    return F.pmod(F.hash(F.get(context, length - 2), F.get(context, length - 1)), F.lit(of)) == number


def pad(tokens: Column, n: int) -> Column:
    """N-1 start sentinels, the tokens, one end sentinel."""
    return F.concat(F.array_repeat(F.lit(START), n - 1), tokens, F.array(F.lit(END)))


def fit_context(tokens: Column, n: int) -> Column:
    """The last n-1 tokens, filled up with start sentinels on the left."""
    width = n - 1
    if width == 0:
        return F.slice(tokens, 1, 0)
    missing = F.greatest(F.lit(width) - F.size(tokens), F.lit(0))
    kept = F.least(F.size(tokens), F.lit(width))
    tail = F.slice(tokens, F.size(tokens) - kept + 1, kept)
    return F.concat(F.array_repeat(F.lit(START), missing), tail)


def extract_ngrams(
    df: DataFrame, n: int | Sequence[int], tokens: str = "code_tokens", keep: Sequence[str] = (), part: Part = (0, 1)
) -> DataFrame:
    """Every window of every sequence as (n, ctx, nxt, pos); ``pos`` counts from 1.

    Positions are exploded, not windows: a task holds one padded array and slices it row
    by row.  Several sizes share one scan, since a shorter context is the end of a longer.
    ``part``, for sizes of ``LONG_CONTEXTS`` and more, gives the windows of one part only.
    """
    sizes = [n] if isinstance(n, int) else sorted(set(n))
    widest = max(sizes)
    # Padding stands below the explode, or it would be done again for every position.  A
    # missing list has no size and yields no position.
    padded = df.select(*keep, pad(F.col(tokens), widest).alias("__padded"))
    last = F.size("__padded") - (widest - 1)
    positions = padded.select(*keep, "__padded", F.explode(F.sequence(F.lit(1), last)).alias("pos"))
    positions = positions.where(in_part(F.col("__padded"), F.col("pos") + (widest - 2), part))

    def context(size: int) -> Column:
        return F.slice("__padded", F.col("pos") + (widest - size), size - 1)

    nxt = F.element_at("__padded", F.col("pos") + (widest - 1)).alias("nxt")
    if len(sizes) == 1:
        return positions.select(
            *keep, F.lit(widest).alias("n"), context(widest).alias("ctx"), nxt, "pos"
        )
    windows = F.array(*[F.struct(F.lit(s).alias("n"), context(s).alias("ctx")) for s in sizes])
    return positions.select(*keep, F.inline(windows), nxt, "pos")


def first_seen(order: Column, pos: Column) -> Column:
    """Row order and position packed into one number, so that the minimum stays a hash aggregate.

    The decimal holds every 64-bit order with every position.  Rows without an order give null.
    """
    packed = order.cast("bigint").cast(_PACKED) * F.lit(_POSITIONS).cast(_PACKED) + pos.cast(_PACKED)
    return packed.cast(_PACKED)


def _mark(token: Column) -> Column:
    """A token to be hashed.  Hashing skips nulls: a null has a sign, and tokens that begin with that sign get another."""
    sign = F.lit("\0")
    return F.when(token.isNull(), sign).when(token.startswith("\0"), F.concat(sign, token)).otherwise(token)


def _tokens_of(ctx: Column, n: int) -> list[Column]:
    """The n-1 tokens of a context as columns, which Spark compiles; it does not compile functions over lists."""
    return [F.get(ctx, F.lit(i)) for i in range(n - 1)]


def context_hashes(ctx: Column, n: int | None = None) -> list[Column]:
    """``a`` and ``b`` of ``fingerprints`` for a context of the shortest size.

    The hash of a list is that of its tokens, so both ways give the same; with ``n`` it is faster.
    """
    marked = [_mark(token) for token in _tokens_of(ctx, n)] if n else [F.transform(ctx, _mark)]
    return [F.xxhash64(F.lit(1), *marked).alias("a"), F.hash(F.lit(2), *marked).alias("b")]


def fingerprints(
    df: DataFrame, sizes: Sequence[int], tokens: str = "code_tokens", keep: Sequence[str] = (), context: bool = False,
    part: Part = (0, 1),
) -> DataFrame:
    """Every position once, as (a, b, pos, nxt, longer), where only equality of contexts matters.

    ``a`` and ``b`` are 96 bits of hashes of the shortest context.  ``longer``, for several sizes, has
    64 bits more for every longer one, which ends with the shortest, so all sizes meet where their
    shortest contexts do.  With ``context`` the tokens of the longest are there too, as ``ctx``.
    """
    first, *others = sorted(sizes)
    widest = max(sizes)
    lists = {"__marked": pad(F.transform(tokens, _mark), widest), "__tokens": F.col(tokens)}
    if context:
        lists["__padded"] = pad(F.col(tokens), widest)
    padded = df.select(*keep, *[column.alias(name) for name, column in lists.items()])
    last = F.size("__marked") - (widest - 1)
    positions = padded.select(*keep, *lists, F.explode(F.sequence(F.lit(1), last)).alias("pos"))
    positions = positions.where(in_part(F.col("__marked"), F.col("pos") + (widest - 2), part))
    whole = [F.slice("__padded", F.col("pos"), widest - 1).alias("ctx")] if context else []

    def marked_context(size: int) -> Column:
        return F.slice("__marked", F.col("pos") + (widest - size), size - 1)

    def hashed(size: int, seed: int) -> Column:
        return F.xxhash64(F.lit(seed), marked_context(size))

    shortest = marked_context(first)
    longer = [F.array(*[hashed(size, 3) for size in others]).alias("longer")] if others else []
    nxt = F.when(F.col("pos") <= F.size("__tokens"), F.get("__tokens", F.col("pos") - 1)).otherwise(F.lit(END))
    return positions.select(
        hashed(first, 1).alias("a"), F.hash(F.lit(2), shortest).alias("b"), "pos", *keep, nxt.alias("nxt"), *longer, *whole
    )


def count_ngrams(ngrams: DataFrame, order: str = "row_ord") -> DataFrame:
    """A9 on extracted windows that keep the row order."""
    return ngrams.groupBy("n", "ctx", "nxt").agg(
        F.count(F.lit(1)).alias("c"),
        F.min(first_seen(F.col(order), F.col("pos"))).alias("first_seen"),
    )


def _escaped(token: Column) -> Column:
    """Escaped tokens are joined by U+0001; a null is U+0000 n, and both characters are escaped in tokens."""
    replaced = F.replace(F.replace(token, F.lit("\0"), F.lit("\0a")), F.lit("\1"), F.lit("\0b"))
    odd = token.contains("\0") | token.contains("\1")
    return F.when(token.isNull(), F.lit("\0n")).when(odd, replaced).otherwise(token)


def packed(ctx: Column, n: int) -> Column:
    """A context as one string; see ``unpacked``."""
    return F.concat_ws("\1", *[_escaped(token) for token in _tokens_of(ctx, n)])


def unpacked(df: DataFrame) -> DataFrame:
    """``ctx`` of a table of packed counts as lists of tokens again."""

    def plain(part: Column) -> Column:
        restored = F.replace(F.replace(part, F.lit("\0b"), F.lit("\1")), F.lit("\0a"), F.lit("\0"))
        return F.when(part == "\0n", F.lit(None)).when(part.contains("\0"), restored).otherwise(part)

    parts = F.split("ctx", "\1", -1)
    parts = F.when(F.col("ctx").contains("\0"), F.transform(parts, plain)).otherwise(parts)
    # With an empty context there is nothing to tell apart.
    lists = F.when(F.col("n") == 1, F.array().cast("array<string>")).otherwise(parts)
    return df.withColumn("ctx", lists)


def packed_counts(
    df: DataFrame, n: int | Sequence[int], tokens: str = "code_tokens", order: str = "row_ord", gather: bool = True,
    part: Part = (0, 1), windows: int = 0,
) -> DataFrame:
    """A9 with packed contexts, for what groups by context afterwards; see ``unpacked``.

    Most longer windows are different, so counting them in every task first only spills them.
    They move once, to where all windows of their context are: ranks and totals by context
    need no other shuffle.  Short contexts may hold any share of the windows and are few.  Without
    ``gather`` every size is counted in the tasks first.  ``part`` counts the windows of one part,
    and ``windows``, where known, says how many those are about.
    """
    lists = df.select(order, F.col(tokens).alias("__plain"), F.transform(tokens, _escaped).alias(tokens))
    ngrams = extract_ngrams(lists, n, tokens, [order, "__plain"], part)
    nxt = F.when(F.col("pos") <= F.size("__plain"), F.get("__plain", F.col("pos") - 1)).otherwise(F.lit(END))
    ngrams = ngrams.select("n", F.array_join("ctx", "\1").alias("ctx"), nxt.alias("nxt"), order, "pos")
    if gather and (n if isinstance(n, int) else min(n)) >= LONG_CONTEXTS:
        ngrams = gathered(ngrams.select("ctx", "pos", order, "nxt", "n"), windows, "ctx")
    return count_ngrams(ngrams, order)


def ngram_counts(
    df: DataFrame, n: int | Sequence[int], tokens: str = "code_tokens", order: str = "row_ord"
) -> DataFrame:
    """How often each token follows each context, and where that was first seen."""
    return unpacked(packed_counts(df, n, tokens, order))


def context_totals(counts: DataFrame) -> DataFrame:
    """A10: occurrences of each context."""
    return counts.groupBy("n", "ctx").agg(F.sum("c").alias("ct"))


def vocabulary_size(df: DataFrame, n: int, tokens: str = "code_tokens", approximate: bool = False) -> DataFrame:
    """One row ``v``, the distinct tokens with the sentinels that occur in training.

    Each sequence contributes its own distinct tokens, which are then merged.
    """
    token = F.explode(F.array_distinct(pad(F.col(tokens), min(n, 2)))).alias("token")
    words = df.select(token)
    if approximate:
        return words.agg(F.approx_count_distinct("token").alias("v"))
    return words.agg(F.count_distinct("token").alias("v"))


def smoothed_probability(c: Column, ct: Column, v: Column, smoothing: str, k: float = 1.0) -> Column:
    """Probability of a token seen ``c`` times in a context seen ``ct`` times."""
    if smoothing == "none":
        return F.coalesce(F.try_divide(c.cast("double"), ct.cast("double")), F.lit(0.0))
    if smoothing not in SMOOTHINGS:
        raise ValueError(f"unknown smoothing {smoothing!r}; expected one of {SMOOTHINGS}")
    added = 1.0 if smoothing == "laplace" else float(k)
    return F.try_divide(c + F.lit(added), ct + F.lit(added) * v)


def lookup_counts(pairs: DataFrame, counts: DataFrame, totals: DataFrame) -> DataFrame:
    """``c`` of each (n, ctx, nxt) and ``ct`` of each (n, ctx); 0 where never seen."""
    zero = F.lit(0).cast("bigint")
    return (
        pairs.join(counts.select("n", "ctx", "nxt", "c"), ["n", "ctx", "nxt"], "left")
        .join(totals, ["n", "ctx"], "left")
        .withColumns({"c": F.coalesce("c", zero), "ct": F.coalesce("ct", zero)})
    )


# What tells contexts apart.
CONTEXT = ("n", "ctx")


def _best_first(by: Sequence[str] = CONTEXT) -> WindowSpec:
    """Both ranking steps use this window, so the rows are sorted once."""
    return W.partitionBy(*by).orderBy(F.desc("c"), F.asc_nulls_last("first_seen"), F.asc("nxt"))


def next_token_topk(counts: DataFrame, k: int = 5, by: Sequence[str] = CONTEXT) -> DataFrame:
    """The k most frequent next tokens of each context; ties by first appearance.

    The rank limit applies inside every task first, so a context with very many
    continuations sends at most k of them per task.
    """
    return counts.withColumn("rank", F.row_number().over(_best_first(by))).where(F.col("rank") <= k)


def candidate_lists(counts: DataFrame, k: int = 5, by: Sequence[str] = CONTEXT) -> DataFrame:
    """One row per context: its k most frequent continuations as an array of (nxt, c), and its ``ct`` if there.

    The row ranked first looks at the k-1 rows after it, which needs no aggregation.  ``by`` names
    hashes that stand for the context; then ``ctx`` only goes with them.
    """
    item = F.struct("nxt", "c")
    following = [F.lead(item, i).over(_best_first(by)) for i in range(1, k)]
    listed = F.array_compact(F.array(item, *following)).alias("candidates")
    others = [c for c in counts.columns if c == "ct" or (c == "ctx" and c not in by)]
    return next_token_topk(counts, k, by).select(*by, "rank", listed, *others).where("rank = 1").drop("rank")


def with_totals(counts: DataFrame, by: Sequence[str] = CONTEXT) -> DataFrame:
    """A10 as a column ``ct`` of the counts, in the order that ranks them; a context is one task's."""
    everything = _best_first(by).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return counts.withColumn("ct", F.sum("c").over(everything))


def lookup_topk(queries: DataFrame, candidates: DataFrame, how: str = "inner") -> DataFrame:
    """The candidate list of each (n, ctx); ``inner`` drops unseen contexts."""
    return queries.join(candidates, ["n", "ctx"], how)


@dataclass(frozen=True)
class NGramModel:
    """Settings of a model; ``fit`` counts a training table."""

    n: int = 3
    smoothing: str = "laplace"
    k: float = 1.0

    def __post_init__(self) -> None:
        if self.n < 1:
            raise ValueError("n must be at least 1")
        if self.smoothing not in SMOOTHINGS:
            raise ValueError(f"unknown smoothing {self.smoothing!r}; expected one of {SMOOTHINGS}")

    def fit(
        self,
        df: DataFrame,
        tokens: str = "code_tokens",
        order: str = "row_ord",
        contexts: DataFrame | None = None,
    ) -> FittedNGramModel:
        """Count ``df``.  The counts are written to the checkpoint folder once; the
        vocabulary is counted when a smoothed probability is first asked for.

        ``contexts`` (n, ctx), if given, restricts the model to the contexts a later
        evaluation will ask for; every answer about those is unchanged.

        Windows of long contexts are gathered and counted part by part, from token lists that
        are made once; a context's windows are all in one part.
        """
        if self.n >= LONG_CONTEXTS:
            df = stored(df.select(order, tokens))
            windows = count_windows(df, tokens)
            parts = parts_of(windows)
            if contexts is None:
                counts = stored_parts(
                    unpacked(packed_counts(df, self.n, tokens, order, part=part, windows=windows // len(parts))) for part in parts
                )
            else:
                counts = counts_for(df, self.n, contexts, windows, tokens, order)
        elif contexts is None:
            counts = stored(ngram_counts(df, self.n, tokens, order))
        else:
            ngrams = restrict_to_contexts(extract_ngrams(df, self.n, tokens, [order]), contexts)
            counts = stored(count_ngrams(ngrams, order))
        return FittedNGramModel(self, counts, vocabulary_size(df, self.n, tokens), contexts is not None)


def counts_for(
    df: DataFrame, n: int, contexts: DataFrame, windows: int, tokens: str = "code_tokens", order: str = "row_ord"
) -> DataFrame:
    """A9 of the contexts (n, ctx) that are asked for, stored; for n of ``LONG_CONTEXTS`` and more.

    Windows carry the hashes of their contexts, and only the contexts asked for their tokens.  Few
    of these go to every task; otherwise both meet part by part.
    """
    columns = [F.lit(n).alias("n"), "ctx", "nxt", "c", "first_seen"]
    asked = contexts.where((F.col("n") == n) & F.col("ctx").isNotNull()).select(*context_hashes(F.col("ctx"), n), "ctx")
    asked = stored(asked.distinct())
    n_asked = asked.count()
    few = n_asked <= MAX_BROADCAST_ROWS
    parts = [(0, 1)] if few else parts_of(max(windows, n_asked))

    def counted(part: Part) -> DataFrame:
        seen = fingerprints(df, [n], tokens, [order], part=part).select("a", "b", F.col("pos").cast("int").alias("pos"), order, "nxt")
        wanted = asked.where(in_part(F.transform("ctx", _mark), F.lit(n - 1), part))
        if few:
            seen = seen.join(F.broadcast(wanted), ["a", "b"])
        else:
            each = windows // len(parts)
            seen = gathered(seen, each, "a", "b").join(gathered(wanted, each, "a", "b").hint("shuffle_hash"), ["a", "b"])
        return seen.groupBy("a", "b", "ctx", "nxt").agg(
            F.count(F.lit(1)).alias("c"), F.min(first_seen(F.col(order), F.col("pos"))).alias("first_seen")
        ).select(*columns)

    return stored_parts(map(counted, parts))


def restrict_to_contexts(ngrams: DataFrame, contexts: DataFrame) -> DataFrame:
    """Windows whose (n, ctx) is asked for, and possibly a few others.

    Windows meet the set of the contexts' hashes, so a window whose context shares a hash
    with another may stay too; contexts themselves are compared later.  The set is stored,
    so its size is known, and Spark picks how to join by that size.
    """
    key = F.xxhash64("n", "ctx").alias("__context")
    wanted = stored(contexts.select(key).distinct())
    return ngrams.withColumn("__context", key).join(wanted, "__context", "left_semi").drop("__context")


@dataclass(frozen=True)
class FittedNGramModel:
    """A trained model: ``counts(n, ctx, nxt, c, first_seen)`` and ``vocabulary(v)``.

    A ``restricted`` model knows only the contexts it was fitted for.
    """

    settings: NGramModel
    counts: DataFrame
    vocabulary: DataFrame
    restricted: bool = False

    @property
    def n(self) -> int:
        return self.settings.n

    @cached_property
    def totals(self) -> DataFrame:
        return context_totals(self.counts)

    @cached_property
    def vocab_size(self) -> int:
        return self.vocabulary.first()["v"]

    def with_smoothing(self, smoothing: str, k: float = 1.0) -> FittedNGramModel:
        """The same counts under another smoothing; nothing is counted again."""
        return replace(self, settings=NGramModel(self.n, smoothing, k))

    def probability(self, c: Column, ct: Column) -> Column:
        v = F.lit(None if self.settings.smoothing == "none" else self.vocab_size)
        return smoothed_probability(c, ct, v, self.settings.smoothing, self.settings.k)

    def score(self, pairs: DataFrame) -> DataFrame:
        """Probability ``p`` of ``nxt`` after ``ctx``, of which the last n-1 tokens count, for every row."""
        fitted = pairs.withColumns({"n": F.lit(self.n), "ctx": fit_context(F.col("ctx"), self.n)})
        looked_up = lookup_counts(fitted, self.counts, self.totals)
        return looked_up.withColumn("p", self.probability(F.col("c"), F.col("ct")))

    def candidates(self, k: int = 5, counts: DataFrame | None = None) -> DataFrame:
        """Per context: its k best continuations as an array of (token, prob).

        ``counts``, if given, are the model's own, or those of some contexts, laid out in another way.
        Long contexts are totalled where they are ranked; short ones may have very many continuations.
        """
        prob = self.probability
        if self.n >= LONG_CONTEXTS:
            listed = candidate_lists(with_totals(self.counts if counts is None else counts), k)
        else:
            listed = candidate_lists(self.counts if counts is None else counts, k).join(self.totals, ["n", "ctx"])
        scored = F.transform(
            "candidates",
            lambda x: F.struct(x["nxt"].alias("token"), prob(x["c"], F.col("ct")).alias("prob")),
        )
        return listed.select("n", "ctx", scored.alias("candidates"))

    def predict(self, prompts: DataFrame, k: int = 5, context: str = "context") -> DataFrame:
        """Add ``predictions``, at most k (token, prob); empty for an unseen context.

        Counts of other contexts are left where they are.
        """
        fitted = prompts.withColumn("n", F.lit(self.n)).withColumn("ctx", fit_context(F.col(context), self.n))
        counts = self.counts
        if not self.restricted:
            asked = fitted.select(F.col("n").cast(counts.schema["n"].dataType).alias("n"), "ctx")
            counts = restrict_to_contexts(counts, asked)
        found = lookup_topk(fitted, self.candidates(k, counts), "left")
        none = F.array().cast("array<struct<token:string,prob:double>>")
        return found.withColumn("predictions", F.coalesce("candidates", none)).drop("n", "ctx", "candidates")

    def complete(self, prompts: DataFrame, max_length: int = 20, seed: int = 42, **names: str) -> DataFrame:
        """N9; see ``generation.complete``."""
        from .generation import complete

        return complete(self, prompts, max_length, seed, **names)

    def save(self, path: str) -> None:
        """Write the tables as Parquet under ``path``, counts by n; a restricted model refuses."""
        if self.restricted:
            raise ValueError("this model holds only some contexts; fit it without contexts to save it")
        self.counts.write.partitionBy("n").mode("overwrite").parquet(f"{path}/counts")
        self.vocabulary.write.mode("overwrite").parquet(f"{path}/vocabulary")

    @staticmethod
    def load(spark: SparkSession, path: str, settings: NGramModel) -> FittedNGramModel:
        counts = spark.read.parquet(f"{path}/counts").where(F.col("n") == settings.n)
        return FittedNGramModel(
            settings,
            counts.select("n", "ctx", "nxt", "c", "first_seen"),
            spark.read.parquet(f"{path}/vocabulary"),
        )
