"""Prompts, predictions and sampled completions in batch."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.bands import format_predictions
from ..functions.randomness import uniform
from ..session import discard, release, scratch_path, stored
from .ngrams import END, LONG_CONTEXTS, candidate_lists, context_hashes, fit_context, in_part, packed, parts_of, unpacked, with_totals

if TYPE_CHECKING:
    from .ngrams import FittedNGramModel

Lookup = Callable[[DataFrame, DataFrame], DataFrame]

# Prompt lengths, number of candidates, and tokens that end a completion.
MIN_CONTEXT, MAX_CONTEXT = 3, 10
TOP_CANDIDATES = 5
STOP_TOKENS = ("}", ";")
MAX_COMPLETION = 50
# Rows a bucket of the candidate table may hold, of it or of the contexts looked up there.
BUCKET_ROWS = 1_000_000
# Contexts that were found, five candidates each, are sent to every task up to this many.
BROADCAST_CONTEXTS = 100_000


def min_prompt_length(tokens: str = "code_tokens", minimum: int = MIN_CONTEXT) -> Column:
    """F8: sequences longer than the shortest prompt."""
    return F.size(tokens) > minimum


def make_prompts(
    df: DataFrame, row_id: str = "row_ord", tokens: str = "code_tokens", seed: int = 42,
    minimum: int = MIN_CONTEXT, maximum: int = MAX_CONTEXT,
) -> DataFrame:
    """Add ``context``, the first m tokens, m random from 3 to 10 but short of the whole."""
    longest = F.least(F.lit(maximum), F.size(tokens) - 1)
    draw = uniform(f"{seed}:prompt", F.col(row_id))
    length = F.lit(minimum) + F.floor(draw * (longest - minimum + 1)).cast("int")
    return df.where(min_prompt_length(tokens, minimum)).withColumn(
        "context", F.slice(F.col(tokens), F.lit(1), length)
    )


def backoff_tries(context: Column, n: int) -> Column:
    """The contexts to look up, best first, as an array of (level, ctx).

    Tokens are dropped from the left one by one and each rest is filled up again, so only
    the last n-1 tokens matter and there are at most n-1 tries.
    """
    length = F.size(context)
    tries = F.when(length > 0, F.greatest(F.least(length, F.lit(n - 1)), F.lit(1))).otherwise(F.lit(0))
    levels = F.when(tries > 0, F.sequence(F.lit(0), tries - 1)).otherwise(F.array().cast("array<int>"))

    def at(level: Column) -> Column:
        kept = tries - level
        rest = F.slice(context, length - kept + 1, kept)
        return F.struct(level.alias("level"), fit_context(rest, n).alias("ctx"))

    return F.transform(levels, at)


def _backoff(row_id: str, columns: Sequence[str], context: Column, n: int) -> Lookup:
    """N7 as a function of (prompts, candidates) whose expressions are built only once."""
    level_of = F.when(F.col("candidates").isNotNull(), F.col("level"))
    exploded = [
        F.col(row_id),
        F.struct(*columns).alias("__prompt"),
        F.posexplode_outer(backoff_tries(context, n)).alias("__at", "__try"),
    ]
    tries = [
        F.col(row_id),
        F.when(F.coalesce("__at", F.lit(0)) == 0, F.col("__prompt")).alias("__prompt"),
        F.col("__try.level").alias("level"),
        F.col("__try.ctx").alias("ctx"),
    ]
    winner = [
        F.first("__prompt", ignorenulls=True).alias("__prompt"),
        F.min(level_of).alias("level"),
        F.min_by("candidates", level_of).alias("candidates"),
    ]
    result = [F.col(row_id), F.col("__prompt.*"), F.col("level"), F.col("candidates")]

    def look_up(prompts: DataFrame, candidates: DataFrame) -> DataFrame:
        found = prompts.select(*exploded).select(*tries).join(candidates, "ctx", "left")
        return found.groupBy(row_id).agg(*winner).select(*result)

    return look_up


def backoff_candidates(
    prompts: DataFrame, candidates: DataFrame, n: int, row_id: str = "row_ord", context: str = "context"
) -> DataFrame:
    """Add the ``level`` and ``candidates`` of the first try that was seen in training.

    ``candidates`` is a table (ctx, candidates) of a model of size ``n``.  One row per try
    is joined; the prompt's own columns travel with its first try only and come together
    again when the lowest level is picked.
    """
    columns = [c for c in prompts.columns if c != row_id]
    look_up = _backoff(row_id, columns, F.col(context), n)
    return look_up(prompts, candidates.select("ctx", "candidates"))


def sample_next(candidates: Column, draw: Column) -> Column:
    """The candidate at which the running share of probability exceeds ``draw``.

    Null when there are no candidates or all have probability 0.
    """
    def total(items: Column) -> Column:
        return F.aggregate(items, F.lit(0.0), lambda acc, c: acc + c["prob"])

    running = F.transform(candidates, lambda _, i: total(F.slice(candidates, F.lit(1), i + 1)))
    everything = total(candidates)
    below = F.size(F.filter(running, lambda r: r <= draw * everything))
    chosen = F.try_element_at(candidates, F.least(below + 1, F.size(candidates)))["token"]
    return F.when((F.size(candidates) > 0) & (everything > 0), chosen)


def buckets_for(rows: int, spark: SparkSession) -> int:
    """Enough buckets that none holds much more than ``BUCKET_ROWS`` rows, and every core has one."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // BUCKET_ROWS))


@contextmanager
def candidate_table(model: FittedNGramModel, asked: int) -> Iterator[DataFrame]:
    """The model's best continuations, bucketed by context in the shared folder.

    A row has the hashes ``a`` and ``b`` of its context, the best token with its count, the context's
    total, and the other tokens where there are any: what a lookup reads of the many rows that are
    not asked for are a few flat columns.  Its buckets are what a shuffle by ``a`` would make, so contexts that
    are looked up are brought to them and the table itself stays where it is.  ``asked`` bounds the
    contexts looked up at once.  The catalog knows the table, and the folder is there, only while it is in use.
    """
    spark = model.counts.sparkSession
    rows = model.counts.count()
    buckets = buckets_for(max(rows, asked), spark)
    name, path = f"candidates_{uuid.uuid4().hex}", scratch_path(spark)
    keys = ["a", "b"]
    # The counts move once, to the buckets, and part by part: only a part's shuffle files are there at once.
    for part in parts_of(rows) if model.n >= LONG_CONTEXTS else [(0, 1)]:
        counts = model.counts.where(in_part(F.col("ctx"), F.lit(model.n - 1), part)).select(
            *context_hashes(F.col("ctx"), model.n), packed(F.col("ctx"), model.n).alias("ctx"), "nxt", "c", "first_seen"
        )
        if model.n >= LONG_CONTEXTS:
            listed = candidate_lists(with_totals(counts.repartition(buckets, "a"), keys), TOP_CANDIDATES, keys)
        else:
            totals = counts.groupBy(*keys).agg(F.sum("c").alias("ct"))
            listed = candidate_lists(counts, TOP_CANDIDATES, keys).join(totals, keys).repartition(buckets, "a")
        best, others = F.col("candidates")[0], F.slice("candidates", 2, TOP_CANDIDATES)
        laid_out = listed.select(
            *keys, best["nxt"].alias("nxt"), best["c"].alias("c"), "ct", F.when(F.size(others) > 0, others).alias("others"), "ctx"
        )
        laid_out.write.mode("append").bucketBy(buckets, "a").option("path", path).saveAsTable(name)
        release(spark)
    try:
        yield unpacked(spark.table(name).withColumn("n", F.lit(model.n))).drop("n")
    finally:
        spark.sql(f"DROP TABLE {name}")
        discard(spark, path)


def look_up(candidates: DataFrame, tries: DataFrame, few: bool = False) -> DataFrame:
    """The candidates of every context that is tried; only distinct contexts are shuffled.

    The contexts are the built side, so the table is streamed as it lies and never sorted.  They
    meet by one long number, and what is left of their hashes is compared after that.  Where they
    are ``few``, their hashes go to every task, and what is found has the hashes alone.
    """
    same = (F.col("a") == F.col("__a")) & (F.col("b").bitwiseXOR(F.col("__b")) == 0)
    hashes = [column.alias(name) for column, name in zip(context_hashes(F.col("ctx")), ("__a", "__b"), strict=True)]
    if few:
        return candidates.drop("ctx").join(F.broadcast(tries.select(*hashes)), same, "left_semi")
    wanted = tries.select("ctx").distinct().select("ctx", *hashes)
    return candidates.drop("ctx").join(wanted.hint("shuffle_hash"), same).drop("__a", "__b")


def complete(
    model: FittedNGramModel, prompts: DataFrame, max_length: int = 20, seed: int = 42,
    row_id: str = "row_ord", context: str = "context",
) -> DataFrame:
    """Sample a continuation of every prompt, one token per step for all of them.

    Adds ``completion`` (tokens) and ``steps`` (the candidates offered at each step).
    ``max_length`` bounds the output and is part of what is asked for.

    A step carries only ids and the last n-1 tokens of the prompts still open.  It looks up
    their distinct contexts in the bucketed candidates, which are not shuffled, and meets the
    prompts with what was found: sent to all tasks while few prompts are open, and otherwise
    stored, so that a context that very many prompts share is split there.
    Each step's rows are written once, as one part of a table; the number of open prompts
    is observed while they are.
    """
    spark, n = prompts.sparkSession, model.n
    width = max(n - 1, 1)
    last = lambda tokens: F.slice(tokens, F.greatest(F.size(tokens) - (width - 1), F.lit(1)), width)
    root = scratch_path(spark)

    def write(rows: DataFrame, open_: Column, name: str) -> int:
        seen = Observation()
        rows.observe(seen, F.count_if(open_).alias("open")).write.parquet(f"{root}/{name}")
        return seen.get["open"]

    start = prompts.select(row_id, last(F.col(context)).alias("tail"))
    left = write(start, F.lit(True), "start")
    state = spark.read.schema(start.schema).parquet(f"{root}/start")
    if not left or max_length <= 0:
        kind = "array<struct<token:string,prob:double>>"
        return prompts.withColumn("completion", F.array().cast("array<string>")).withColumn(
            "steps", F.array().cast(f"array<{kind}>")
        )
    # Expressions are the same in every step, so they are built once.
    asked = [F.col(row_id), F.col("tail"), F.inline(backoff_tries(F.col("tail"), n))]
    winner = [F.min_by("candidates", "level").alias("candidates"), F.any_value("tail").alias("tail")]
    listed = F.concat(F.array(F.struct("nxt", "c")), F.coalesce("others", F.array().cast("array<struct<nxt:string,c:bigint>>")))
    offered = F.transform(
        listed, lambda x: F.struct(x["nxt"].alias("token"), model.probability(x["c"], F.col("ct")).alias("prob"))
    )
    sampled = sample_next(F.col("candidates"), F.col("__draw")).alias("__token")
    emitted = F.col("__token") != END
    goes_on = F.coalesce(emitted & ~F.col("__token").isin(*STOP_TOKENS), F.lit(False))
    made = [
        F.col(row_id), F.when(emitted, F.col("__token")).alias("token"), F.col("candidates"), goes_on.alias("goes_on"),
        F.when(goes_on, last(F.concat("tail", F.array("__token")))).alias("tail"),
    ]
    with candidate_table(model, left * width) as candidates:
        for step in range(max_length):
            tries = state.select(*asked)
            # A prompt asks for at most n-1 contexts, so the number of open ones bounds what is found.
            few = left * width <= BROADCAST_CONTEXTS
            found = look_up(candidates, tries, few).select("a", "b", offered.alias("candidates"))
            found = F.broadcast(found) if few else stored(found)
            tries = tries.select(row_id, "tail", "level", *context_hashes(F.col("ctx")))
            draw = uniform(f"{seed}:step", F.lit(step), F.col(row_id)).alias("__draw")
            best = tries.join(found, ["a", "b"]).groupBy(row_id).agg(*winner).select(row_id, "candidates", "tail", draw)
            rows = best.select(row_id, "candidates", "tail", sampled).select(*made)
            left = write(rows, F.col("goes_on"), f"steps/step={step}")
            if not left:
                break
            written = spark.read.schema(rows.schema).parquet(f"{root}/steps/step={step}")
            state = written.where("goes_on").select(row_id, "tail")
    kinds = T.StructType([*rows.schema, T.StructField("step", T.IntegerType())])
    steps = spark.read.schema(kinds).parquet(f"{root}/steps")
    every = F.sort_array(F.collect_list(F.struct("step", "token", "candidates")))
    gathered = steps.groupBy(row_id).agg(every.alias("__steps"))
    completed = prompts.join(gathered, row_id, "left")
    return completed.withColumn("completion", F.filter(F.transform("__steps", lambda s: s["token"]), lambda t: t.isNotNull())).withColumns(
        {
            "completion": F.coalesce("completion", F.array().cast("array<string>")),
            "steps": F.transform(F.coalesce("__steps", F.array()), lambda s: s["candidates"]),
        }
    ).drop("__steps")


def prediction_rows(
    model: FittedNGramModel, test: DataFrame, row_id: str = "row_ord", tokens: str = "code_tokens",
    max_length: int = MAX_COMPLETION, seed: int = 42,
) -> DataFrame:
    """Prompt, formatted predictions and completed text of each test row."""
    prompts = make_prompts(test.select(row_id, tokens), row_id, tokens, seed).select(row_id, "context")
    # Read twice: where completion starts, and for the result.
    predicted = stored(model.predict(prompts, TOP_CANDIDATES))
    completed = complete(model, predicted, max_length, seed, row_id)
    return completed.select(
        row_id,
        F.array_join("context", " ").alias("input_context"),
        format_predictions(F.col("predictions")).alias("next_5_tokens (probability)"),
        F.concat(
            F.array_join("context", " "), F.lit(" "), F.array_join("completion", " ")
        ).alias("sampled_completion"),
    )
