"""Proportional sampling and stratified splitting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.randomness import seeded_hash
from ..session import materialize
from .cleaning import quality_filter
from .ordinals import with_ordinal
from .selection import with_chosen

# The sizes and the seed of the data set.
N_TRAIN = 20_000
N_TEST = 5_000
SEED = 42


def distinct_repos(df: DataFrame, repo: str = "repo_name") -> DataFrame:
    """A5: number of repositories, missing names not counted."""
    return df.agg(F.count_distinct(repo).alias("repos"))


def repo_distribution(df: DataFrame, repo: str = "repo_name") -> DataFrame:
    """Rows per repository, largest first."""
    counts = df.where(F.col(repo).isNotNull()).groupBy(repo).agg(F.count(F.lit(1)).alias("rows"))
    return counts.orderBy(F.col("rows").desc(), repo)


def split_report(df: DataFrame, repo: str = "repo_name") -> DataFrame:
    """Train and test rows per repository."""
    split = F.col("dataset_split")
    return df.groupBy(repo).agg(
        F.count_if(split == "train").alias("train_rows"), F.count_if(split == "test").alias("test_rows")
    )


def sample_quotas(
    counts: DataFrame, n: int, on_shortfall: str = "skip", repo: str = "repo_name"
) -> DataFrame:
    """Rows to draw from each repository of (repo, rows): its share of ``n``, rounded down.

    The total counts rows without a repository, which are never drawn.  Where a quota
    exceeds what a repository has, ``skip`` leaves the repository out and ``all`` takes
    everything it has.
    """
    if on_shortfall not in ("skip", "all"):
        raise ValueError(f"unknown on_shortfall {on_shortfall!r}")
    total = counts.agg(F.sum("rows").alias("total")).scalar()
    share = F.col("rows").cast("double") / total
    wanted = F.floor(F.lit(n) * share)
    quotas = counts.where(F.col(repo).isNotNull()).select(repo, "rows", wanted.alias("quota"))
    if on_shortfall == "skip":
        quotas = quotas.where(F.col("quota") <= F.col("rows"))
    else:
        quotas = quotas.withColumn("quota", F.least("quota", "rows"))
    return quotas.where(F.col("quota") > 0)


def proportional_sample(
    df: DataFrame,
    n: int = N_TRAIN + N_TEST,
    seed: int = SEED,
    on_shortfall: str = "skip",
    repo: str = "repo_name",
    row_id: str = "id",
) -> DataFrame:
    """A random sample of each repository in proportion to its size."""
    marked = with_chosen(
        df, repo, seed, [row_id], lambda counts: sample_quotas(counts, n, on_shortfall, repo), "__chosen"
    )
    return marked.where("__chosen").drop("__chosen")


def shuffle(df: DataFrame, seed: int = SEED, row_id: str = "id") -> DataFrame:
    """T4: all rows in a random order that depends on the seed and each row's id only."""
    return df.orderBy(seeded_hash(seed, F.col(row_id)), F.col(row_id))


def split_quotas(counts: DataFrame, test_fraction: float, repo: str = "repo_name") -> DataFrame:
    """Training rows per repository of (repo, rows), by the largest-remainder rule.

    The test set has ``ceil(fraction * rows)`` rows.  Every repository gets its training
    share rounded down; the rows still missing go to the largest remainders, then by name.
    A repository with one row is all training.
    """
    splittable = F.col("rows") > 1
    sums = counts.agg(
        F.sum("rows").alias("__all"), F.coalesce(F.sum(F.when(splittable, F.col("rows"))), F.lit(0)).alias("__n")
    )
    n = sums.select("__n").scalar()
    n_test = F.least(F.ceil(F.lit(test_fraction) * sums.select(F.col("__all").cast("double")).scalar()), n)
    exact = F.col("rows") / n * (n - n_test)
    shares = counts.where(splittable).select(
        repo,
        "rows",
        F.floor(exact).alias("__base"),
        (exact - F.floor(exact)).alias("__rest"),
        (n - n_test).alias("__n_train"),
    )
    ranked = with_ordinal(shares, [F.col("__rest").desc(), F.col(repo).asc()], name="__no")
    missing = ranked.agg((F.max("__n_train") - F.sum("__base")).alias("m")).scalar()
    extra = (F.col("__no") <= missing).cast("bigint")
    return ranked.select(repo, "rows", (F.col("__base") + extra).alias("train_rows")).unionByName(
        counts.where(~splittable).select(repo, "rows", F.col("rows").alias("train_rows"))
    )


def stratified_split(
    df: DataFrame,
    test_fraction: float,
    seed: int = SEED,
    repo: str = "repo_name",
    row_id: str = "id",
) -> DataFrame:
    """Set ``dataset_split`` so that every repository is split in the same proportion."""
    def train_quota(counts: DataFrame) -> DataFrame:
        return split_quotas(counts, test_fraction, repo).withColumnRenamed("train_rows", "quota")

    marked = with_chosen(df, repo, f"split:{seed}", [row_id], train_quota, "__train")
    split = F.when(F.col("__train"), F.lit("train")).otherwise(F.lit("test"))
    return marked.withColumn("dataset_split", split).drop("__train")


def order_splits(df: DataFrame, seed: int = SEED, row_id: str = "id") -> DataFrame:
    """Number all rows from 0 as ``row_ord``: training rows first, shuffled inside a split."""
    second = F.col("dataset_split") == "test"
    unnumbered = df.drop("row_ord")
    numbered = with_ordinal(unnumbered, [second, seeded_hash(seed, F.col(row_id)), F.col(row_id)], name="row_ord")
    return numbered.withColumn("row_ord", F.col("row_ord") - 1)


def union_splits(
    train: DataFrame, test: DataFrame, seed: int = SEED, row_id: str = "id"
) -> DataFrame:
    """Training rows, then test rows; ``row_ord`` makes that order explicit."""
    return order_splits(
        train.withColumn("dataset_split", F.lit("train")).unionByName(
            test.withColumn("dataset_split", F.lit("test"))
        ),
        seed,
        row_id,
    )


def sample_from_large_repos(
    df: DataFrame,
    n_train: int = N_TRAIN,
    n_test: int = N_TEST,
    seed: int = SEED,
    on_shortfall: str = "skip",
) -> DataFrame:
    """R2: quality filter, proportional sample, stratified split, training rows first.

    The sample is written down once: it has at most ``n_train + n_test`` rows and three
    later steps read it.
    """
    sampled = materialize(
        proportional_sample(quality_filter(df), n_train + n_test, seed, on_shortfall)
    )
    return order_splits(stratified_split(sampled, n_test / (n_train + n_test), seed), seed)
