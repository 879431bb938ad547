"""Duplicate methods."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .cleaning import METHOD_KEY
from .ordinals import join_on


def duplicate_report(df: DataFrame, keys: Sequence[str] = METHOD_KEY) -> DataFrame:
    """Every row whose key occurs more than once, sorted by key; null keys are equal.

    Counting before joining keeps a key with very many copies to one row per task on the
    counting side, and the join may split it.  The row's hash ends the sort order so that
    such a key can also be sorted by several tasks.
    """
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows")).where(F.col("__rows") > 1)
    rows = join_on(df, repeated.select(*keys), keys, "left_semi")
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    return rows.orderBy(*[F.col(k).asc_nulls_last() for k in keys], row_hash)


def dedupe_keep_last(
    df: DataFrame, keys: Sequence[str] = METHOD_KEY, sha: str = "repo_commit_sha", tie: str = "id"
) -> DataFrame:
    """Per key the row with the largest commit hash; a missing hash wins, then ``tie``.

    ``row_number() = 1`` lets Spark keep one row per key in every task before the shuffle.
    """
    latest_first = W.partitionBy(*keys).orderBy(
        F.col(sha).desc_nulls_first(), F.col(tie).desc_nulls_first()
    )
    return df.withColumn("__no", F.row_number().over(latest_first)).where("__no = 1").drop("__no")
