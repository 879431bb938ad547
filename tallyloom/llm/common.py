"""What the operators of this folder share: words, reading tables, identities, components."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stored

# White space is these six ASCII characters, a word is a run of others.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

# Components stop by themselves; this only guards against a fault.
_MAX_ROUNDS = 60


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def columns_of(df: DataFrame, without: Sequence[str] = ()) -> list[Column]:
    """The columns of a table, whatever characters their names hold."""
    return [F.col(f"`{c}`") for c in df.columns if c not in without]


def n_words(text: Column) -> Column:
    """Words of a text as a long; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash128(value: Column) -> list[Column]:
    """Two independent 64-bit hashes; together they stand for the value itself."""
    return [F.xxhash64(value), F.xxhash64(F.lit("second"), value)]


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components: one row (node, root) for every node that has an edge.

    ``root`` is the smallest node of the component.  Rounds of large-star and small-star:
    every node tells its larger, then its smaller neighbours about the smallest one it
    knows.  The number of edges never grows.  Each half round takes one minimum per node,
    summed up in the tasks first and written out, so a node with very many edges is split
    when edges meet minima.
    """
    loops = F.col("u") != F.col("v")
    current = stored(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where(loops).distinct())
    nodes = current.select(F.col("u").alias("node")).union(current.select("v")).distinct()
    seen = None
    for _ in range(_MAX_ROUNDS):
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = stored(
            large.where(loops).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        )
        least = stored(down.groupBy("u").agg(F.min("v").alias("m")))
        small = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))
        )
        current = stored(small.where(loops).distinct())
        state = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
    else:
        raise RuntimeError("components did not settle")
    # Settled edges are stars: every node but the root points at the root.
    return nodes.join(current.select(F.col("u").alias("node"), F.col("v").alias("root")), "node", "left").select(
        "node", F.coalesce("root", "node").alias("root")
    )
