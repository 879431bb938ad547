"""Dropping lines that occur in several documents, except in the first document that has them.

Lines are exploded and normalised (edge white space stripped, A-Z lower-cased), keys of at
least ``min_chars`` code points are hashed to 128 bits, distinct documents per hash are
counted, and documents are reassembled by position without the lines of frequent keys.

Defined cases: null and empty texts are one empty line, which is too short to be a key; a key
that is repeated in one document only stays; rows that repeat an id are one document; a null
id counts as one document that comes after all others; extra columns stay, and columns with
the names of the added ones are replaced; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .common import columns_of, hash128

MIN_CHARS = 10
MIN_DOCS = 2

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LAST_ID = 2**63 - 1
ADDED = ("n_lines", "n_dropped")


def line_key(line: Column) -> Column:
    return F.translate(F.trim(line, F.lit(" \t\n\x0b\f\r")), _UPPER, _LOWER)


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """The documents with repeated lines removed from ``text``; adds ``n_lines`` and ``n_dropped``.

    What travels per line is 36 bytes.  A line that very many documents share is summed up
    in the tasks, and its rows are split when they meet the frequent keys.  Texts travel
    once, to meet the positions of their dropped lines.
    """
    doc_id = F.coalesce(F.col("doc_id"), F.lit(_LAST_ID))
    keyed = docs.select(
        *columns_of(docs, ADDED),
        doc_id.alias("__doc"), F.xxhash64("text").alias("__text"),
        F.split(F.coalesce("text", F.lit("")), "\n").alias("__lines"),
    )
    long_enough = F.col("__key").isNotNull() & (F.length("__key") >= min_chars)
    first, second = hash128(F.col("__key"))
    lines = stored(
        keyed.select("__doc", "__text", F.posexplode("__lines").alias("__pos", "__line"))
        .withColumn("__key", line_key(F.col("__line")))
        .where(long_enough)
        .select("__doc", "__text", "__pos", first.alias("__h1"), second.alias("__h2"))
    )
    key = ["__h1", "__h2"]
    frequent = stored(
        lines.select(*key, "__doc").distinct().groupBy(*key)
        .agg(F.count(F.lit(1)).alias("__docs"), F.min("__doc").alias("__keeper"))
        .where(F.col("__docs") >= min_docs)
        .select(*key, "__keeper")
    )
    dropped = (
        lines.join(frequent, key)
        .where(F.col("__doc") != F.col("__keeper"))
        .groupBy("__doc", "__text")
        .agg(F.collect_set("__pos").alias("__dropped"))
    )
    joined = keyed.drop("__lines").join(dropped, ["__doc", "__text"], "left").withColumn(
        "__lines", F.split(F.coalesce("text", F.lit("")), "\n")
    )
    places = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__dropped"))
    kept = F.array_join(F.transform(places, lambda i: F.get("__lines", i)), "\n")
    text = F.when(F.col("__dropped").isNull(), F.col("text")).otherwise(kept)
    return joined.select(
        *[text.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns if c not in ADDED],
        F.size("__lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("__dropped"), F.lit(0)).cast("long").alias("n_dropped"),
    )
