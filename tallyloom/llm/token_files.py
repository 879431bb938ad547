"""Token ids as ORC files that can be read by stripe and pruned by document id.

Documents are range-partitioned and sorted by id before they are encoded, so file, stripe and
row order are id order, and the min/max of every stripe and row group covers a narrow range of
ids.  Ids are integers, which ORC run-length encodes; a Bloom filter on ``doc_id`` serves
lookups of single documents.  Every row knows its shard, the number of ids before it there, and its own,
so the start of a document needs no column of ids to be read.

Defined cases: null and empty texts hold the end id alone; null ids come first; rows that
repeat an id stay separate rows, in the order of their texts' hashes; an empty table gives files
without rows.  Only ``doc_id`` and ``text`` are read, so other columns may have any name.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from .pretokens import UnitEncoder, id_lists, slices

END_ID = 0
ORC_OPTIONS = {
    "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01", "orc.stripe.size": str(64 << 20),
    "orc.row.index.stride": "1000", "orc.create.index": "true", "orc.compress": "ZSTD",
}
FILE_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("shard", T.IntegerType()),
        T.StructField("shard_start", T.LongType()),
        T.StructField("n_ids", T.LongType()),
        T.StructField("ids", T.ArrayType(T.IntegerType())),
    ]
)


@lru_cache(maxsize=2)
def _encoder(path: str) -> UnitEncoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    # As a plain call has it: the name of a special token inside a text is that token.  Names hold no
    # white space, so the stretches that texts are cut into keep them whole.
    tokenizer = Tokenizer.from_file(path)

    def encode(units):
        return [e.ids for e in tokenizer.encode_batch_fast(list(units), add_special_tokens=False)]

    return UnitEncoder(encode, lambda text: [text])


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Encode ``text`` with the tokenizer file, append ``end_id``, write ORC in id order."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, start, shard = _encoder(tokenizer), 0, TaskContext.get().partitionId()
        for batch in batches:
            names = batch.column(0)
            for first, texts in slices(batch.column(1)):
                ids, ends = encoder(texts)
                ids = np.insert(ids, ends, end_id)
                ends = ends + np.arange(1, len(ends) + 1)
                starts = np.concatenate([[0], ends[:-1]]) + start
                start += len(ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        names.slice(first, len(texts)), pa.array(np.full(len(texts), shard, np.int32)),
                        pa.array(starts), pa.array(np.diff(ends, prepend=0)), id_lists(ids, ends),
                    ],
                    ["doc_id", "shard", "shard_start", "n_ids", "ids"],
                )

    keys = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    ordered = docs.select("doc_id", "text").repartitionByRange(*keys).sortWithinPartitions(*keys)
    ordered.mapInArrow(encode, FILE_SCHEMA).write.options(**ORC_OPTIONS).orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FILE_SCHEMA).orc(path)


def document_starts(tokens: DataFrame) -> DataFrame:
    """Adds ``start``, the number of ids in all documents before; the window holds a row per file."""
    sizes = tokens.groupBy("shard").agg(F.sum("n_ids").alias("__ids"))
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    bases = sizes.select("shard", F.coalesce(F.sum("__ids").over(before), F.lit(0)).alias("__base"))
    # One row per file; without the hint the ids would be shuffled to meet it.
    return tokens.join(F.broadcast(bases), "shard").withColumn("start", F.col("__base") + F.col("shard_start")).drop("__base")


DIGEST_SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long"


def digests(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the CRC-32 of the ids as little-endian 32-bit integers."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            offsets = lists.offsets.to_numpy().astype(np.int64) * 4
            data = memoryview(lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)).cast("B")
            sums = [zlib.crc32(data[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
            counts = np.diff(offsets) // 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts), pa.array(sums, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return document_starts(tokens).select("doc_id", "start", "ids").mapInArrow(digest, DIGEST_SCHEMA)
