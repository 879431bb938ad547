"""Declared schemas: nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

# The nine metrics of a record, in order.
METRIC_NAMES = (
    "cyclomatic_complexity", "n_ast_nodes", "ast_depth", "n_identifiers", "vocab_size",
    "n_whitespaces", "n_words", "nloc", "token_counts",
)
METRIC_PREFIX = "metrics_"
CORRUPT = "_corrupt_record"


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


METHOD = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("qualified_name", T.StringType()),
    T.StructField("start_line", T.LongType()),
    T.StructField("end_line", T.LongType()),
    T.StructField("signature", T.StringType()),
    T.StructField("original_code", T.StringType()),
    T.StructField("doc_comment", T.StringType()),
])

# One mined method, nested.
RECORD = T.StructType([
    T.StructField("dataset_split", T.StringType()),
    T.StructField("id", T.StringType()),
    T.StructField("repo", _strings("name", "url", "commit_sha", "license")),
    T.StructField("file", _strings("path", "language")),
    T.StructField("method", METHOD),
    T.StructField("code_tokens", T.ArrayType(T.StringType())),
    T.StructField("metrics", T.StructType([T.StructField(m, T.LongType()) for m in METRIC_NAMES])),
])

# The prepared dataset: flat, without the licence; tokens as an array.
DATASET = T.StructType(
    [
        *_strings("dataset_split", "id", "repo_name", "repo_url", "repo_commit_sha",
                  "file_path", "file_language"),
        *[T.StructField(f"method_{f.name}", f.dataType) for f in METHOD],
        T.StructField("code_tokens", T.ArrayType(T.StringType())),
        *[T.StructField(METRIC_PREFIX + m, T.LongType()) for m in METRIC_NAMES],
        T.StructField("row_ord", T.LongType()),
    ]
)

# One node of a syntax tree.  ``node_id`` grows from left to right inside a level and
# ``sibling_ord`` counts a parent's children from 0; the root has depth 1 and no parent.
NODES = T.StructType([
    T.StructField("record_id", T.StringType()),
    T.StructField("node_id", T.LongType()),
    T.StructField("parent_id", T.LongType()),
    T.StructField("sibling_ord", T.IntegerType()),
    T.StructField("depth", T.IntegerType()),
    T.StructField("node_type", T.StringType()),
    T.StructField("is_named", T.BooleanType()),
    T.StructField("text", T.StringType()),
    T.StructField("start_row", T.IntegerType()),
    T.StructField("end_row", T.IntegerType()),
])
