"""From file changes and syntax trees to method records on disk."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import mining as M
from ..operators import trees
from ..operators.cleaning import isolate_bad_rows
from ..session import stored
from ..sources.sinks import write_chunked_jsonl

# Order in which methods are visited inside a repository.
TRAVERSAL = ("committed_ts", "commit_sha", "new_path", "start_line", "end_line", "node_id")


def method_rows(
    file_changes: DataFrame, file_nodes: DataFrame, method_nodes: DataFrame, licenses: DataFrame
) -> DataFrame:
    """Every method of every change with its metrics and licence.

    ``file_nodes.record_id`` is the change's ``record_id``; ``method_nodes`` hold one tree per
    method, with the record id ``<change>/<node_id of the declaration>``.
    """
    methods = trees.extract_declarations(file_nodes).join(
        trees.leading_comment(file_nodes), ["record_id", "node_id"]
    )
    methods = methods.withColumn("method_id", F.concat_ws("/", "record_id", "node_id"))
    texts = methods.select(F.col("method_id").alias("record_id"), F.col("source_code").alias("text"))
    metrics = trees.all_metrics(method_nodes, texts, with_tokens=True)
    changes = M.has_source(file_changes).drop("source_code")
    joined = (
        methods.join(metrics.withColumnRenamed("record_id", "method_id"), "method_id")
        .join(changes, "record_id")
        .drop("method_id")
    )
    return M.attach_license(joined, licenses)


def without_tree(changes: DataFrame, file_nodes: DataFrame) -> DataFrame:
    """Changes that leave a file with content of which no tree was made; only ids of roots are shuffled to find them."""
    roots = file_nodes.where(F.col("parent_id").isNull()).select("record_id")
    return M.has_source(changes).join(roots, "record_id", "left_anti")


def mine(
    repos: DataFrame,
    file_changes: DataFrame,
    file_nodes: DataFrame,
    method_nodes: DataFrame,
    licenses: DataFrame,
    since: datetime,
    to: datetime,
    root: str,
    methods_to_mine: int | None = None,
    chunk_size: int = M.CHUNK_SIZE,
    quarantine: str | None = None,
    **search: object,
) -> DataFrame:
    """Search, scan, measure, cap, write chunked records; returns the report per repository.

    Repositories are visited by stars, most first, and methods in commit order.  A file or
    a method that was not measured, because its tree is missing, is neither written nor counted
    toward the cap; it goes to ``quarantine`` as a JSON line with the reason, where a path is
    given.
    """
    found = M.parse_repo_urls(M.search_repos(repos, since.date(), to.date(), **search))
    ranked = found.select(F.col("clone_url").alias("repo_url"), "stars")
    changes = M.scan_changes(file_changes, since, to).join(ranked, "repo_url")
    visited = stored(method_rows(changes, file_nodes, method_nodes, licenses))
    methods, failed = isolate_bad_rows(visited, ["n_ast_nodes"])
    if quarantine:
        files = without_tree(changes, file_nodes).drop("source_code").withColumn("bad_reason", F.lit("missing tree"))
        failed.unionByName(files, allowMissingColumns=True).write.mode("overwrite").json(quarantine)
    capped = stored(
        M.mining_cap(
            methods,
            methods_to_mine,
            repo_order=[F.col("stars").desc(), F.col("repo_url").asc()],
            repo=["stars", "repo_url"],
            order=[F.col(c) for c in TRAVERSAL],
        )
    )
    records = M.build_record(capped, TRAVERSAL)
    write_chunked_jsonl(records, root, [F.col(c) for c in TRAVERSAL], chunk_size)
    return M.mining_report(capped, "repo_url", chunk_size)
