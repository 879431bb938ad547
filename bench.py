"""Time the headline queries; prints one JSON line.

    BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8)

Every query runs in full; its result is discarded by the ``noop`` sink.  The tables at hand
have one row group each, which one task reads.  Tables of a size worth a cluster have many, so
the queries run on a copy of the same rows in many files, written before the clock starts, and
then on the tables as given: ``queries`` and ``value`` are those of the copy, ``as_given`` the others.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

from tallyloom.plans.catalog import QUERIES
from tallyloom.session import scratch_path

TABLES = ("documents", "events", "customer", "nation", "pages")
HEADLINE = (
    "t3_next_token_topk",
    "a9_ngram_counts_n3",
    "a10_context_totals_n5",
    "a12_perplexity_n3",
    "a13_topk_accuracy_n5",
    "a15_score_grid",
    "a15_score_grid_first",
    "n9_complete",
    "a1_tree_metrics",
    "a2_leaf_tokens",
    "a3_branch_complexity",
    "d1_extract_declarations",
    "x1_x4_text_metrics",
    "a4_step_report",
    "w1_duplicate_report",
    "w2_dedupe_keep_last",
    "w3_chunk_number",
    "w4_mining_cap",
    "r2_sample_from_large_repos",
    "s2_scan_changes",
    "k1_s3_records_round_trip",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:]
    names = [n for n in HEADLINE if not wanted or any(n.startswith(w) for w in wanted)]
    seconds = {"split": timed(spark, names, split_copy(spark, sf_dir, 2 * int(cpus))), "given": timed(spark, names, sf_dir)}
    totals = {files: round(sum(found.values()), 3) for files, found in seconds.items()}
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries on tables of many files",
                "value": totals["split"],
                "unit": "sec",
                "queries": seconds["split"],
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "as_given": {"value": totals["given"], "queries": seconds["given"]},
            }
        )
    )


def split_copy(spark: SparkSession, sf_dir: str, files: int) -> str:
    """The tables that the queries read, each in so many files, in the scratch folder."""
    root = scratch_path(spark)
    for table in TABLES:
        spark.read.parquet(f"{sf_dir}/{table}.parquet").repartition(files).write.parquet(f"{root}/{table}.parquet")
    return root


def timed(spark: SparkSession, names: list[str], sf_dir: str) -> dict[str, float]:
    seconds: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    return seconds


if __name__ == "__main__":
    main()
