"""From record files to the train/test dataset."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import cleaning as C
from ..operators import sampling as S
from ..operators.dedupe import dedupe_keep_last
from ..session import stored
from ..sources import records as R
from ..sources import sinks as K

REQUIRED = ("id",)


@dataclass(frozen=True)
class Preparation:
    """Reports of one run: rows per repository and split, rows left after every step, lines read and set apart."""

    split_report: DataFrame
    step_report: DataFrame
    lines_read: int
    lines_quarantined: int


def prepare_methods(records: DataFrame) -> DataFrame:
    """Flatten, standardise, filter and de-duplicate the rows that can be used."""
    good, _ = C.isolate_bad_rows(records, REQUIRED)
    return dedupe_keep_last(C.clean_methods(C.flatten_one_level(good)))


def prepare(
    spark: SparkSession,
    records_root: str,
    dataset_path: str,
    n_train: int = S.N_TRAIN,
    n_test: int = S.N_TEST,
    seed: int = S.SEED,
    layout: str = "folders",
    on_shortfall: str = "skip",
    fmt: str = "parquet",
    quarantine: str | None = None,
    pattern: str = "*.jsonl",
) -> Preparation:
    """Read, prepare, sample, split and write; returns the reports.

    Record files are read once.  Lines that cannot be used go to ``quarantine`` as JSON lines
    with the reason, their file and their text, where a path is given; they are counted
    either way.  The step report (A4) is observed on the writes and costs no scan.

    The prepared methods are stored once as Parquet: sampling reads two columns of them to
    count and the rest only for the rows it draws.
    """
    lines = R.read_record_lines(spark, records_root, layout, pattern)
    clean, bad, rows = C.separate(lines, REQUIRED)
    if quarantine:
        bad.write.mode("overwrite").json(quarantine)
    left = Observation()
    methods = stored(dedupe_keep_last(clean).observe(left, F.count(F.lit(1)).alias("deduplicated")))
    dataset = stored(S.sample_from_large_repos(methods, n_train, n_test, seed, on_shortfall))
    K.write_dataset(dataset, dataset_path, fmt)
    steps = [*C.passed_steps(), "deduplicated"]
    counts = rows | left.get
    report = spark.createDataFrame([(i, s, counts[s]) for i, s in enumerate(steps)], "step_no int, step string, rows bigint")
    return Preparation(S.split_report(dataset), report, rows["read"], rows["quarantined"])


def prepare_dataset(spark: SparkSession, records_root: str, dataset_path: str, *sizes: int, **options: object) -> DataFrame:
    """``prepare`` for its split report alone."""
    return prepare(spark, records_root, dataset_path, *sizes, **options).split_report
