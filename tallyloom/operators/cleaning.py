"""Flattening, standardising and filtering method rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import patterns as P
from ..functions import text as X
from ..schema import CORRUPT
from ..session import scratch_path

# A method is identified by these columns after standardisation.
METHOD_KEY = ("repo_name", "file_path", "method_signature")


def flatten_one_level(df: DataFrame) -> DataFrame:
    """``a.b`` becomes ``a_b``; deeper structs, arrays and scalars stay as they are."""
    columns: list[Column] = []
    for field in df.schema:
        if isinstance(field.dataType, T.StructType):
            columns += [
                F.col(f"`{field.name}`.`{sub}`").alias(f"{field.name}_{sub}")
                for sub in field.dataType.fieldNames()
            ]
        else:
            columns.append(F.col(f"`{field.name}`"))
    return df.select(*columns)


def drop_license(df: DataFrame) -> DataFrame:
    """P9."""
    return df.drop("repo_license")


def valid_method_name(name: str = "method_name") -> Column:
    """word characters and ``$`` only, at least two of them."""
    return ~F.col(name).rlike(P.NOT_NAME_CHAR) & (F.length(name) > 1)


def valid_line_span() -> Column:
    """F3."""
    return (F.col("method_start_line") > 0) & (F.col("method_end_line") >= F.col("method_start_line"))


def nloc_between(low: int = 3, high: int = 100) -> Column:
    """both ends included."""
    return F.col("metrics_nloc").between(low, high)


def parsed_ok() -> Column:
    """complexity 0 marks blank input or a failed analysis."""
    return F.col("metrics_cyclomatic_complexity") > 0


def quality() -> Column:
    """moderately complex methods with a tree of some size."""
    return F.col("metrics_cyclomatic_complexity").between(2, 15) & (F.col("metrics_n_ast_nodes") > 10)


def quality_filter(df: DataFrame) -> DataFrame:
    return df.where(quality())


def standardize(df: DataFrame) -> DataFrame:
    """P9-P12 on a flat table."""
    return drop_license(df).withColumns(
        {
            "repo_name": X.standardize_repo_name(F.col("repo_name")),
            "file_path": X.standardize_path(F.col("file_path")),
            "method_signature": X.normalize_signature(F.col("method_signature")),
        }
    )


# Row filters in the order they apply.  No filter reads a column that P10-P12 rewrite,
# so standardising first gives the same rows.
CLEANING_STEPS = (
    ("valid_method_name", valid_method_name),
    ("valid_line_span", valid_line_span),
    ("nloc_between", nloc_between),
    ("parsed_ok", parsed_ok),
)


def clean_methods(df: DataFrame) -> DataFrame:
    """P9-P12 and F2-F5 in one pass over a flat table."""
    keep = reduce(lambda a, b: a & b, [step() for _, step in CLEANING_STEPS])
    return standardize(df.where(keep))


def with_bad_reason(df: DataFrame, required: Sequence[str], corrupt: str = CORRUPT) -> DataFrame:
    """Add ``bad_reason``: why a row cannot be used, or null.

    A row is bad when it could not be parsed or lacks a required value.
    """
    reasons = []
    if corrupt in df.columns:
        reasons.append(F.when(F.col(corrupt).isNotNull(), F.lit("unparseable")))
    reasons += [F.when(F.col(c).isNull(), F.lit(f"missing {c}")) for c in required]
    return df.withColumn("bad_reason", F.coalesce(*reasons, F.lit(None)))


def isolate_bad_rows(
    df: DataFrame, required: Sequence[str], corrupt: str = CORRUPT
) -> tuple[DataFrame, DataFrame]:
    """rows that can be used, and the rest with the reason.

    The two read ``df`` once each; ``separate`` gives both from one pass.
    """
    checked = with_bad_reason(df, required, corrupt)
    good = checked.where(F.col("bad_reason").isNull()).drop("bad_reason", corrupt)
    return good, checked.where(F.col("bad_reason").isNotNull())


def passed_steps() -> dict[str, Column]:
    """For every cleaning step, whether a row passes it and all before it."""
    passed, found = F.lit(True), {"input": F.lit(True)}
    for name, step in CLEANING_STEPS:
        passed = passed & step()
        found[name] = passed
    return found


def separate(records: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """F9, P9-P12, F2-F5 and A4 in one pass over nested records that carry ``source_file`` and ``line``.

    Returns clean methods, quarantined lines (``bad_reason, source_file, line``), and the rows
    seen on the way: all that were read, those quarantined, and those left after every step.
    Both outputs are parts of one table, and the counts are observed while it is written.
    """
    flat = flatten_one_level(with_bad_reason(records, required))
    usable = F.col("bad_reason").isNull()
    steps = passed_steps()
    seen = Observation()
    observed = flat.observe(
        seen, F.count(F.lit(1)).alias("read"), F.count_if(~usable).alias("quarantined"),
        *[F.count_if(usable & passed).alias(name) for name, passed in steps.items()],
    )
    spark = records.sparkSession
    path = scratch_path(spark)
    kept = observed.where(~usable | steps[CLEANING_STEPS[-1][0]]).withColumns(
        {"line": F.when(~usable, F.col("line")), "usable": usable}
    )
    kept.write.partitionBy("usable").parquet(path)
    table = spark.read.schema(kept.schema).parquet(path)
    good = table.where("usable").drop("usable", "bad_reason", "source_file", "line", CORRUPT)
    bad = table.where("NOT usable").select("bad_reason", "source_file", "line")
    return standardize(good), bad, dict(seen.get)


def step_report(df: DataFrame) -> DataFrame:
    """A4: rows left after every cleaning step and after de-duplication, in one pass.

    Rows are first counted per method key, so the last step needs no second scan and a
    method with very many copies is one counter per task.
    """
    standard, passed = standardize(df), passed_steps()
    names = list(passed)
    per_key = standard.groupBy(*METHOD_KEY).agg(*[F.count_if(p).alias(n) for n, p in passed.items()])
    totals = per_key.agg(
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names],
        F.count_if(F.col(names[-1]) > 0).alias("deduplicated"),
    )
    steps = [*names, "deduplicated"]
    return totals.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(i).alias("step_no"), F.lit(n).alias("step"), F.col(n).alias("rows"))
                    for i, n in enumerate(steps)
                ]
            )
        )
    )
