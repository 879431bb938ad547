"""Session helpers: where lineage is cut, and the settings the jobs expect."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

# Settings of a production session.  All are runtime SQL settings, and all but the last
# two are Spark's defaults; the library itself never changes a caller's session.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def recommended(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    return builder


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's checkpoint folder; where none is set, one inside the shared warehouse.

    On a cluster that names neither, the default warehouse is a folder of the driver's machine,
    which executors do not see: that is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    settings = context.getConf()
    if not named and not settings.contains("spark.sql.warehouse.dir") and not settings.get("spark.master").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir, or spark.sql.warehouse.dir, to a folder that all machines share")
    context.setCheckpointDir(named or f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints")


def materialize(df: DataFrame) -> DataFrame:
    """The same rows, read back from reliable storage: lineage ends here.

    Partition boundaries and the order of rows inside a partition are fixed from now on,
    also when an executor is lost.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """The same rows as a Parquet table next to the checkpoints, for readers of few columns.

    The table belongs to the session's driver: it is removed when that process ends, also
    after a failure.  What a killed driver leaves is a folder ``table-*`` under
    ``spark.checkpoint.dir`` and follows that folder's retention.
    """
    path = scratch_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_parts(parts: Iterable[DataFrame]) -> DataFrame:
    """Tables of one schema as one Parquet table, written one after another.

    A part's shuffle files are removed before the next part is asked for, so the parts need
    only one part's room for them.
    """
    path = ""
    for part in parts:
        path = path or scratch_path(part.sparkSession)
        part.write.mode("append").parquet(path)
        spark, schema = part.sparkSession, part.schema
        release(spark)
    return spark.read.schema(schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Removes the shuffle files of queries that have ended.

    Spark does so when the driver's JVM has collected their plans, which may be long after they
    were needed.  Files of a query that is still in use are left alone.
    """
    spark._jvm.System.gc()


def discard(spark: SparkSession, path: str) -> None:
    """Removes a folder that ``scratch_path`` named before the driver ends."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def scratch_path(spark: SparkSession) -> str:
    """A new path in the shared checkpoint folder, removed when the driver ends."""
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4()}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path
