"""Session settings and lineage cuts shared by all jobs."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Settings for sessions this package builds itself (tests, bench). Sessions handed in keep what they set.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Every tree lookup joins many rows to one row per key, so splitting a hot key is always
    # worth an extra exchange afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

# Rows of tree tables are narrow and alike: ten bytes in a shuffle are a hundred in a sort, and a fifth of all rows may share a
# key. At Spark's defaults (64 MB a task, skew from 256 MB on) such a key is one task of gigabytes, and a table written with
# 10 MB is broadcast with a hundred.
NARROW = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "12m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.autoBroadcastJoinThreshold": "1m",
}


def tune(spark: SparkSession) -> None:
    """Settings for tree tables, each unless the session has its own. They are read when a query runs, so they stay."""
    for key, value in NARROW.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def build_session(app: str, master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder of this application's step tables, shared by all executors.

    It lies below spark.checkpoint.dir, or below the warehouse folder where that is unset.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_steps"
    return f"{folder.rstrip('/')}/{spark.sparkContext.applicationId}"


def cut(frame: DataFrame) -> DataFrame:
    """Write the frame to the shared folder and go on from the written table.

    Plans stay short in iterative jobs, a lost executor costs no more than the last step, and the next
    step is planned with the table's true size.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/step-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def cut_counting(frame: DataFrame, **counts: Column) -> tuple[DataFrame, dict[str, int]]:
    """As ``cut``, with the number of rows and of those that fulfil each condition, counted while writing."""
    tune(frame.sparkSession)
    seen = Observation()
    exprs = {"rows": F.count(F.lit(1))} | {name: F.count_if(holds) for name, holds in counts.items()}
    written = cut(frame.observe(seen, *[expr.alias(name) for name, expr in exprs.items()]))
    return written, seen.get


def drop_steps(spark: SparkSession) -> None:
    """Remove the step tables of this application. Frames that still read them are of no use afterwards."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
