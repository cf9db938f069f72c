"""Document pipeline: quality rules, near duplicates, repeated passages, benchmark passages, mixing.

Each stage takes (spark, docs, sf_dir) and all documents its predecessor kept. All but the last return the columns of
documents; the last adds the mixing rate and the number of copies to read. SQL can express none of the fitted stages.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeflow.llm import decontamination, mixing, quality_rules, simhash_dedup, substring_dedup
from cladeflow.llm.common import bounded_batches, release
from cladeflow.session import cut

ORACLE_SQL: str | None = None


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a base rule or a certified cutoff go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_rules.apply_rules(docs, labels).where("kept").select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group stays."""
    return simhash_dedup.keep_one(docs).select(docs.columns)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Recurring passages are cut out of the texts; documents that consist of nothing else go."""
    found = substring_dedup.remove_repeated(docs).where("n_removed = 0 or n_removed < n_words")
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars")))
    return found.select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark passages make up a twentieth of, or more, go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.find_items(docs, benchmark).where(~decontamination.contaminated()).select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rates and copies that bring the expected shares of tokens to the targets. All documents stay, for the reader to apply the copies (0 included)."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return mixing.mix(docs, labels)


def _hand_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    release()
    yield from batches


def tidy_workers(spark: SparkSession) -> None:
    """Python workers are used again from stage to stage and keep what earlier ones have freed; a few short tasks for each core
    reach most of them and hand it back to the system."""
    tasks = 4 * spark.sparkContext.defaultParallelism
    spark.range(0, tasks, 1, tasks).mapInArrow(_hand_back, "id bigint").write.format("noop").mode("overwrite").save()


def tidy_driver(spark: SparkSession) -> None:
    """The driver keeps samples, models and plans of earlier stages: Python's go first, as its frames and broadcasts hold those of
    the JVM; Spark drops a broadcast or shuffle only when the JVM collects it."""
    release()
    spark.sparkContext._jvm.System.gc()


def _stage(work):
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bounded_batches(spark)
        tidy_driver(spark)
        tidy_workers(spark)
        return work(spark, docs, sf_dir)

    stage.__doc__ = work.__doc__
    return stage


STAGES = [
    ("quality_rules", _stage(drop_low_quality)),
    ("near_duplicates", _stage(drop_near_duplicates)),
    ("repeated_passages", _stage(cut_repeated_passages)),
    ("benchmark_passages", _stage(drop_contaminated)),
    ("mixing", _stage(mix)),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        documents = stage(spark, cut(documents) if k else documents, sf_dir)
    return documents
