"""Token counts kept up to date by deltas.

Changes arrive in batches: inserts, deletes, and revised counts of documents. A batch becomes signed sums by source,
language and tokenizer version, added up in Spark, and is committed under its id by one rename of a folder below the
rollup's folder. A batch that is committed already changes nothing when it is delivered again, and one that failed half
way leaves nothing behind, so every batch counts once. Totals are the sums over all committed batches.

Null source or language is a group of its own. A null text has no tokens. Groups whose documents are all deleted are
left out of the totals. Extra columns are ignored. Rows repeated within a batch count as often as they appear: a batch
lists changes, not documents.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GROUP = ("source", "lang", "tokenizer")
VOCABULARIES = "/opt/tokenizers"
# Fixed value: the pattern that splits text before the merges of the public byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def token_counter(spark: SparkSession, name: str = "byte_bpe_50k", folder: str = VOCABULARIES):
    """A function from a text column to its number of tokens. The vocabulary is a file of fixed size, sent to the tasks."""
    lines = spark.read.format("binaryFile").load(f"file://{folder}/{name}.tiktoken").select("content").first()[0]
    shared = spark.sparkContext.broadcast(bytes(lines))

    @F.pandas_udf("bigint")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, shared.value.splitlines())}
        encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        for texts in batches:
            yield pd.Series([len(encoding.encode_ordinary(t)) if t else 0 for t in texts], dtype=np.int64)

    return count


def inserted(documents: DataFrame, tokenizer: str, tokens: Column) -> DataFrame:
    return _change(documents, tokenizer, F.lit(1), tokens)


def deleted(documents: DataFrame, tokenizer: str, tokens: Column) -> DataFrame:
    """tokens: as they were inserted."""
    return _change(documents, tokenizer, F.lit(-1), -tokens)


def revised(documents: DataFrame, tokenizer: str, before: Column, after: Column) -> DataFrame:
    """Same document, other number of tokens."""
    return _change(documents, tokenizer, F.lit(0), after - before)


def _change(documents: DataFrame, tokenizer: str, docs: Column, tokens: Column) -> DataFrame:
    return documents.select(
        "source", "lang", F.lit(tokenizer).alias("tokenizer"), docs.cast("bigint").alias("docs"), F.coalesce(tokens, F.lit(0)).cast("bigint").alias("tokens")
    )


def _sums(changes: DataFrame) -> DataFrame:
    return changes.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))


class Rollup:
    """Totals below a folder that all executors share."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._files.mkdirs(self._path(self.folder))

    def committed(self) -> list[str]:
        """Ids of the batches that count."""
        names = [s.getPath().getName() for s in self._files.listStatus(self._path(self.folder))]
        return sorted(n.removeprefix("batch=") for n in names if n.startswith("batch="))

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch; False, without any effect, if it is committed already."""
        if batch in self.committed():
            return False
        staged = f"{self.folder}/_staged-{uuid.uuid4().hex}"
        _sums(changes).write.parquet(staged)
        target = self._path(f"{self.folder}/batch={batch}")
        # of two writers of a batch one finds the folder there
        if self._files.exists(target) or not self._files.rename(self._path(staged), target):
            self._files.delete(self._path(staged), True)
            return False
        return True

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, docs and tokens over all committed batches."""
        schema = "source string, lang string, tokenizer string, docs bigint, tokens bigint"
        paths = [f"{self.folder}/batch={b}" for b in self.committed()]
        changes = self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)
        return _sums(changes).where("docs <> 0 or tokens <> 0")
