"""Words, hashes, batches and bounded filters shared by the document operators."""

from __future__ import annotations

import ctypes
import ctypes.util
import gc
import re
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Size in bits of the filters that spare rows a shuffle. They only ever let too many rows pass.
FILTER_BITS = 1 << 26
# A worker forgets its cached words beyond this number.
CACHED_WORDS = 200_000


def held_out(doc_id: str, remainder: int) -> Column:
    """crc32 of the id as text, mod 5, is the remainder; a null id counts as empty text."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 5 == remainder


def raw(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A text column as UTF-8 bytes; null becomes empty. bytes.split() and bytes.lower() know ASCII only."""
    return [x or b"" for x in batch.column(name).cast(pa.binary()).to_pylist()]


_WORD_BYTE = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]")
_CLEAN = bytes(c if _WORD_BYTE.match(bytes([c])) else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def normal_words(text: bytes) -> list[bytes]:
    """Lower-cased (A-Z) words of letters, digits and all beyond ASCII."""
    return text.translate(_CLEAN).split()


def text_map(frame: DataFrame, schema: str, column: str, per_text: Callable[[bytes], tuple], once: bool = False) -> DataFrame:
    """The frame with the columns of the schema, computed from each whole text. Only the text goes to Python.

    once: Spark must not work the columns out a second time for a filter on one of them.
    """

    @F.arrow_udf(f"struct<{schema.replace(' ', ':').replace(',:', ',')}>")
    def read(texts: pa.Array) -> pa.Array:
        rows = [per_text(text) for text in stream(texts)]
        return pa.array([dict(zip(names, row, strict=True)) for row in rows], pa.struct([(n, kinds[k]) for n, k in fields]))

    kinds = {"bigint": pa.int64(), "double": pa.float64(), "string": pa.string()}
    fields = [tuple(part.split()) for part in schema.split(", ")]
    names = [n for n, _ in fields]
    read = read.asNondeterministic() if once else read
    return frame.withColumn("_read", read(F.col(column))).select(*[f"`{c}`" for c in frame.columns], "_read.*")


class WordIds(dict):
    """64-bit hashes of words, computed once per worker and word."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.array([*map(self.__getitem__, words)], dtype=np.uint64)


def _slot(key: Column) -> Column:
    return F.pmod(key, F.lit(FILTER_BITS))


def bit_filter(spark: SparkSession, keys: DataFrame):
    """Broadcast bit array of a long column: of fixed size, so it may pass too much but never too little."""
    slot = _slot(F.col(keys.columns[0]))
    words = keys.groupBy(F.shiftright(slot, 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (slot % 64).cast("int"))).alias("bits")
    )
    table = words.toArrow()
    bits = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    bits[table.column("word").to_numpy()] = table.column("bits").to_numpy()
    return spark.sparkContext.broadcast(bits)


def passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """keys: int64."""
    slot = np.mod(keys, FILTER_BITS)
    return (bits[slot >> 6].view(np.uint64) >> (slot & 63).astype(np.uint64)) & np.uint64(1) == 1


def may_be_in(shared, key: Column) -> Column:
    """Rows whose key may be among those of bit_filter; only the key goes to Python."""

    @F.pandas_udf("boolean")
    def known(keys: pd.Series) -> pd.Series:
        return pd.Series(passes(shared.value, keys.to_numpy(dtype=np.int64)))

    return known(key)


def bounded_batches(spark: SparkSession) -> None:
    """Texts vary from nothing to megabytes, so what goes to Python at a time is bounded in bytes, not only in rows.

    A session with a bound of its own keeps it.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) in (None, "-1b", "67108864b"):
        spark.conf.set(name, "4m")


def stream(column: pa.Array) -> Iterator[bytes]:
    """As raw, text by text; only a few texts are copied at a time."""
    for k in range(0, len(column), 128):
        yield from (x or b"" for x in column.slice(k, 128).cast(pa.binary()).to_pylist())


def columns_of(schema_fields, batch: pa.RecordBatch) -> list[pa.Array]:
    return [batch.column(f.name) for f in schema_fields]


def ddl(fields) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)


def release() -> None:
    """Unreachable objects go, and freed memory goes back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    name = ctypes.util.find_library("c")
    trim = getattr(ctypes.CDLL(name), "malloc_trim", None) if name else None
    if trim:
        trim(0)
