"""Helpers shared by the operators: tables in the shared folder, words and shingles, bounded id filters."""
from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusflow.session import checkpoint_dir

SHINGLE_WORDS = 5
WORD_CACHE = 150_000  # entries a Python worker remembers before it starts anew


def work_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the folder that all executors share."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives lost executors."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(col: str = "text") -> Column:
    """Text as UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(col), F.lit("")).cast("binary")


class _WordIds(dict):
    """bytes -> 64-bit hash of a word, bounded in size."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_IDS = _WordIds()


def forget() -> None:
    """Give back what a task remembered: workers are used again by later stages."""
    _IDS.clear()
    pa.default_memory_pool().release_unused()


def word_ids(text: bytes) -> np.ndarray:
    """64-bit ids of the words ``[^\\x20\\x09-\\x0D]+`` of a text with A-Z lower-cased."""
    words = text.lower().split()  # of bytes: ASCII letters and ASCII white space only
    return np.fromiter(map(_IDS.__getitem__, words), np.uint64, len(words))


def _hashed(parts: list[np.ndarray], seed: int) -> np.ndarray:
    h = np.full(len(parts[0]), seed, np.uint64)
    for p in parts:
        h = (h ^ p) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def shingles(ids: np.ndarray, width: int = SHINGLE_WORDS) -> np.ndarray:
    """Hashes of the distinct word shingles, ascending; fewer words than ``width`` are one shingle, none give none."""
    n = len(ids)
    if n == 0:
        return np.empty(0, np.uint64)
    w = min(width, n)
    return np.unique(_hashed([ids[j:n - w + 1 + j] for j in range(w)], w))


def id_filter(ids: DataFrame, col: str, rows_log2: int = 20) -> DataFrame:
    """A Bloom filter of ids as a small table (w, bits): at most 2**rows_log2 rows, whatever the input."""
    h = F.xxhash64(F.col(col))
    return (ids.select(F.shiftrightunsigned(h, 64 - rows_log2).alias("w"), F.expr(f"shiftleft(1L, cast(xxhash64(`{col}`) & 63 as int))").alias("b"))
            .groupBy("w").agg(F.bit_or("b").alias("bits")))


def maybe_in(df: DataFrame, col: str, flt: DataFrame, rows_log2: int = 20) -> DataFrame:
    """Rows whose id may be in the filter: no shuffle of ``df``; false positives are left to the join that follows."""
    h = F.xxhash64(df[col])
    bit = F.expr(f"shiftleft(1L, cast(xxhash64(`{col}`) & 63 as int))")
    return (df.withColumn("__w", F.shiftrightunsigned(h, 64 - rows_log2)).withColumn("__b", bit)
            .join(F.broadcast(flt), (F.col("__w") == F.col("w")) & (F.col("bits").bitwiseAND(F.col("__b")) != 0), "left_semi")
            .drop("__w", "__b"))
