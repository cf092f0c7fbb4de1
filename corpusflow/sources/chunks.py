"""Chunk requests (S12): the JSON landing zone of embedding requests, batch
and streaming twins. One JSON object per line:
{"request_id", "chunk_id", "item_sequence", "name", "contents", "meta": {...}}
and ``request_chunks``, the number of chunks of the request, if its sender says it.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REQUEST_SCHEMA = ("request_id string, chunk_id string, item_sequence string, name string, "
                  "contents string, meta map<string,string>, request_chunks long")
REQUIRED = ("chunk_id", "item_sequence", "name", "contents")


def read_chunk_requests(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REQUEST_SCHEMA).json(path)


def stream_chunk_requests(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming source; ``max_files_per_trigger`` bounds each micro-batch
    (the backpressure of ST2)."""
    r = spark.readStream.schema(REQUEST_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.json(path)


def validate_chunks(chunks: DataFrame) -> DataFrame:
    """Add ``missing`` (required fields absent) and ``valid``."""
    missing = F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in REQUIRED]), lambda x: x.isNotNull())
    return chunks.withColumn("missing", missing).withColumn("valid", F.size("missing") == 0)


def one_per_chunk(chunks: DataFrame) -> DataFrame:
    """One row per chunk id: the one of the greatest request id, then name and contents."""
    row = F.max_by(F.struct(*chunks.columns), F.struct(*[c for c in ("request_id", "name", "contents") if c in chunks.columns]))
    return chunks.groupBy("chunk_id").agg(row.alias("_r")).select("_r.*")
