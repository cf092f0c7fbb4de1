"""Chunk search (Q3): V4 -> F4 -> V2 -> F9 -> V8.

Query texts are embedded with the query role, matched against a points
table whose payload is the chunk JSON, and hits resolve back to chunks.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.payload import chunk_payload, resolve_chunk
from ..operators.embed import HashingEmbedder
from ..operators.search import search
from ..session import checkpoint_dir
from ..sources.chunks import one_per_chunk

# Above this many hit ids the payload lookup uses a shuffled semi join.
MAX_BROADCAST_HITS = 2_000_000


def chunk_points(chunks: DataFrame, embedder=None) -> DataFrame:
    """Points for chunks (ST1's batch twin): point id = chunk_id, payload = chunk JSON."""
    embedder = embedder or HashingEmbedder()
    # A repeated id is one point: one row per id, whose vector is made in the row that holds its payload.
    pay = chunk_payload("chunk_id", "item_sequence", "name", "contents", "meta")
    rows = one_per_chunk(chunks).select(F.col("chunk_id").alias("point_id"), "contents", pay.alias("payload"))
    return embedder.embed(rows, ["point_id", "payload"], "contents", role="passage").select("point_id", "vector", "payload")


def search_chunks(points: DataFrame, queries: DataFrame, *, embedder=None, k: int = 5, where=None,
                  threshold: float | None = None, query_id: str = "query_id", text_col: str = "text") -> DataFrame:
    """Top-k chunks per query text: (query_id, rank, score, chunk fields...).
    Hits without a payload are dropped (V8)."""
    embedder = embedder or HashingEmbedder()
    qv = embedder.embed(queries, [query_id], text_col, role="query").withColumnRenamed(query_id, "query_id")
    src = points if where is None else points.where(where)
    # Score on (id, vector) only; payloads (whole chunk texts) are looked up
    # for the hits alone: at most queries x k rows, broadcast into one scan.
    hits = search(src.select("point_id", "vector"), qv, k=k, threshold=threshold)
    checkpoint_dir(points.sparkSession)
    hits = hits.checkpoint(eager=True)
    ids = hits.select("point_id").distinct()
    # at most queries x k ids: broadcast under the bound, shuffled beyond it
    ids = F.broadcast(ids) if ids.count() <= MAX_BROADCAST_HITS else ids
    hits = hits.join(src.select("point_id", "payload").join(ids, "point_id", "left_semi"), "point_id")
    hits = hits.where(F.col("payload").isNotNull()).withColumn("chunk", resolve_chunk("payload"))
    return hits.select("query_id", "rank", "score", "point_id", "chunk.*").drop("_missing")
