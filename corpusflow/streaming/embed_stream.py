"""Embedding stream (ST1-ST5) on Structured Streaming.

Chunk requests land as JSON files; each micro-batch
  1. admits requests within limits (F5) and checks required fields. A request
     that names its number of chunks is judged as a whole however its chunks are
     spread over files: they are held until all are there, or until it is over
     a limit, which rejects what came and what is still to come. A held chunk is
     written once and read again when its request is decided; the open requests
     are a small table per micro-batch, made from the one before it,
  2. builds the embedder input (P6) and embeds (V3),
  3. writes the points as one batch of the points table, whose current rows are
     the latest of each id (S10); a replayed micro-batch writes the same batch
     again, so delivery is effectively exactly-once,
  4. writes rejected, invalid and failed chunks as a batch of dead letters (ST5).
Backpressure (ST2) is ``maxFilesPerTrigger``; drain-and-stop (ST3) is
``trigger(availableNow=True)``. Load status (ST4) is a view over progress
or queue metrics rows.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.payload import chunk_payload
from ..functions.text import embedding_input
from ..operators.embed import HashingEmbedder
from ..operators.state import MAX_BROADCAST_REQUESTS, admit_requests, over_limits, small_side
from ..sources.chunks import REQUEST_SCHEMA, one_per_chunk, stream_chunk_requests, validate_chunks
from ..session import checkpoint_dir
from ..sources.tables import current, exists, last_batch, read_batches, write_batch

POINTS_SCHEMA = "point_id string, vector array<float>, payload string, embedding_version int"
DEAD_SCHEMA = "chunk_id string, request_id string, reason string"
OPEN_SCHEMA = ("request_id string, reason string, left long, request_chunks long, n_chunks long, n_bytes long, "
               "batches array<long>")


def _open(spark: SparkSession, held_path: str, epoch: int | None) -> DataFrame:
    return read_batches(spark, f"{held_path}/open", OPEN_SCHEMA).where(F.col("batch") == F.lit(epoch)).drop("batch")


def _held(spark: SparkSession, held_path: str, requests: DataFrame) -> DataFrame:
    """The held chunks of ``requests`` (request_id, batches, further columns); only batches that hold some are read."""
    requests = requests.select("*", F.explode("batches").alias("batch")).drop("batches").checkpoint(eager=True)
    numbers = [r["batch"] for r in requests.select("batch").distinct().collect()]
    rows = read_batches(spark, f"{held_path}/chunks", REQUEST_SCHEMA).where(F.col("batch").isin(numbers))
    return rows.join(small_side(requests), ["request_id", "batch"]).drop("batch")


def admit(batch: DataFrame, epoch: int, held_path: str | None, max_items: int, max_bytes: int) -> DataFrame:
    """The chunks of requests that are decided now, with ``reject_reason`` (F5 across micro-batches).

    ``request_chunks`` is the number of chunks that a request has; without it
    (or without ``held_path``) a request ends with its micro-batch. A new chunk
    that is undecided is written as held, once; of each open request a row says
    how much of it came and in which batches it is held, or, if it was rejected
    before all its chunks came, why and how many are still to come. Verdicts
    come from those rows and one partially aggregated row a request.
    """
    spark = batch.sparkSession
    new = admit_requests(batch, max_items=max_items, max_bytes=max_bytes, greatest=["request_chunks"]) \
        .select("request_id", F.col("n_chunks").alias("_n"), F.col("n_bytes").alias("_b"), F.col("request_chunks").alias("_of"))
    if held_path and exists(spark, f"{held_path}/rejected"):
        raise RuntimeError(f"{held_path} holds chunks as an earlier version wrote them: let that version drain the stream first")
    open_ = _open(spark, held_path, epoch - 1) if held_path else spark.createDataFrame([], OPEN_SCHEMA)
    n, n_bytes = (F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)) for a, b in (("_n", "n_chunks"), ("_b", "n_bytes")))
    of = F.greatest("_of", "request_chunks")
    left = F.coalesce("left", of) - n
    whole = of.isNull() | (left <= 0) | F.lit(held_path is None)
    reason = F.coalesce("reason", F.when(of > max_items, "too_many_chunks"), over_limits(n, n_bytes, max_items, max_bytes))
    now = F.when(F.col("_n") > 0, F.array(F.lit(epoch).cast("long"))).otherwise(F.array().cast("array<long>"))
    verdict = new.join(open_, "request_id", "full_outer").select(
        "request_id", reason.alias("reject_reason"), (whole | reason.isNotNull()).alias("decided"), left.alias("left"),
        of.alias("request_chunks"), n.alias("n_chunks"), n_bytes.alias("n_bytes"), F.col("batches").alias("before"),
        F.concat(F.coalesce("batches", F.array().cast("array<long>")), now).alias("batches")).checkpoint(eager=True)
    # Most requests come whole and within the limits: only the others meet their chunks.
    others = verdict.where(~F.col("decided") | F.col("reject_reason").isNotNull()).select("request_id", "reject_reason", "decided")
    j = batch.where("request_id is not null").join(small_side(others), "request_id", "left").fillna(True, "decided")
    out = j.where("decided").drop("decided")
    if held_path:
        write_batch(j.where(~F.col("decided")).drop("reject_reason", "decided"), f"{held_path}/chunks", epoch)
        waiting = verdict.where(~F.col("decided")).select("request_id", F.lit(None).cast("string").alias("reason"), F.lit(None).cast("long").alias("left"),
                                                          "request_chunks", "n_chunks", "n_bytes", "batches")
        rejected = verdict.where(F.col("reject_reason").isNotNull() & (F.col("left") > 0))
        write_batch(waiting.unionByName(rejected.select("request_id", F.col("reject_reason").alias("reason"), "left"), allowMissingColumns=True),
                    f"{held_path}/open", epoch)
        ended = verdict.where(F.col("decided") & (F.size("before") > 0)).select("request_id", "reject_reason", F.col("before").alias("batches"))
        out = out.unionByName(_held(spark, held_path, ended), allowMissingColumns=True)
    return out


def _single(chunks: DataFrame) -> DataFrame:
    """:func:`one_per_chunk`, for which only the chunks of repeated ids move."""
    repeated = chunks.groupBy("chunk_id").count().where("count > 1").select("chunk_id").checkpoint(eager=True)
    n = repeated.count()
    if n > MAX_BROADCAST_REQUESTS:
        return one_per_chunk(chunks).checkpoint(eager=True)
    if n == 0:
        return chunks
    again = one_per_chunk(chunks.join(F.broadcast(repeated), "chunk_id", "left_semi")).checkpoint(eager=True)
    return chunks.join(F.broadcast(repeated), "chunk_id", "left_anti").unionByName(again)


def process_batch(batch: DataFrame, epoch: int, *, points_path: str, dead_path: str, held_path: str | None = None, embedder=None,
                  version: int = 1, max_items: int = 500, max_bytes: int = 5242880) -> None:
    spark = batch.sparkSession
    embedder = embedder or HashingEmbedder()
    checkpoint_dir(spark)
    if "request_chunks" not in batch.columns:
        batch = batch.withColumn("request_chunks", F.lit(None).cast("long"))
    batch = batch.persist()
    try:
        j = validate_chunks(admit(batch, epoch, held_path, max_items, max_bytes))
        reason = F.when(F.col("reject_reason").isNotNull(), F.col("reject_reason")) \
            .when(~F.col("valid"), F.concat(F.lit("missing:"), F.array_join("missing", ",")))
        j = j.withColumn("reason", reason)
        # One row per chunk id before anything is embedded: a repeated id is one point.
        good = _single(j.where(F.col("reason").isNull())).withColumn(
            "input", embedding_input("name", "contents", F.col("meta")["content_type"] == "html"))
        # Points and dead letters both read the vectors, which are made once; the texts are read again.
        vec = embedder.embed(good.select("chunk_id", "input"), ["chunk_id"], "input", role="passage").checkpoint(eager=True)
        emb = good.join(vec, "chunk_id", "left")
        failed = F.concat_ws(": ", F.lit("embed_failed"), F.col("embed_error")) if "embed_error" in emb.columns else F.lit("embed_failed")
        pts = emb.where(F.col("vector").isNotNull()).select(
            F.col("chunk_id").alias("point_id"), "vector",
            chunk_payload("chunk_id", "item_sequence", "name", "contents", "meta").alias("payload"),
            F.lit(int(version)).alias("embedding_version"))
        dead = j.where(F.col("reason").isNotNull()).select("chunk_id", "request_id", "reason") \
            .unionByName(emb.where(F.col("vector").isNull())
                         .select("chunk_id", "request_id", failed.alias("reason")))
        write_batch(pts, points_path, epoch)
        write_batch(dead, dead_path, epoch)
    finally:
        batch.unpersist()


def start_embed_stream(spark: SparkSession, source_path: str, points_path: str, dead_path: str,
                       checkpoint: str, *, embedder=None, version: int = 1, available_now: bool = True,
                       max_files_per_trigger: int | None = None, max_items: int = 500,
                       max_bytes: int = 5242880):
    src = stream_chunk_requests(spark, source_path, max_files_per_trigger)

    def fb(df, epoch):
        process_batch(df, epoch, points_path=points_path, dead_path=dead_path, held_path=f"{checkpoint.rstrip('/')}-held", embedder=embedder,
                      version=version, max_items=max_items, max_bytes=max_bytes)

    w = src.writeStream.foreachBatch(fb).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="5 seconds")
    return w.start()


def read_points(spark: SparkSession, points_path: str) -> DataFrame:
    """The current points: of each id the one written last."""
    return current(spark, points_path, POINTS_SCHEMA, ["point_id"])


def read_dead_letters(spark: SparkSession, dead_path: str) -> DataFrame:
    return read_batches(spark, dead_path, DEAD_SCHEMA).withColumnRenamed("batch", "epoch")


def read_held(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Chunks that still wait for the rest of their requests."""
    path = f"{checkpoint.rstrip('/')}-held"
    waiting = _open(spark, path, last_batch(spark, f"{path}/open")).where("reason is null").select("request_id", "batches")
    return _held(spark, path, waiting)


def stream_load(metrics: DataFrame, threshold: float = 0.7, size_col: str = "size", max_col: str = "max_size") -> DataFrame:
    """Load status (ST4): usage = size / max, available while size < floor(max x threshold)."""
    return metrics.withColumn("usage", F.col(size_col) / F.col(max_col)) \
        .withColumn("available", F.col(size_col) < F.floor(F.col(max_col) * F.lit(float(threshold))))


def progress_rows(spark: SparkSession, query) -> DataFrame:
    """The query's recent progress as rows (batch id, input rows, rates, duration)."""
    rows = [(p["batchId"], p.get("numInputRows", 0), float(p.get("inputRowsPerSecond") or 0.0),
             float(p.get("processedRowsPerSecond") or 0.0), int((p.get("durationMs") or {}).get("triggerExecution", 0)))
            for p in query.recentProgress]
    return spark.createDataFrame(rows, "batch_id long, input_rows long, input_rate double, process_rate double, duration_ms long")
