"""Stateful streaming exact deduplication (operator 2), native DataFrame and SQL functions only.

A Structured Streaming aggregation keyed by digest keeps, on disk and without
expiry, the first row (smallest doc_id; its file and row number locate the
content) and the number of rows. Partial aggregation runs before the shuffle,
so a text that a third of all rows share reaches the state as one row a task.
Rows that hit a digest are compared byte for byte with the content at its
locator; those that differ (a digest collision) are grouped by their full text.

Texts are equal when identical after replacing each run of ``[\\x20\\x09-\\x0D]``
by one blank. Defined cases: null texts count as empty; null doc_ids come last;
rows with the same doc_id and text are ordered by file and row, and one stays;
other columns are never read; an empty table gives no rows.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusflow.llm.common import id_filter, maybe_in, saved, work_path

TRIGGER_BYTES = 2 << 30  # of input files in a micro-batch; the next ones meet its state
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB,
         # Many small stores: no megabytes of disk set aside for each one's logs.
         "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false"}


def normalised(text: str = "text") -> Column:
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _rows(df: DataFrame, digest_chars: int, *more: Column) -> DataFrame:
    return (df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"),
                      normalised().alias("norm"))
            .withColumn("sha", F.sha2(F.col("norm").cast("binary"), 256))
            .select("doc_id", "file", "row", "sha", F.unhex(F.substring("sha", 1, digest_chars)).alias("digest"), *more))


def _first() -> Column:
    """Order of the rows of a text: doc_id (null last), then place."""
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "file", "row")


def stream_state(spark: SparkSession, path: str, checkpoint: str, out: str, digest_chars: int = 64, max_bytes_per_trigger: int | None = None) -> DataFrame:
    """Run the stream over the files at ``path`` that ``checkpoint`` has not seen; (digest, first, n) of all so far.

    The checkpoint holds the state: a later call with the same folders takes
    up new files and keeps the earlier identities.
    """
    schema = spark.read.parquet(path).select("doc_id", "text").schema
    # As a pattern that matches the path alone, it may be a folder or a single file.
    pattern = f"{path.rstrip('/')[:-1]}[{path.rstrip('/')[-1]}]"
    src = spark.readStream.schema(schema).option("maxBytesPerTrigger", max_bytes_per_trigger or TRIGGER_BYTES).parquet(pattern)
    state = _rows(src, digest_chars).groupBy("digest").agg(F.min(_first()).alias("first"), F.count("*").alias("n"))

    def keep(batch: DataFrame, epoch: int) -> None:
        batch.withColumn("epoch", F.lit(epoch)).write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    before = {k: spark.conf.get(k, None) for k in STATE}
    for k, v in STATE.items():
        spark.conf.set(k, v)
    try:
        q = state.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(keep).start()
        q.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    fields = "digest binary, first struct<none:boolean,doc_id:bigint,file:string,row:bigint>, n bigint, epoch int"
    try:
        seen = spark.read.schema(fields).parquet(f"{out}/epoch=*")
    except Exception as e:  # no file at all: no batch ran
        if "PATH_NOT_FOUND" not in str(e):
            raise
        seen = spark.createDataFrame([], fields)
    return seen.groupBy("digest").agg(F.max(F.struct("epoch", "first", "n")).alias("s")).select("digest", "s.first", "s.n")


def stateful_dedup(spark: SparkSession, path: str, digest_chars: int = 64, max_bytes_per_trigger: int | None = None) -> DataFrame:
    """One row per row at ``path``: doc_id, keep_id, group_size, kept, text_sha256.

    ``digest_chars``: hex digits of SHA-256 in the state's key (fewer only to
    provoke collisions in tests; an even number).
    """
    groups = saved(stream_state(spark, path, work_path(spark, "dedup-state"), work_path(spark, "dedup-out"), digest_chars, max_bytes_per_trigger), "dedup-groups")
    scan = spark.read.parquet(path)
    rows = saved(_rows(scan, digest_chars), "dedup-rows")

    # Full bytes on hits: only texts whose digest may repeat move.
    many = groups.where("n > 1")
    texts = maybe_in(_rows(scan, digest_chars, F.col("norm")), "digest", id_filter(many, "digest"))
    heads = (texts.alias("t").join(many.alias("m"), (F.col("t.digest") == F.col("m.digest")) & (F.col("t.file") == F.col("m.first.file")) & (F.col("t.row") == F.col("m.first.row")))
             .select(F.col("t.digest").alias("digest"), F.col("t.norm").alias("head"), F.col("m.first").alias("first")))
    odd = (texts.join(heads, "digest").where("norm <> head")
           .select("doc_id", "file", "row", "digest", "norm"))
    odd = saved(odd, "dedup-collisions")  # empty unless digests collide
    regrouped = odd.groupBy("digest", "norm").agg(F.min(_first()).alias("first2"), F.count("*").alias("n2"))
    moved = odd.join(regrouped, ["digest", "norm"]).select("file", "row", "first2", "n2")
    fewer = odd.groupBy("digest").agg(F.count("*").alias("gone"))

    whole = groups.join(fewer, "digest", "left").select("digest", "first", (F.col("n") - F.coalesce("gone", F.lit(0))).alias("n"))
    out = rows.join(whole, "digest").join(F.broadcast(moved) if moved.isEmpty() else moved, ["file", "row"], "left")
    first, n = F.coalesce("first2", "first"), F.coalesce("n2", "n")
    return out.select("doc_id", first["doc_id"].alias("keep_id"), n.cast("long").alias("group_size"),
                      ((F.col("file") == first["file"]) & (F.col("row") == first["row"])).alias("kept"), F.col("sha").alias("text_sha256"))
