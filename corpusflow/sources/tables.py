"""Tables that grow by batches, on plain partitioned Parquet.

A run appends the rows it changed as one partition ``batch=<n>``; writing a
batch again replaces that partition, so a run that is repeated after a stop
writes the same table. The current rows are the latest of each key; a row with
``deleted`` set takes its key away. Nothing that is being read is overwritten.
(With Delta Lake or Iceberg on the classpath, MERGE INTO replaces this.)
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import merge_upsert


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def last_batch(spark: SparkSession, path: str) -> int | None:
    """Number of the last batch, which may hold no rows."""
    if not exists(spark, path):
        return None
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    names = [f.getPath().getName() for f in p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)]
    return max((int(n.removeprefix("batch=")) for n in names if n.startswith("batch=")), default=None)


def write_batch(df: DataFrame, path: str, batch: int) -> None:
    """Write (or replace) one batch of the table."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={int(batch)}")


def read_batches(spark: SparkSession, path: str, schema: str, before: int | None = None) -> DataFrame:
    """All rows of the table with their ``batch``; with ``before`` those of earlier
    batches, which partition pruning reads alone. A table without any batch is empty."""
    schema = f"{schema}, batch long"
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", path).parquet(path)
    return rows if before is None else rows.where(F.col("batch") < before)


def current(spark: SparkSession, path: str, schema: str, keys, before: int | None = None) -> DataFrame:
    """The latest row of each key (of ``schema``, which must have ``keys``), rows marked ``deleted`` left out."""
    keys = list(keys)
    rows = read_batches(spark, path, schema, before)
    others = [c for c in rows.columns if c not in keys and c != "batch"]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*others), "batch").alias("_r")).select(*keys, "_r.*")
    return last.where("deleted is not true").drop("deleted") if "deleted" in others else last


def upsert_bucketed(spark: SparkSession, path: str, new: DataFrame, key: str, buckets: int,
                    staging: str, schema: str) -> DataFrame:
    """Upsert ``new`` into a table stored partitioned by
    ``bucket = pmod(xxhash64(key), buckets)``, rewriting only the buckets the
    batch touches (S10 at scale).

    The touched buckets (at most ``buckets`` values, broadcast) prune the scan
    of the current table; the merged buckets are staged first (a path being
    read is never overwritten) and then swapped in with a dynamic partition
    overwrite. A failed commit is repaired by running the same upsert again:
    the merge is idempotent. Returns the merged rows of the touched buckets
    with ``_action``.
    """
    nb = new.withColumn("bucket", F.pmod(F.xxhash64(F.col(key)), F.lit(int(buckets))).cast("int"))
    touched = nb.select("bucket").distinct()
    cur = spark.read.schema(schema + ", bucket int").parquet(path) if exists(spark, path) \
        else spark.createDataFrame([], schema + ", bucket int")
    cur = cur.join(F.broadcast(touched), "bucket", "left_semi")
    merged = merge_upsert(cur, nb, [key])
    merged.write.mode("overwrite").partitionBy("bucket").parquet(staging)
    staged = spark.read.schema(merged.schema).parquet(staging)
    if staged.select("bucket").limit(1).count() or not exists(spark, path):
        staged.drop("_action").write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy("bucket").parquet(path)
    return staged
