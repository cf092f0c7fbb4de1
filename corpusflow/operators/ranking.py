"""Global ordering without a single-partition window.

A global 1-based rank is computed in two passes over a range-partitioned,
checkpointed copy: per-partition counts (one row per partition, broadcast)
give each partition its offset; each row adds its position inside its
partition. The checkpoint fixes the range bounds, so both passes see the
same partitioning, and it survives executor loss.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir

_LOCAL_MASK = (1 << 33) - 1


def global_rank(df: DataFrame, order_col: str, rank_col: str = "rank",
                num_partitions: int | None = None) -> DataFrame:
    """Add ``rank_col`` = 1-based position of each row by ascending ``order_col``
    (ties broken arbitrarily but consistently)."""
    checkpoint_dir(df.sparkSession)
    # Finding range bounds runs the input once more: an input that is more than
    # a scan is written first. The shuffle setting, coalesced by size, gives the ranges.
    to = [num_partitions] if num_partitions else []
    ranged = df.checkpoint(eager=True).repartitionByRange(*to, F.col(order_col)).sortWithinPartitions(order_col).checkpoint(eager=True)
    # monotonically_increasing_id = partition index << 33 | position in partition
    local = ranged.withColumn("_mid", F.monotonically_increasing_id()) \
        .withColumn("_pid", F.shiftright("_mid", 33)) \
        .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit(_LOCAL_MASK)))
    counts = local.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # At most one row per partition: a bounded, broadcastable table.
    offsets = counts.select("_pid", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_off"))
    return local.join(F.broadcast(offsets), "_pid") \
        .withColumn(rank_col, F.col("_off") + F.col("_pos") + 1) \
        .drop("_mid", "_pid", "_pos", "_off")


def page_anchors(ids: DataFrame, id_col: str, page_size: int) -> DataFrame:
    """First id of every page of ``page_size`` ids in ascending order (W1):
    columns (page_no, start_id)."""
    if page_size <= 0:
        raise ValueError("page_size must be positive")
    ranked = global_rank(ids.select(id_col), id_col)
    return ranked.where((F.col("rank") - 1) % page_size == 0) \
        .select(((F.col("rank") - 1) / page_size + 1).cast("long").alias("page_no"),
                F.col(id_col).alias("start_id"))


def page_ranges(anchors: DataFrame) -> DataFrame:
    """Half-open id ranges [start_id, end_id) between consecutive anchors; the
    last range is open (W2). An equi-join on page_no + 1, no global window."""
    nxt = anchors.select((F.col("page_no") - 1).alias("page_no"), F.col("start_id").alias("end_id"))
    return anchors.join(nxt, "page_no", "left").select("page_no", "start_id", "end_id")


def assign_pages(df: DataFrame, id_col: str, page_size: int) -> DataFrame:
    """Page number of every row when ids are paged in ascending order."""
    return global_rank(df, id_col).withColumn(
        "page_no", ((F.col("rank") - 1) / page_size + 1).cast("long"))


def ids_by_page(df: DataFrame, id_col: str, page_no: int, page_size: int, directory: DataFrame | None = None) -> DataFrame:
    """Ids of page ``page_no`` (1-based) in ascending order with their rank (L1);
    bad page or size -> empty. With a stored page directory this is one pushed
    range scan at any depth (``sources.scan``)."""
    from ..sources.scan import scan_page
    return scan_page(df, id_col, page_no, page_size, None, [id_col], directory).withColumnRenamed("position", "rank")


def total_pages(df: DataFrame, page_size: int) -> DataFrame:
    """ceil(count / size); size <= 0 -> 0 (A4). One aggregate row."""
    if page_size <= 0:
        return df.sparkSession.range(1).select(F.lit(0).cast("long").alias("total_pages"))
    return df.agg(F.count(F.lit(1)).alias("n")).select(
        F.floor((F.col("n") + page_size - 1) / page_size).cast("long").alias("total_pages"))


def scroll(df: DataFrame, id_col: str, after=None, limit: int = 10) -> DataFrame:
    """Keyset scroll (L3): ids after ``after`` in ascending order, ``limit`` rows."""
    src = df if after is None else df.where(F.col(id_col) > F.lit(after))
    return src.orderBy(id_col).limit(limit)
