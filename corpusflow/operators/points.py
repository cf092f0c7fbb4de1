"""Vector point table operators: idempotent upsert (S10), delete (V7),
collection schema check (S11), counts (A1) and the index summary (A2).

points(point_id STRING, vector ARRAY<FLOAT>, type, doc_id, embedding_version INT, ...)
collection_meta(name, dim INT, distance)
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import needs_index
from ..functions.vectors import canonical_distance
from .merge import delete_by_ids, merge_upsert

POLICIES = ("error", "recreate", "ignore")


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Append the columns of a one-row aggregate to every row of ``df``.

    The row travels as one scalar subquery (a struct), evaluated once and
    inlined as a value: no join, no broadcast of anything that grows."""
    cols = one_row.columns
    sub = one_row.select(F.struct(*[F.col(c) for c in cols]).alias("_row")).scalar()
    return df.withColumn("_row", sub).select(*df.columns, *[F.col("_row")[c].alias(c) for c in cols])


def upsert_points(points: DataFrame, new: DataFrame, order_col: str | None = None) -> DataFrame:
    """Points after an idempotent upsert by point_id (S10), with ``_action``.
    Replaying the same batch gives 'same' for every row."""
    return merge_upsert(points, new, ["point_id"], order_col)


def delete_points(points: DataFrame, ids: DataFrame) -> DataFrame:
    """Points without the given ids (V7)."""
    return delete_by_ids(points, ids, "point_id")


def check_vector_schema(new: DataFrame, meta: DataFrame | None, distance: str = "cosine",
                        on_mismatch: str = "error", vec_col: str = "vector") -> DataFrame:
    """Compare an incoming batch with the collection schema.

    One aggregate over the batch (min/max vector size) joined with the one-row
    ``meta``. ``decision``: 'empty' (nothing to check: the batch has no
    vectors), 'create' (no collection), 'ok', or the mismatch
    policy ('recreate', 'error', 'ignore'); an inconsistent batch (several
    sizes) is always 'error'. :func:`ensure_collection` acts on it.
    """
    if on_mismatch not in POLICIES:
        raise ValueError(f"on_mismatch must be one of {POLICIES}")
    want = canonical_distance(distance)
    b = new.agg(F.min(F.size(vec_col)).alias("batch_min_dim"), F.max(F.size(vec_col)).alias("batch_max_dim"))
    spark = new.sparkSession
    if meta is None:
        meta = spark.createDataFrame([], "name string, dim int, distance string")
    m = meta.agg(F.max("dim").alias("coll_dim"), F.max("distance").alias("coll_distance"),
                 F.count(F.lit(1)).alias("_n"))
    j = attach_row(b, m)
    coll_dist = F.col("coll_distance")
    decision = (F.when(F.col("batch_max_dim").isNull(), "empty")
                .when(F.col("batch_min_dim") != F.col("batch_max_dim"), "error")
                .when(F.col("_n") == 0, "create")
                .when((F.col("coll_dim") == F.col("batch_max_dim")) & (coll_dist == F.lit(want)), "ok")
                .otherwise(F.lit(on_mismatch)))
    return j.select("batch_min_dim", "batch_max_dim", "coll_dim", "coll_distance",
                    F.lit(want).alias("want_distance"), decision.alias("decision"))


def ensure_collection(new: DataFrame, meta: DataFrame | None, name: str, distance: str = "cosine",
                      on_mismatch: str = "error", vec_col: str = "vector"):
    """Apply S11: returns (meta to write, drop_existing_points). Raises on 'error'."""
    row = check_vector_schema(new, meta, distance, on_mismatch, vec_col).first()
    spark = new.sparkSession
    if row["decision"] == "error":
        raise RuntimeError(f"vector schema mismatch for {name}: batch dims "
                           f"{row['batch_min_dim']}..{row['batch_max_dim']}, collection {row['coll_dim']}/"
                           f"{row['coll_distance']}, want {row['want_distance']}")
    if row["decision"] in ("create", "recreate"):
        m = spark.createDataFrame([(name, int(row["batch_max_dim"] or 0), row["want_distance"])],
                                  "name string, dim int, distance string")
        return m, row["decision"] == "recreate"
    return meta, False


def points_count(points: DataFrame, by=(), **equals) -> DataFrame:
    """Exact count of points matching equality filters (A1)."""
    src = points
    for k, v in equals.items():
        src = src.where(F.col(k) == F.lit(v))
    return src.groupBy(*by).agg(F.count(F.lit(1)).alias("points"))


def index_summary(docs: DataFrame, state: DataFrame, points: DataFrame, version: int, dataset_type: str = "documents") -> DataFrame:
    """Index summary (A2): points per (type, version) with document totals.

    ``docs`` has (doc_id, row_hash), the stored hash, or else text_hash. One
    aggregate over docs ⟕ state and one over points; the one-row document
    totals are attached to every points row. A collection without a point of
    ``dataset_type`` and ``version`` still has its row.
    """
    by = "indexed_row_hash" if "indexed_row_hash" in state.columns and "row_hash" in docs.columns else "indexed_hash"
    now = "row_hash" if by == "indexed_row_hash" else "text_hash"
    st = state.select("doc_id", "embedding_version", by, F.lit(True).alias("has_state"))
    d = docs.select("doc_id", now).join(st, "doc_id", "left").agg(
        F.count(F.lit(1)).alias("documents"),
        F.count_if(F.col("embedding_version").eqNullSafe(F.lit(str(version)))).alias("indexed_current"),
        F.count_if(needs_index(version, current_hash=now, indexed_hash=by)).alias("needs_index"))
    p = points.groupBy("type", "embedding_version").agg(F.count(F.lit(1)).alias("points"))
    own = points.sparkSession.range(1).select(F.lit(dataset_type).alias("type"), F.lit(int(version)).alias("embedding_version"))
    p = p.join(own, ["type", "embedding_version"], "full_outer").withColumn("points", F.coalesce("points", F.lit(0)).cast("long"))
    return attach_row(p, d)
