"""Exact and list-pruned top-k similarity search.

Plan: points and queries meet on a grid. A point lies in one of the point
tiles and is sent to every query tile, a query lies in one query tile and is
sent to every point tile; a tile holds at most about ``max_block_bytes`` of
vectors a side, so each (point tile x query tile) group is of bounded size
whatever the tables' sizes. A group scores its pairs in blocks of at most
``SCORE_BYTES`` and returns the local top k + offset of each query; a window
per query, whose rank limit Spark applies before its shuffle, merges them.
Queries and points stay on the executors; the driver sees row counts.

With an inverted file (``build_ivf``) the grid is laid per list: a point lies
in the cell of its list, a query in the cells of the lists it probes, and a
list of any size is cut into as many tiles as it needs.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vectors import NORM_EPS, canonical_distance
from ..session import checkpoint_dir

# Vectors of one side of a tile (bytes of float64), and the scores held at once.
MAX_BLOCK_BYTES = 4 * 1024 * 1024
SCORE_BYTES = 32 * 1024 * 1024
# Scores of all lists, and copies for the probed ones, of the queries that are sent out at once.
PROBE_BYTES = 8 * 1024 * 1024
# Lists of an inverted file: their centroids and sizes are small tables.
MAX_LISTS, SAMPLE_PER_LIST, CALIBRATION_QUERIES = 65_536, 256, 256


def _matrix(col: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers that hold a vector, their vectors as one float64 matrix)."""
    lengths = pc.fill_null(pc.list_value_length(col), 0).to_numpy()
    rows = np.flatnonzero(lengths)
    if len(rows) == 0:
        return rows, np.empty((0, 0))
    dims = np.unique(lengths[rows])
    if len(dims) > 1:
        raise ValueError(f"vectors of different dimensions in one search: {dims.tolist()}")
    flat = pc.list_flatten(col).combine_chunks().cast(pa.float64()).to_numpy(zero_copy_only=False)
    return rows, flat.reshape(len(rows), dims[0])


def _pair_scores(p: np.ndarray, q: np.ndarray, metric: str) -> np.ndarray:
    """Scores of the rows of ``p`` with one query, each summed in the same order."""
    if metric == "euclid":
        return np.sqrt(((p - q) ** 2).sum(axis=1))
    s = (p * q).sum(axis=1)
    if metric == "dot":
        return s
    norms = np.maximum(np.sqrt((p * p).sum(axis=1)), NORM_EPS) * max(float(np.sqrt((q * q).sum())), NORM_EPS)
    return s / norms


def _tile_topk(metric: str, keep: int, threshold: float | None, id_col: str, carry: list[str], schema: pa.Schema,
               own_row: bool):
    """The group function: local top ``keep`` of each query of a tile."""
    def run(points: pa.Table, queries: pa.Table) -> pa.Table:
        p_rows, p = _matrix(points["_vec"])
        q_rows, q = _matrix(queries["_vec"])
        if len(p_rows) == 0 or len(q_rows) == 0:
            return schema.empty_table()
        if p.shape[1] != q.shape[1]:
            raise ValueError(f"points of dimension {p.shape[1]} searched by queries of dimension {q.shape[1]}")
        by_id = pc.rank(points[id_col].combine_chunks(), sort_keys="ascending", null_placement="at_end", tiebreaker="dense").to_numpy()[p_rows]
        p_norm = np.sqrt((p * p).sum(axis=1))
        q_norm = np.sqrt((q * q).sum(axis=1))
        own = dict(zip(points["_row"].to_numpy()[p_rows].tolist(), range(len(p_rows)))) if own_row else {}
        q_keys = queries["query_id"].to_pylist() if own_row else []
        kk = min(keep, len(p))
        hit_p, hit_q, scores = [], [], []
        step = max(1, SCORE_BYTES // (8 * len(p)))
        for at in range(0, len(q), step):
            block = q[at:at + step]
            s = block @ p.T
            # ``key`` ascends with rank; ``slack`` covers what sums in another order can differ by.
            if metric == "euclid":
                key = (p_norm ** 2)[None, :] + (q_norm[at:at + step] ** 2)[:, None] - 2.0 * s
                slack = 1e-9 * (p_norm.max() ** 2 + q_norm[at:at + step] ** 2 + 1.0)
            elif metric == "dot":
                key, slack = -s, 1e-9 * (p_norm.max() * q_norm[at:at + step] + 1.0)
            else:
                key = -s / (np.maximum(p_norm, NORM_EPS)[None, :] * np.maximum(q_norm[at:at + step], NORM_EPS)[:, None])
                slack = np.full(len(block), 1e-9)
            for i in range(len(block)):
                if own_row and (j := own.get(q_keys[q_rows[at + i]])) is not None:
                    key[i, j] = np.inf
            kth = np.partition(key, kk - 1, axis=1)[:, kk - 1]
            for i in range(len(block)):
                rows = np.flatnonzero(np.isfinite(key[i]) & ~(key[i] > kth[i] + slack[i]))
                exact = _pair_scores(p[rows], block[i], metric)
                order = np.lexsort((by_id[rows], exact if metric == "euclid" else -exact))[:kk]
                rows, exact = rows[order], exact[order]
                if threshold is not None:
                    good = exact <= threshold if metric == "euclid" else exact >= threshold
                    rows, exact = rows[good], exact[good]
                hit_p.append(p_rows[rows])
                hit_q.append(np.full(len(rows), q_rows[at + i]))
                scores.append(exact)
        take_p, take_q = pa.array(np.concatenate(hit_p)), pa.array(np.concatenate(hit_q))
        cols = [queries["query_id"].take(take_q), pa.array(np.concatenate(scores))]
        cols += [points[c].take(take_p) for c in (id_col, *carry)]
        return pa.table(cols, names=schema.names).cast(schema)
    return run


def tiled_topk(points: DataFrame, queries: DataFrame, keep: int, metric: str = "cosine", threshold: float | None = None,
               id_col: str = "point_id", vec_col: str = "vector", query_vec: str = "vector", carry=(),
               cell: str | None = None, row_col: str | None = None, max_block_bytes: int = MAX_BLOCK_BYTES) -> DataFrame:
    """Candidates (query_id, score, id, carried columns): each tile's best ``keep`` points per query.

    ``queries`` hold query_id and ``query_vec``. With ``cell`` both sides have
    such a column and only rows of equal cell meet; the number of cells must be
    small (at most ``MAX_LISTS``). With ``row_col``, a point is no hit of the
    query whose query_id equals its ``row_col``. Equal scores go to the smaller
    id. Rows without a vector, and vectors holding null or NaN, have no hits;
    vectors of different dimensions raise ValueError.
    """
    metric = canonical_distance(metric)
    carry = list(carry)
    key = F.col(row_col or id_col)
    p = points.select(key.alias("_row"), F.col(vec_col).alias("_vec"), id_col, *carry, (F.col(cell) if cell else F.lit(0)).cast("int").alias("_cell")).where("_vec is not null")
    q = queries.select("query_id", F.col(query_vec).alias("_vec"), (F.col(cell) if cell else F.lit(0)).cast("int").alias("_cell")).where("_vec is not null")
    dim, n_points = p.agg(F.max(F.size("_vec")), F.count("*")).first()
    rows = max(1, max_block_bytes // (8 * (dim or 1)))
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    spread = lambda c, n: F.pmod(F.xxhash64(c), n).cast("int")
    if cell:
        tiles = lambda df, n: df.groupBy("_cell").agg(F.ceil(F.count("*") / rows).cast("int").alias(n))
        # One row a cell: bounded by the number of cells, not by the data.
        grid = F.broadcast(tiles(p, "_np").join(tiles(q, "_nq"), "_cell"))
        p, q = p.join(grid, "_cell"), q.join(grid, "_cell")
        n_p, n_q = F.col("_np"), F.col("_nq")
    else:
        n_p, n_q = F.lit(max(1, -(-n_points // rows))), F.lit(max(1, -(-q.count() // rows)))
    p = p.select("*", spread("_row", n_p).alias("_pt"), every(n_q).alias("_qt")).drop("_np", "_nq")
    q = q.select("*", spread("query_id", n_q).alias("_qt"), every(n_p).alias("_pt")).drop("_np", "_nq")
    out = points.select(id_col, *carry).schema
    ddl = ", ".join([f"query_id {q.schema['query_id'].dataType.simpleString()}", "score double",
                     *(f"`{f.name}` {f.dataType.simpleString()}" for f in out)])
    from pyspark.sql.pandas.types import to_arrow_schema
    empty = points.sparkSession.createDataFrame([], ddl)
    run = _tile_topk(metric, keep, threshold, id_col, carry, to_arrow_schema(empty.schema), row_col is not None)
    at = ["_cell", "_pt", "_qt"]
    return p.groupBy(*at).cogroup(q.groupBy(*at)).applyInArrow(run, ddl)


def _ranked(cand: DataFrame, k: int, offset: int, metric: str, id_col: str) -> DataFrame:
    score: Column = F.col("score").asc() if canonical_distance(metric) == "euclid" else F.col("score").desc()
    w = Window.partitionBy("query_id").orderBy(score, F.col(id_col).asc_nulls_last())
    top = cand.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= offset + k)
    return top.where(F.col("_rn") > offset).withColumn("rank", (F.col("_rn") - offset).cast("int")).drop("_rn")


def search(points: DataFrame, queries: DataFrame, k: int = 5, metric: str = "cosine", where=None,
           threshold: float | None = None, offset: int = 0, with_vectors: bool = False,
           id_col: str = "point_id", vec_col: str = "vector", query_id: str = "query_id",
           query_vec: str = "vector", payload_cols=(), max_block_bytes: int = MAX_BLOCK_BYTES,
           cell: str | None = None) -> DataFrame:
    """Top-k points per query: (query_id, rank, id, score[, payload..., vector]).

    ``where`` is a Column over points (payload filter, F4) and runs before any
    Python; ``threshold`` drops weaker hits (F9); ``offset`` skips the first
    hits (L2). Ranks are 1-based after the offset; ties go to the smaller
    point id. Other arguments as for ``tiled_topk``.
    """
    if k <= 0:
        raise ValueError("k must be positive")
    offset = max(0, offset)
    src = points if where is None else points.where(where)
    # The query side is counted and then read: computed once.
    checkpoint_dir(points.sparkSession)
    q = queries.select(F.col(query_id).alias("query_id"), F.col(query_vec).alias("_qv"), *([cell] if cell else [])).checkpoint(eager=True)
    carry = list(payload_cols) + ([vec_col] if with_vectors and vec_col not in payload_cols else [])
    cand = tiled_topk(src, q, k + offset, metric, threshold, id_col, vec_col, "_qv", carry, cell, None, max_block_bytes)
    return _ranked(cand, k, offset, metric, id_col)


def build_ivf(points: DataFrame, nlist: int | None = None, vec_col: str = "vector", seed: int = 7, max_iter: int = 20):
    """Inverted-file index: MLlib k-means over the L2-normalized vectors
    (spherical k-means for cosine); returns (points with a ``cluster`` column,
    centroids ndarray). Every point is in a list.

    Without ``nlist`` there are about as many lists as a list has points (the
    square root of the row count, ``MAX_LISTS`` at most). The centroids are
    fitted on about ``SAMPLE_PER_LIST`` points a list."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    from ..functions.vectors import l2_normalize
    feats = points.where(F.col(vec_col).isNotNull()).withColumn("_f", array_to_vector(l2_normalize(vec_col)))
    n = feats.count()
    nlist = nlist or max(2, min(MAX_LISTS, round(n ** 0.5)))
    fraction = min(1.0, 1.1 * SAMPLE_PER_LIST * nlist / max(n, 1))
    sample = feats if fraction == 1.0 else feats.sample(fraction, seed=seed)
    model = KMeans(k=nlist, seed=seed, maxIter=max_iter, featuresCol="_f", predictionCol="cluster").fit(sample)
    centers = np.array(model.clusterCenters(), dtype=np.float64)
    return model.transform(feats).drop("_f"), centers


def _unit(m: np.ndarray) -> np.ndarray:
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), NORM_EPS)


def list_order(vectors: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Lists of each vector, the nearest centroid (by cosine) first."""
    return np.argsort(-(_unit(vectors) @ _unit(centers).T), axis=1, kind="stable")


def _sent(queries: pa.Table, centers: np.ndarray, nprobe: int, cell: str) -> Iterator[pa.Table]:
    """The queries of a batch, each for the lists it probes, in tables of about ``PROBE_BYTES``:
    a batch has thousands of queries, and each meets all centroids and is sent to many lists."""
    rows, m = _matrix(queries["vector"])
    step = max(1, PROBE_BYTES // (8 * (len(centers) + nprobe * centers.shape[1])))
    for at in range(0, len(rows), step):
        lists = list_order(m[at:at + step], centers)[:, :nprobe]
        yield queries.take(pa.array(np.repeat(rows[at:at + step], nprobe))).append_column(cell, pa.array(lists.ravel().astype(np.int32)))


def probed(queries: DataFrame, centers: np.ndarray, nprobe: int, query_id: str = "query_id", query_vec: str = "vector",
           cell: str = "cluster") -> DataFrame:
    """One row per query and probed list: (query_id, vector, ``cell``)."""
    nprobe = max(1, min(int(nprobe), len(centers)))
    q = queries.select(F.col(query_id).alias("query_id"), F.col(query_vec).alias("vector"))
    shared = q.sparkSession.sparkContext.broadcast(centers)

    def run(batches):
        for b in batches:
            for out in _sent(pa.Table.from_batches([b]), shared.value, nprobe, cell):
                yield from out.to_batches()
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in q.schema) + f", {cell} int"
    return q.mapInArrow(run, ddl)


def search_ivf(points_with_cluster: DataFrame, centers, queries: DataFrame, k: int = 5, nprobe: int = 4, query_id: str = "query_id",
               query_vec: str = "vector", **kw) -> DataFrame:
    """Top-k over the ``nprobe`` lists nearest each query (cosine): a query meets
    the points of its lists only. Approximate unless ``nprobe`` equals the
    number of lists, where it is exact."""
    q = probed(queries, np.asarray(centers, np.float64), nprobe, query_id, query_vec)
    return search(points_with_cluster, q, k=k, metric="cosine", cell="cluster", **kw)


def calibrate_nprobe(points_with_cluster: DataFrame, centers, queries: DataFrame, k: int = 5, recall: float = 0.95,
                     sample: int = CALIBRATION_QUERIES, **kw) -> int:
    """Smallest number of lists that finds ``recall`` of the exact hits of ``sample``
    queries (those of smallest hash). The sample's hits and vectors, at most
    ``sample * k`` rows, come to the driver."""
    checkpoint_dir(queries.sparkSession)
    some = queries.where("vector is not null").orderBy(F.xxhash64("query_id"), "query_id").limit(sample).checkpoint(eager=True)
    vectors = {r["query_id"]: r["vector"] for r in some.collect()}
    hits = search(points_with_cluster, some, k=k, payload_cols=["cluster"], **kw).collect()
    if not hits:
        return 1
    ids = list(vectors)
    order = list_order(np.array([vectors[i] for i in ids], np.float64), np.asarray(centers))
    place = dict(zip(ids, np.argsort(order, axis=1)))
    need = np.sort([place[h["query_id"]][h["cluster"]] for h in hits])
    return int(need[min(len(need) - 1, int(np.ceil(recall * len(need))) - 1)]) + 1
