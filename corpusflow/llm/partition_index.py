"""Approximate nearest neighbours by learned partitions (operator 11).

Fit, on a bounded sample (``SAMPLE`` rows, fewer if their vectors would pass
``SAMPLE_BYTES``): the neighbour graph of the sample under inner product, a
balanced partitioning of that graph (grown region by region, then moves that
cut fewer edges while no part passes its capacity), and a small classifier (one
hidden layer) that learns from a vector where its graph neighbours lie. There
are about sqrt(rows) / 4 parts, ``MAX_PARTS`` at most.

Index: every row goes to its most probable part. Search: a query goes to its
most probable parts, as many as find ``TARGET`` of the exact neighbours of
``CALIBRATION`` queries, which one exact pass over all rows gives, and more
until the parts hold enough rows. Query and rows of a part meet on a grid of
tiles of bounded size (``operators.search.tiled_topk``), so a part of any size,
copies included, is cut up; scores are exact inner products in double precision.

Defined cases: null vectors, empty and zero vectors and vectors that hold null,
NaN or an infinity take no part; a shorter vector counts as padded with zeros;
equal scores go to the smaller id, null ids last; a row with a null id is a
candidate but no query; rows with equal ids are rows of their own, each a query
and a candidate of the others; an empty table gives no rows; other columns are
ignored, whatever their names. Inner products beyond the double range are no hits.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from corpusflow.llm.common import saved
from corpusflow.operators.search import tiled_topk

K, EVERY = 20, 20
SAMPLE, SAMPLE_BYTES, NEIGHBOURS = 8_192, 32 << 20, 12
MAX_PARTS, SLACK = 128, 1.05
CALIBRATION, TARGET = 256, 0.95
HIDDEN, EPOCHS, BATCH, RATE = 64, 40, 256, 0.01


def searchable(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(row, id, vec): the rows that take part, each with a number of its own, as a table."""
    v = F.col("vec")
    finite = F.forall(v, lambda x: F.coalesce((F.abs(x.cast("double")) < float("inf")) & ~F.isnan(x), F.lit(False)))
    good = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec")).where(v.isNotNull() & finite & F.exists(v, lambda x: x != 0))
    sizes = good.agg(F.min(F.size("vec")), F.max(F.size("vec"))).first()
    if sizes[0] != sizes[1]:
        zero = F.lit(0).cast(good.schema["vec"].dataType.elementType)
        good = good.withColumn("vec", F.concat("vec", F.array_repeat(zero, F.lit(sizes[1]) - F.size("vec"))))
    return saved(good.select(F.monotonically_increasing_id().alias("row"), "id", "vec"), "op11-rows")


def balanced_parts(near: list[list[int]], parts: int) -> np.ndarray:
    """Part of each node of a graph given as neighbour lists: parts of nearly equal size, few edges between them."""
    n = len(near)
    links: list[set[int]] = [set(x) for x in near]
    for i, x in enumerate(near):
        for j in x:
            links[j].add(i)
    part = np.full(n, -1)
    room, free, seeds = np.full(parts, -(-n // parts)), set(range(n)), iter(range(n))
    for p in range(parts):  # a region grows from an unassigned node over its links
        front: list[int] = []
        while room[p] and free:
            i = front.pop(0) if front else next(s for s in seeds if s in free)
            if i in free:
                free.remove(i)
                part[i] = p
                room[p] -= 1
                front += [j for j in links[i] if j in free]
    room = np.full(parts, int(np.ceil(SLACK * n / parts))) - np.bincount(part, minlength=parts)
    for _ in range(10):
        moved = 0
        for i in range(n):
            if links[i]:
                ties = np.bincount(part[list(links[i])], minlength=parts)
                ties[(room <= 0) & (np.arange(parts) != part[i])] = -1
                to = int(ties.argmax())
                if ties[to] > ties[part[i]]:
                    room[part[i]] += 1
                    room[to] -= 1
                    part[i] = to
                    moved += 1
        if not moved:
            break
    return part


class Router:
    """The classifier: log-probabilities of the parts for vectors."""

    def __init__(self, x: np.ndarray, target: np.ndarray, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.scale = 1.0 / max(float(np.sqrt((x * x).mean())), 1e-12)
        d, m = x.shape[1], target.shape[1]
        self.w = [rng.normal(size=(d, HIDDEN)) / np.sqrt(d), np.zeros(HIDDEN), rng.normal(size=(HIDDEN, m)) / np.sqrt(HIDDEN), np.zeros(m), np.zeros((d, m))]
        first, second, step = [np.zeros_like(a) for a in self.w], [np.zeros_like(a) for a in self.w], 0
        x = x * self.scale
        for epoch in range(EPOCHS):
            rate = RATE * (1 - epoch / EPOCHS)
            order = rng.permutation(len(x))
            for at in range(0, len(x), BATCH):
                b, t = x[order[at:at + BATCH]], target[order[at:at + BATCH]]
                h, logits = self._forward(b)
                e = np.exp(logits - logits.max(axis=1, keepdims=True))
                g = (e / e.sum(axis=1, keepdims=True) - t) / len(b)
                gh = (g @ self.w[2].T) * (h > 0)
                step += 1
                for k, grad in enumerate((b.T @ gh, gh.sum(0), h.T @ g, g.sum(0), b.T @ g)):
                    first[k] = 0.9 * first[k] + 0.1 * grad
                    second[k] = 0.999 * second[k] + 0.001 * grad * grad
                    self.w[k] = self.w[k] - rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)

    def _forward(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = np.maximum(x @ self.w[0] + self.w[1], 0)
        return h, h @ self.w[2] + self.w[3] + x @ self.w[4]

    def order(self, x: np.ndarray) -> np.ndarray:
        """Parts of each vector, the most probable first."""
        return np.argsort(-self._forward(x * self.scale)[1], axis=1, kind="stable")


def _vectors(batch: pa.RecordBatch) -> np.ndarray:
    col = batch.column(batch.schema.get_field_index("vec"))
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(col), -1)


def fit(rows: DataFrame, n: int) -> Router:
    """The classifier learned on the sample of ``rows`` (row, id, vec), ``n`` of them."""
    dim = rows.select(F.size("vec")).first()[0]
    take = max(2, min(SAMPLE, SAMPLE_BYTES // (8 * dim)))
    sample = rows.orderBy(F.xxhash64("row"), "row").limit(take).select("row", "vec")
    sample = saved(sample.dropDuplicates(["vec"]), "op11-sample")
    links = tiled_topk(sample, sample.select(F.col("row").alias("query_id"), "vec"), NEIGHBOURS, "dot", id_col="row", vec_col="vec", query_vec="vec", row_col="row", max_block_bytes=256 << 10)
    best = links.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "row"))).alias("near"))
    found = sample.join(best, F.col("row") == F.col("query_id"), "left").select("row", "vec", F.slice("near", 1, NEIGHBOURS)["row"].alias("near")).orderBy("row").collect()
    x = np.array([r["vec"] for r in found], np.float64)
    at = {r["row"]: i for i, r in enumerate(found)}
    near = [[at[j] for j in r["near"] or ()] for r in found]
    parts = max(1, min(MAX_PARTS, round(n ** 0.5 / 4), len(x) // 2))
    part = balanced_parts(near, parts)
    target = np.zeros((len(x), parts))
    for i, js in enumerate(near):
        np.add.at(target[i], part[[i, *js]], 1.0 / (len(js) + 1))
    return Router(x, target)


def nearest(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K, every: int = EVERY) -> DataFrame:
    """The ``k`` nearest found of each row whose id ``every`` divides: query_id, rank, vec_id, score."""
    rows = searchable(vectors, id_col, vec_col)
    n = rows.count()
    if n < 2:
        return rows.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score")).limit(0)
    router = fit(rows, n)
    sc = rows.sparkSession.sparkContext
    shared = sc.broadcast(router)

    def place(batches):
        for b in batches:
            if b.num_rows:
                yield b.append_column("part", pa.array(shared.value.order(_vectors(b))[:, 0].astype(np.int32)))

    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", part int"
    index = saved(rows.mapInArrow(place, ddl), "op11-index")
    sizes = np.zeros(router.w[3].shape[0], np.int64)
    for r in index.groupBy("part").count().collect():  # one row a part
        sizes[r["part"]] = r["count"]

    queries = rows.where(F.col("id") % every == 0).select(F.col("row").alias("query_id"), "vec")
    search = {"id_col": "id", "vec_col": "vec", "query_vec": "vec", "row_col": "row"}
    order = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("id")))

    def probes_of(order: np.ndarray, probes: int) -> list[np.ndarray]:
        """Parts that each query opens: ``probes``, or as many as hold k rows beside its own."""
        held = np.cumsum(sizes[order], axis=1)
        need = np.maximum(probes, (held <= k).sum(axis=1) + 1)
        return [o[:m] for o, m in zip(order, need)]

    # The calibration: exact neighbours of some queries, and how far down their list of parts those lie.
    some = saved(queries.orderBy(F.xxhash64("query_id"), "query_id").limit(CALIBRATION), "op11-calibration")
    exact = tiled_topk(index, some, k, "dot", carry=["part"], **search).withColumn("rank", order).where(F.col("rank") <= k)
    hits = exact.groupBy("query_id").agg(F.collect_list("part").alias("parts"))
    places = []
    for r in some.join(hits, "query_id").collect():  # CALIBRATION rows of k parts
        down = np.argsort(router.order(np.array([r["vec"]], np.float64))[0])
        places += [int(down[p]) for p in r["parts"]]
    probes = int(np.sort(places)[max(0, int(np.ceil(TARGET * len(places))) - 1)]) + 1 if places else 1

    def route(batches):
        for b in batches:
            if b.num_rows:
                opened = probes_of(shared.value.order(_vectors(b)), probes)
                at = np.repeat(np.arange(b.num_rows), [len(o) for o in opened])
                yield b.take(pa.array(at)).append_column("part", pa.array(np.concatenate(opened).astype(np.int32)))

    vec_type = rows.schema["vec"].dataType.simpleString()
    routed = queries.mapInArrow(route, f"query_id long, vec {vec_type}, part int")
    found = tiled_topk(index, routed, k, "dot", cell="part", **search).withColumn("rank", order).where(F.col("rank") <= k)
    ids = queries.select("query_id").join(rows.select(F.col("row").alias("query_id"), F.col("id").alias("own")), "query_id")
    return found.join(ids, "query_id").select(F.col("own").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")
