"""V2/L2/F9/F4 against brute force, with the FIXTURES edge rows."""
import numpy as np
from pyspark.sql import functions as F

from corpusflow.operators.search import search


def brute(P, ids, Q, k, offset=0, threshold=None, metric="cosine"):
    out = {}
    for qi, q in enumerate(Q):
        if metric == "cosine":
            s = P @ q / (np.maximum(np.linalg.norm(P, axis=1), 1e-9) * max(np.linalg.norm(q), 1e-9))
            order = sorted(range(len(P)), key=lambda i: (-s[i], ids[i]))
            keep = [i for i in order if threshold is None or s[i] >= threshold]
        else:
            s = np.sqrt(((P - q) ** 2).sum(1))
            order = sorted(range(len(P)), key=lambda i: (s[i], ids[i]))
            keep = [i for i in order if threshold is None or s[i] <= threshold]
        out[qi] = [(ids[i], round(float(s[i]), 9)) for i in keep[offset:offset + k]]
    return out


def run(spark, P, Q, **kw):
    pts = spark.createDataFrame([(i, [float(x) for x in v], "t" + str(i % 3)) for i, v in enumerate(P)],
                                "point_id long, vector array<float>, type string").repartition(3)
    qs = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(Q)], "query_id long, vector array<float>")
    hits = search(pts, qs, payload_cols=["type"], **kw).collect()
    got = {}
    for r in sorted(hits, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.point_id, round(r.score, 9)))
    return got


def test_topk_matches_brute_force(spark):
    rng = np.random.default_rng(1)
    P = rng.normal(size=(300, 8)).astype(np.float32)
    P[10] = P[20]                                    # tied scores: smaller id first
    Q = rng.normal(size=(7, 8)).astype(np.float32)
    Q[3] = 0                                         # zero query vector: all scores 0
    ids = list(range(len(P)))
    for kw in ({"k": 5}, {"k": 4, "offset": 3}, {"k": 10, "threshold": 0.5}, {"k": 3, "metric": "euclid"}):
        exp = brute(P.astype(np.float64), ids, Q.astype(np.float64), kw["k"], kw.get("offset", 0),
                    kw.get("threshold"), kw.get("metric", "cosine"))
        got = run(spark, P, Q, **kw)
        assert {q: v for q, v in exp.items() if v} == got, kw


def test_k_larger_than_table_and_offset_past_end(spark):
    P = np.eye(3, dtype=np.float32)
    got = run(spark, P, P[:1], k=10)
    assert [p for p, _ in got[0]] == [0, 1, 2]
    assert run(spark, P, P[:1], k=2, offset=5) == {}
    assert run(spark, P, P[:1], k=2, threshold=2.0) == {}


def test_payload_filter_and_blocks(spark):
    rng = np.random.default_rng(2)
    P = rng.normal(size=(100, 4)).astype(np.float32)
    Q = rng.normal(size=(9, 4)).astype(np.float32)
    got_f = run(spark, P, Q, k=3, where=F.col("type") == "t1")
    assert all(p % 3 == 1 for v in got_f.values() for p, _ in v)
    # a tiny block bound forces several broadcast blocks: same answer
    assert run(spark, P, Q, k=3, max_block_bytes=64) == run(spark, P, Q, k=3)


def test_ivf_exact_at_full_probe_and_recall(spark):
    from corpusflow.operators.search import build_ivf, search_ivf
    rng = np.random.default_rng(3)
    P = rng.normal(size=(400, 8)).astype(np.float32)
    Q = rng.normal(size=(12, 8)).astype(np.float32)
    pts = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(P)], "point_id long, vector array<float>")
    qs = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(Q)], "query_id long, vector array<float>")
    assigned, centers = build_ivf(pts, nlist=6)
    exact = brute(P.astype(np.float64), list(range(len(P))), Q.astype(np.float64), 5)
    full = {}
    for r in search_ivf(assigned, centers, qs, k=5, nprobe=6).collect():
        full.setdefault(r.query_id, []).append((r.rank, r.point_id))
    assert {q: [p for _, p in sorted(v)] for q, v in full.items()} == {q: [p for p, _ in v] for q, v in exact.items()}
    part = {(r.query_id, r.point_id) for r in search_ivf(assigned, centers, qs, k=5, nprobe=3).collect()}
    truth = {(q, p) for q, v in exact.items() for p, _ in v}
    assert len(part & truth) / len(truth) >= 0.6


def test_dot_metric_and_a_large_group_of_copies(spark):
    rng = np.random.default_rng(4)
    P = rng.normal(size=(240, 6)).astype(np.float32)
    P[40:160] = P[40]                                # equal scores over many tiles: the smallest ids win
    Q = np.concatenate([P[40:41], rng.normal(size=(4, 6)).astype(np.float32)])
    got = run(spark, P, Q, k=7, metric="dot", max_block_bytes=6 * 8 * 16)
    for qi, q in enumerate(Q.astype(np.float64)):
        s = (P.astype(np.float64) * q).sum(1)
        exp = sorted(range(len(P)), key=lambda i: (-s[i], i))[:7]
        assert [p for p, _ in got[qi]] == exp


def test_vectors_of_another_dimension_are_a_stated_error(spark):
    import pytest
    pts = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], "point_id long, vector array<float>")
    ok = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], "query_id long, vector array<float>")
    assert [(r.query_id, r.point_id) for r in search(pts, ok, k=3).collect()] == [(1, 1)]
    bad = spark.createDataFrame([(1, [1.0, 0.0, 2.0])], "query_id long, vector array<float>")
    with pytest.raises(Exception, match="dimension 2 searched by queries of dimension 3"):
        search(pts, bad, k=3).collect()
    assert search(pts.limit(0), ok, k=3).collect() == [] == search(pts, ok.limit(0), k=3).collect()


def test_a_query_meets_the_points_of_its_lists_only(spark):
    from corpusflow.operators.search import build_ivf, calibrate_nprobe, list_order, search_ivf
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(8, 8)) * 4
    P = (centre[rng.integers(0, 8, 600)] + rng.normal(size=(600, 8))).astype(np.float32)
    pts = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(P)], "point_id long, vector array<float>")
    qs = pts.where("point_id % 20 = 0").withColumnRenamed("point_id", "query_id")
    assigned, centers = build_ivf(pts)
    assert len(centers) == 24                       # the square root of 600
    assigned = assigned.checkpoint(eager=True)
    lists = {r.point_id: r.cluster for r in assigned.collect()}
    order = list_order(P[::20].astype(np.float64), centers)
    hits = search_ivf(assigned, centers, qs, k=5, nprobe=3).collect()
    assert all(lists[h.point_id] in order[h.query_id // 20][:3] for h in hits)
    nprobe = calibrate_nprobe(assigned, centers, qs, k=5)
    assert nprobe < 12                               # clustered data: most lists are never read
    exact = {(h.query_id, h.point_id) for h in search(pts, qs, k=5).collect()}
    found = {(h.query_id, h.point_id) for h in search_ivf(assigned, centers, qs, k=5, nprobe=nprobe).collect()}
    assert len(found & exact) >= 0.9 * len(exact)


def test_queries_are_sent_to_their_lists_in_bounded_tables():
    import pyarrow as pa
    from corpusflow.operators import search as S
    rng = np.random.default_rng(3)
    vectors, centers = rng.normal(size=(3000, 16)).astype(np.float32), rng.normal(size=(400, 16))
    vectors = [v.tolist() for v in vectors]
    queries = pa.table({"query_id": list(range(3001)), "vector": pa.array([*vectors, None], pa.list_(pa.float32()))})
    sent = list(S._sent(queries, centers, 300, "cluster"))
    assert len(sent) > 1 and max(t.nbytes for t in sent) <= S.PROBE_BYTES
    rows = pa.concat_tables(sent)
    assert rows["query_id"].to_pylist() == np.repeat(np.arange(3000), 300).tolist()
    assert rows["cluster"].to_pylist() == S.list_order(np.array(vectors), centers)[:, :300].ravel().tolist()
