"""Operators 11 to 13 against brute force, with their defined cases."""
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusflow.llm import partition_index, spelling, term_pipeline
from corpusflow.operators.search import tiled_topk

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, row string, part int, query_id string, score string"


# ---------------------------------------------------------------- 11
def _brute(rows, k=20, every=20):
    """{(query row number): [(id, score)]} over rows that take part, padded with zeros."""
    good = [(i, v) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    d = max((len(v) for _, v in good), default=0)
    ids = [i for i, _ in good]
    m = np.array([[*v, *[0.0] * (d - len(v))] for _, v in good], np.float32).astype(np.float64)
    out = []
    for q, i in enumerate(ids):
        if i is not None and i % every == 0:
            s = (m * m[q]).sum(axis=1)
            best = sorted((j for j in range(len(ids)) if j != q), key=lambda j: (-s[j], ids[j] is None, ids[j] or 0))[:k]
            out.append((i, [(ids[j], float(s[j])) for j in best]))
    return out


def _vectors(spark, rows, parts=5):
    return spark.createDataFrame([(i, v, "x", 1, "y", "z") for i, v in rows], VECTORS).repartition(parts)


def test_vectors_defined_cases_in_few_rows_are_exact(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.normal(size=3)]) for i in range(15)]
    rows += [(20, rows[0][1]), (40, None), (60, []), (80, [0.0, 0.0, 0.0]), (100, [1.0, None, 2.0]), (120, [float("nan"), 1.0, 1.0]),
             (140, [float("inf"), 1.0, 1.0]), (160, [1.0, 2.0]), (None, [3.0, 3.0, 3.0]), (20, rows[0][1]), (None, [3.0, 3.0, 3.0])]
    got = partition_index.nearest(_vectors(spark, rows))
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert [t.dataType.simpleString() for t in got.schema] == ["bigint", "int", "bigint", "double"]
    found = sorted(tuple(r) for r in got.collect())
    want = sorted(((q, n + 1, i, s) for q, hits in _brute(rows) for n, (i, s) in enumerate(hits)), key=lambda t: (t[0], t[1], t[2] is None, t[2] or 0))
    key = lambda t: (t[0], t[1], t[2] is None, t[2] or 0)
    assert [t[:3] for t in sorted(found, key=key)] == [t[:3] for t in want]
    assert np.allclose([t[3] for t in sorted(found, key=key)], [t[3] for t in want], rtol=1e-12)


def test_vectors_empty_one_row_and_no_query(spark):
    assert partition_index.nearest(_vectors(spark, [])).collect() == []
    assert partition_index.nearest(_vectors(spark, [(20, [1.0, 2.0])])).collect() == []
    assert partition_index.nearest(_vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []


def test_a_third_of_all_vectors_equal(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in (np.ones(8) if i % 3 == 0 else rng.normal(size=8))]) for i in range(1200)]
    got = {}
    for r in partition_index.nearest(_vectors(spark, rows)).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    want = dict(_brute(rows))
    for q in (q for q in want if q % 3 == 0):      # many equal scores: the smaller ids, all of them found
        assert [i for _, i in sorted(got[q])] == [i for i, _ in want[q]]
    hits = sum(len({i for _, i in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(len(v) for v in want.values())


def test_clustered_vectors_open_few_parts_and_find_nine_in_ten(spark, monkeypatch):
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(40, 16)) * 3
    m = (centre[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 16))).astype(np.float32)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(m)]
    opened = []
    whole = tiled_topk

    def watched(points, queries, *a, **kw):
        if kw.get("cell") == "part":
            opened.append(queries.groupBy("query_id").count().agg(F.avg("count")).first()[0])
        return whole(points, queries, *a, **kw)
    monkeypatch.setattr(partition_index, "tiled_topk", watched)
    got = {}
    for r in partition_index.nearest(_vectors(spark, rows)).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    want = dict(_brute(rows))
    assert sum(len(got[q] & {i for i, _ in want[q]}) for q in want) >= 0.9 * 20 * len(want)
    assert opened and opened[0] < 16 / 2             # sqrt(4000) / 4 parts


def test_parts_are_balanced_and_follow_the_graph():
    rng = np.random.default_rng(3)
    near = [[int(j) for j in rng.choice([x for x in range(c * 50, c * 50 + 50) if x != i], 6, replace=False)] for c in range(6) for i in range(c * 50, c * 50 + 50)]
    part = partition_index.balanced_parts(near, 6)
    assert np.bincount(part).max() <= math.ceil(1.05 * 50) and part.min() == 0
    assert sum(part[i] != part[j] for i, js in enumerate(near) for j in js) <= 0.1 * 300 * 6
    assert partition_index.balanced_parts([[] for _ in range(7)], 3).tolist().count(0) in (2, 3)


def test_recall_on_the_given_table(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in e.collect()]
    got = {}
    for r in partition_index.nearest(e).collect():
        got.setdefault(r.query_id, {})[r.vec_id] = r.score
    want = dict(_brute(rows))
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    assert sum(i in got[q] for q in want for i, _ in want[q]) >= 0.9 * 20 * len(want)
    assert all(abs(got[q][i] - s) < 1e-12 for q in want for i, s in want[q] if i in got[q])


# ---------------------------------------------------------------- 12
DOCS = "doc_id long, text string, item string, slice long, h long, score string"
ITEMS = "item_id long, text string, doc_id string, rank string"
_TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def _terms(text):
    return _TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _rank(docs, items, top=10):
    held = [(i, Counter(t)) for i, t in ((i, _terms(x)) for i, x in docs) if t]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in held:
            m = 25 + 75 * sum(c.values()) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m)) for t in _terms(text) if c[t])
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, k + 1, None if none else i, -s) for k, (s, none, i) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


def _ranked(spark, docs, items):
    d = spark.createDataFrame([(i, t, "a", 1, 2, "b") for i, t in docs], DOCS).repartition(4)
    q = spark.createDataFrame([(i, t, "a", "b") for i, t in items], ITEMS).repartition(2)
    got = term_pipeline.ranked(d, q)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert [t.dataType.simpleString() for t in got.schema] == ["bigint", "int", "bigint", "bigint"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def _corpus(seed, n=160):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(120)] + ["Über", "naïve", "日本", "the", "THE", "x9"]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.choice([1, 5, 40, 200])))) for i in range(n)]
    items = [(i, ", ".join(rng.choices(words, weights, k=rng.choice([1, 3, 30])))) for i in range(9)]
    return docs, items


def test_ranking_equals_brute_force(spark, monkeypatch):
    docs, items = _corpus(1)
    docs += [(900, None), (901, ""), (902, "... !!"), (None, docs[3][1]), (None, docs[3][1]), (7, docs[7][1]), (7, "the w1 w1"), (903, "the " * 5000 + "w5"),
             *[(2000 - i, docs[5][1]) for i in range(40)]]
    items += [(50, None), (51, ""), (52, "absent words"), (None, "the w3 w3 w3"), (3, "w2 x9 x9"), (60, docs[5][1])]
    want = _rank(docs, items)
    assert _ranked(spark, docs, items) == want
    monkeypatch.setattr(term_pipeline, "SLICE_DOCS", 7)       # many slices, several item blocks, one and six owners
    monkeypatch.setattr(term_pipeline, "ITEM_BLOCK", 4)
    assert _ranked(spark, docs, items) == want
    for stages in (1, 6):
        monkeypatch.setattr(term_pipeline, "STAGES", stages)
        assert _ranked(spark, docs, items) == want


def test_ranking_of_empty_tables(spark):
    docs, items = _corpus(2, 5)
    assert _ranked(spark, [], items) == _ranked(spark, docs, []) == _ranked(spark, [(1, None)], items) == []


# ---------------------------------------------------------------- 13
WORDS = "doc_id long, text string, word string, n long, id long"


def _spelled(docs):
    counts = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 7 and c >= 2}

    def near(a, b):
        if abs(len(a) - len(b)) > 1 or a == b:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return any(b[:i] + b[i + 1:] == a for i in range(len(b)))
    form, partners = {}, {}
    for w in n:
        others = [x for x in n if near(w, x)]
        best = min(others, key=lambda x: (-n[x], x), default=None)
        partners[w] = len(others)
        form[w] = best if best and n[best] >= 10 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return sorted((w, form[w], root(w), n[w], partners[w], n[form[w]] if form[w] else None) for w in n)


def _variants(spark, docs):
    got = spelling.variants(spark.createDataFrame([(i, t, "a", 1, 2) for i, t in docs], WORDS).repartition(3))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert [t.dataType.simpleString() for t in got.schema] == ["string", "string", "string", "bigint", "bigint", "bigint"]
    return sorted(tuple(r) for r in got.collect())


def _spelling_corpus(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abÀé") for _ in range(rng.choice([7, 8, 9]))) for _ in range(60)] + ["aaaaaaa", "aaaaaaaa", "aaaaaaab"]
    docs = [(i, " ".join(rng.choices(base, [1 / (k + 1) ** 2 for k in range(len(base))], k=60)).upper() if i % 5 == 0 else
             "; ".join(rng.choices(base, [1 / (k + 1) ** 2 for k in range(len(base))], k=60))) for i in range(60)]
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_spelling_equals_brute_force(spark, seed):
    docs = _spelling_corpus(seed)
    docs += [(900, None), (901, ""), (902, "日本語 123 short"), (None, docs[1][1]), (4, docs[4][1]), (4, docs[4][1]), (903, "xµ×abcdefg ×abcdefg " * 3)]
    assert _variants(spark, docs) == _spelled(docs)


def test_spelling_chain_very_long_runs_and_empty_table(spark):
    long_run = "".join(random.Random(3).choice("abc") for _ in range(30_000))
    docs = [(1, "abcdefgh " * 1200), (2, "abcdefgx " * 110 + "abcdefxx " * 9 + "abcdefg " * 2), (3, f"{long_run} {long_run} {long_run}z {long_run}z")]
    got = _variants(spark, docs)
    assert got == _spelled(docs)
    chain = {w: (f, r) for w, f, r, *_ in got}
    assert any(f and chain[f][0] for f, _ in chain.values())     # a form that has a form of its own
    assert _variants(spark, []) == [] == _variants(spark, [(1, None)])


def test_node_numbers_are_those_of_the_trie(spark):
    words = sorted({w for _, t in _spelling_corpus(4) for w in re.findall("[a-zÀé]+", t)})
    df = spark.createDataFrame([(w,) for w in words], "word string").repartition(5)
    nodes, seen = {}, {}
    for r in spelling.number_nodes(df, "word").collect():
        assert len(r.nodes) == len(r.word) + 1
        for i, x in enumerate(r.nodes):
            assert nodes.setdefault(r.word[:i], x) == x and seen.setdefault(x, r.word[:i]) == r.word[:i]
        assert r.starts == [i == 0 or r.word[i] != r.word[i - 1] for i in range(len(r.word))]
