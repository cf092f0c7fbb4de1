"""Toxicity by nearest labelled examples under exact TF-IDF cosine (operator 6).

Fit, on a bounded sample (at most about ``PER_CLASS`` labelled texts of each
class, chosen by a hash of doc_id and weighted back to the class's size): the
terms (words, and beginnings of long words) most associated with the label by
chi-square, their IDF, and the examples' vectors. A text's vector has the TF-IDF
of its terms (frequency: occurrences per word) and one background term of
constant weight, so the cosine also tells how dense its terms are.

Score: the ``K`` examples of largest cosine are found exactly with an inverted
index in blocks: each block's largest weight per term bounds its cosines, blocks
are opened in descending order of bound, and search ends when the K-th best
reaches the next bound. They vote with weight 1 / (distance + EPS); votes become
probabilities by isotonic regression on the examples' leave-one-out votes. The
nearest examples are the evidence.

Defined cases: null and empty texts have the background term only, so their
score is that of texts without any chosen term; rows without a label teach
nothing, repeated labels teach once and contradicting ones both; of several texts
under one doc_id the least by code points teaches; a null doc_id teaches nothing; equal cosines go to the example of smaller id; repeated rows each get a row;
other columns are ignored; without any example all scores are 0.
"""
from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusflow.llm.common import forget, saved
from corpusflow.llm.language_id import remainder

PER_CLASS, TERMS, K, EPS, BACKGROUND, BLOCK = 3_000, 1_000, 25, 0.05, 0.02, 64
THRESHOLD = 0.7
PREFIX, LONG_WORD = 5, 7
_LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return _LETTERS.findall(text.lower())


def _terms(words: set[str]) -> set[str]:
    return words | {w[:PREFIX] + "*" for w in words if len(w) >= LONG_WORD}


class Vocabulary:
    """Chosen terms, their IDF, and texts as sparse vectors of unit length; term 0 is the background."""

    def __init__(self, terms: list[str], idf: list[float]):
        self.word = {t: k for k, t in enumerate(terms, 1) if not t.endswith("*")}
        self.start = {t[:-1]: k for k, t in enumerate(terms, 1) if t.endswith("*")}
        self.idf, self.size = np.array([1.0, *idf]), len(terms) + 1

    def vector(self, text: str) -> tuple[tuple[int, ...], tuple[float, ...]]:
        words = words_of(text)
        word, start, counts = self.word, self.start, {}
        for w in words:
            if w in word:
                k = word[w]
                counts[k] = counts.get(k, 0) + 1
        if start:
            for w in words:
                if len(w) >= LONG_WORD and w[:PREFIX] in start:
                    k = start[w[:PREFIX]]
                    counts[k] = counts.get(k, 0) + 1
        if not counts:
            return (0,), (1.0,)
        terms = (0, *sorted(counts))
        v = [BACKGROUND, *(counts[k] / len(words) * self.idf[k] for k in terms[1:])]
        size = sum(x * x for x in v) ** 0.5
        return terms, tuple(x / size for x in v)


class ExampleIndex:
    """Inverted lists of the examples in blocks, with each block's largest weight per term."""

    def __init__(self, ids, labels, weights, vectors, n_terms: int):
        # Examples with the same heaviest term share blocks, which keeps the bounds close.
        order = sorted(range(len(ids)), key=lambda k: (vectors[k][0][int(np.argmax(vectors[k][1]))], len(vectors[k][0]), ids[k]))
        self.ids = np.array([ids[k] for k in order], np.int64)
        self.labels, self.weights = np.array([labels[k] for k in order], float), np.array([weights[k] for k in order], float)
        self.vectors = [vectors[k] for k in order]
        n_blocks = -(-len(order) // BLOCK)
        self.top = np.zeros((n_blocks, n_terms))
        lists: dict[tuple[int, int], tuple[list, list]] = {}
        for k, (terms, values) in enumerate(self.vectors):
            for t, v in zip(terms, values):
                at = lists.setdefault((t, k // BLOCK), ([], []))
                at[0].append(k % BLOCK)
                at[1].append(v)
                self.top[k // BLOCK, t] = max(self.top[k // BLOCK, t], v)
        self.lists = {k: (np.array(a), np.array(b)) for k, (a, b) in lists.items()}

    def nearest(self, vector, k: int = K, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Positions and cosines of the k nearest examples; exact."""
        terms, values = vector
        bounds = self.top[:, list(terms)] @ np.array(values)
        found, cosines, worst = np.empty(0, np.int64), np.empty(0), -1.0
        for b in np.argsort(-bounds, kind="stable").tolist():
            if len(found) >= k and bounds[b] + 1e-12 < worst:
                break
            acc = np.zeros(min(BLOCK, len(self.ids) - b * BLOCK))
            for t, q in zip(terms, values):
                if (t, b) in self.lists:
                    at, w = self.lists[t, b]
                    acc[at] += q * w
            at = np.arange(len(acc)) + b * BLOCK
            keep = (at != without) & ((acc >= worst - 1e-12) | (len(found) < k))
            found, cosines = np.concatenate([found, at[keep]]), np.concatenate([cosines, acc[keep]])
            best = np.lexsort((self.ids[found], -np.round(cosines, 12)))[:k]
            found, cosines = found[best], cosines[best]
            worst = cosines[-1]
        return found, cosines

    def vote(self, found: np.ndarray, cosines: np.ndarray) -> float:
        w = self.weights[found] / (np.maximum(0.0, 1.0 - cosines) + EPS)
        return float((w * self.labels[found]).sum() / w.sum()) if len(found) else 0.0


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Steps (x, value) of the ascending function closest to y, by pooling neighbours that descend."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []  # last x, value, weight
    for a, b, c in zip(x[order], y[order], w[order]):
        pools.append([a, b, c])
        while len(pools) > 1 and (pools[-2][1] >= pools[-1][1] or pools[-2][0] == pools[-1][0]):
            hi = pools.pop()
            lo = pools[-1]
            total = lo[2] + hi[2]
            pools[-1] = [hi[0], (lo[1] * lo[2] + hi[1] * hi[2]) / total, total]
    return np.array([p[0] for p in pools]), np.array([p[1] for p in pools])


class Model:
    def __init__(self, vocabulary: Vocabulary, index: ExampleIndex | None):
        self.vocabulary, self.index, self.known = vocabulary, index, {}
        if index is None:
            return
        cache: dict = {}
        votes = np.empty(len(index.ids))
        for k, v in enumerate(index.vectors):
            if v[0] == (0,):  # one of many equal vectors: leaving one out changes next to nothing
                if v not in cache:
                    cache[v] = index.vote(*index.nearest(v, without=k))
                votes[k] = cache[v]
            else:
                votes[k] = index.vote(*index.nearest(v, without=k))
        # Two examples a class at each end keep small samples from certainty.
        x = np.concatenate([votes, [0.0, 1.0]])
        y = np.concatenate([index.labels, [0.0, 1.0]])
        self.steps = isotonic(x, y, np.concatenate([index.weights, [1.0, 1.0]]))

    def score(self, text: str) -> tuple[float, list[int], list[float]]:
        v = self.vocabulary.vector(text)
        if v in self.known:
            return self.known[v]
        if self.index is None:
            return 0.0, [], []
        found, cosines = self.index.nearest(v)
        p = float(np.clip(np.interp(self.index.vote(found, cosines), *self.steps), 0.0, 1.0))
        out = p, self.index.ids[found[:3]].tolist(), [round(c, 6) for c in cosines[:3].tolist()]
        if len(self.known) < 20_000:
            self.known[v] = out
        return out


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, n_terms: int = TERMS) -> Model:
    """A model from docs (doc_id, text) and labels (doc_id, toxic).

    The sample is chosen among the labels, which are narrow; its ids (about
    2 * per_class) are broadcast to fetch the texts, so the documents stay in place.
    """
    rows = labels.where("toxic is not null and doc_id is not null").select("doc_id", (F.col("toxic") > 0).cast("int").alias("label")).distinct()
    sizes = rows.groupBy("label").agg(F.count("*").alias("n"))
    part = F.least(F.lit(1.0), F.lit(float(per_class)) / F.col("n"))
    chosen = (rows.join(F.broadcast(sizes), "label").withColumn("part", part)
              .where(F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1_000_000)) < F.col("part") * 1_000_000)
              .select("doc_id", "label", (1.0 / F.col("part")).alias("weight")))
    sample = saved(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
                   .groupBy("doc_id", "label", "weight").agg(F.min("text").alias("text"))
                   .select("doc_id", "text", "label", "weight").repartition(12), "toxic-sample")

    count_schema = pa.schema([("term", pa.string()), ("toxic", pa.float64()), ("clean", pa.float64()), ("docs", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list] = {}
        for batch in batches:
            for r in batch.to_pylist():
                for t in _terms(set(words_of(r["text"]))):
                    c = seen.setdefault(t, [0.0, 0.0, 0])
                    c[1 - r["label"]] += r["weight"]
                    c[2] += 1
            if len(seen) > 200_000:
                yield pa.RecordBatch.from_pylist([{"term": t, "toxic": a, "clean": b, "docs": n} for t, (a, b, n) in seen.items()], schema=count_schema)
                seen = {}
        if seen:
            yield pa.RecordBatch.from_pylist([{"term": t, "toxic": a, "clean": b, "docs": n} for t, (a, b, n) in seen.items()], schema=count_schema)

    total = {r["label"]: r["w"] for r in sample.groupBy("label").agg(F.sum("weight").alias("w")).collect()}
    a_all, b_all = total.get(1, 0.0), total.get(0, 0.0)
    terms, idf = [], []
    if a_all and b_all:
        n = a_all + b_all
        per = sample.select("text", "label", "weight").mapInArrow(count, "term string, toxic double, clean double, docs long").groupBy("term").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b"), F.sum("docs").alias("docs"))
        a, b = F.col("a"), F.col("b")
        cross = a * F.lit(b_all) - b * F.lit(a_all)
        chi = F.lit(n) * cross * cross / ((a + b) * (F.lit(n) - a - b + F.lit(1.0)) * F.lit(a_all) * F.lit(b_all))
        chosen = per.where((F.col("docs") >= 2) & (a * F.lit(b_all) > b * F.lit(2 * a_all))).orderBy(F.desc(F.round(chi, 9)), "term").limit(n_terms).collect()
        terms = [r["term"] for r in chosen]
        idf = [float(np.log((n + 1) / (r["a"] + r["b"] + 1)) + 1) for r in chosen]
    vocabulary = Vocabulary(terms, idf)
    vec_schema = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("weight", pa.float64()), ("terms", pa.list_(pa.int32())), ("values", pa.list_(pa.float64()))])

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                t, v = vocabulary.vector(r["text"])
                out.append({"doc_id": r["doc_id"], "label": r["label"], "weight": r["weight"], "terms": list(t), "values": list(v)})
            yield pa.RecordBatch.from_pylist(out, schema=vec_schema)

    got = sample.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "label", "weight").mapInArrow(vectors, "doc_id long, label int, weight double, terms array<int>, values array<double>").collect()
    if not got:
        return Model(vocabulary, None)
    got.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["label"]))
    return Model(vocabulary, ExampleIndex([r["doc_id"] if r["doc_id"] is not None else -1 for r in got], [r["label"] for r in got], [r["weight"] for r in got],
                                          [(tuple(r["terms"]), tuple(r["values"])) for r in got], vocabulary.size))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, predicted, evidence (ids of the nearest examples), cosines; docs need doc_id and text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32()), ("evidence", pa.list_(pa.int64())), ("cosines", pa.list_(pa.float64()))])

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                got = [m.score(t or "") for t in batch.column(1).slice(lo, 1024).to_pylist()]
                s = [g[0] for g in got]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, 1024), pa.array(s, pa.float64()), pa.array([int(x >= THRESHOLD) for x in s], pa.int32()),
                                                  pa.array([g[1] for g in got], pa.list_(pa.int64())), pa.array([g[2] for g in got], pa.list_(pa.float64()))], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(rate, "doc_id long, score double, predicted int, evidence array<long>, cosines array<double>")


def filtered(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` (all columns) that are not predicted toxic, judged in place: no join, no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                yield part.filter(pa.array([m.score(t or "")[0] < THRESHOLD for t in part.column(at).to_pylist()], pa.bool_()))
        m.known.clear()
        forget()

    return docs.mapInArrow(keep, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame, modulus: int = 3, held: int = 1) -> DataFrame:
    """doc_id, held_out, score, predicted, evidence, cosines: labels of held-out rows are not read."""
    model = fit(docs, labels.where(remainder(modulus) != held))
    return score(docs, model).select("doc_id", (remainder(modulus) == held).alias("held_out"), "score", "predicted", "evidence", "cosines")
