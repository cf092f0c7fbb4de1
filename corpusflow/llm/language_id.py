"""Language identification by hyperdimensional profiles (operator 5).

Each letter has a random vector of +1 and -1 (seeded by its code point). A
letter trigram is the product of its letters' vectors, each permuted by its
place; a text is the sum (bundle) of its trigrams; a language's prototype is
the bundle of its training texts. A text gets the language whose prototype has
the largest cosine with it. Words are runs of letters, lower-cased, with a
blank at each end; trigrams do not span words.

Training reads a bounded sample: about ``per_lang`` texts of each language,
chosen by a hash of doc_id. Prediction reads whole texts and nothing else.

Defined cases: null texts and texts without a letter are ``und`` with score 0;
a null doc_id is hashed as empty text; repeated rows each get a row; equal
cosines go to the language first in code point order; null languages teach
nothing; other columns are ignored; with nothing to learn from all is ``und``.
"""
from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

DIM, SEED, PER_LANG, BATCH = 2048, 5, 5_000, 128
KNOWN_TRIGRAMS = 30_000  # vectors a worker remembers
_LETTERS = re.compile(r"[^\W\d_]+")
_MASK = np.uint64((1 << 21) - 1)


def remainder(n: int, doc_id: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(n))


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct trigrams (three code points in 63 bits) and their counts."""
    s = " ".join(["", *_LETTERS.findall(text.lower()), ""])
    a = np.frombuffer(s.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    if len(a) < 3:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    codes = (a[:-2] << np.uint64(42)) | (a[1:-1] << np.uint64(21)) | a[2:]
    return np.unique(codes[a[1:-1] != 32], return_counts=True)


class Space:
    """Vectors of letters and trigrams, made when first needed."""

    def __init__(self, dim: int = DIM, seed: int = SEED):
        self.dim, self.seed, self.letters = dim, seed, {}
        self.known: dict[int, int] = {}
        self.rows = np.empty((0, dim), np.int8)

    def letter(self, c: int) -> np.ndarray:
        if c not in self.letters:
            self.letters[c] = (np.random.default_rng((self.seed, c)).integers(0, 2, self.dim, dtype=np.int8) * 2 - 1).astype(np.int8)
        return self.letters[c]

    def vectors(self, codes: np.ndarray) -> np.ndarray:
        """One row a trigram, as float32."""
        codes = codes.tolist()
        new = [c for c in codes if c not in self.known]
        if len(self.known) + len(new) > KNOWN_TRIGRAMS:
            self.known, self.rows, new = {}, self.rows[:0], codes
        if new:
            made = np.empty((len(new), self.dim), np.int8)
            for k, c in enumerate(new):
                x, y, z = c >> 42, (c >> 21) & 0x1FFFFF, c & 0x1FFFFF
                made[k] = np.roll(self.letter(x), 2) * np.roll(self.letter(y), 1) * self.letter(z)
                self.known[c] = len(self.rows) + k
            self.rows = np.concatenate([self.rows, made])
        return self.rows[[self.known[c] for c in codes]].astype(np.float32)

    def bundles(self, texts: list[str]) -> np.ndarray:
        """One row a text: the sum of its trigrams' vectors (zero without letters)."""
        out = np.zeros((len(texts), self.dim), np.float32)
        found = [trigrams(t) for t in texts]
        codes = np.unique(np.concatenate([c for c, _ in found])) if found else np.empty(0, np.uint64)
        for lo in range(0, len(codes), 8192):  # bounded, however many letters the texts use
            part = codes[lo:lo + 8192]
            counts = np.zeros((len(texts), len(part)), np.float32)
            for k, (c, n) in enumerate(found):
                a, b = np.searchsorted(c, part[0]), np.searchsorted(c, part[-1], "right")
                counts[k, np.searchsorted(part, c[a:b])] = n[a:b]
            out += counts @ self.vectors(part)
        return out


_SPACES: dict[tuple, Space] = {}


def _space(dim: int, seed: int) -> Space:
    return _SPACES.setdefault((dim, seed), Space(dim, seed))


def learn(docs: DataFrame, per_lang: int = PER_LANG, dim: int = DIM, seed: int = SEED) -> tuple[list[str], np.ndarray]:
    """Languages and their prototypes (unit length) from docs (doc_id, text, lang)."""
    rows = docs.where("lang is not null and text is not null").select("doc_id", "text", "lang")
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"))
    # By a hash of id and text, so that rows which share an id are chosen one by one; equal rows are one row with a count.
    chosen = rows.join(F.broadcast(sizes), "lang").where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) * F.col("n") < F.lit(per_lang * 1_000_000))
    chosen = chosen.groupBy("text", "lang").agg(F.count("*").alias("times"))
    schema = pa.schema([("lang", pa.string()), ("v", pa.list_(pa.float64()))])

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, sums = _space(dim, seed), {}
        for batch in batches:
            langs, times = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for lo in range(0, len(langs), BATCH):
                v = space.bundles(batch.column(0).slice(lo, BATCH).to_pylist())
                for k, lang in enumerate(langs[lo:lo + BATCH]):
                    sums[lang] = sums.get(lang, 0) + v[k].astype(np.float64) * times[lo + k]
        if sums:
            yield pa.RecordBatch.from_pylist([{"lang": k, "v": x.tolist()} for k, x in sums.items()], schema=schema)

    # At most per_lang texts a language move to 16 tasks; 16 vectors a language reach the driver.
    parts = chosen.select("text", "lang", "times").repartition(16).mapInArrow(bundle, "lang string, v array<double>").collect()
    total: dict[str, np.ndarray] = {}
    for r in parts:
        total[r["lang"]] = total.get(r["lang"], 0) + np.array(r["v"])
    langs = sorted(k for k, v in total.items() if np.abs(v).max() > 0)
    return langs, np.array([total[k] / np.linalg.norm(total[k]) for k in langs], np.float32).reshape(len(langs), dim)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], dim: int = DIM, seed: int = SEED) -> DataFrame:
    """doc_id, lang_pred, score (the cosine, at least 0) from docs (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, (langs, protos) = _space(dim, seed), shared.value
        for batch in batches:
            for lo in range(0, batch.num_rows, BATCH):
                texts = [t or "" for t in batch.column(1).slice(lo, BATCH).to_pylist()]
                pred, score = ["und"] * len(texts), [0.0] * len(texts)
                if langs:
                    v = space.bundles(texts)
                    size = np.linalg.norm(v, axis=1)
                    cos = (v @ protos.T) / np.maximum(size, 1e-9)[:, None]
                    for k, best in enumerate(cos.argmax(axis=1).tolist()):
                        if size[k] > 0:
                            pred[k], score[k] = langs[best], float(min(1.0, max(0.0, cos[k, best])))
                        elif _LETTERS.search(texts[k]):  # the vectors cancelled out
                            pred[k] = langs[0]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, BATCH), pa.array(pred), pa.array(score)], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(name, "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame, modulus: int = 4, held: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score: learned from the rows that are not held out."""
    model = learn(docs.where(remainder(modulus) != held))
    return predict(docs, model).select("doc_id", (remainder(modulus) == held).alias("held_out"), "lang_pred", "score")
