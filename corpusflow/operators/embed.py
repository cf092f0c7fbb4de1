"""Embedders (V3, V4, V6) and masked mean pooling (A5).

An embedder turns (key, text) rows into (key, vector) rows. Two kinds:

* :class:`HashingEmbedder` - the default, fully native: the first ``max_tokens``
  lower-cased tokens are hashed into ``dim`` buckets (first 8 hex digits of
  md5, mod dim), counted inside the row and L2-normalized: no shuffle, and the
  work of a row is bounded however long its text is.
* :class:`ArrowEmbedder` - a plug-in for real models: ``mapInPandas`` over
  Arrow batches, the model loaded once per Python worker, encoded in batches
  of ``batch_size``; the texts of a batch that fails are encoded one by one, so
  an error column marks just the rows that fail. Only the first ``max_length``
  tokens of a text reach the model.
"""
from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Dimension by model family / size word (fixed values); default when unknown.
DIM_BY_NAME = [("small", 384), ("minilm", 384), ("base", 768), ("large", 1024)]
DEFAULT_DIM = 768
# Role prefixes of the E5 family (fixed values).
E5_PREFIX = {"passage": "passage: ", "query": "query: "}
# Token separators of the hashing embedder: ASCII whitespace.
TOKEN_SPLIT = r"[ \t\n\r\f\x0b]+"
# Tokens of a text that an embedder reads (fixed value); what follows is cut off.
MAX_TOKENS = 512


def model_family(model_name: str) -> str:
    n = (model_name or "").lower()
    for fam in ("e5", "bge", "minilm"):
        if fam in n:
            return fam
    return "other"


def resolve_dim(model_name: str, model_dim: int | None = None) -> int:
    """Vector size (V6): the model's own size, else by name, else the default."""
    if model_dim:
        return int(model_dim)
    n = (model_name or "").lower()
    for word, d in DIM_BY_NAME:
        if word in n:
            return d
    return DEFAULT_DIM


def token_window(text, max_tokens: int = MAX_TOKENS):
    """The first ``max_tokens`` tokens of a text as an array; the text is split no further than that."""
    # A leading separator makes one empty element, the last element holds what was not split.
    parts = F.split(F.coalesce(text, F.lit("")), TOKEN_SPLIT, max_tokens + 2)
    return F.slice(F.filter(parts, lambda t: t != ""), 1, max_tokens)


def role_prefix(model_name: str, role: str) -> str:
    return E5_PREFIX.get(role, "") if model_family(model_name) == "e5" else ""


@dataclass
class HashingEmbedder:
    dim: int = 64
    model_name: str = "hashing"
    max_tokens: int = MAX_TOKENS

    def _bucket(self, token):
        """int(first 8 hex digits of md5(token), 16) mod dim. When dim divides
        256 only the low byte matters, i.e. hex digits 7-8."""
        digits = F.substring(F.md5(token), 7, 2) if 256 % self.dim == 0 else F.substring(F.md5(token), 1, 8)
        return F.pmod(F.conv(digits, 16, 10).cast("long"), F.lit(self.dim)).cast("int")

    def _counts(self, buckets):
        """How often each of the ``dim`` buckets is in the array ``buckets``."""
        every = F.sequence(F.lit(0), F.lit(self.dim - 1))
        # A one-element array binds what is used for every bucket once.
        if self.dim > 64:
            return F.transform(F.array(buckets), lambda b: F.transform(every, lambda k: F.size(b) - F.size(F.array_remove(b, k))))[0]
        # One ASCII letter a bucket: a letter is counted by the bytes that go with it.
        letter = lambda k: F.char(k + 48)
        text = F.array_join(F.transform(buckets, letter), "")
        return F.transform(F.array(text), lambda s: F.transform(every, lambda k: F.octet_length(s) - F.octet_length(F.replace(s, letter(k), F.lit("")))))[0]

    def _counted(self, df: DataFrame, keys, text_col: str, role: str) -> DataFrame:
        """(keys..., _c: count of each bucket, _norm), one row per text with a token, counted in its row."""
        pre = role_prefix(self.model_name, role)
        text = F.concat(F.lit(pre), F.coalesce(F.col(text_col), F.lit(""))) if pre else F.col(text_col)
        # Lower-case per token, after the split (same tokens: lower-casing never
        # makes or removes ASCII whitespace): ASCII tokens stay on Spark's fast path.
        buckets = F.transform(token_window(text, self.max_tokens), lambda t: self._bucket(F.lower(t)))
        norm = lambda c: F.greatest(F.sqrt(F.aggregate(c, F.lit(0.0), lambda a, n: a + n * n)), F.lit(1e-9))
        # A generator's rows: neither the text nor its counts are worked out again, for a filter or for each bucket.
        # Outer: the plain one would have them worked out a second time, to filter empty arrays.
        some = F.filter(F.array(buckets), lambda b: F.size(b) > 0)
        found = F.transform(F.transform(some, self._counts), lambda c: F.struct(c.alias("_c"), norm(c).alias("_norm")))
        return df.select(*keys, F.explode_outer(found).alias("_f")).where("_f is not null").select(*keys, "_f._c", "_f._norm")

    def embed_sparse(self, df: DataFrame, keys, text_col: str = "text", role: str = "passage") -> DataFrame:
        """(keys..., bucket, value) for the non-zero buckets, L2-normalized."""
        keys = list(keys)
        g = self._counted(df, keys, text_col, role)
        # Outer: the plain one would have the counts worked out a second time, to filter empty arrays.
        return g.select(*keys, "_norm", F.posexplode_outer("_c").alias("bucket", "_n")).where("_n > 0") \
            .select(*keys, "bucket", (F.col("_n") / F.col("_norm")).alias("value"))

    def embed(self, df: DataFrame, keys, text_col: str = "text", role: str = "passage") -> DataFrame:
        """(keys..., vector array<float>) dense vectors. A text without tokens
        gets no row (its vector would be all zero)."""
        keys = list(keys)
        g = self._counted(df, keys, text_col, role)
        return g.select(*keys, F.transform("_c", lambda n: (n / F.col("_norm")).cast("float")).alias("vector"))


_MODEL_CACHE: dict = {}


@dataclass
class ArrowEmbedder:
    """Plug-in for a real model. ``load`` returns an object whose
    ``encode(list[str]) -> np.ndarray`` gives one row per text; it runs once
    per Python worker and model name."""
    model_name: str
    load: Callable[[], object]
    batch_size: int = 64
    normalize: bool = True
    max_length: int = MAX_TOKENS

    def embed(self, df: DataFrame, keys, text_col: str = "text", role: str = "passage") -> DataFrame:
        keys = list(keys)
        name, load, bs, norm = self.model_name, self.load, self.batch_size, self.normalize
        pre = role_prefix(name, role)
        key_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keys).schema.fields)
        schema = f"{key_schema}, vector array<float>, embed_error string"

        def run(batches):
            model = _MODEL_CACHE.get(name)
            if model is None:
                model = _MODEL_CACHE[name] = load()
            for pdf in batches:
                texts = (pre + pdf[text_col].fillna("")).tolist()
                vecs, errs = [None] * len(texts), [None] * len(texts)

                def encode(at, n):
                    m = np.asarray(model.encode(texts[at:at + n]), dtype=np.float64)
                    if norm:
                        m = m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-9)
                    vecs[at:at + n] = list(m.astype(np.float32))

                for s in range(0, len(texts), bs):
                    n = min(bs, len(texts) - s)
                    try:
                        encode(s, n)
                    except Exception:  # failure isolation: find the rows, mark them, keep the stage
                        for i in range(s, s + n):
                            try:
                                encode(i, 1)
                            except Exception as e:
                                errs[i] = f"{type(e).__name__}: {e}"
                out = pdf[keys].copy()
                out["vector"] = vecs
                out["embed_error"] = errs
                yield out

        window = F.array_join(token_window(F.col(text_col), self.max_length), " ")
        long_text = F.size(F.split(F.col(text_col), TOKEN_SPLIT, self.max_length + 2)) > self.max_length
        return df.select(*keys, F.when(long_text, window).otherwise(F.col(text_col)).alias(text_col)).mapInPandas(run, schema)


def mean_vectors(df: DataFrame, keys, vec_col: str = "vector", mask_col: str | None = None, dim: int | None = None) -> DataFrame:
    """Masked mean of vectors per group (A5): (keys..., vector array<double>).

    Rows whose mask is 0 are left out, the count is clamped at 1e-9. The sums
    of all positions are one aggregation over the arrays: a vector enters it as
    one row, and a hot group reaches the shuffle as one row per map task.
    ``dim`` (else the largest in ``df``) positions are summed; a missing or
    null position adds nothing.
    """
    keys = list(keys)
    dim = dim or df.agg(F.max(F.size(vec_col))).first()[0] or 0
    m = F.coalesce(F.col(mask_col).cast("double"), F.lit(0.0)) if mask_col else F.lit(1.0)
    rows = df.select(*keys, F.col(vec_col).alias("_v"), m.alias("_m")).where("_v is not null")
    sums = [F.coalesce(F.sum(F.get("_v", F.lit(i)).cast("double") * F.col("_m")), F.lit(0.0)) for i in range(dim)]
    pooled = rows.groupBy(*keys).agg(F.array(*sums).alias("_s"), F.greatest(F.sum("_m"), F.lit(1e-9)).alias("_n"))
    return pooled.select(*keys, F.transform("_s", lambda x: x / F.col("_n")).alias("vector"))


def mean_pool(df: DataFrame, keys, vec_col: str = "vector", mask_col: str | None = None) -> DataFrame:
    """:func:`mean_vectors` as rows (keys..., pos, value)."""
    pooled = mean_vectors(df, keys, vec_col, mask_col)
    return pooled.select(*list(keys), F.posexplode("vector").alias("pos", "value"))
