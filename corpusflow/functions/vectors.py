"""Vector column functions (V1, V5), native higher-order functions in double."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NORM_EPS = 1e-9
# Distance names and aliases accepted (fixed values); unknown names mean cosine.
DISTANCE_ALIASES = {
    "cosine": "cosine", "cos": "cosine",
    "dot": "dot", "dotproduct": "dot", "dot_product": "dot", "ip": "dot",
    "euclid": "euclid", "euclidean": "euclid", "l2": "euclid",
}


def canonical_distance(name: str | None) -> str:
    return DISTANCE_ALIASES.get((name or "cosine").strip().lower(), "cosine")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def dot(a, b) -> Column:
    return _sum(F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double")))


def norm(a) -> Column:
    return F.sqrt(_sum(F.transform(_col(a), lambda x: x.cast("double") * x.cast("double"))))


def cosine(a, b) -> Column:
    return dot(a, b) / (F.greatest(norm(a), F.lit(NORM_EPS)) * F.greatest(norm(b), F.lit(NORM_EPS)))


def euclid(a, b) -> Column:
    return F.sqrt(_sum(F.zip_with(_col(a), _col(b),
                                  lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))))


def score(a, b, metric: str = "cosine") -> Column:
    m = canonical_distance(metric)
    return {"cosine": cosine, "dot": dot, "euclid": euclid}[m](a, b)


def l2_normalize(v) -> Column:
    """v / max(||v||, 1e-9) (V5), as array<double>."""
    v = _col(v)
    n = F.greatest(norm(v), F.lit(NORM_EPS))
    return F.transform(v, lambda x: x.cast("double") / n)
