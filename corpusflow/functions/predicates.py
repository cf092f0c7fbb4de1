"""Filter predicates as Column builders."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .time import ts_lit


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def needs_index(version, indexed_present="has_state", indexed_version="embedding_version",
                current_hash="text_hash", indexed_hash="indexed_hash") -> Column:
    """Document needs (re)indexing (F1): never indexed, indexed with another
    embedding version (stored as text or number), or current and indexed
    hashes differ with missing treated as empty."""
    v = F.lit(str(version))
    return (~F.coalesce(_col(indexed_present), F.lit(False))
            | ~_col(indexed_version).cast("string").eqNullSafe(v)
            | (F.coalesce(_col(current_hash), F.lit("")) != F.coalesce(_col(indexed_hash), F.lit(""))))


def lease_free(now, lease_present="has_lease", expires_at="expires_at") -> Column:
    """No lease, or the lease has expired (F2). A lease without an expiry is held."""
    now = now if isinstance(now, Column) else ts_lit(now)
    return ~F.coalesce(_col(lease_present), F.lit(False)) | F.coalesce(_col(expires_at) <= now, F.lit(False))


def in_range(c, start=None, end=None) -> Column:
    """start <= c < end; a None bound is open (F3). Pushed down to Parquet."""
    c = _col(c)
    cond = F.lit(True)
    if start is not None:
        cond = cond & (c >= F.lit(start))
    if end is not None:
        cond = cond & (c < F.lit(end))
    return cond


def payload_match(**equals) -> Column:
    """Conjunction of column == value (F4); no condition matches everything."""
    conds = [F.col(k) == F.lit(v) for k, v in equals.items()]
    return reduce(lambda a, b: a & b, conds, F.lit(True))

