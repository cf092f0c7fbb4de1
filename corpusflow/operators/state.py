"""Index state and leases as table transitions (T1-T6), index routing (F6-F8),
page statistics (A3), request admission (F5).

Tables (all keyed by doc_id, one row per key):
  index_state(doc_id, embedding_version STRING, indexed_hash, indexed_row_hash, indexed_at, last_error, last_error_at)
  index_lease(doc_id, owner, expires_at, heartbeat_at)
Instants are TIMESTAMP_NTZ in UTC; ``now`` is always an argument.

Two hashes say what changed: ingestion stores a hash of the whole row with each
document, indexing keeps that one (``indexed_row_hash``) and the hash of the
text it embedded (``indexed_hash``). Candidates come from the stored row hashes
alone; only their texts are read, and a candidate whose text hash is the
indexed one (some other field changed) is not embedded again. A state table
without ``indexed_row_hash`` works by the text hash alone.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import lease_free, needs_index
from ..functions.time import lease_expiry, ts_lit
from .merge import merge_upsert

STATE_COLS = ["doc_id", "embedding_version", "indexed_hash", "indexed_row_hash", "indexed_at", "last_error", "last_error_at"]
# Above this many requests their verdicts join by shuffle.
MAX_BROADCAST_REQUESTS = 1_000_000
LEASE_COLS = ["doc_id", "owner", "expires_at", "heartbeat_at"]


def _now(now) -> Column:
    return now if isinstance(now, Column) else ts_lit(now)


def _expired(now) -> Column:
    return F.coalesce(F.col("expires_at") <= _now(now), F.lit(False))


def release_stale(leases: DataFrame, now) -> DataFrame:
    """Leases left after dropping those with expires_at <= now (T1). A lease
    without an expiry is kept."""
    return leases.where(~_expired(now))


def stale_count(leases: DataFrame, now) -> DataFrame:
    return leases.agg(F.count_if(_expired(now)).alias("released"))


def acquire(candidates: DataFrame, leases: DataFrame, owner: str, now, seconds: int = 300) -> DataFrame:
    """New lease table after ``owner`` claims every candidate doc_id whose lease
    is free (T2). Expired leases of claimed docs are replaced."""
    lz = leases.select(*LEASE_COLS, F.lit(True).alias("has_lease"))
    claim = candidates.select("doc_id").join(lz, "doc_id", "left").where(lease_free(now)) \
        .select("doc_id", F.lit(owner).alias("owner"), lease_expiry(now, seconds).alias("expires_at"),
                _now(now).alias("heartbeat_at"))
    return leases.join(claim.select("doc_id"), "doc_id", "left_anti").select(*LEASE_COLS) \
        .unionByName(claim)


def heartbeat(leases: DataFrame, ids: DataFrame, owner: str, now, seconds: int = 300) -> DataFrame:
    """Extend the leases of ``ids`` held by ``owner`` (T3); others unchanged."""
    hit = ids.select("doc_id").distinct().withColumn("_hb", F.lit(True))
    j = leases.join(hit, "doc_id", "left")
    mine = F.coalesce(F.col("_hb"), F.lit(False)) & (F.col("owner") == F.lit(owner))
    return j.select("doc_id", "owner",
                    F.when(mine, lease_expiry(now, seconds)).otherwise(F.col("expires_at")).alias("expires_at"),
                    F.when(mine, _now(now)).otherwise(F.col("heartbeat_at")).alias("heartbeat_at"))


def release(leases: DataFrame, ids: DataFrame, owner: str) -> DataFrame:
    """Drop the leases of ``ids`` held by ``owner`` (T4); idempotent."""
    mine = leases.where(F.col("owner") == F.lit(owner)).join(ids.select("doc_id"), "doc_id", "left_semi")
    return leases.join(mine.select("doc_id"), "doc_id", "left_anti")


def _state_cols(df: DataFrame) -> list[str]:
    return [c for c in STATE_COLS if c in df.columns]


def _indexed(done: DataFrame, version: int, now) -> DataFrame:
    """State columns of documents that were indexed: (doc_id, text_hash[, row_hash])."""
    row = [F.coalesce("row_hash", F.lit("")).alias("indexed_row_hash")] if "row_hash" in done.columns else []
    return done.select("doc_id", F.lit(str(version)).alias("embedding_version"),
                       F.coalesce(F.col("text_hash"), F.lit("")).alias("indexed_hash"), *row, _now(now).alias("indexed_at"))


def mark_indexed(state: DataFrame, done: DataFrame, version: int, now) -> DataFrame:
    """Record success (T5): version, hashes (null -> ''), time; the error columns
    are kept. ``done`` has (doc_id, text_hash[, row_hash])."""
    merged = merge_upsert(state, _indexed(done, version, now), ["doc_id"])
    return merged.select(*_state_cols(merged), "_action")


def drop_leases(leases: DataFrame, ids: DataFrame) -> DataFrame:
    return leases.join(ids.select("doc_id"), "doc_id", "left_anti")


def _failures(failed: DataFrame, leases: DataFrame) -> DataFrame:
    """Failures that count: without an owner, or of the owner who holds the document's lease."""
    lz = leases.select("doc_id", F.col("owner").alias("_holder"))
    return failed.join(lz, "doc_id", "left").where(F.col("owner").isNull() | (F.col("owner") == F.col("_holder")))


def mark_failed(state: DataFrame, failed: DataFrame, leases: DataFrame, now) -> tuple[DataFrame, DataFrame]:
    """Record failures (T6) and release their leases.

    ``failed`` has (doc_id, reason, owner); a row with an owner applies only
    when that owner holds the doc's lease. A null reason keeps the previous
    error text. Returns (new state, new leases).
    """
    ok = _failures(failed, leases)
    prev = state.select("doc_id", F.col("last_error").alias("_prev"))
    upd = ok.join(prev, "doc_id", "left").select(
        "doc_id", F.coalesce(F.col("reason"), F.col("_prev")).alias("last_error"),
        _now(now).alias("last_error_at"))
    merged = merge_upsert(state, upd, ["doc_id"])
    return merged.select(*_state_cols(merged), "_action"), drop_leases(leases, ok)


def mark_results(state: DataFrame, done: DataFrame, failed: DataFrame, leases: DataFrame, version: int, now) -> DataFrame:
    """State rows that a run changes, successes (T5) and failures (T6) in one pass over the state.

    ``done`` and ``failed`` are as above and share no document. Returns the
    changed rows only; the other rows of the state stay as they are.
    """
    good = _indexed(done, version, now).withColumn("_ok", F.lit(True))
    bad = _failures(failed, leases).select("doc_id", F.col("reason").alias("_reason"), F.lit(False).alias("_ok"))
    upd = good.unionByName(bad, allowMissingColumns=True)
    old = state.select("doc_id", *[F.col(c).alias(f"_old_{c}") for c in _state_cols(state) if c != "doc_id"])
    was = lambda c: F.col(f"_old_{c}") if c in state.columns else F.lit(None)
    new = {c: F.when(F.col("_ok"), F.col(c)).otherwise(was(c)) for c in upd.columns if c not in ("doc_id", "_ok", "_reason")}
    new["last_error"] = F.when(F.col("_ok"), was("last_error")).otherwise(F.coalesce("_reason", was("last_error")))
    new["last_error_at"] = F.when(F.col("_ok"), was("last_error_at")).otherwise(_now(now))
    return upd.join(old, "doc_id", "left").select("doc_id", *[new.get(c, was(c)).alias(c) for c in _state_cols(state) if c != "doc_id"])


def candidates(stored: DataFrame, state: DataFrame, leases: DataFrame, version: int, now) -> DataFrame:
    """First half of the routing (F1, F2): who needs indexing and whose lease is free.

    ``stored`` has (doc_id, row_hash), the hash that ingestion stored: no text is
    read. Without ``indexed_row_hash`` in the state, ``row_hash`` is compared
    with the indexed text hash. Stale leases are released first (T1). Status:
    'up_to_date', 'leased' (held by someone) or 'claimed'.
    """
    by = "indexed_row_hash" if "indexed_row_hash" in state.columns else "indexed_hash"
    st = state.select("doc_id", "embedding_version", "indexed_hash", F.col(by).alias("_known"), F.lit(True).alias("has_state"))
    lz = release_stale(leases, now).select("doc_id", "owner", "expires_at", F.lit(True).alias("has_lease"))
    j = stored.select("doc_id", "row_hash").join(st, "doc_id", "left").join(lz, "doc_id", "left")
    status = (F.when(~needs_index(version, current_hash="row_hash", indexed_hash="_known"), "up_to_date")
              .when(~lease_free(now), "leased").otherwise("claimed"))
    return j.withColumn("status", status).drop("_known", "has_state", "has_lease")


def settle(claimed: DataFrame, texts: DataFrame, version: int) -> DataFrame:
    """Second half of the routing (F6-F8): the status of the claimed documents by their texts.

    ``texts`` has (doc_id, text_hash, blank) of the claimed ones. 'empty_text'
    (F6), 'skipped_same_hash' (F7: the text that was indexed, in this version)
    or 'embed'; other rows keep their status.
    """
    j = claimed.join(texts.select("doc_id", "text_hash", "blank"), "doc_id", "left")
    same = (F.coalesce("indexed_hash", F.lit("")) != "") & (F.col("indexed_hash") == F.col("text_hash")) & \
        F.col("embedding_version").eqNullSafe(F.lit(str(version)))
    return j.withColumn("status", F.when(F.col("status") != "claimed", F.col("status")).when(F.col("blank"), "empty_text")
                        .when(same, "skipped_same_hash").otherwise("embed"))


def route(docs: DataFrame, state: DataFrame, leases: DataFrame, version: int, now) -> DataFrame:
    """Index routing (F8) in one step, for documents whose texts are at hand:
    one status per document of (doc_id, text_hash, ``text`` or a boolean
    ``blank``, and the stored ``row_hash`` where there is one)."""
    blank = F.col("blank") if "blank" in docs.columns else (F.col("text") == "")
    stored = docs.select("doc_id", F.col("row_hash" if "row_hash" in docs.columns else "text_hash").alias("row_hash"))
    found = candidates(stored, state, leases, version, now)
    return settle(found, docs.select("doc_id", "text_hash", blank.alias("blank")), version)


def page_stats(routed: DataFrame, page_col: str = "page_no") -> DataFrame:
    """Per page counts (A3) of routed candidates (needs-index docs). A failed
    document was fetched, but neither embedded nor upserted."""
    s = F.col("status")
    acquired = s.isin("empty_text", "skipped_same_hash", "embed", "failed")
    return routed.where(s != "up_to_date").groupBy(page_col).agg(
        F.count(F.lit(1)).alias("ids"),
        F.count_if(acquired).alias("leases_acquired"),
        F.count_if(acquired).alias("fetched"),
        F.count_if(s == "empty_text").alias("empty_text"),
        F.count_if(s == "skipped_same_hash").alias("skipped_same_hash"),
        F.count_if(s == "embed").alias("embedded"),
        F.count_if(s == "embed").alias("upserted"),
        F.count_if(s.isin("embed", "empty_text", "skipped_same_hash")).alias("marked_indexed"),
        F.count_if(s == "failed").alias("marked_failed"))


def small_side(requests: DataFrame) -> DataFrame:
    """A written table of one row per request as a join's side: broadcast under a bound, so that the chunks stay where
    they are and a request that holds a large share of them never lands in one task; above it they join by shuffle."""
    return F.broadcast(requests) if requests.count() <= MAX_BROADCAST_REQUESTS else requests


def over_limits(n_chunks: Column, n_bytes: Column, max_items: int, max_bytes: int) -> Column:
    """Why a request of that size is rejected (F5), null if it is not."""
    return F.when(n_chunks > max_items, "too_many_chunks").when(n_bytes > max_bytes, "too_many_bytes")


def admit_requests(chunks: DataFrame, request_col: str = "request_id", max_items: int = 500,
                   max_bytes: int = 5242880, greatest=()) -> DataFrame:
    """Request admission (F5): per request, the chunk count and UTF-8 bytes of
    contents; rejected over either limit. One partially aggregated groupBy,
    which takes the greatest value of further columns too."""
    agg = chunks.groupBy(request_col).agg(
        F.count(F.lit(1)).alias("n_chunks"),
        F.sum(F.coalesce(F.octet_length("contents"), F.lit(0))).cast("long").alias("n_bytes"),
        *[F.max(c).alias(c) for c in greatest])
    reason = over_limits(F.col("n_chunks"), F.col("n_bytes"), max_items, max_bytes)
    return agg.select("*", reason.alias("reject_reason"), reason.isNull().alias("accepted"))
