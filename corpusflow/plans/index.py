"""Incremental indexing run (Q2):
T1 -> F1/F2 -> W1/J4 -> T2 -> P3/P4/P9 -> F8 -> V3 -> S11 -> P10/P12 -> S10 -> T5/T6 -> T4 -> A3/A2.

Per-document loops become set operations: candidates are one join on the
stored row hashes and a CASE, without any text; texts are read, normalized and
hashed for the claimed candidates only; embedding is one stage over those whose
text is new; and every table transition is a join against the routed frame. The
routed frame is checkpointed once (it feeds several writers; the embedder must
not run twice).
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import chunk_id, point_id
from ..functions.text import chunk_count, chunk_text
from ..operators import state as S
from ..operators.embed import HashingEmbedder
from ..operators.points import ensure_collection, index_summary, upsert_points
from ..operators.ranking import assign_pages
from ..session import checkpoint_dir

# Above this many documents to embed, their text is fetched by a shuffled semi join.
MAX_BROADCAST_IDS = 2_000_000


def routed_candidates(stored: DataFrame, state: DataFrame, leases: DataFrame, version: int, now,
                      page_size: int = 500) -> DataFrame:
    """Candidates by their stored hashes (doc_id, row_hash) and the indexing page
    of every one (W1/J4: pages of ``page_size`` ids in order)."""
    r = S.candidates(stored, state, leases, version, now)
    cand = r.where(F.col("status") != "up_to_date").select("doc_id")
    pages = assign_pages(cand, "doc_id", page_size).select("doc_id", "page_no")
    return r.join(pages, "doc_id", "left")


def stored_hashes(docs: DataFrame) -> DataFrame:
    """(doc_id, row_hash): what ingestion stored with each document, else the text hash."""
    return docs.select("doc_id", F.col("row_hash" if "row_hash" in docs.columns else "text_hash").alias("row_hash"))


def texts_hashed(docs: DataFrame, prepare=None) -> DataFrame:
    return (prepare(docs) if prepare else docs).select("doc_id", "text_hash")


def texts_of(docs: DataFrame, ids: DataFrame, prepare=None) -> DataFrame:
    """(doc_id, text, text_hash) of the documents ``ids``: their rows alone are
    read and prepared, by a broadcast semi join under a bound on the ids."""
    ids = F.broadcast(ids) if ids.count() <= MAX_BROADCAST_IDS else ids
    rows = docs.join(ids, "doc_id", "left_semi")
    return (prepare(rows) if prepare else rows).select("doc_id", "text", "text_hash")


@dataclass
class IndexResult:
    status: DataFrame      # doc_id, page_no, status, point_id
    points: DataFrame      # new points table
    state: DataFrame       # new index_state table
    leases: DataFrame      # new index_lease table
    meta: DataFrame        # collection_meta
    page_stats: DataFrame  # A3
    summary: DataFrame     # A2
    new_points: DataFrame  # points that this run made
    new_state: DataFrame   # state rows that this run changed
    replaced: DataFrame    # documents (doc_id) whose earlier points go


def index_documents(docs: DataFrame, state: DataFrame, leases: DataFrame, points: DataFrame,
                    meta: DataFrame | None, *, version: int, owner: str, now, embedder=None,
                    collection: str = "documents", dataset_type: str = "documents", page_size: int = 500,
                    chunk_size: int = 1600, overlap: int = 80, lease_seconds: int = 300,
                    distance: str = "cosine", on_mismatch: str = "error",
                    granularity: str = "document", prepare=None) -> IndexResult:
    """One indexing run. ``docs`` is the stored document table with its
    ``row_hash``; ``prepare`` turns rows of it into (doc_id, text, text_hash)
    with the canonical text and runs on the claimed candidates only. Without it
    ``docs`` has those columns itself; without ``row_hash`` the text hash
    decides alone. Returns the new tables; ``plans.runs`` commits them.

    ``granularity``: 'document' makes one point per document (point id =
    uuid5 of doc and version); 'chunk' cuts the canonical text into
    ``chunk_size``/``overlap`` windows and makes one point per window (point
    id = the chunk id; identical windows of a document share it, the later
    one wins). A document counts as embedded when all its windows are; its
    earlier points are replaced."""
    if granularity not in ("document", "chunk"):
        raise ValueError("granularity must be 'document' or 'chunk'")
    embedder = embedder or HashingEmbedder()
    checkpoint_dir(docs.sparkSession)
    # Candidates by stored hashes: neither this scan nor its joins move text.
    stored = stored_hashes(docs)
    found = routed_candidates(stored, state, leases, version, now, page_size).checkpoint(eager=True)
    claimed = found.where(F.col("status") == "claimed").select("doc_id")
    texts = texts_of(docs, claimed, prepare).checkpoint(eager=True)
    routed = S.settle(found, texts.select("doc_id", "text_hash", (F.col("text") == "").alias("blank")), version).checkpoint(eager=True)

    acquired = routed.where(F.col("status").isin("empty_text", "skipped_same_hash", "embed")).select("doc_id")
    leases1 = S.acquire(acquired, S.release_stale(leases, now), owner, now, lease_seconds)
    to_embed = texts.join(routed.where(F.col("status") == "embed").select("doc_id"), "doc_id", "left_semi")
    if granularity == "document":
        vec = embedder.embed(to_embed, ["doc_id"], "text", role="passage")
        emb = to_embed.select("doc_id", "text_hash", F.char_length("text").alias("n_chars")).join(vec, "doc_id", "left")
        if "embed_error" not in emb.columns:
            emb = emb.withColumn("embed_error", F.when(F.col("vector").isNull(), F.lit("Vector dimension is 0")))
        emb = emb.withColumn("embed_error", F.coalesce("embed_error", F.when(F.size("vector") <= 0,
                                                                            F.lit("Vector dimension is 0"))))
    else:
        ch = to_embed.select("doc_id", F.posexplode(chunk_text(F.col("text"), chunk_size, overlap))
                             .alias("chunk_idx", "chunk"))
        vec = embedder.embed(ch, ["doc_id", "chunk_idx"], "chunk", role="passage")
        cv = ch.select("doc_id", "chunk_idx", chunk_id("doc_id", "chunk").alias("chunk_id")) \
            .join(vec, ["doc_id", "chunk_idx"], "left")
        if "embed_error" not in cv.columns:
            cv = cv.withColumn("embed_error", F.when(F.col("vector").isNull(), F.lit("Vector dimension is 0")))
        cv = cv.checkpoint(eager=True)
        per_doc = cv.groupBy("doc_id").agg(F.count(F.lit(1)).cast("int").alias("n_chunks"),
                                           F.max("embed_error").alias("embed_error"))
        emb = to_embed.select("doc_id", "text_hash", F.char_length("text").alias("n_chars")) \
            .join(per_doc, "doc_id", "left") \
            .withColumn("embed_error", F.coalesce("embed_error", F.when(F.col("n_chunks").isNull(),
                                                                        F.lit("Vector dimension is 0"))))
    emb = emb.checkpoint(eager=True)
    ok = emb.where(F.col("embed_error").isNull())
    failed = emb.where(F.col("embed_error").isNotNull())

    if granularity == "document":
        new_points = ok.select(
            point_id("doc_id", version).alias("point_id"), "vector", F.lit(dataset_type).alias("type"),
            F.col("doc_id").cast("string").alias("doc_id"), F.lit(int(version)).alias("embedding_version"),
            F.greatest(chunk_count("n_chars", chunk_size, overlap), F.lit(1)).alias("chunk_count"),
            F.lit(int(chunk_size)).alias("chunk_size"), F.lit(int(overlap)).alias("overlap"))
        order = None
        replaced = points
    else:
        new_points = cv.join(ok.select("doc_id", "n_chunks"), "doc_id").select(
            F.col("chunk_id").alias("point_id"), "vector", F.lit(dataset_type).alias("type"),
            F.col("doc_id").cast("string").alias("doc_id"), F.lit(int(version)).alias("embedding_version"),
            F.col("n_chunks").alias("chunk_count"), F.lit(int(chunk_size)).alias("chunk_size"),
            F.lit(int(overlap)).alias("overlap"), F.col("chunk_idx").cast("int").alias("chunk_idx"))
        order = "chunk_idx"
        # the earlier windows of re-embedded documents go away
        gone = ok.select(F.col("doc_id").cast("string").alias("doc_id"))
        replaced = points.join(gone, "doc_id", "left_anti")
    meta2, drop_existing = ensure_collection(new_points, meta, collection, distance, on_mismatch)
    base_points = points.limit(0) if drop_existing else replaced
    if order:
        # keep the window index as a column of the table
        new_points = new_points.withColumn("_order", F.col("chunk_idx"))
        order = "_order"
    points2 = upsert_points(base_points, new_points, order)

    two = ["row_hash"] if "indexed_row_hash" in state.columns else []
    marks = routed.where(F.col("status").isin("empty_text", "skipped_same_hash", "embed")).select("doc_id", "text_hash", *two)
    fails = failed.select("doc_id", F.col("embed_error").alias("reason"), F.lit(owner).alias("owner"))
    done = marks.join(fails, "doc_id", "left_anti")
    changed = S.mark_results(state, done, fails, leases1, version, now).checkpoint(eager=True)
    state2 = state.join(changed.select("doc_id"), "doc_id", "left_anti").select(*changed.columns).unionByName(changed)
    leases3 = S.release(leases1, acquired, owner)

    final = routed.join(emb.select("doc_id", F.col("embed_error")), "doc_id", "left")
    status = F.when(F.col("status") != "embed", F.col("status")) \
        .when(F.col("embed_error").isNull(), "embedded").otherwise("failed")
    out = final.select("doc_id", "page_no", status.alias("status"),
                       F.when((status == "embedded") & F.lit(granularity == "document"),
                              point_id("doc_id", version)).alias("point_id"))
    stats = S.page_stats(final.withColumn("status", F.when(F.col("embed_error").isNotNull(), "failed")
                                          .otherwise(F.col("status"))))
    summ = index_summary(docs if two else texts_hashed(docs, prepare), state2, points2.drop("_action"), version, dataset_type)
    return IndexResult(out, points2.drop("_action"), state2, leases3, meta2, stats, summ,
                       new_points.drop("_order"), changed, gone if granularity == "chunk" else acquired.limit(0).select(F.col("doc_id").cast("string")))
