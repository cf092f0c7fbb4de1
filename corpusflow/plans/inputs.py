"""Operator inputs derived from the driver tables by fixed rules.

The library's operators consume API pages, ledgers, index state, leases,
chunk requests and vector tables. The checks build those inputs from the
given parquet tables with the rules below (all DataFrame transformations, so
the work grows with the tables). Fixed clock: 2024-01-31 00:00:00 UTC.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import row_hash, text_hash
from ..functions.text import extract_text, normalize_again
from ..functions.time import lease_expiry, ts_lit
from ..operators.points import attach_row
from ..operators.ranking import global_rank
from ..operators.state import admit_requests, small_side
from ..session import FIXED_NOW, checkpoint_dir

API_NAME = "items"
RUN_DATE = "2024-01-31"
API_PAGE_SIZE = 100          # records per API page
INDEX_PAGE_SIZE = 500        # documents per indexing page
CHUNK_MAX, CHUNK_OVERLAP = 1600, 80
LEASE_SECONDS = 300
DOC_BLOCK, PAGE_BLOCK = 200, 20               # ids per block of chunk requests
REQUEST_ITEMS, REQUEST_BYTES = 100, 100000    # limits of the embedding worker
CHUNKS_PER_FILE = 2000                        # of the landing zone
EMBEDDING_VERSION = 1
DATASET_TYPE = "documents"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- API pages
def api_records(spark, sf_dir) -> DataFrame:
    """part -> API records, 100 per page by key order:
    (page_no, record_idx, ITEM_SEQ, ITEM_NAME, ENTP_NAME)."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    r = global_rank(part, "p_partkey")
    return r.select(((F.col("rank") - 1) / API_PAGE_SIZE + 1).cast("int").alias("page_no"),
                    ((F.col("rank") - 1) % API_PAGE_SIZE).cast("int").alias("record_idx"),
                    F.col("p_partkey").cast("string").alias("ITEM_SEQ"),
                    F.col("p_name").alias("ITEM_NAME"), F.col("p_brand").alias("ENTP_NAME"))


def _pages_grouped(spark, sf_dir) -> DataFrame:
    rec = api_records(spark, sf_dir)
    total = rec.agg(F.count(F.lit(1)).alias("total"))
    g = rec.groupBy("page_no").agg(F.array_sort(F.collect_list(
        F.struct("record_idx", "ITEM_SEQ", "ITEM_NAME", "ENTP_NAME"))).alias("items"))
    return attach_row(g, total)


def json_pages(spark, sf_dir) -> DataFrame:
    """raw_pages rows with a JSON body {"body": {"items": [...], "totalCount": n}}."""
    g = _pages_grouped(spark, sf_dir)
    items = F.transform("items", lambda e: F.struct(e["ITEM_SEQ"].alias("ITEM_SEQ"),
                                                    e["ITEM_NAME"].alias("ITEM_NAME"),
                                                    e["ENTP_NAME"].alias("ENTP_NAME")))
    body = F.to_json(F.struct(F.struct(items.alias("items"), F.col("total").alias("totalCount")).alias("body")))
    return g.select(F.lit(API_NAME).alias("api_name"), F.lit(RUN_DATE).alias("run_date"), "page_no",
                    F.lit("json").alias("format"), body.alias("body"))


def _xml_text(c):
    return F.replace(F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;")),
                               F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def xml_pages(spark, sf_dir) -> DataFrame:
    """raw_pages rows with an XML body <response><body><items><item>...; each
    item has a nested child, alone (DETAIL) and after text (NOTE), and a repeated
    one (TAG). A further page is not well-formed."""
    g = _pages_grouped(spark, sf_dir)
    item = F.transform("items", lambda e: F.concat(
        F.lit("<item><ITEM_SEQ>"), _xml_text(e["ITEM_SEQ"]), F.lit("</ITEM_SEQ><ITEM_NAME>"),
        _xml_text(e["ITEM_NAME"]), F.lit("</ITEM_NAME><ENTP_NAME>"), _xml_text(e["ENTP_NAME"]),
        F.lit("</ENTP_NAME><DETAIL><MAKER>"), _xml_text(e["ENTP_NAME"]), F.lit("</MAKER></DETAIL><NOTE>no. 0"), e["ITEM_SEQ"],
        F.lit("<i>x</i></NOTE><TAG>old</TAG><TAG>new</TAG></item>")))
    body = F.concat(F.lit("<response><header><resultCode>00</resultCode></header><body><items>"),
                    F.array_join(item, ""), F.lit("</items><totalCount>"), F.col("total").cast("string"),
                    F.lit("</totalCount></body></response>"))
    pages = g.select("page_no", body.alias("body"))
    cut = pages.where("page_no = 1").select(F.lit(0).alias("page_no"), F.concat("body", F.lit("<response>")).alias("body"))
    return pages.unionByName(cut).select(F.lit(API_NAME).alias("api_name"), F.lit(RUN_DATE).alias("run_date"), "page_no",
                                         F.lit("xml").alias("format"), "body")


def ledger(spark, sf_dir) -> DataFrame:
    """Pages with page_no % 3 = 0 are done; processed_at = now - page_no x 10 days."""
    n = table(spark, sf_dir, "part").agg(F.count(F.lit(1)).alias("n"))
    pages = n.select(F.explode(F.sequence(F.lit(1), F.greatest(F.ceil(F.col("n") / API_PAGE_SIZE).cast("int"),
                                                                F.lit(1)))).alias("page_no"), "n") \
        .where(F.col("n") > 0).drop("n")
    return pages.where(F.col("page_no") % 3 == 0).select(
        F.lit(API_NAME).alias("api_name"), F.lit(RUN_DATE).alias("run_date"), F.col("page_no").cast("int"),
        F.lit(API_PAGE_SIZE).alias("processed_size"),
        F.timestamp_add("DAY", -10 * F.col("page_no"), ts_lit(FIXED_NOW)).alias("processed_at"))


def event_totals(spark, sf_dir) -> DataFrame:
    """API totals for page planning: one API per event type, total = its events."""
    ev = table(spark, sf_dir, "events")
    return ev.groupBy(F.col("event_type").alias("api_name")).agg(
        F.count(F.lit(1)).cast("string").alias("total_count"))


def event_records(spark, sf_dir) -> DataFrame:
    """events -> API records (event_id, record VARIANT) of every shape the item
    model meets: ITEM_SEQ is text, but a number for clicks, absent for views and
    null for signups; ITEM_NAME is the event type, but a number for errors; and
    a field ``k`` of the event's properties."""
    ev = table(spark, sf_dir, "events")
    kind, key = F.col("event_type"), F.col("event_id").cast("string")
    seq = F.when(kind == "click", F.concat(F.lit('"ITEM_SEQ":'), key, F.lit(","))).when(kind == "view", F.lit("")) \
        .when(kind == "signup", F.lit('"ITEM_SEQ":null,')).otherwise(F.concat(F.lit('"ITEM_SEQ":"'), key, F.lit('",')))
    name = F.when(kind == "error", F.lit("404")).otherwise(F.concat(F.lit('"'), kind, F.lit('"')))
    body = F.concat(F.lit("{"), seq, F.lit('"ITEM_NAME":'), name, F.lit(',"k":'), F.get_json_object("props", "$.k"), F.lit("}"))
    return ev.select("event_id", F.parse_json(body).alias("record"))


def part_items(spark, sf_dir) -> DataFrame:
    """Parsed item table (id, name, vendor) straight from part."""
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("name"),
                    F.col("p_brand").alias("vendor"))


def changed_batch(spark, sf_dir) -> DataFrame:
    """Update batch: key % 7 = 0 renamed (with an older duplicate that must
    lose), key % 11 = 0 vendor set to an explicit null, key % 5 = 0 sent
    unchanged, key % 13 = 0 also arrives as the new key key + 1000000."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    touched = p.where((k % 7 == 0) | (k % 11 == 0) | (k % 5 == 0))
    upd = touched.select(k.cast("string").alias("id"),
                         F.when(k % 7 == 0, F.concat("p_name", F.lit(" v2"))).otherwise(F.col("p_name")).alias("name"),
                         F.when(k % 11 == 0, F.lit(None).cast("string")).otherwise(F.col("p_brand")).alias("vendor"),
                         F.lit(1).alias("seq"))
    older = p.where(k % 7 == 0).select(k.cast("string").alias("id"), F.concat("p_name", F.lit(" old")).alias("name"),
                                       F.col("p_brand").alias("vendor"), F.lit(0).alias("seq"))
    new = p.where(k % 13 == 0).select((k + 1000000).cast("string").alias("id"), F.col("p_name").alias("name"),
                                      F.col("p_brand").alias("vendor"), F.lit(1).alias("seq"))
    return upd.unionByName(older).unionByName(new)


# ---------------------------------------------------------------- documents
BLANK_IDS = 10 ** 12         # ids of the blank documents start here


def documents(spark, sf_dir) -> DataFrame:
    """All documents, and blank ones as rows of their own: one, id BLANK_IDS + doc_id, per document whose doc_id 17 divides."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    blank = d.where(F.col("doc_id") % 17 == 0).select((F.col("doc_id") + BLANK_IDS).alias("doc_id"), F.lit("   ").alias("text"), "lang", "source")
    return d.unionByName(blank)


def stored_documents(spark, sf_dir) -> DataFrame:
    """The document table as ingestion leaves it, written once: each row with the
    hash of all its fields (P2). Scans of it read the columns they name."""
    d = documents(spark, sf_dir)
    fields = F.create_map(*[x for c in ("doc_id", "text", "lang", "source") for x in (F.lit(c), F.col(c).cast("string"))])
    path = f"{checkpoint_dir(spark).rstrip('/')}/stored-documents-{uuid.uuid4().hex}"
    d.withColumn("row_hash", row_hash(fields)).write.parquet(path)
    return spark.read.parquet(path)


def canonical(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source, text, text_hash): canonical text as the indexer
    sees it (fields normalized, then the whole again) and the sha1 of its
    normalization."""
    t = normalize_again(extract_text(["text"]))
    return docs.select("doc_id", "lang", "source", t.alias("text")) \
        .withColumn("text_hash", text_hash(normalize_again(F.col("text"))))


def doc_texts(spark, sf_dir) -> DataFrame:
    return canonical(documents(spark, sf_dir))


def index_state(spark, sf_dir, texts: DataFrame | None = None, stored: DataFrame | None = None) -> DataFrame:
    """By doc_id % 6: 0 none; 1 version 1 + current hashes; 2 version 1 +
    'stale'; 3 version 0 + current hashes; 4 version 1 + ''; 5 no version +
    current hashes. Version stored as text. With ``stored`` documents the rows
    have an indexed row hash too: that of the text's case, but 'older' (another
    field than the text has changed since) for case 1 where 5 divides doc_id."""
    t = texts if texts is not None else doc_texts(spark, sf_dir)
    m = F.col("doc_id") % 6
    ver = F.when(m.isin(1, 2, 4), "1").when(m == 3, "0")
    by_case = lambda c: F.when(m == 2, "stale").when(m == 4, "").otherwise(F.col(c))
    row = []
    if stored is not None:
        t = t.select("doc_id", "text_hash").join(stored.select("doc_id", "row_hash"), "doc_id")
        row = [F.when((m == 1) & (F.col("doc_id") % 5 == 0), "older").otherwise(by_case("row_hash")).alias("indexed_row_hash")]
    return t.where(m != 0).select("doc_id", ver.alias("embedding_version"), by_case("text_hash").alias("indexed_hash"), *row,
                                  F.timestamp_add("DAY", F.lit(-1), ts_lit(FIXED_NOW)).alias("indexed_at"),
                                  F.lit(None).cast("string").alias("last_error"),
                                  F.lit(None).cast("timestamp_ntz").alias("last_error_at"))


def leases(spark, sf_dir) -> DataFrame:
    """By doc_id % 4: 0 none; 1 expired (doc 1 expires exactly now); 2 held
    by w1; 3 held by w2."""
    d = documents(spark, sf_dir).select("doc_id")
    m = F.col("doc_id") % 4
    now = ts_lit(FIXED_NOW)
    exp = F.when(m == 1, F.timestamp_add("SECOND", -(F.col("doc_id") % BLANK_IDS - 1), now)) \
        .otherwise(lease_expiry(now, LEASE_SECONDS))
    return d.where(m != 0).select("doc_id", F.when(m == 1, "w0").when(m == 2, "w1").otherwise("w2").alias("owner"),
                                  exp.alias("expires_at"),
                                  F.timestamp_add("SECOND", F.lit(-LEASE_SECONDS), exp).alias("heartbeat_at"))


# ---------------------------------------------------------------- chunks
def chunks(spark, sf_dir) -> DataFrame:
    """Chunk requests: documents (text) and pages (html); request = source."""
    d = table(spark, sf_dir, "documents")
    p = table(spark, sf_dir, "pages")
    dc = d.select(F.col("source").alias("request_id"), F.col("doc_id").cast("string").alias("chunk_id"),
                  F.col("source").alias("item_sequence"), F.col("lang").alias("name"), F.col("text").alias("contents"),
                  F.create_map(F.lit("source_ref"), F.col("source"), F.lit("lang"), F.col("lang"),
                               F.lit("content_type"), F.lit("text")).alias("meta"))
    pc = p.select(F.lit("pages").alias("request_id"), F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("chunk_id"),
                  F.col("url").alias("item_sequence"), F.lit("page").alias("name"), F.col("html").alias("contents"),
                  F.create_map(F.lit("source_ref"), F.col("url"), F.lit("content_type"), F.lit("html")).alias("meta"))
    return dc.unionByName(pc)


def block_chunks(spark, sf_dir) -> DataFrame:
    """The same chunks in requests of bounded size, whose number grows with the
    tables: a source's documents of DOC_BLOCK ids, PAGE_BLOCK pages. A block
    over the worker's limits is sent as one request per chunk id, so only a
    chunk that is over them by itself is rejected."""
    c = chunks(spark, sf_dir)
    page = F.col("request_id") == "pages"
    key = F.when(page, F.substring("chunk_id", 2, 20)).otherwise(F.col("chunk_id")).cast("long")
    block = F.floor(key / F.when(page, PAGE_BLOCK).otherwise(DOC_BLOCK)).cast("string")
    c = c.withColumn("request_id", F.concat_ws(":", "request_id", block))
    checkpoint_dir(spark)
    over = admit_requests(c, max_items=REQUEST_ITEMS, max_bytes=REQUEST_BYTES).where(~F.col("accepted"))
    over = over.select("request_id", F.lit(True).alias("over")).checkpoint(eager=True)
    j = c.join(small_side(over), "request_id", "left")
    return j.withColumn("request_id", F.when(F.col("over"), F.concat_ws(":", "request_id", "chunk_id"))
                        .otherwise(F.col("request_id"))).drop("over")


# ---------------------------------------------------------------- vectors
def vector_points(spark, sf_dir) -> DataFrame:
    """embeddings as points: point_id = vec_id, payload type = label."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("point_id"), F.col("embedding").alias("vector"),
                    F.col("label").cast("string").alias("type"))


def vector_queries(spark, sf_dir) -> DataFrame:
    """The query set: every vector of the table (each one's nearest neighbours)."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))


def vector_searches(spark, sf_dir) -> DataFrame:
    """The searches of the inverted file: every vector whose id 20 divides, against all points."""
    return vector_queries(spark, sf_dir).where(F.col("query_id") % 20 == 0)
