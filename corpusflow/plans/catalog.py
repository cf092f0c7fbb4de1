"""The checked query catalog: one Spark query per operator of the inventory,
each with an independent DuckDB statement of the same rule where one exists.

Every query reads the driver tables under ``sf_dir`` (or data Spark derives
from them, see inputs.py). Doubles are rounded to 6 places and instants
rendered as text on both sides.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import hashing as H
from ..functions import text as T
from ..functions import time as TM
from ..functions import vectors as V
from . import inputs as I

QUERIES: dict = {}
ORACLES: dict = {}


def query(name, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# DuckDB spellings used by the oracles. Python's whitespace set, spelled out.
WS_SQL = r"[\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
ZW_SQL = r"[\x{200b}-\x{200d}\x{feff}]"


def norm_sql(x: str) -> str:
    """One normalization pass in DuckDB (inputs are already NFKC)."""
    return (f"trim(regexp_replace(regexp_replace(coalesce({x}, ''), '{ZW_SQL}', '', 'g'), "
            f"'{WS_SQL}+', ' ', 'g'), ' ')")


def html_sql(x: str) -> str:
    """Visible text in DuckDB: the text is cut at each '<', and a fold over the
    pieces keeps a state (in text, or the element or comment whose end is due)."""
    tag = """^(/?[A-Za-z](?:[^>"\'\']|"[^"]*"|\'\'[^\'\']*\'\')*)>"""
    name = "lower(regexp_extract(s, '^([A-Za-z]+)[\\s/>]', 1))"
    rest = f"regexp_replace(s, '{tag}', '')"
    end = "regexp_replace(s, '^[^>]*>', '')"
    s = f"""list_reduce(string_split(coalesce({x}, ''), '<')[2:], lambda a, s: CASE
      WHEN a.due = '--' AND contains(s, '-->') THEN {{'due': '', 'out': a.out || ' ' || substr(s, strpos(s, '-->') + 3)}}
      WHEN a.due NOT IN ('', '--') AND regexp_matches(lower(s), '^/' || a.due || '[\\s>]') THEN {{'due': '', 'out': a.out || ' ' || {end}}}
      WHEN a.due <> '' THEN a
      WHEN starts_with(s, '!--') AND contains(s, '-->') THEN {{'due': '', 'out': a.out || ' ' || substr(s, strpos(s, '-->') + 3)}}
      WHEN starts_with(s, '!--') THEN {{'due': '--', 'out': a.out || ' '}}
      WHEN {name} IN ('script', 'style', 'noscript') THEN {{'due': {name}, 'out': a.out || ' '}}
      WHEN regexp_matches(s, '{tag}') THEN {{'due': '', 'out': a.out || ' ' || {rest}}}
      WHEN regexp_matches(s, '^[!?/]') THEN {{'due': '', 'out': a.out || ' ' || {end}}}
      ELSE {{'due': '', 'out': a.out || '<' || s}} END, {{'due': '', 'out': string_split(coalesce({x}, ''), '<')[1]}}).out"""
    for ent, ch in (("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&lt;", "<"),
                    ("&gt;", ">"), ("&amp;", "&")):
        s = f"replace({s}, '{ent}', '{ch}')"
    return f"trim(regexp_replace({s}, '{WS_SQL}+', ' ', 'g'), ' ')"


# All documents, and blank ones as rows of their own.
DOCS_SQL = f"""(SELECT doc_id, text, lang, source FROM documents
  UNION ALL SELECT doc_id + {I.BLANK_IDS}, '   ', lang, source FROM documents WHERE doc_id % 17 = 0)"""


# ------------------------------------------------------------------ P4
@query("normalize_text", f"SELECT doc_id, {norm_sql('text')} AS text_norm FROM documents")
def q_normalize_text(spark, sf):
    d = I.table(spark, sf, "documents")
    return d.select("doc_id", T.normalize_text("text").alias("text_norm"))


# ------------------------------------------------------------------ P5
@query("strip_html", f"SELECT page_id, {html_sql('html')} AS text FROM pages")
def q_strip_html(spark, sf):
    p = I.table(spark, sf, "pages")
    return p.select("page_id", T.strip_html("html").alias("text"))


# ------------------------------------------------------------------ P7 / P8
_STEP = I.CHUNK_MAX - I.CHUNK_OVERLAP
_CHUNKS_SQL = f"""
  WITH d AS (SELECT doc_id, text, length(text) AS n FROM documents),
  k AS (SELECT doc_id, text, CASE WHEN n = 0 THEN 0 WHEN n <= {I.CHUNK_MAX} THEN 1
        ELSE 1 + CAST(ceil((n - {I.CHUNK_MAX}) / {_STEP}.0) AS BIGINT) END AS k FROM d),
  c AS (SELECT doc_id, i AS chunk_idx, substring(text, i * {_STEP} + 1, {I.CHUNK_MAX}) AS chunk
        FROM k, range(0, k) t(i))
"""


def _chunks(spark, sf):
    d = I.table(spark, sf, "documents")
    return d.select("doc_id", F.posexplode(T.chunk_text(F.col("text"), I.CHUNK_MAX, I.CHUNK_OVERLAP))
                    .alias("chunk_idx", "chunk"))


@query("chunk_text", _CHUNKS_SQL + "SELECT doc_id, CAST(chunk_idx AS INTEGER) AS chunk_idx, "
       "CAST(length(chunk) AS INTEGER) AS chunk_len, chunk FROM c")
def q_chunk_text(spark, sf):
    return _chunks(spark, sf).select("doc_id", "chunk_idx", F.char_length("chunk").alias("chunk_len"), "chunk")


@query("chunk_id", _CHUNKS_SQL + "SELECT doc_id, CAST(chunk_idx AS INTEGER) AS chunk_idx, "
       "left(sha256(CAST(doc_id AS VARCHAR) || '|' || chunk), 24) AS chunk_id FROM c")
def q_chunk_id(spark, sf):
    return _chunks(spark, sf).select("doc_id", "chunk_idx", H.chunk_id("doc_id", "chunk").alias("chunk_id"))


# ------------------------------------------------------------------ P9, P10, P11
@query("text_hash", f"SELECT doc_id, sha1({norm_sql(norm_sql('text'))}) AS text_hash FROM documents")
def q_text_hash(spark, sf):
    d = I.table(spark, sf, "documents")
    return d.select("doc_id", H.text_hash(T.normalize_twice("text")).alias("text_hash"))


def uuid_sql(docs: str) -> str:
    return f"""
  SELECT doc_id, substr(h,1,8) || '-' || substr(h,9,4) || '-5' || substr(h,14,3) || '-' ||
    lower(printf('%02x', (CAST(('0x' || substr(h,17,2)) AS INTEGER) & 63) | 128)) || substr(h,19,2) || '-' ||
    substr(h,21,12) AS point_id
  FROM (SELECT doc_id, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') ||
        encode('doc:' || CAST(doc_id AS VARCHAR) || '|v1')) AS h FROM {docs})
"""


@query("point_id", uuid_sql("documents"))
def q_point_id(spark, sf):
    d = I.table(spark, sf, "documents")
    return d.select("doc_id", H.point_id("doc_id", I.EMBEDDING_VERSION).alias("point_id"))


@query("item_hash_id", "SELECT p_partkey, md5(CAST(p_partkey AS VARCHAR) || '-' || p_name) AS item_hash_id FROM part")
def q_item_hash_id(spark, sf):
    p = I.table(spark, sf, "part")
    return p.select("p_partkey", H.item_hash_id("p_partkey", "p_name").alias("item_hash_id"))


# ------------------------------------------------------------------ P2 (over S1 records)
@query("row_hash", "SELECT CAST(p_partkey AS VARCHAR) AS item_seq, "
       "md5(coalesce(p_brand, '') || '|' || coalesce(p_name, '') || '|' || CAST(p_partkey AS VARCHAR)) AS row_hash FROM part")
def q_row_hash(spark, sf):
    from ..sources.pages import explode_json_pages
    r = explode_json_pages(I.json_pages(spark, sf))
    m = F.try_variant_get("record", "$", "map<string,string>")
    return r.select(F.variant_get("record", "$.ITEM_SEQ", "string").alias("item_seq"), H.row_hash(m).alias("row_hash"))


# ------------------------------------------------------------------ P14, P16
@query("kst_date", "SELECT event_id, strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%d') AS kst_date FROM events")
def q_kst_date(spark, sf):
    e = I.table(spark, sf, "events")
    return e.select("event_id", TM.business_date("ts").alias("kst_date"))


@query("mask_secret", "SELECT page_id, CASE WHEN url IS NULL THEN '***MASKED***' "
       "ELSE left(url, 5) || '...' || right(url, 3) END AS masked FROM pages")
def q_mask_secret(spark, sf):
    p = I.table(spark, sf, "pages")
    return p.select("page_id", T.mask_secret("url").alias("masked"))


# ------------------------------------------------------------------ V5
@query("l2_normalize", """
  SELECT vec_id, CAST(pos - 1 AS INTEGER) AS pos, round(CAST(x AS DOUBLE) / greatest(sqrt(ss), 1e-9), 6) AS value
  FROM (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos,
               list_sum(list_transform(embedding, lambda v: CAST(v AS DOUBLE) * CAST(v AS DOUBLE))) AS ss
        FROM embeddings)
""")
def q_l2_normalize(spark, sf):
    e = I.table(spark, sf, "embeddings")
    return e.select("vec_id", F.posexplode(V.l2_normalize("embedding")).alias("pos", "value")) \
        .select("vec_id", "pos", F.round("value", 6).alias("value"))


# ------------------------------------------------------------------ P3
@query("extract_text", f"""
  SELECT doc_id, CASE WHEN {norm_sql('text')} = ''
    THEN {norm_sql(norm_sql(chr(39) + '{"doc_id":' + chr(39) + ' || doc_id || ' + chr(39) + ',"text":"' + chr(39) +
                             ' || text || ' + chr(39) + '","lang":"' + chr(39) + ' || lang || ' + chr(39) +
                             '","source":"' + chr(39) + ' || source || ' + chr(39) + '"}' + chr(39)))}
    ELSE {norm_sql(norm_sql('text'))} END AS text
  FROM {DOCS_SQL}
""")
def q_extract_text(spark, sf):
    d = I.documents(spark, sf)
    return d.select("doc_id", T.normalize_text(T.extract_text(["text"], ["doc_id", "text", "lang", "source"]))
                    .alias("text"))


# ------------------------------------------------------------------ P6
@query("embedding_input", f"""
  WITH c AS (
    SELECT CAST(doc_id AS VARCHAR) AS chunk_id, lang AS name, text AS contents, false AS is_html FROM documents
    UNION ALL
    SELECT 'p' || CAST(page_id AS VARCHAR), 'page', html, true FROM pages),
  s AS (SELECT chunk_id, regexp_replace(coalesce(name, ''), '^{WS_SQL}+|{WS_SQL}+$', '', 'g') AS a,
               regexp_replace(CASE WHEN is_html THEN {html_sql('contents')} ELSE coalesce(contents, '') END,
                              '^{WS_SQL}+|{WS_SQL}+$', '', 'g') AS b FROM c)
  SELECT chunk_id, CASE WHEN a <> '' AND b <> '' THEN a || ' | ' || b WHEN a <> '' THEN a ELSE b END AS input FROM s
""")
def q_embedding_input(spark, sf):
    c = I.chunks(spark, sf)
    return c.select("chunk_id", T.embedding_input("name", "contents", F.col("meta")["content_type"] == "html")
                    .alias("input"))


# ================================================================== sources
REC_SQL = """rec AS (
  SELECT CAST((rn - 1) // 100 + 1 AS INTEGER) AS page_no, CAST((rn - 1) % 100 AS INTEGER) AS record_idx,
         CAST(p_partkey AS VARCHAR) AS item_seq, p_name AS item_name, p_brand AS entp_name,
         CAST(cnt AS VARCHAR) AS total_count
  FROM (SELECT *, row_number() OVER (ORDER BY p_partkey) AS rn, count(*) OVER () AS cnt FROM part))"""
PAGES_SQL = "pg AS (SELECT CAST(range + 1 AS INTEGER) AS page_no FROM range(0, (SELECT CAST(ceil(count(*) / 100.0) AS BIGINT) FROM part)))"


def _json_records(spark, sf):
    from ..sources.pages import explode_json_pages
    return explode_json_pages(I.json_pages(spark, sf))


@query("json_page_records", f"WITH {REC_SQL} SELECT page_no, record_idx, item_seq, item_name, entp_name, "
       "total_count, 'list' AS shape_status FROM rec")
def q_json_page_records(spark, sf):
    r = _json_records(spark, sf)
    g = lambda k: F.variant_get("record", f"$.{k}", "string")
    return r.select("page_no", "record_idx", g("ITEM_SEQ").alias("item_seq"), g("ITEM_NAME").alias("item_name"),
                    g("ENTP_NAME").alias("entp_name"), "total_count", "shape_status")


@query("xml_page_records", f"""WITH {REC_SQL} SELECT page_no, record_idx, item_seq, item_name, entp_name, total_count,
  CAST(NULL AS VARCHAR) AS detail, 'no. 0' || item_seq AS note, 'new' AS tag FROM rec""")
def q_xml_page_records(spark, sf):
    from ..sources.pages import explode_xml_pages
    r = explode_xml_pages(I.xml_pages(spark, sf))
    m = F.col("record_map")
    return r.select("page_no", "record_idx", m["ITEM_SEQ"].alias("item_seq"), m["ITEM_NAME"].alias("item_name"),
                    m["ENTP_NAME"].alias("entp_name"), "total_count", m["DETAIL"].alias("detail"), m["NOTE"].alias("note"), m["TAG"].alias("tag"))


def _parsed(spark, sf):
    from ..sources.pages import parse_records
    return parse_records(_json_records(spark, sf), keep=("page_no", "record_idx"))


@query("parse_records", "SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, p_brand AS vendor, "
       "md5(coalesce(p_brand, '') || '|' || coalesce(p_name, '') || '|' || CAST(p_partkey AS VARCHAR)) AS row_hash FROM part")
def q_parse_records(spark, sf):
    good, _ = _parsed(spark, sf)
    return good.select("id", "name", "vendor", "row_hash")


@query("parse_quarantine", """SELECT event_id, CASE event_type WHEN 'click' THEN 'id:not_string' WHEN 'error' THEN 'name:not_string'
  ELSE 'id:missing' END AS reason FROM events WHERE event_type IN ('click', 'error', 'view', 'signup')""")
def q_parse_quarantine(spark, sf):
    from ..sources.pages import parse_records
    _, bad = parse_records(I.event_records(spark, sf), keep=["event_id"])
    return bad.select("event_id", "reason")


K_SQL = "(SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)"


def _odd_k(rec):
    """A user's parser: raises for a record whose name is a number, skips even k."""
    if not isinstance(rec["ITEM_NAME"], str):
        raise ValueError(f"bad name {rec['ITEM_NAME']}")
    return None if rec["k"] % 2 == 0 else {"y": rec["k"], "kind": rec["ITEM_NAME"]}


def _function_parsed(spark, sf):
    from ..sources.pages import FunctionParser, parse_records
    return parse_records(I.event_records(spark, sf), FunctionParser(_odd_k, "y long, kind string"), keep=["event_id"])


def _column_parsed(spark, sf):
    from ..sources.pages import ColumnParser, parse_records
    k = lambda r: F.try_variant_get(r, "$.k", "long")
    number = lambda r: F.schema_of_variant(F.try_variant_get(r, "$.ITEM_NAME", "variant")) != "STRING"
    parser = ColumnParser({"y": k, "kind": lambda r: F.try_variant_get(r, "$.ITEM_NAME", "string")}, skip=lambda r: k(r) % 2 == 0,
                          error=lambda r: F.when(number(r), F.concat(F.lit("bad name "), F.try_variant_get(r, "$.ITEM_NAME", "string"))))
    return parse_records(I.event_records(spark, sf), parser, keep=["event_id"])


_ODD_SQL = f"SELECT event_id, k AS y, event_type AS kind FROM {K_SQL} WHERE event_type <> 'error' AND k % 2 = 1"


@query("parse_function", _ODD_SQL)
def q_parse_function(spark, sf):
    return _function_parsed(spark, sf)[0]


@query("parse_function_errors", "SELECT event_id, 'ValueError: bad name 404' AS reason FROM events WHERE event_type = 'error'")
def q_parse_function_errors(spark, sf):
    return _function_parsed(spark, sf)[1]


@query("parse_columns", _ODD_SQL)
def q_parse_columns(spark, sf):
    return _column_parsed(spark, sf)[0]


@query("parse_columns_errors", "SELECT event_id, 'bad name 404' AS reason FROM events WHERE event_type = 'error'")
def q_parse_columns_errors(spark, sf):
    return _column_parsed(spark, sf)[1]


@query("xml_parse_records", "SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, p_brand AS vendor FROM part")
def q_xml_parse_records(spark, sf):
    from ..sources.pages import explode_xml_pages, map_to_variant, parse_records
    r = explode_xml_pages(I.xml_pages(spark, sf)).withColumn("record", map_to_variant("record_map"))
    good, _ = parse_records(r)
    return good.select("id", "name", "vendor")


@query("page_plan", """
  SELECT api_name, page_count, CAST(p AS INTEGER) AS page_no, CAST((p - 1) // 100 AS INTEGER) AS batch_no
  FROM (SELECT event_type AS api_name, CAST(ceil(count(*) / 100.0) AS INTEGER) AS page_count
        FROM events GROUP BY 1) t, range(1, page_count + 1) r(p)
""")
def q_page_plan(spark, sf):
    from ..sources.pages import plan_pages
    return plan_pages(I.event_totals(spark, sf), page_size=100, batch_size=100) \
        .select("api_name", "page_count", "page_no", "batch_no")


@query("page_batches", """
  SELECT api_name, CAST((p - 1) // 100 AS INTEGER) AS batch_no, CAST(count(*) AS BIGINT) AS pages,
         CAST(min(p) AS INTEGER) AS first_page, CAST(max(p) AS INTEGER) AS last_page
  FROM (SELECT event_type AS api_name, CAST(ceil(count(*) / 10.0) AS INTEGER) AS n FROM events GROUP BY 1) t,
       range(1, n + 1) r(p) GROUP BY 1, 2
""")
def q_page_batches(spark, sf):
    from ..sources.pages import page_batches, plan_pages
    b = page_batches(plan_pages(I.event_totals(spark, sf), page_size=10, batch_size=100))
    return b.select("api_name", "batch_no", F.size("page_batch").cast("long").alias("pages"),
                    F.col("page_batch")[0].alias("first_page"), F.element_at("page_batch", -1).alias("last_page"))


def _item_plan(spark, sf):
    """Page plan of the items API from the totalCount its first page reports."""
    from ..sources.pages import plan_pages
    rec = _json_records(spark, sf)
    totals = rec.where(F.col("page_no") == 1).groupBy("api_name", "run_date").agg(F.max("total_count").alias("total_count"))
    return plan_pages(totals, page_size=I.API_PAGE_SIZE, batch_size=100)


@query("pending_pages", f"WITH {PAGES_SQL} SELECT 'items' AS api_name, '2024-01-31' AS run_date, page_no "
       "FROM pg WHERE page_no % 3 <> 0")
def q_pending_pages(spark, sf):
    from ..sources.ledger import pending_pages
    return pending_pages(_item_plan(spark, sf), I.ledger(spark, sf)).select("api_name", "run_date", "page_no")


@query("ledger_mark", f"""WITH {REC_SQL}, sz AS (SELECT page_no, count(*) AS n FROM rec GROUP BY 1)
  SELECT 'items' AS api_name, '2024-01-31' AS run_date, page_no,
         CAST(CASE WHEN page_no % 3 = 0 THEN 100 ELSE n END AS INTEGER) AS processed_size,
         strftime(CASE WHEN page_no % 3 = 0 THEN TIMESTAMP '2024-01-31' - to_days(CAST(10 * page_no AS INTEGER))
                  ELSE TIMESTAMP '2024-01-31 00:00:00' END, '%Y-%m-%d %H:%M:%S') AS processed_at,
         CASE WHEN page_no % 3 = 0 THEN 'kept' ELSE 'upserted' END AS _action
  FROM sz""")
def q_ledger_mark(spark, sf):
    from ..sources.ledger import mark_pages, pending_pages
    from ..session import FIXED_NOW
    rec = _json_records(spark, sf)
    pend = pending_pages(_item_plan(spark, sf), I.ledger(spark, sf))
    sizes = rec.groupBy("api_name", "run_date", "page_no").agg(F.count(F.lit(1)).cast("int").alias("processed_size"))
    done = pend.join(sizes, ["api_name", "run_date", "page_no"])
    m = mark_pages(I.ledger(spark, sf), done, FIXED_NOW)
    return m.select("api_name", "run_date", "page_no", "processed_size",
                    TM.fmt_ts("processed_at").alias("processed_at"), "_action")


@query("ledger_unmark", f"WITH {PAGES_SQL} SELECT 'items' AS api_name, '2024-01-31' AS run_date, page_no "
       "FROM pg WHERE page_no % 3 = 0 AND page_no % 2 = 1")
def q_ledger_unmark(spark, sf):
    from ..sources.ledger import unmark_pages
    led = I.ledger(spark, sf)
    return unmark_pages(led, led.where(F.col("page_no") % 2 == 0)).select("api_name", "run_date", "page_no")


@query("ledger_retention", f"WITH {PAGES_SQL} SELECT 'items' AS api_name, '2024-01-31' AS run_date, page_no "
       "FROM pg WHERE page_no % 3 = 0 AND TIMESTAMP '2024-01-31' - to_days(CAST(10 * page_no AS INTEGER)) "
       "> TIMESTAMP '2024-01-31' - INTERVAL 90 DAY")
def q_ledger_retention(spark, sf):
    from ..sources.ledger import expire_pages
    from ..session import FIXED_NOW
    return expire_pages(I.ledger(spark, sf), FIXED_NOW, 90).select("api_name", "run_date", "page_no")


@query("request_plan", f"""WITH {PAGES_SQL}
  SELECT page_no, 'demo-...key' AS service_key, 'json' AS type, CAST(page_no AS VARCHAR) AS page_param,
         '100' AS num_of_rows, 'Y' AS flag FROM pg""")
def q_request_plan(spark, sf):
    from ..sources.paged_api import request_plan
    r = request_plan(_item_plan(spark, sf), 100, "json", {"flag": "Y"}, service_key="demo-service-key")
    p = F.col("params")
    return r.select("page_no", p["serviceKey"].alias("service_key"), p["type"].alias("type"),
                    p["pageNo"].alias("page_param"), p["numOfRows"].alias("num_of_rows"), p["flag"].alias("flag"))


# ------------------------------------------------------------------ S9 / A4 / L1
def _stored(df, spark, name):
    """``df`` as a table in the shared folder."""
    import uuid
    from ..session import checkpoint_dir
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@query("page_directory", """
  SELECT CAST((rn - 1) // 50 + 1 AS BIGINT) AS page_no, doc_id AS start_id, lead(doc_id) OVER (ORDER BY doc_id) AS end_id
  FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rn FROM documents WHERE lang = 'en') WHERE (rn - 1) % 50 = 0""")
def q_page_directory(spark, sf):
    from ..sources.scan import page_directory
    return page_directory(I.table(spark, sf, "documents"), "doc_id", 50, F.col("lang") == "en")


@query("scan_page", """
  SELECT doc_id, source, rn AS position FROM (
    SELECT doc_id, source, row_number() OVER (ORDER BY doc_id) AS rn FROM documents WHERE lang = 'en')
  WHERE rn > 50 AND rn <= 100""")
def q_scan_page(spark, sf):
    """One page by the stored directory: a range scan with both bounds pushed."""
    from ..sources.scan import page_directory, read_page
    d, en = I.table(spark, sf, "documents"), F.col("lang") == "en"
    directory = _stored(page_directory(d, "doc_id", 50, en), spark, "page-directory")
    return read_page(d, directory, "doc_id", 2, 50, en, ["doc_id", "source"])


@query("scan_count", "SELECT count(*) AS n FROM documents WHERE lang = 'en'")
def q_scan_count(spark, sf):
    from ..sources.scan import scan_count
    return scan_count(I.table(spark, sf, "documents"), F.col("lang") == "en")


@query("total_pages", "SELECT CAST(ceil(count(*) / 50.0) AS BIGINT) AS total_pages FROM documents")
def q_total_pages(spark, sf):
    from ..operators.ranking import total_pages
    return total_pages(I.table(spark, sf, "documents"), 50)


@query("ids_by_page", "SELECT doc_id, rn AS rank FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rn "
       "FROM documents) WHERE rn > 100 AND rn <= 150")
def q_ids_by_page(spark, sf):
    from ..operators.ranking import ids_by_page
    return ids_by_page(I.table(spark, sf, "documents"), "doc_id", page_no=3, page_size=50)


# ================================================================== merge
_MERGE_SQL = """
  WITH b AS (
    SELECT CAST(p_partkey AS VARCHAR) AS id,
           CASE WHEN p_partkey % 7 = 0 THEN p_name || ' v2' ELSE p_name END AS name,
           CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_brand END AS vendor, 1 AS seq
    FROM part WHERE p_partkey % 7 = 0 OR p_partkey % 11 = 0 OR p_partkey % 5 = 0
    UNION ALL SELECT CAST(p_partkey AS VARCHAR), p_name || ' old', p_brand, 0 FROM part WHERE p_partkey % 7 = 0
    UNION ALL SELECT CAST(p_partkey + 1000000 AS VARCHAR), p_name, p_brand, 1 FROM part WHERE p_partkey % 13 = 0),
  u AS (SELECT id, name, vendor, seq FROM (
          SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC, name DESC, vendor DESC) AS rn FROM b) WHERE rn = 1),
  t AS (SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, p_brand AS vendor FROM part),
  m AS (
    SELECT coalesce(t.id, u.id) AS id,
           CASE WHEN u.id IS NOT NULL THEN u.name ELSE t.name END AS name,
           CASE WHEN u.id IS NOT NULL THEN u.vendor ELSE t.vendor END AS vendor,
           CASE WHEN t.id IS NULL THEN 'upserted'
                WHEN u.id IS NULL THEN 'kept'
                WHEN t.name IS DISTINCT FROM u.name OR t.vendor IS DISTINCT FROM u.vendor THEN 'modified'
                ELSE 'same' END AS _action
    FROM t FULL OUTER JOIN u ON t.id = u.id)
"""


@query("dedup_latest", _MERGE_SQL + "SELECT id, name, vendor, CAST(seq AS INTEGER) AS seq FROM u")
def q_dedup_latest(spark, sf):
    from ..operators.merge import dedup_latest
    return dedup_latest(I.changed_batch(spark, sf), ["id"], "seq").select("id", "name", "vendor", "seq")


@query("merge_upsert", _MERGE_SQL + "SELECT id, name, vendor, _action FROM m")
def q_merge_upsert(spark, sf):
    from ..operators.merge import merge_upsert
    return merge_upsert(I.part_items(spark, sf), I.changed_batch(spark, sf), ["id"], "seq")


@query("merge_counts", _MERGE_SQL + """SELECT count(*) FILTER (WHERE _action = 'upserted') AS upserted,
  count(*) FILTER (WHERE _action = 'modified') AS modified, count(*) FILTER (WHERE _action = 'same') AS same,
  count(*) FILTER (WHERE _action IN ('upserted', 'modified')) AS written FROM m""")
def q_merge_counts(spark, sf):
    from ..operators.merge import merge_counts, merge_upsert
    return merge_counts(merge_upsert(I.part_items(spark, sf), I.changed_batch(spark, sf), ["id"], "seq"))


@query("point_delete", "SELECT vec_id AS point_id, CAST(label AS VARCHAR) AS type FROM embeddings WHERE label <> 3")
def q_point_delete(spark, sf):
    from ..operators.points import delete_points
    pts = I.vector_points(spark, sf)
    return delete_points(pts, pts.where(F.col("type") == "3")).select("point_id", "type")


@query("point_lookup", "SELECT vec_id AS point_id, label FROM embeddings WHERE vec_id IN "
       "(SELECT doc_id FROM labels WHERE quality = 1)")
def q_point_lookup(spark, sf):
    from ..operators.merge import lookup_by_ids
    e = I.table(spark, sf, "embeddings").select(F.col("vec_id").alias("point_id"), "label")
    ids = I.table(spark, sf, "labels").where(F.col("quality") == 1).select(F.col("doc_id").alias("point_id"))
    return lookup_by_ids(e, ids, "point_id")


# ================================================================== indexing (F, T, W1, A2, A3, Q2)
DOC_STATE_SQL = f"""
  dt AS (SELECT doc_id, {norm_sql(norm_sql('text'))} AS text,
                md5(concat(doc_id, '|', lang, '|', source, '|', text)) AS row_hash FROM {DOCS_SQL}),
  dh AS (SELECT doc_id, text, row_hash, sha1({norm_sql('text')}) AS text_hash FROM dt),
  st AS (SELECT doc_id, CASE WHEN doc_id % 6 IN (1, 2, 4) THEN '1' WHEN doc_id % 6 = 3 THEN '0' END AS embedding_version,
                CASE WHEN doc_id % 6 = 2 THEN 'stale' WHEN doc_id % 6 = 4 THEN '' ELSE text_hash END AS indexed_hash,
                CASE WHEN doc_id % 6 = 2 THEN 'stale' WHEN doc_id % 6 = 4 THEN '' WHEN doc_id % 6 = 1 AND doc_id % 5 = 0 THEN 'older'
                     ELSE row_hash END AS indexed_row_hash
         FROM dh WHERE doc_id % 6 <> 0),
  ls AS (SELECT doc_id, CASE doc_id % 4 WHEN 1 THEN 'w0' WHEN 2 THEN 'w1' ELSE 'w2' END AS owner,
                CASE WHEN doc_id % 4 = 1 THEN TIMESTAMP '2024-01-31' - to_seconds(CAST(doc_id % {I.BLANK_IDS} - 1 AS BIGINT))
                     ELSE TIMESTAMP '2024-01-31 00:05:00' END AS expires_at
         FROM {DOCS_SQL} WHERE doc_id % 4 <> 0),
  j AS (SELECT dh.*, st.doc_id IS NOT NULL AS has_state, st.embedding_version, st.indexed_hash, st.indexed_row_hash,
               ls.doc_id IS NOT NULL AS has_lease, ls.owner, ls.expires_at
        FROM dh LEFT JOIN st USING (doc_id) LEFT JOIN ls USING (doc_id)),
  f AS (SELECT *, (NOT has_state OR embedding_version IS DISTINCT FROM '1'
                   OR coalesce(row_hash, '') <> coalesce(indexed_row_hash, '')) AS needs,
               (NOT has_lease OR coalesce(expires_at <= TIMESTAMP '2024-01-31', false)) AS free FROM j),
  r AS (SELECT *, CASE WHEN NOT needs THEN 'up_to_date' WHEN NOT free THEN 'leased'
                       WHEN text = '' THEN 'empty_text'
                       WHEN coalesce(indexed_hash, '') <> '' AND indexed_hash = text_hash AND embedding_version = '1'
                         THEN 'skipped_same_hash'
                       ELSE 'embed' END AS status FROM f),
  pg AS (SELECT doc_id, CAST((row_number() OVER (ORDER BY doc_id) - 1) // 500 + 1 AS BIGINT) AS page_no
         FROM r WHERE status <> 'up_to_date')
"""


def _doc_state(spark, sf):
    """Stored documents with their row hashes, index state and leases. The
    state's text hashes are those of the canonical texts."""
    stored = I.stored_documents(spark, sf)
    return stored, I.index_state(spark, sf, I.canonical(stored), stored), I.leases(spark, sf)


def _joined(spark, sf):
    stored, st, ls = _doc_state(spark, sf)
    return stored.select("doc_id", "row_hash") \
        .join(st.select("doc_id", "embedding_version", "indexed_hash", "indexed_row_hash", F.lit(True).alias("has_state")), "doc_id", "left") \
        .join(ls.select("doc_id", "owner", "expires_at", F.lit(True).alias("has_lease")), "doc_id", "left")


def _needs():
    from ..functions.predicates import needs_index
    return needs_index(I.EMBEDDING_VERSION, current_hash="row_hash", indexed_hash="indexed_row_hash")


@query("needs_index", f"WITH {DOC_STATE_SQL} SELECT doc_id, needs AS needs_index FROM f")
def q_needs_index(spark, sf):
    return _joined(spark, sf).select("doc_id", _needs().alias("needs_index"))


@query("lease_free", f"WITH {DOC_STATE_SQL} SELECT doc_id, free AS lease_free FROM f")
def q_lease_free(spark, sf):
    from ..functions.predicates import lease_free
    from ..session import FIXED_NOW
    return _joined(spark, sf).select("doc_id", lease_free(FIXED_NOW).alias("lease_free"))


@query("id_range", "SELECT doc_id, lang FROM documents WHERE doc_id >= 100 AND doc_id < 600")
def q_id_range(spark, sf):
    from ..functions.predicates import in_range
    return I.table(spark, sf, "documents").where(in_range("doc_id", 100, 600)).select("doc_id", "lang")


def _found(spark, sf):
    """(state, first half of the routing by stored hashes, claimed documents with their canonical texts)."""
    from ..operators.state import candidates
    from ..plans.index import stored_hashes, texts_of
    from ..session import FIXED_NOW, checkpoint_dir
    checkpoint_dir(spark)
    stored, st, ls = _doc_state(spark, sf)
    found = candidates(stored_hashes(stored), st, ls, I.EMBEDDING_VERSION, FIXED_NOW).checkpoint(eager=True)
    return st, found, texts_of(stored, found.where(F.col("status") == "claimed").select("doc_id"), I.canonical)


def _routed(spark, sf):
    from ..operators.state import settle
    _, found, texts = _found(spark, sf)
    return settle(found, texts.select("doc_id", "text_hash", (F.col("text") == "").alias("blank")), I.EMBEDDING_VERSION)


@query("index_routing", f"WITH {DOC_STATE_SQL} SELECT doc_id, status FROM r")
def q_index_routing(spark, sf):
    return _routed(spark, sf).select("doc_id", "status")


@query("blank_docs", f"WITH {DOC_STATE_SQL} SELECT doc_id FROM r WHERE status = 'empty_text'")
def q_blank_docs(spark, sf):
    return _routed(spark, sf).where(F.col("status") == "empty_text").select("doc_id")


@query("unchanged_docs", f"WITH {DOC_STATE_SQL} SELECT doc_id FROM r WHERE status = 'skipped_same_hash'")
def q_unchanged_docs(spark, sf):
    """candidates by their row hash whose text is the indexed one."""
    return _routed(spark, sf).where(F.col("status") == "skipped_same_hash").select("doc_id")


@query("index_candidates", f"WITH {DOC_STATE_SQL} SELECT doc_id, CASE WHEN NOT needs THEN 'up_to_date' WHEN NOT free THEN 'leased' ELSE 'claimed' END AS status FROM r")
def q_index_candidates(spark, sf):
    """First half of the routing, from the stored hashes alone: the document scan reads doc_id and row_hash."""
    from ..operators.state import candidates
    from ..plans.index import stored_hashes
    from ..session import FIXED_NOW
    stored, st, ls = _doc_state(spark, sf)
    return candidates(stored_hashes(stored), st, ls, I.EMBEDDING_VERSION, FIXED_NOW).select("doc_id", "status")


@query("page_anchors", f"WITH {DOC_STATE_SQL} SELECT page_no, doc_id AS start_id FROM "
       "(SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rn, CAST((row_number() OVER (ORDER BY doc_id) - 1) // 500 + 1 AS BIGINT) AS page_no "
       "FROM f WHERE needs) WHERE (rn - 1) % 500 = 0")
def q_page_anchors(spark, sf):
    from ..operators.ranking import page_anchors
    ids = _joined(spark, sf).where(_needs()).select("doc_id")
    return page_anchors(ids, "doc_id", I.INDEX_PAGE_SIZE)


@query("page_ranges", f"WITH {DOC_STATE_SQL}, a AS (SELECT page_no, doc_id AS start_id FROM "
       "(SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rn, CAST((row_number() OVER (ORDER BY doc_id) - 1) // 500 + 1 AS BIGINT) AS page_no "
       "FROM f WHERE needs) WHERE (rn - 1) % 500 = 0) "
       "SELECT page_no, start_id, lead(start_id) OVER (ORDER BY page_no) AS end_id FROM a")
def q_page_ranges(spark, sf):
    from ..operators.ranking import page_anchors, page_ranges
    ids = _joined(spark, sf).where(_needs()).select("doc_id")
    return page_ranges(page_anchors(ids, "doc_id", I.INDEX_PAGE_SIZE))


@query("page_assignment", f"WITH {DOC_STATE_SQL} SELECT doc_id, page_no FROM pg")
def q_page_assignment(spark, sf):
    from ..plans.index import routed_candidates, stored_hashes
    from ..session import FIXED_NOW
    stored, st, ls = _doc_state(spark, sf)
    r = routed_candidates(stored_hashes(stored), st, ls, I.EMBEDDING_VERSION, FIXED_NOW, I.INDEX_PAGE_SIZE)
    return r.where(F.col("page_no").isNotNull()).select("doc_id", "page_no")


# ------------------------------------------------------------------ T1-T6
_TS = "'%Y-%m-%d %H:%M:%S'"


@query("release_stale", f"WITH {DOC_STATE_SQL} SELECT doc_id, owner FROM ls WHERE NOT (expires_at <= TIMESTAMP '2024-01-31')")
def q_release_stale(spark, sf):
    from ..operators.state import release_stale
    from ..session import FIXED_NOW
    return release_stale(I.leases(spark, sf), FIXED_NOW).select("doc_id", "owner")


@query("stale_count", f"WITH {DOC_STATE_SQL} SELECT count(*) FILTER (WHERE expires_at <= TIMESTAMP '2024-01-31') AS released FROM ls")
def q_stale_count(spark, sf):
    from ..operators.state import stale_count
    from ..session import FIXED_NOW
    return stale_count(I.leases(spark, sf), FIXED_NOW)


@query("acquire_leases", f"""WITH {DOC_STATE_SQL}
  SELECT doc_id, owner, strftime(expires_at, {_TS}) AS expires_at FROM ls WHERE doc_id NOT IN (SELECT doc_id FROM f WHERE needs AND free)
  UNION ALL
  SELECT doc_id, 'w9', '2024-01-31 00:05:00' FROM f WHERE needs AND free""")
def q_acquire_leases(spark, sf):
    from ..operators.state import acquire
    from ..session import FIXED_NOW
    cand = _joined(spark, sf).where(_needs()).select("doc_id")
    out = acquire(cand, I.leases(spark, sf), "w9", FIXED_NOW, I.LEASE_SECONDS)
    return out.select("doc_id", "owner", TM.fmt_ts("expires_at").alias("expires_at"))


@query("heartbeat", f"""WITH {DOC_STATE_SQL}
  SELECT doc_id, owner,
         CASE WHEN owner = 'w1' THEN '2024-01-31 00:07:00' ELSE strftime(expires_at, {_TS}) END AS expires_at,
         CASE WHEN owner = 'w1' THEN '2024-01-31 00:02:00' ELSE strftime(expires_at - INTERVAL 300 SECOND, {_TS}) END AS heartbeat_at
  FROM ls""")
def q_heartbeat(spark, sf):
    import datetime as dt
    from ..operators.state import heartbeat
    from ..session import FIXED_NOW
    ids = I.documents(spark, sf).select("doc_id")
    out = heartbeat(I.leases(spark, sf), ids, "w1", FIXED_NOW + dt.timedelta(seconds=120), I.LEASE_SECONDS)
    return out.select("doc_id", "owner", TM.fmt_ts("expires_at").alias("expires_at"),
                      TM.fmt_ts("heartbeat_at").alias("heartbeat_at"))


@query("release_owned", f"WITH {DOC_STATE_SQL} SELECT doc_id, owner FROM ls WHERE owner <> 'w2'")
def q_release_owned(spark, sf):
    from ..operators.state import release
    ids = I.documents(spark, sf).select("doc_id")
    return release(I.leases(spark, sf), ids, "w2").select("doc_id", "owner")


@query("mark_indexed", f"""WITH {DOC_STATE_SQL}
  SELECT coalesce(st.doc_id, e.doc_id) AS doc_id,
         CASE WHEN e.doc_id IS NOT NULL THEN '1' ELSE st.embedding_version END AS embedding_version,
         CASE WHEN e.doc_id IS NOT NULL THEN coalesce(e.text_hash, '') ELSE st.indexed_hash END AS indexed_hash,
         CASE WHEN e.doc_id IS NOT NULL THEN e.row_hash ELSE st.indexed_row_hash END AS indexed_row_hash,
         CASE WHEN e.doc_id IS NOT NULL THEN '2024-01-31 00:00:00' ELSE '2024-01-30 00:00:00' END AS indexed_at,
         -- a matched row always changes: indexed_at moves from the day before to now
         CASE WHEN st.doc_id IS NULL THEN 'upserted' WHEN e.doc_id IS NULL THEN 'kept'
              ELSE 'modified' END AS _action
  FROM st FULL OUTER JOIN (SELECT doc_id, text_hash, row_hash FROM r WHERE status = 'embed') e USING (doc_id)""")
def q_mark_indexed(spark, sf):
    from ..operators.state import mark_indexed, settle
    from ..session import FIXED_NOW
    st, found, texts = _found(spark, sf)
    routed = settle(found, texts.select("doc_id", "text_hash", (F.col("text") == "").alias("blank")), I.EMBEDDING_VERSION)
    done = routed.where(F.col("status") == "embed").select("doc_id", "text_hash", "row_hash")
    out = mark_indexed(st, done, I.EMBEDDING_VERSION, FIXED_NOW)
    return out.select("doc_id", "embedding_version", "indexed_hash", "indexed_row_hash", TM.fmt_ts("indexed_at").alias("indexed_at"), "_action")


@query("mark_failed", f"""WITH {DOC_STATE_SQL},
  fl AS (SELECT doc_id FROM r WHERE status = 'leased' AND owner = 'w1')
  SELECT coalesce(st.doc_id, fl.doc_id) AS doc_id,
         CASE WHEN fl.doc_id IS NOT NULL THEN 'lease conflict' END AS last_error,
         CASE WHEN fl.doc_id IS NOT NULL THEN '2024-01-31 00:00:00' END AS last_error_at,
         CASE WHEN st.doc_id IS NULL THEN 'upserted' WHEN fl.doc_id IS NULL THEN 'kept' ELSE 'modified' END AS _action
  FROM st FULL OUTER JOIN fl USING (doc_id)""")
def q_mark_failed(spark, sf):
    from ..operators.state import mark_failed
    from ..session import FIXED_NOW
    r = _routed(spark, sf).where(F.col("status") == "leased")
    failed = r.select("doc_id", F.lit("lease conflict").alias("reason"), F.lit("w1").alias("owner"))
    st, _ = mark_failed(I.index_state(spark, sf), failed, I.leases(spark, sf), FIXED_NOW)
    return st.select("doc_id", "last_error", TM.fmt_ts("last_error_at").alias("last_error_at"), "_action")


@query("lease_after_failure", f"""WITH {DOC_STATE_SQL}
  SELECT doc_id, owner FROM ls WHERE NOT (owner = 'w1' AND doc_id IN (SELECT doc_id FROM r WHERE status = 'leased'))""")
def q_lease_after_failure(spark, sf):
    from ..operators.state import mark_failed
    from ..session import FIXED_NOW
    r = _routed(spark, sf).where(F.col("status") == "leased")
    failed = r.select("doc_id", F.lit("lease conflict").alias("reason"), F.lit("w1").alias("owner"))
    _, ls = mark_failed(I.index_state(spark, sf), failed, I.leases(spark, sf), FIXED_NOW)
    return ls.select("doc_id", "owner")


# ================================================================== vectors (V, A1, A5, S10, S11, L2, L3, F4, F9)
TOK_SQL = r"'[ \t\n\r\x0c\x0b]+'"


def hashing_sql(src: str, key: str, text: str) -> str:
    """Hashing embedder in DuckDB: (key, bucket, value) for non-zero buckets."""
    return f"""(SELECT {key}, bucket, n / sqrt(sum(n * n) OVER (PARTITION BY {key})) AS value FROM (
      SELECT {key}, CAST(CAST(('0x' || substr(md5(w), 1, 8)) AS BIGINT) % 64 AS INTEGER) AS bucket, count(*) AS n
      FROM (SELECT {key}, unnest(list_filter(regexp_split_to_array(lower({text}), {TOK_SQL}), lambda w: w <> '')[1:512]) AS w FROM {src})
      GROUP BY 1, 2))"""


DOC_TEXT_SQL = f"(SELECT doc_id, {norm_sql(norm_sql('text'))} AS text FROM {DOCS_SQL})"


@query("embed_docs", f"SELECT doc_id, bucket, round(value, 6) AS value FROM {hashing_sql(DOC_TEXT_SQL, 'doc_id', 'text')}")
def q_embed_docs(spark, sf):
    from ..operators.embed import HashingEmbedder
    sp = HashingEmbedder(dim=64).embed_sparse(I.doc_texts(spark, sf), ["doc_id"], "text", role="passage")
    return sp.select("doc_id", "bucket", F.round("value", 6).alias("value"))


@query("embed_query", f"SELECT item_id, bucket, round(value, 6) AS value FROM {hashing_sql('benchmark', 'item_id', 'text')}")
def q_embed_query(spark, sf):
    from ..operators.embed import HashingEmbedder
    sp = HashingEmbedder(dim=64).embed_sparse(I.table(spark, sf, "benchmark"), ["item_id"], "text", role="query")
    return sp.select("item_id", "bucket", F.round("value", 6).alias("value"))


CENTROID_SQL = """cen AS (SELECT label, pos, avg(CAST(x AS DOUBLE)) AS c FROM (
    SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings) GROUP BY 1, 2)"""


@query("mean_pool", f"WITH {CENTROID_SQL} SELECT label, CAST(pos AS INTEGER) AS pos, round(c, 6) AS value FROM cen")
def q_mean_pool(spark, sf):
    from ..operators.embed import mean_pool
    e = I.table(spark, sf, "embeddings")
    return mean_pool(e, ["label"], "embedding").select("label", "pos", F.round("value", 6).alias("value"))


@query("mean_pool_masked", """SELECT label, CAST(pos AS INTEGER) AS pos,
  round(sum(CASE WHEN mask THEN CAST(x AS DOUBLE) ELSE 0 END) / greatest(count(*) FILTER (WHERE mask), 1e-9), 6) AS value
  FROM (SELECT label, embedding[1] > 0 AS mask, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings)
  GROUP BY 1, 2""")
def q_mean_pool_masked(spark, sf):
    """Mean per label of the vectors whose first component is positive."""
    from ..operators.embed import mean_pool
    e = I.table(spark, sf, "embeddings").withColumn("mask", (F.col("embedding")[0] > 0).cast("int"))
    return mean_pool(e, ["label"], "embedding", "mask").select("label", "pos", F.round("value", 6).alias("value"))


@query("vector_scores", f"""WITH {CENTROID_SQL},
  ex AS (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings),
  s AS (SELECT vec_id, sum(CAST(x AS DOUBLE) * c) AS dot, sum(CAST(x AS DOUBLE) * x) AS xx, sum(c * c) AS cc,
               sum((CAST(x AS DOUBLE) - c) * (CAST(x AS DOUBLE) - c)) AS d2
        FROM ex JOIN cen USING (label, pos) GROUP BY 1)
  SELECT vec_id, round(dot / (greatest(sqrt(xx), 1e-9) * greatest(sqrt(cc), 1e-9)), 6) AS cosine,
         round(dot, 6) AS dot, round(sqrt(d2), 6) AS euclid FROM s""")
def q_vector_scores(spark, sf):
    from ..operators.embed import mean_vectors
    e = I.table(spark, sf, "embeddings")
    cen = mean_vectors(e, ["label"], "embedding").withColumnRenamed("vector", "centroid")
    j = e.join(cen, "label")
    return j.select("vec_id", F.round(V.cosine("embedding", "centroid"), 6).alias("cosine"),
                    F.round(V.dot("embedding", "centroid"), 6).alias("dot"),
                    F.round(V.euclid("embedding", "centroid"), 6).alias("euclid"))


def topk_sql(k: int, offset: int = 0, where: str = "true", threshold: str = "true") -> str:
    return f"""
  WITH q AS (SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS qv FROM embeddings),
  p AS (SELECT vec_id AS point_id, CAST(label AS VARCHAR) AS type, CAST(embedding AS DOUBLE[]) AS pv FROM embeddings),
  s AS (SELECT query_id, point_id, type,
               list_dot_product(qv, pv) / (greatest(sqrt(list_dot_product(qv, qv)), 1e-9) *
                                           greatest(sqrt(list_dot_product(pv, pv)), 1e-9)) AS score
        FROM q, p WHERE {where}),
  r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, point_id) AS rn FROM s WHERE {threshold})
  SELECT query_id, CAST(rn - {offset} AS INTEGER) AS rank, point_id, type, round(score, 6) AS score
  FROM r WHERE rn > {offset} AND rn <= {offset + k}"""


def _topk(spark, sf, k, offset=0, where=None, threshold=None):
    from ..operators.search import search
    hits = search(I.vector_points(spark, sf), I.vector_queries(spark, sf), k=k, offset=offset, where=where,
                  threshold=threshold, payload_cols=["type"])
    return hits.select("query_id", "rank", "point_id", "type", F.round("score", 6).alias("score"))


@query("vector_topk", topk_sql(5))
def q_vector_topk(spark, sf):
    return _topk(spark, sf, 5)


@query("vector_topk_offset", topk_sql(5, offset=5))
def q_vector_topk_offset(spark, sf):
    return _topk(spark, sf, 5, offset=5)


@query("search_threshold", topk_sql(10, threshold="score >= 0.25"))
def q_search_threshold(spark, sf):
    return _topk(spark, sf, 10, threshold=0.25)


@query("payload_filter", topk_sql(5, where="type = '3'"))
def q_payload_filter(spark, sf):
    from ..functions.predicates import payload_match
    return _topk(spark, sf, 5, where=payload_match(type="3"))


def metric_topk_sql(score: str, order: str) -> str:
    return f"""
  WITH q AS (SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS qv FROM embeddings),
  p AS (SELECT vec_id AS point_id, CAST(embedding AS DOUBLE[]) AS pv FROM embeddings),
  s AS (SELECT query_id, point_id, {score} AS score FROM q, p),
  r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score {order}, point_id) AS rn FROM s)
  SELECT query_id, CAST(rn AS INTEGER) AS rank, point_id, round(score, 6) AS score FROM r WHERE rn <= 5"""


def _metric_topk(spark, sf, metric):
    from ..operators.search import search
    hits = search(I.vector_points(spark, sf), I.vector_queries(spark, sf), k=5, metric=metric)
    return hits.select("query_id", "rank", "point_id", F.round("score", 6).alias("score"))


@query("vector_topk_dot", metric_topk_sql("list_dot_product(qv, pv)", "DESC"))
def q_vector_topk_dot(spark, sf):
    return _metric_topk(spark, sf, "dot")


@query("vector_topk_euclid", metric_topk_sql("list_distance(qv, pv)", "ASC"))
def q_vector_topk_euclid(spark, sf):
    return _metric_topk(spark, sf, "l2")


@query("points_scroll", """SELECT vec_id AS point_id, CAST(label AS VARCHAR) AS type, CAST(len(embedding) AS INTEGER) AS dim,
  round(CAST(embedding[1] AS DOUBLE), 6) AS first_value FROM embeddings WHERE vec_id > 100 ORDER BY vec_id LIMIT 10""")
def q_points_scroll(spark, sf):
    from ..operators.ranking import scroll
    s = scroll(I.vector_points(spark, sf), "point_id", after=100, limit=10)
    return s.select("point_id", "type", F.size("vector").alias("dim"),
                    F.round(F.col("vector")[0].cast("double"), 6).alias("first_value"))


@query("points_count", "SELECT CAST(label AS VARCHAR) AS type, count(*) AS points FROM embeddings GROUP BY 1")
def q_points_count(spark, sf):
    from ..operators.points import points_count
    return points_count(I.vector_points(spark, sf), by=["type"])


@query("point_upsert", """
  SELECT vec_id AS point_id, CASE WHEN label = 0 THEN 'zero' ELSE CAST(label AS VARCHAR) END AS type,
         CASE WHEN label = 0 THEN 'modified' WHEN label = 2 THEN 'same' ELSE 'kept' END AS _action FROM embeddings
  UNION ALL SELECT vec_id + 1000000, CAST(label AS VARCHAR), 'upserted' FROM embeddings WHERE label = 1""")
def q_point_upsert(spark, sf):
    from ..operators.points import upsert_points
    pts = I.vector_points(spark, sf)
    new = pts.where(F.col("type") == "0").withColumn("type", F.lit("zero")) \
        .unionByName(pts.where(F.col("type") == "1").withColumn("point_id", F.col("point_id") + 1000000)) \
        .unionByName(pts.where(F.col("type") == "2"))
    return upsert_points(pts, new).select("point_id", "type", "_action")


@query("vector_schema_check", """SELECT CAST(min(len(embedding)) AS INTEGER) AS batch_min_dim,
  CAST(max(len(embedding)) AS INTEGER) AS batch_max_dim,
  384 AS coll_dim, 'cosine' AS coll_distance, 'cosine' AS want_distance,
  CASE WHEN min(len(embedding)) <> max(len(embedding)) THEN 'error' WHEN max(len(embedding)) = 384 THEN 'ok' ELSE 'error' END AS decision
  FROM embeddings""")
def q_vector_schema_check(spark, sf):
    from ..operators.embed import resolve_dim
    from ..operators.points import check_vector_schema
    pts = I.vector_points(spark, sf)
    # The collection was created for a MiniLM model (V6: 384 dimensions).
    meta = spark.range(1).select(F.lit("documents").alias("name"), F.lit(resolve_dim("all-MiniLM-L6-v2")).alias("dim"),
                                 F.lit("cosine").alias("distance"))
    return check_vector_schema(pts, meta, "cos", "error").select(
        F.col("batch_min_dim").cast("int").alias("batch_min_dim"), F.col("batch_max_dim").cast("int").alias("batch_max_dim"),
        "coll_dim", "coll_distance", "want_distance", "decision")


# ================================================================== payloads, requests
@query("build_payload", f"""
  SELECT doc_id, 'documents' AS type, 1 AS embedding_version,
         CAST(CASE WHEN n = 0 THEN 0 WHEN n <= 1600 THEN 1 ELSE 1 + CAST(ceil((n - 1600) / 1520.0) AS BIGINT) END AS INTEGER) AS chunk_count,
         1600 AS chunk_size, 80 AS overlap
  FROM (SELECT doc_id, length(text) AS n FROM {DOC_TEXT_SQL})""")
def q_build_payload(spark, sf):
    from ..functions.payload import index_payload
    from ..functions.text import chunk_text
    d = I.doc_texts(spark, sf)
    p = index_payload("doc_id", I.DATASET_TYPE, I.EMBEDDING_VERSION,
                      F.size(chunk_text(F.col("text"), I.CHUNK_MAX, I.CHUNK_OVERLAP)), I.CHUNK_MAX, I.CHUNK_OVERLAP)
    return d.select(F.col("doc_id"), p.alias("p")).select(
        "doc_id", F.col("p.type").alias("type"), F.col("p.embeddingVersion").alias("embedding_version"),
        F.col("p.chunkCount").alias("chunk_count"), F.col("p.chunkSize").alias("chunk_size"), F.col("p.overlap").alias("overlap"))


CHUNKS_SQL = """(
    SELECT source AS request_id, CAST(doc_id AS VARCHAR) AS chunk_id, source AS item_sequence, lang AS name, text AS contents,
           lang AS meta_lang, 'text' AS content_type FROM documents
    UNION ALL
    SELECT 'pages', 'p' || CAST(page_id AS VARCHAR), url, 'page', html, NULL, 'html' FROM pages)"""


@query("payload_roundtrip", f"""SELECT chunk_id, item_sequence, name, CAST(length(contents) AS INTEGER) AS contents_len,
  meta_lang, content_type, CASE WHEN name IS NULL THEN 1 ELSE 0 END AS n_missing
  FROM (SELECT * REPLACE (nullif(name, 'es') AS name) FROM {CHUNKS_SQL})""")
def q_payload_roundtrip(spark, sf):
    from ..functions.payload import chunk_payload, resolve_chunk
    c = I.chunks(spark, sf).withColumn("name", F.nullif("name", F.lit("es")))
    r = c.select(resolve_chunk(chunk_payload("chunk_id", "item_sequence", "name", "contents", "meta")).alias("r")).select("r.*")
    return r.select("chunk_id", "item_sequence", "name", F.char_length("contents").alias("contents_len"),
                    F.col("meta")["lang"].alias("meta_lang"), F.col("meta")["content_type"].alias("content_type"),
                    F.size("_missing").alias("n_missing"))


@query("request_admission", f"""SELECT request_id, count(*) AS n_chunks, CAST(sum(strlen(contents)) AS BIGINT) AS n_bytes,
  CASE WHEN count(*) > 100 THEN 'too_many_chunks' WHEN sum(strlen(contents)) > 100000 THEN 'too_many_bytes' END AS reject_reason,
  count(*) <= 100 AND sum(strlen(contents)) <= 100000 AS accepted
  FROM {CHUNKS_SQL} GROUP BY 1""")
def q_request_admission(spark, sf):
    from ..operators.state import admit_requests
    # Limits of the embedding worker (fixed values): 100 chunks, 100,000 bytes.
    return admit_requests(I.chunks(spark, sf), max_items=100, max_bytes=100000)


# What senders leave out: documents in Spanish come without a name.
SENT_SQL = f"(SELECT chunk_id, request_id, nullif(name, 'es') AS name FROM {CHUNKS_SQL})"


@query("chunk_requests", f"SELECT chunk_id, request_id, name IS NOT NULL AS valid FROM {SENT_SQL}")
def q_chunk_requests(spark, sf):
    import uuid
    from ..session import checkpoint_dir
    from ..sources.chunks import read_chunk_requests, validate_chunks
    landing = checkpoint_dir(spark).rstrip("/") + f"/landing-{uuid.uuid4().hex}"
    sent = I.chunks(spark, sf).withColumn("name", F.nullif("name", F.lit("es")))
    sent.write.mode("overwrite").json(landing)
    return validate_chunks(read_chunk_requests(spark, landing)).select("chunk_id", "request_id", "valid")


# ================================================================== composed runs (Q1, Q2, Q3)
@query("ingest_pages", f"""WITH {REC_SQL}
  SELECT item_seq AS id, item_name AS name, entp_name AS vendor,
         md5(coalesce(entp_name, '') || '|' || coalesce(item_name, '') || '|' || item_seq) AS row_hash,
         CASE WHEN page_no % 3 = 0 THEN 'kept' ELSE 'upserted' END AS _action FROM rec""")
def q_ingest_pages(spark, sf):
    from ..plans.ingest import ingest_pages, page_records
    from ..session import FIXED_NOW
    from ..sources.pages import parse_records
    pages = I.json_pages(spark, sf)
    done = page_records(pages).join(I.ledger(spark, sf).select("api_name", "run_date", "page_no"),
                                    ["api_name", "run_date", "page_no"], "left_semi")
    items, _ = parse_records(done)  # what earlier runs stored
    res = ingest_pages(pages, I.ledger(spark, sf), items, FIXED_NOW)
    return res.items.select("id", "name", "vendor", "row_hash", "_action")


@query("ingest_ledger", f"""WITH {REC_SQL}
  SELECT DISTINCT page_no, CASE WHEN page_no % 3 = 0 THEN 'kept' ELSE 'upserted' END AS _action FROM rec""")
def q_ingest_ledger(spark, sf):
    from ..plans.ingest import ingest_pages, page_records
    from ..session import FIXED_NOW
    from ..sources.pages import parse_records
    pages = I.json_pages(spark, sf)
    done = page_records(pages).join(I.ledger(spark, sf).select("api_name", "run_date", "page_no"),
                                    ["api_name", "run_date", "page_no"], "left_semi")
    items, _ = parse_records(done)
    return ingest_pages(pages, I.ledger(spark, sf), items, FIXED_NOW).ledger.select("page_no", "_action")


def _index_run(spark, sf, granularity="document", embedder=None):
    from ..plans.index import index_documents
    from ..session import FIXED_NOW
    stored, st, ls = _doc_state(spark, sf)
    empty_points = spark.createDataFrame([], "point_id string, vector array<float>, type string, doc_id string, "
                                             "embedding_version int, chunk_count int, chunk_size int, overlap int")
    return index_documents(stored, st, ls, empty_points, None, version=I.EMBEDDING_VERSION, owner="indexer-1",
                           now=FIXED_NOW, page_size=I.INDEX_PAGE_SIZE, chunk_size=I.CHUNK_MAX,
                           overlap=I.CHUNK_OVERLAP, lease_seconds=I.LEASE_SECONDS, granularity=granularity,
                           embedder=embedder, prepare=I.canonical)


@query("index_documents", f"""WITH {DOC_STATE_SQL}, u AS ({uuid_sql(DOCS_SQL)})
  SELECT r.doc_id, pg.page_no, CASE WHEN status = 'embed' THEN 'embedded' ELSE status END AS status,
         CASE WHEN status = 'embed' THEN u.point_id END AS point_id
  FROM r LEFT JOIN pg USING (doc_id) LEFT JOIN u USING (doc_id)""")
def q_index_documents(spark, sf):
    return _index_run(spark, sf).status


@query("page_stats", f"""WITH {DOC_STATE_SQL}
  SELECT page_no, count(*) AS ids,
    count(*) FILTER (WHERE status IN ('empty_text', 'skipped_same_hash', 'embed')) AS leases_acquired,
    count(*) FILTER (WHERE status IN ('empty_text', 'skipped_same_hash', 'embed')) AS fetched,
    count(*) FILTER (WHERE status = 'empty_text') AS empty_text,
    count(*) FILTER (WHERE status = 'skipped_same_hash') AS skipped_same_hash,
    count(*) FILTER (WHERE status = 'embed') AS embedded, count(*) FILTER (WHERE status = 'embed') AS upserted,
    count(*) FILTER (WHERE status IN ('embed', 'empty_text', 'skipped_same_hash')) AS marked_indexed,
    CAST(0 AS BIGINT) AS marked_failed
  FROM r JOIN pg USING (doc_id) GROUP BY 1""")
def q_page_stats(spark, sf):
    return _index_run(spark, sf).page_stats


class _RefusesD:
    """A model of two components that fails for texts beginning with D."""

    def encode(self, texts):
        if any(t.startswith("D") for t in texts):
            raise ValueError("no D")
        return [[1.0, float(len(t))] for t in texts]


@query("page_stats_failures", f"""WITH {DOC_STATE_SQL}, x AS (SELECT *, status = 'embed' AND starts_with(text, 'D') AS failed FROM r)
  SELECT page_no, count(*) AS ids,
    count(*) FILTER (WHERE status IN ('empty_text', 'skipped_same_hash', 'embed')) AS leases_acquired,
    count(*) FILTER (WHERE status IN ('empty_text', 'skipped_same_hash', 'embed')) AS fetched,
    count(*) FILTER (WHERE status = 'empty_text') AS empty_text,
    count(*) FILTER (WHERE status = 'skipped_same_hash') AS skipped_same_hash,
    count(*) FILTER (WHERE status = 'embed' AND NOT failed) AS embedded, count(*) FILTER (WHERE status = 'embed' AND NOT failed) AS upserted,
    count(*) FILTER (WHERE status IN ('embed', 'empty_text', 'skipped_same_hash') AND NOT failed) AS marked_indexed,
    count(*) FILTER (WHERE failed) AS marked_failed
  FROM x JOIN pg USING (doc_id) GROUP BY 1""")
def q_page_stats_failures(spark, sf):
    """A3 of a run whose model fails for some documents."""
    from ..operators.embed import ArrowEmbedder
    return _index_run(spark, sf, embedder=ArrowEmbedder("refuses-d", _RefusesD)).page_stats


@query("index_commit", f"""WITH {DOC_STATE_SQL}, u AS ({uuid_sql(DOCS_SQL)})
  SELECT doc_id, coalesce(CASE WHEN status IN ('embed', 'empty_text', 'skipped_same_hash') THEN '1' ELSE embedding_version END, 'none') AS embedding_version,
    CASE WHEN status IN ('embed', 'empty_text', 'skipped_same_hash') THEN row_hash ELSE indexed_row_hash END AS indexed_row_hash,
    CASE WHEN status = 'embed' THEN u.point_id END AS point_id
  FROM r JOIN u USING (doc_id) WHERE has_state OR status IN ('embed', 'empty_text', 'skipped_same_hash')""")
def q_index_commit(spark, sf):
    """Q2 committed twice, the second time with nothing left to do: the state and the points that the batches hold."""
    import uuid
    from ..session import FIXED_NOW, checkpoint_dir
    from . import runs
    reg = runs.datasets(f"{checkpoint_dir(spark).rstrip('/')}/index-{uuid.uuid4().hex}")
    stored, st, ls = _doc_state(spark, sf)
    st = _stored(st, spark, "state")
    kw = dict(state=st, version=I.EMBEDDING_VERSION, owner="indexer-1", page_size=I.INDEX_PAGE_SIZE, prepare=I.canonical)
    first = runs.run_index(spark, reg, stored, ls, FIXED_NOW, 1, **kw)
    runs.run_index(spark, reg, stored, ls, FIXED_NOW, 2, meta=first.meta, **kw)
    now = runs.current(spark, reg, "state", runs.STATE)
    now = now.unionByName(st.join(now.select("doc_id"), "doc_id", "left_anti").select(*now.columns))
    pts = runs.current(spark, reg, "points", runs.POINTS).select(F.col("doc_id").cast("long").alias("doc_id"), "point_id")
    return now.join(pts, "doc_id", "left").select("doc_id", F.coalesce("embedding_version", F.lit("none")).alias("embedding_version"), "indexed_row_hash", "point_id")


@query("ingest_commit", f"""WITH {REC_SQL}
  SELECT item_seq AS id, item_name AS name, entp_name AS vendor,
         md5(coalesce(entp_name, '') || '|' || coalesce(item_name, '') || '|' || item_seq) AS row_hash FROM rec""")
def q_ingest_commit(spark, sf):
    """Q1 committed page by page order: half of the pages in the first batch, all in the second; the items that the batches hold."""
    import uuid
    from ..session import FIXED_NOW, checkpoint_dir
    from . import runs
    reg = runs.datasets(f"{checkpoint_dir(spark).rstrip('/')}/ingest-{uuid.uuid4().hex}")
    pages = I.json_pages(spark, sf)
    runs.run_ingest(spark, reg, pages.where(F.col("page_no") % 2 == 1), FIXED_NOW, 1)
    runs.run_ingest(spark, reg, pages, FIXED_NOW, 2)
    return runs.current(spark, reg, "items", runs.ITEMS).select("id", "name", "vendor", "row_hash")


@query("index_summary", f"""WITH {DOC_STATE_SQL},
  st2 AS (SELECT doc_id, CASE WHEN r.status IN ('embed', 'empty_text', 'skipped_same_hash') THEN '1' ELSE st.embedding_version END AS v,
                 CASE WHEN r.status IN ('embed', 'empty_text', 'skipped_same_hash') THEN r.row_hash ELSE st.indexed_row_hash END AS h,
                 st.doc_id IS NOT NULL OR r.status IN ('embed', 'empty_text', 'skipped_same_hash') AS has
          FROM r LEFT JOIN st USING (doc_id))
  SELECT 'documents' AS type, 1 AS embedding_version, (SELECT count(*) FROM r WHERE status = 'embed') AS points,
         count(*) AS documents, count(*) FILTER (WHERE v = '1') AS indexed_current,
         count(*) FILTER (WHERE NOT has OR v IS DISTINCT FROM '1' OR coalesce(dh.row_hash, '') <> coalesce(h, '')) AS needs_index
  FROM dh JOIN st2 USING (doc_id)""")
def q_index_summary(spark, sf):
    return _index_run(spark, sf).summary


@query("search", f"""WITH d AS {hashing_sql(DOC_TEXT_SQL, 'doc_id', 'text')},
  q AS {hashing_sql('benchmark', 'item_id', 'text')},
  s AS (SELECT q.item_id, d.doc_id, sum(q.value * d.value) AS score FROM q JOIN d USING (bucket) GROUP BY 1, 2),
  r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY round(score, 9) DESC, CAST(doc_id AS VARCHAR)) AS rn FROM s)
  SELECT r.item_id AS query_id, CAST(rn AS INTEGER) AS rank, round(score, 4) AS score, CAST(r.doc_id AS VARCHAR) AS chunk_id,
         documents.source AS item_sequence, documents.lang AS name
  FROM r JOIN documents USING (doc_id) WHERE rn <= 5""")
def q_search(spark, sf):
    from ..plans.search import chunk_points, search_chunks
    from ..session import checkpoint_dir
    checkpoint_dir(spark)
    d = I.doc_texts(spark, sf)
    chunks = d.select(F.col("doc_id").cast("string").alias("chunk_id"), F.col("source").alias("item_sequence"),
                      F.col("lang").alias("name"), F.col("text").alias("contents"),
                      F.create_map(F.lit("lang"), F.col("lang")).alias("meta"))
    # the points table, written once (a stored table in production)
    points = chunk_points(chunks).checkpoint(eager=True)
    hits = search_chunks(points, I.table(spark, sf, "benchmark"), k=5, query_id="item_id")
    return hits.select("query_id", "rank", F.round("score", 4).alias("score"), "chunk_id", "item_sequence", "name")


# ================================================================== streaming (ST1-ST5)
def _run_stream(spark, chunks, embedder=None):
    """(points, dead letters, the ended query) of the stream over ``chunks``.

    Each sender names its request's size; the chunks land in any order, so a
    request is spread over files. A quarter of the files per micro-batch."""
    import uuid
    from ..operators.state import small_side
    from ..session import checkpoint_dir
    from ..streaming.embed_stream import read_dead_letters, read_points, start_embed_stream
    base = checkpoint_dir(spark).rstrip("/") + f"/stream-{uuid.uuid4().hex}"
    several = chunks.groupBy("request_id").agg(F.count("*").alias("request_chunks")).where("request_chunks > 1").checkpoint(eager=True)
    sized = chunks.where("request_id is not null").join(small_side(several), "request_id", "left").fillna(1, "request_chunks")
    files = max(8, chunks.count() // I.CHUNKS_PER_FILE)
    sized.repartition(files, "chunk_id").write.json(base + "/landing")
    q = start_embed_stream(spark, base + "/landing", base + "/points", base + "/dead", base + "/ckpt", embedder=embedder,
                           max_files_per_trigger=-(-files // 4), max_items=I.REQUEST_ITEMS, max_bytes=I.REQUEST_BYTES)
    q.awaitTermination()
    return read_points(spark, base + "/points"), read_dead_letters(spark, base + "/dead"), q


ADMIT_SQL = f"""adm AS (SELECT request_id, CASE WHEN count(*) > 100 THEN 'too_many_chunks'
                 WHEN sum(strlen(contents)) > 100000 THEN 'too_many_bytes' END AS reason FROM {CHUNKS_SQL} GROUP BY 1)"""


@query("embed_stream", f"""WITH {ADMIT_SQL}
  SELECT c.chunk_id AS point_id, c.item_sequence, c.name, 1 AS embedding_version, 64 AS dim
  FROM {CHUNKS_SQL} c JOIN adm USING (request_id) WHERE adm.reason IS NULL""")
def q_embed_stream(spark, sf):
    return _stream_points(spark, I.chunks(spark, sf))


def _stream_points(spark, chunks):
    pts, _, _ = _run_stream(spark, chunks)
    p = F.from_json("payload", "itemSequence string, name string")
    return pts.select("point_id", p["itemSequence"].alias("item_sequence"), p["name"].alias("name"),
                      "embedding_version", F.size("vector").alias("dim"))


@query("dead_letter", f"""WITH {ADMIT_SQL}
  SELECT c.chunk_id, c.request_id, adm.reason FROM {CHUNKS_SQL} c JOIN adm USING (request_id) WHERE adm.reason IS NOT NULL""")
def q_dead_letter(spark, sf):
    _, dead, _ = _run_stream(spark, I.chunks(spark, sf))
    return dead.select("chunk_id", "request_id", "reason")


# The same stream over requests of bounded size: every chunk that fits a request by itself is embedded.
BLOCKS_SQL = f"""(SELECT CASE WHEN n > 100 OR bytes > 100000 THEN block || ':' || chunk_id ELSE block END AS request_id,
    chunk_id, item_sequence, name, contents FROM (
    SELECT *, count(*) OVER w AS n, sum(strlen(contents)) OVER w AS bytes FROM (
      SELECT *, CASE WHEN content_type = 'html' THEN 'pages:' || (CAST(substr(chunk_id, 2) AS BIGINT) // 20)
                ELSE request_id || ':' || (CAST(chunk_id AS BIGINT) // 200) END AS block FROM {CHUNKS_SQL})
    WINDOW w AS (PARTITION BY block)))"""
ADMIT_BLOCKS_SQL = f"""c AS {BLOCKS_SQL}, adm AS (SELECT request_id, CASE WHEN count(*) > 100 THEN 'too_many_chunks'
                 WHEN sum(strlen(contents)) > 100000 THEN 'too_many_bytes' END AS reason FROM c GROUP BY 1)"""


@query("embed_stream_blocks", f"""WITH {ADMIT_BLOCKS_SQL}
  SELECT c.chunk_id AS point_id, c.item_sequence, c.name, 1 AS embedding_version, 64 AS dim
  FROM c JOIN adm USING (request_id) WHERE adm.reason IS NULL""")
def q_embed_stream_blocks(spark, sf):
    return _stream_points(spark, I.block_chunks(spark, sf))


@query("dead_letter_blocks", f"""WITH {ADMIT_BLOCKS_SQL}
  SELECT c.chunk_id, c.request_id, adm.reason FROM c JOIN adm USING (request_id) WHERE adm.reason IS NOT NULL""")
def q_dead_letter_blocks(spark, sf):
    _, dead, _ = _run_stream(spark, I.block_chunks(spark, sf))
    return dead.select("chunk_id", "request_id", "reason")


class _RefusesFrench:
    """A model of two components that fails for texts of one language."""

    def encode(self, texts):
        if any(t.startswith("fr | ") for t in texts):
            raise ValueError("no French")
        return [[1.0, float(len(t))] for t in texts]


@query("dead_letter_failures", f"""WITH {ADMIT_BLOCKS_SQL}
  SELECT c.chunk_id, c.request_id, coalesce(adm.reason, 'embed_failed: ValueError: no French') AS reason
  FROM c JOIN adm USING (request_id) WHERE adm.reason IS NOT NULL OR name = 'fr'""")
def q_dead_letter_failures(spark, sf):
    """ST5: chunks that the model fails for are dead letters with its error; the others of their batch are embedded."""
    from ..operators.embed import ArrowEmbedder
    _, dead, _ = _run_stream(spark, I.block_chunks(spark, sf), ArrowEmbedder("refuses-french", _RefusesFrench))
    return dead.select("chunk_id", "request_id", "reason")


@query("stream_load", f"""SELECT CAST(count(*) AS BIGINT) AS input_rows, true AS several_batches, true AS usage_is_share
  FROM {CHUNKS_SQL}""")
def q_stream_load(spark, sf):
    """ST4 over the progress of the embedding stream: the rows of each
    micro-batch as a share of the largest, available below 0.7 of it."""
    from ..streaming.embed_stream import progress_rows, stream_load
    _, _, q = _run_stream(spark, I.block_chunks(spark, sf))
    sizes = progress_rows(spark, q).where("input_rows > 0").select(F.col("input_rows").alias("size"))
    load = stream_load(sizes.withColumn("max_size", F.lit(sizes.agg(F.max("size")).first()[0])), 0.7)
    return load.agg(F.sum("size").alias("input_rows"), (F.count("*") > 1).alias("several_batches"),
                    F.bool_and((F.col("usage") == F.col("size") / F.col("max_size")) & (F.col("available") == (F.col("size") < F.floor(F.col("max_size") * 0.7)))).alias("usage_is_share"))


@query("point_upsert_bucketed", """
  SELECT vec_id AS point_id, CASE WHEN label = 0 THEN 'zero' ELSE CAST(label AS VARCHAR) END AS type FROM embeddings
  UNION ALL SELECT vec_id + 1000000, CAST(label AS VARCHAR) FROM embeddings WHERE label = 1""")
def q_point_upsert_bucketed(spark, sf):
    import uuid
    from ..session import checkpoint_dir
    from ..sources.tables import upsert_bucketed
    base = checkpoint_dir(spark).rstrip("/") + f"/points-{uuid.uuid4().hex}"
    schema = "point_id long, vector array<float>, type string"
    pts = I.vector_points(spark, sf)
    # initial load, then an upsert that touches a subset of the 16 buckets
    upsert_bucketed(spark, base + "/table", pts, "point_id", 16, base + "/stage0", schema)
    new = pts.where(F.col("type") == "0").withColumn("type", F.lit("zero")) \
        .unionByName(pts.where(F.col("type") == "1").withColumn("point_id", F.col("point_id") + 1000000))
    upsert_bucketed(spark, base + "/table", new, "point_id", 16, base + "/stage1", schema)
    return spark.read.parquet(base + "/table").select("point_id", "type")


def _ivf(spark, sf, nlist=None):
    """(points with their list, written once; centroids; the searches)."""
    from ..operators.search import build_ivf
    from ..session import checkpoint_dir
    checkpoint_dir(spark)
    pts, centers = build_ivf(I.vector_points(spark, sf), nlist)
    # the posting lists: stored in list order
    pts = pts.repartition("cluster").sortWithinPartitions("cluster", "point_id").checkpoint(eager=True)
    return pts, centers, I.vector_searches(spark, sf)


@query("vector_topk_ivf")
def q_vector_topk_ivf(spark, sf):
    """Searches over the probed lists of an inverted file: a query meets the
    points of its lists only. The number of lists follows the row count, the
    number of probes is the least that finds 0.95 of a sample's exact hits.
    Approximate, so it has no SQL; ``vector_ivf_recall`` states its recall."""
    from ..operators.search import calibrate_nprobe, search_ivf
    pts, centers, qs = _ivf(spark, sf)
    hits = search_ivf(pts, centers, qs, k=5, nprobe=calibrate_nprobe(pts, centers, qs, k=5), payload_cols=["type"])
    return hits.select("query_id", "rank", "point_id", "type", F.round("score", 6).alias("score"))


@query("vector_topk_ivf_full", f"""SELECT query_id, rank, point_id, type, score FROM ({topk_sql(5)}) WHERE query_id % 20 = 0""")
def q_vector_topk_ivf_full(spark, sf):
    """All lists probed: equal to the exact search."""
    from ..operators.search import search_ivf
    pts, centers, qs = _ivf(spark, sf, nlist=8)
    hits = search_ivf(pts, centers, qs, k=5, nprobe=8, payload_cols=["type"])
    return hits.select("query_id", "rank", "point_id", "type", F.round("score", 6).alias("score"))


@query("vector_ivf_recall", """SELECT count(*) AS queries, CAST(count(*) * least(5, (SELECT count(*) FROM embeddings)) AS BIGINT) AS exact_hits,
  true AS recall_ok FROM embeddings WHERE vec_id % 20 = 0""")
def q_vector_ivf_recall(spark, sf):
    """Share of the exact hits of every search that the probed lists hold: recall_ok is recall >= 0.9."""
    from ..operators.search import calibrate_nprobe, search, search_ivf
    pts, centers, qs = _ivf(spark, sf)
    found = search_ivf(pts, centers, qs, k=5, nprobe=calibrate_nprobe(pts, centers, qs, k=5))
    exact = search(pts, qs, k=5)
    both = exact.select("query_id", "point_id").join(found.select("query_id", "point_id", F.lit(1).alias("hit")), ["query_id", "point_id"], "left")
    return both.agg(F.count_distinct("query_id").alias("queries"), F.count("*").alias("exact_hits"),
                    (F.count("hit") >= 0.9 * F.count("*")).alias("recall_ok"))


@query("paged_api_source", f"WITH {REC_SQL} SELECT page_no, record_idx, item_seq, item_name FROM rec")
def q_paged_api_source(spark, sf):
    """S8 end to end: pages land as files (one folder per page, written by
    Spark), the paged_api source reads them back in batches of 10 pages per
    partition (file transport: no socket), and S1 explodes them."""
    import uuid
    from ..session import checkpoint_dir
    from ..sources.paged_api import register
    from ..sources.pages import explode_json_pages
    register(spark)
    land = checkpoint_dir(spark).rstrip("/").replace("file:", "") + f"/api-{uuid.uuid4().hex}"
    pages = I.json_pages(spark, sf)
    pages.select("page_no", "body").write.partitionBy("page_no").text(land)
    n = pages.agg(F.max("page_no")).first()[0] or 0
    raw = spark.read.format("paged_api").options(transport="file", path=land, pages=f"1-{n}", batch_size="10",
                                                  api_name=I.API_NAME, run_date=I.RUN_DATE).load()
    r = explode_json_pages(raw)
    return r.select("page_no", "record_idx", F.variant_get("record", "$.ITEM_SEQ", "string").alias("item_seq"),
                    F.variant_get("record", "$.ITEM_NAME", "string").alias("item_name"))


@query("index_chunks", f"""WITH {DOC_STATE_SQL},
  e AS (SELECT r.doc_id, dh.text, length(dh.text) AS n FROM r JOIN dh USING (doc_id) WHERE r.status = 'embed'),
  k AS (SELECT doc_id, text, CASE WHEN n = 0 THEN 0 WHEN n <= 1600 THEN 1
        ELSE 1 + CAST(ceil((n - 1600) / 1520.0) AS BIGINT) END AS k FROM e),
  c AS (SELECT doc_id, CAST(i AS INTEGER) AS chunk_idx, k,
               left(sha256(CAST(doc_id AS VARCHAR) || '|' || substring(text, i * 1520 + 1, 1600)), 24) AS point_id
        FROM k, range(0, k) t(i))
  SELECT CAST(doc_id AS VARCHAR) AS doc_id, chunk_idx, point_id, CAST(k AS INTEGER) AS chunk_count FROM (
    SELECT *, row_number() OVER (PARTITION BY point_id ORDER BY chunk_idx DESC) AS rn FROM c) WHERE rn = 1""")
def q_index_chunks(spark, sf):
    """Q2 at chunk granularity: one point per window of each embedded document."""
    return _index_run(spark, sf, "chunk").points.select("doc_id", "chunk_idx", "point_id", "chunk_count")
