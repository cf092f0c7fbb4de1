"""Daily ingestion run (Q1): S3 -> S4 -> S1/S2 -> P1/P2 -> W3 -> J2 -> S5.

Pages are planned from the total the first page reports, pages already in
the ledger are skipped, records are parsed and validated, the last write per
key wins (page order, then record order), the batch is merged into the item
table, and only pages that produced records are marked (an empty page is
retried next run). Commit order: items first, ledger second, so a crash
re-does pages idempotently.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.payload import DEFAULT_SPEC, RecordSpec
from ..operators.merge import merge_counts, merge_upsert, null_key_rows
from ..session import checkpoint_dir
from ..sources.ledger import LEDGER_KEYS, mark_pages, pending_pages
from ..sources.pages import explode_json_pages, explode_xml_pages, map_to_variant, parse_records, plan_pages


@dataclass
class IngestResult:
    items: DataFrame        # merged item table with _action
    ledger: DataFrame       # new ledger with _action
    quarantine: DataFrame   # rejected records with a reason
    counts: DataFrame       # A6 totals


def page_records(raw_pages: DataFrame) -> DataFrame:
    """Records of raw pages of either format as (page key, record_idx, record VARIANT, total_count)."""
    js = explode_json_pages(raw_pages.where(F.col("format") == "json")) \
        .select(*LEDGER_KEYS, "record_idx", "record", "total_count")
    xm = explode_xml_pages(raw_pages.where(F.col("format") == "xml")) \
        .select(*LEDGER_KEYS, "record_idx", map_to_variant("record_map").alias("record"), "total_count")
    return js.unionByName(xm)


def page_totals(raw_pages: DataFrame) -> DataFrame:
    """(api_name, run_date, total_count) from the envelopes of first pages, whether or not they hold records."""
    first = raw_pages.where(F.col("page_no") == 1)
    js = explode_json_pages(first.where(F.col("format") == "json"), keep_empty=True)
    xm = explode_xml_pages(first.where(F.col("format") == "xml"), keep_empty=True)
    cols = ["api_name", "run_date", "total_count"]
    return js.select(*cols).unionByName(xm.select(*cols)).where("total_count is not null") \
        .groupBy("api_name", "run_date").agg(F.max("total_count").alias("total_count"))


def ingest_pages(raw_pages: DataFrame, ledger: DataFrame, items: DataFrame, now, *,
                 spec: RecordSpec = DEFAULT_SPEC, keys=("id",), page_size: int = 100,
                 batch_size: int = 100) -> IngestResult:
    plan = plan_pages(page_totals(raw_pages), page_size, batch_size)
    todo = pending_pages(plan, ledger)
    # Only pending pages are read as trees. Their records feed the item merge,
    # the page sizes of the ledger and the quarantine: exploded once.
    recs = page_records(raw_pages.join(todo.select(*LEDGER_KEYS), LEDGER_KEYS, "left_semi"))
    checkpoint_dir(raw_pages.sparkSession)
    recs = recs.checkpoint(eager=True)
    good, bad = parse_records(recs, spec, keep=(*LEDGER_KEYS, "record_idx"))
    upd = good.withColumn("_seq", F.struct("page_no", "record_idx"))
    merged = merge_upsert(items, upd.drop(*LEDGER_KEYS, "record_idx"), list(keys), "_seq")
    quarantine = bad.unionByName(
        null_key_rows(good, list(keys)).select(*LEDGER_KEYS, "record_idx", "reason"))
    sizes = good.groupBy(*LEDGER_KEYS).agg(F.count(F.lit(1)).cast("int").alias("processed_size"))
    ledger2 = mark_pages(ledger, todo.select(*LEDGER_KEYS).join(sizes, LEDGER_KEYS), now)
    return IngestResult(merged, ledger2, quarantine, merge_counts(merged))
