"""Processed-page ledger.

ledger(api_name, run_date, page_no INT, processed_size INT, processed_at TIMESTAMP_NTZ)
keyed by (api_name, run_date, page_no); stored partitioned by run_date so a
run reads one partition and retention drops whole partitions.
"""
from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import ts_lit
from ..operators.merge import merge_upsert

LEDGER_KEYS = ["api_name", "run_date", "page_no"]
LEDGER_COLS = LEDGER_KEYS + ["processed_size", "processed_at"]
RETENTION_DAYS = 90


def pending_pages(plan: DataFrame, ledger: DataFrame, keys=LEDGER_KEYS) -> DataFrame:
    """Planned pages not yet processed (S4): a left anti join on the page key.
    The ledger slice of a run (one run_date partition) is small; Spark
    broadcasts it when its size is under the broadcast threshold."""
    return plan.join(ledger.select(*keys), list(keys), "left_anti")


def mark_pages(ledger: DataFrame, done: DataFrame, now) -> DataFrame:
    """Upsert markers for processed pages (S5); size is an updated value.
    ``done`` has the key plus processed_size."""
    upd = done.select(*LEDGER_KEYS, F.coalesce(F.col("processed_size"), F.lit(0)).cast("int").alias("processed_size"),
                      (now if not isinstance(now, (_dt.datetime, str)) else ts_lit(now)).alias("processed_at"))
    return merge_upsert(ledger, upd, LEDGER_KEYS)


def unmark_pages(ledger: DataFrame, keys_df: DataFrame) -> DataFrame:
    """Ledger without the given page keys."""
    return ledger.join(keys_df.select(*LEDGER_KEYS), LEDGER_KEYS, "left_anti")


def expire_pages(ledger: DataFrame, now, days: int = RETENTION_DAYS) -> DataFrame:
    """Markers younger than ``days`` (S7): processed_at > now - days."""
    cutoff = F.timestamp_add("DAY", F.lit(-int(days)), now if not isinstance(now, (_dt.datetime, str)) else ts_lit(now))
    return ledger.where(F.col("processed_at") > cutoff)
