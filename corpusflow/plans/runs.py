"""Committed runs of ingestion (Q1) and indexing (Q2).

Each run reads the tables as the batches before its own left them, and writes
what it changed as one batch a table, data before marks: items, then the page
ledger; points, then the index state. A stop in between leaves data without
marks. The same batch run again reads the same earlier tables and writes the
same rows; a later run finds the data there, changes nothing in it and sets the
marks. Tables are found by name in a :class:`Registry` (S13).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import tables
from ..sources.ledger import LEDGER_KEYS
from ..sources.registry import Dataset, Registry
from .index import IndexResult, index_documents
from .ingest import IngestResult, ingest_pages

ITEMS = "id string, name string, vendor string, row_hash string"
LEDGER = "api_name string, run_date string, page_no int, processed_size int, processed_at timestamp_ntz"
POINTS = ("point_id string, vector array<float>, type string, doc_id string, embedding_version int, chunk_count int, "
          "chunk_size int, overlap int, deleted boolean")
STATE = ("doc_id long, embedding_version string, indexed_hash string, indexed_row_hash string, indexed_at timestamp_ntz, "
         "last_error string, last_error_at timestamp_ntz")


def datasets(base: str) -> Registry:
    """The tables of the runs below one folder, with their keys."""
    at = lambda name, keys: Dataset(name, f"{base.rstrip('/')}/{name}", keys)
    return Registry([at("items", ("id",)), at("ledger", tuple(LEDGER_KEYS)), at("points", ("point_id",)), at("state", ("doc_id",))])


def current(spark: SparkSession, registry: Registry, name: str, schema: str, before: int | None = None) -> DataFrame:
    d = registry.resolve(name)
    return tables.current(spark, d.path, schema, d.keys, before)


def _write(registry: Registry, name: str, rows: DataFrame, batch: int) -> None:
    registry.check(name, rows)
    tables.write_batch(rows, registry.resolve(name).path, batch)


def _changed(merged: DataFrame) -> DataFrame:
    return merged.where(F.col("_action").isin("upserted", "modified")).drop("_action")


def run_ingest(spark: SparkSession, registry: Registry, raw_pages: DataFrame, now, batch: int, **kw) -> IngestResult:
    """Ingest pages and commit: the changed items, then the marks of their pages."""
    items = current(spark, registry, "items", ITEMS, batch)
    ledger = current(spark, registry, "ledger", LEDGER, batch)
    res = ingest_pages(raw_pages, ledger, items, now, keys=registry.resolve("items").keys, **kw)
    _write(registry, "items", _changed(res.items), batch)
    _write(registry, "ledger", _changed(res.ledger), batch)
    return res


def run_index(spark: SparkSession, registry: Registry, docs: DataFrame, leases: DataFrame, now, batch: int, *,
              state: DataFrame | None = None, meta: DataFrame | None = None, **kw) -> IndexResult:
    """Index documents and commit: new points and the marks of removed ones,
    then the state rows that changed. ``state`` is the state that the first
    batch starts from."""
    points = current(spark, registry, "points", POINTS, batch)
    known = current(spark, registry, "state", STATE, batch)
    if state is not None:
        known = known.unionByName(state.join(known.select("doc_id"), "doc_id", "left_anti").select(*known.columns))
    res = index_documents(docs, known, leases, points, meta, now=now, **kw)
    removed = points.join(res.points.select("point_id"), "point_id", "left_anti").withColumn("deleted", F.lit(True))
    _write(registry, "points", res.new_points.withColumn("deleted", F.lit(False)).unionByName(removed, allowMissingColumns=True), batch)
    _write(registry, "state", res.new_state, batch)
    return res
