"""S8 source, and idempotence of the composed runs (Q1, Q2)."""
import json
import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF
from corpusflow.plans import inputs as I
from corpusflow.session import FIXED_NOW


def test_paged_api_file_transport(spark):
    from corpusflow.sources.paged_api import register
    register(spark)
    d = tempfile.mkdtemp(prefix="cf-pages-")
    for p in range(1, 26):
        with open(os.path.join(d, f"{p}.json"), "w") as f:
            json.dump({"body": {"items": [{"ITEM_SEQ": str(p)}], "totalCount": 25}}, f)
    df = spark.read.format("paged_api").options(transport="file", path=d, pages="1-25", batch_size="10",
                                                 api_name="items", run_date="2024-01-31").load()
    assert df.rdd.getNumPartitions() == 3
    rows = df.collect()
    assert sorted(r.page_no for r in rows) == list(range(1, 26))
    assert all(r.format == "json" and r.api_name == "items" for r in rows)


def test_ingest_twice_changes_nothing(spark):
    from corpusflow.plans.ingest import ingest_pages
    pages = I.json_pages(spark, SF)
    empty_items = spark.createDataFrame([], "id string, name string, vendor string, row_hash string")
    empty_ledger = spark.createDataFrame([], "api_name string, run_date string, page_no int, processed_size int, "
                                             "processed_at timestamp_ntz")
    first = ingest_pages(pages, empty_ledger, empty_items, FIXED_NOW)
    items1 = first.items.drop("_action").checkpoint()
    ledger1 = first.ledger.drop("_action").checkpoint()
    assert items1.count() == I.table(spark, SF, "part").count()
    second = ingest_pages(pages, ledger1, items1, FIXED_NOW)
    assert {r._action for r in second.items.collect()} == {"kept"}       # every page already done
    assert {r._action for r in second.ledger.collect()} == {"kept"}
    # replaying the same pages without the ledger is harmless too
    third = ingest_pages(pages, empty_ledger, items1, FIXED_NOW)
    assert {r._action for r in third.items.collect()} == {"same"}


def test_index_run_then_nothing_left(spark):
    from corpusflow.plans.index import index_documents
    d = I.doc_texts(spark, SF).checkpoint()
    st = I.index_state(spark, SF, d)
    ls = spark.createDataFrame([], "doc_id long, owner string, expires_at timestamp_ntz, heartbeat_at timestamp_ntz")
    pts = spark.createDataFrame([], "point_id string, vector array<float>, type string, doc_id string, "
                                    "embedding_version int, chunk_count int, chunk_size int, overlap int")
    r1 = index_documents(d, st, ls, pts, None, version=1, owner="o", now=FIXED_NOW)
    st1, pts1, ls1 = r1.state.checkpoint(), r1.points.checkpoint(), r1.leases.checkpoint()
    assert ls1.count() == 0                                              # every lease released
    s1 = {r.status for r in r1.status.collect()}
    assert s1 <= {"up_to_date", "embedded", "empty_text"}
    r2 = index_documents(d, st1, ls1, pts1, r1.meta, version=1, owner="o", now=FIXED_NOW)
    assert {r.status for r in r2.status.collect()} == {"up_to_date"}
    assert r2.points.count() == pts1.count() == r1.status.where(F.col("status") == "embedded").count()
    summ = r2.summary.first()
    assert summ.needs_index == 0 and summ.indexed_current == summ.documents


def test_registry():
    import pytest
    from corpusflow.sources.registry import Dataset, Registry
    reg = Registry([Dataset("items", "/data/items", keys=("id",))])
    assert reg.resolve("items").keys == ("id",)
    with pytest.raises(KeyError):
        reg.resolve("nope")


def test_registry_warns_on_missing_keys(spark):
    import warnings
    from corpusflow.sources.registry import Dataset, Registry
    reg = Registry([Dataset("items", "/data/items", keys=("id", "region"))])
    df = spark.createDataFrame([("1",)], "id string")
    with warnings.catch_warnings(record=True) as w:
        warnings.simplefilter("always")
        assert reg.check("items", df) == ["region"]
    assert any("region" in str(x.message) for x in w)


def test_chunk_granularity_replaces_windows(spark):
    from corpusflow.functions.hashing import text_hash
    from corpusflow.plans.index import index_documents
    def docs(texts):
        df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
        return df.withColumn("text_hash", text_hash(F.col("text")))
    state = spark.createDataFrame([], "doc_id long, embedding_version string, indexed_hash string, indexed_at timestamp_ntz, "
                                      "last_error string, last_error_at timestamp_ntz")
    ls = spark.createDataFrame([], "doc_id long, owner string, expires_at timestamp_ntz, heartbeat_at timestamp_ntz")
    pts = spark.createDataFrame([], "point_id string, vector array<float>, type string, doc_id string, "
                                    "embedding_version int, chunk_count int, chunk_size int, overlap int")
    kw = dict(version=1, owner="o", now=FIXED_NOW, chunk_size=10, overlap=2, granularity="chunk")
    r1 = index_documents(docs({1: "alpha beta gamma delta epsilon", 2: "short"}), state, ls, pts, None, **kw)
    p1 = r1.points.checkpoint()
    assert sorted(r.chunk_idx for r in p1.where("doc_id = '1'").collect()) == [0, 1, 2, 3]
    r2 = index_documents(docs({1: "alpha beta gamma", 2: "short"}), r1.state.checkpoint(), r1.leases, p1, r1.meta, **kw)
    p2 = {(r.doc_id, r.chunk_idx) for r in r2.points.collect()}
    assert p2 == {("1", 0), ("1", 1), ("2", 0)}       # doc 1 re-embedded: 2 windows, old ones gone
    assert {r.status for r in r2.status.collect()} == {"embedded", "up_to_date"}


def test_request_params(spark):
    from corpusflow.sources.paged_api import request_plan
    plan = spark.createDataFrame([(1,), (2,)], "page_no int")
    js = {r.page_no: r.params for r in request_plan(plan, 100, "json", {"numOfRows": "7", "q": "x"},
                                                     service_key="abcdefghij").collect()}
    assert js[1] == {"serviceKey": "abcde...hij", "type": "json", "pageNo": "1", "numOfRows": "7", "q": "x"}
    xm = request_plan(plan, 100, "xml", None, service_key=None).first().params
    assert "type" not in xm and xm["serviceKey"] == "***MASKED***"


def _stop_at(monkeypatch, name):
    """A commit that stops before it writes the table ``name``."""
    from corpusflow.plans import runs
    write = runs._write

    def stopped(registry, table, rows, batch):
        if table == name:
            raise RuntimeError("stopped")
        write(registry, table, rows, batch)
    monkeypatch.setattr(runs, "_write", stopped)


def test_ingestion_stopped_between_items_and_marks(spark, tmp_path, monkeypatch):
    import pytest
    from corpusflow.plans import runs
    pages = I.json_pages(spark, SF)
    reg, whole = runs.datasets(f"file://{tmp_path}/a"), runs.datasets(f"file://{tmp_path}/b")

    def tables(r):
        return (sorted(map(tuple, runs.current(spark, r, "items", runs.ITEMS).collect())),
                sorted(map(tuple, runs.current(spark, r, "ledger", runs.LEDGER).collect())))
    runs.run_ingest(spark, whole, pages, FIXED_NOW, 1)
    with monkeypatch.context() as m:
        _stop_at(m, "ledger")
        with pytest.raises(RuntimeError, match="stopped"):
            runs.run_ingest(spark, reg, pages, FIXED_NOW, 1)
    items, marks = tables(reg)
    assert items == tables(whole)[0] and items and not marks          # data without marks, never the other way
    runs.run_ingest(spark, reg, pages, FIXED_NOW, 1)                   # the same batch again
    assert tables(reg) == tables(whole) and tables(reg)[1]
    later = runs.run_ingest(spark, reg, pages, FIXED_NOW, 2)           # nothing is left to do
    assert tables(reg) == tables(whole) and {r._action for r in later.items.collect()} == {"kept"}


def test_ingestion_resumed_by_a_later_batch_only_sets_the_marks(spark, tmp_path, monkeypatch):
    import pytest
    from corpusflow.plans import runs
    from corpusflow.sources.tables import read_batches
    pages, reg = I.json_pages(spark, SF), runs.datasets(f"file://{tmp_path}")
    with monkeypatch.context() as m:
        _stop_at(m, "ledger")
        with pytest.raises(RuntimeError):
            runs.run_ingest(spark, reg, pages, FIXED_NOW, 1)
    runs.run_ingest(spark, reg, pages, FIXED_NOW, 2)
    batches = {r.batch: r["count"] for r in read_batches(spark, f"file://{tmp_path}/items", runs.ITEMS).groupBy("batch").count().collect()}
    assert batches == {1: 200}
    assert runs.current(spark, reg, "ledger", runs.LEDGER).count() == 2


def test_indexing_stopped_between_points_and_state(spark, tmp_path, monkeypatch):
    import pytest
    from corpusflow.plans import runs
    stored = I.stored_documents(spark, SF)
    ls = spark.createDataFrame([], "doc_id long, owner string, expires_at timestamp_ntz, heartbeat_at timestamp_ntz")
    st = spark.createDataFrame(I.index_state(spark, SF, I.canonical(stored), stored).collect(), runs.STATE)
    reg, whole = runs.datasets(f"file://{tmp_path}/a"), runs.datasets(f"file://{tmp_path}/b")
    kw = dict(state=st, version=1, owner="o", prepare=I.canonical)

    def tables(r):
        pts = runs.current(spark, r, "points", runs.POINTS).select("point_id", "doc_id", "vector").collect()
        return sorted(map(str, pts)), sorted(map(str, runs.current(spark, r, "state", runs.STATE).collect()))
    first = runs.run_index(spark, whole, stored, ls, FIXED_NOW, 1, **kw)
    assert {r.status for r in first.status.collect()} == {"up_to_date", "skipped_same_hash", "empty_text", "embedded"}
    with monkeypatch.context() as m:
        _stop_at(m, "state")
        with pytest.raises(RuntimeError, match="stopped"):
            runs.run_index(spark, reg, stored, ls, FIXED_NOW, 1, **kw)
    pts, marks = tables(reg)
    assert pts == tables(whole)[0] and pts and not marks
    runs.run_index(spark, reg, stored, ls, FIXED_NOW, 1, **kw)
    assert tables(reg) == tables(whole) and tables(reg)[1]
    again = runs.run_index(spark, reg, stored, ls, FIXED_NOW, 2, meta=first.meta, **kw)
    assert {r.status for r in again.status.collect()} == {"up_to_date"} and tables(reg) == tables(whole)


def test_candidate_scan_reads_no_text(spark):
    import __spark_entry__ as E
    plan = E.queries()["index_candidates"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    read = [line.split("ReadSchema: ")[1] for line in plan.splitlines() if "FileScan" in line]
    assert "struct<doc_id:bigint,row_hash:string>" in read and not any("text" in r for r in read)


def test_summary_has_a_row_without_points(spark):
    from corpusflow.operators.points import index_summary
    docs = spark.createDataFrame([(1, "h")], "doc_id long, text_hash string")
    st = spark.createDataFrame([], "doc_id long, embedding_version string, indexed_hash string")
    pts = spark.createDataFrame([], "type string, embedding_version int")
    assert [tuple(r) for r in index_summary(docs, st, pts, 1).collect()] == [("documents", 1, 0, 1, 0, 1)]
