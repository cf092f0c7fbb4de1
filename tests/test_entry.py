"""Driver contract: entry() runs; every query has a callable; streaming equals batch."""
import __spark_entry__ as E
from conftest import SF


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["doc_id", "status"]


def test_oracles_have_queries():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 60


def test_stream_equals_batch(spark):
    from pyspark.sql import functions as F
    q = E.queries()
    stream = {r.point_id for r in q["embed_stream"](spark, SF).collect()}
    dead = {r.chunk_id for r in q["dead_letter"](spark, SF).collect()}
    adm = q["request_admission"](spark, SF).where(F.col("accepted")).select("request_id")
    from corpusflow.plans import inputs as I
    expected = {r.chunk_id for r in I.chunks(spark, SF).join(adm, "request_id").collect()}
    assert stream == expected and not (stream & dead)
