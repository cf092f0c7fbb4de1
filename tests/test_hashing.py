import hashlib
import uuid

from pyspark.sql import functions as F

from corpusflow.functions import hashing as H


def test_point_id_matches_uuid5(spark):
    ids = ["1", "abc", "한국어-문서", "doc with space"]
    df = spark.createDataFrame([(i,) for i in ids], "d string")
    got = [r.p for r in df.select(H.point_id("d", 3).alias("p")).collect()]
    assert got == [str(uuid.uuid5(uuid.NAMESPACE_URL, f"doc:{i}|v3")) for i in ids]


def test_row_hash_rule(spark):
    rec = {"ITEM_SEQ": "7", "ITEM_NAME": None, "ZZ": "extra", "contentHash": "x", "content_hash": "y", "A": ""}
    df = spark.createDataFrame([(rec,)], "m map<string,string>")
    # Values by key: A "", ITEM_NAME null, ITEM_SEQ "7", ZZ "extra"; hashes are left out.
    assert df.select(H.row_hash("m").alias("h")).first().h == hashlib.md5(b"||7|extra").hexdigest()


def test_chunk_and_item_ids(spark):
    df = spark.createDataFrame([("d1", "chunk é", "201707337", "test")], "d string, c string, s string, n string")
    r = df.select(H.chunk_id("d", "c").alias("c"), H.item_hash_id("s", "n").alias("i"),
                  H.text_hash(F.col("c")).alias("t")).first()
    assert r.c == hashlib.sha256("d1|chunk é".encode()).hexdigest()[:24]
    assert r.i == hashlib.md5(b"201707337-test").hexdigest()
    assert r.t == hashlib.sha1("chunk é".encode()).hexdigest()


from hypothesis import given, settings, strategies as st  # noqa: E402

_keys = st.sampled_from(["ITEM_SEQ", "ITEM_NAME", "ENTP_NAME", "content_hash", "contentHash", "Z", "a", "가"])


@settings(max_examples=30, deadline=None)
@given(st.lists(st.dictionaries(_keys, st.one_of(st.none(), st.text(max_size=6)), max_size=6), min_size=1, max_size=6))
def test_row_hash_property(spark, recs):
    """Order of keys, excluded keys and null instead of empty make no difference; another value does."""
    hashes = ("content_hash", "contentHash")
    forms = [lambda r: r, lambda r: dict(reversed(r.items())), lambda r: {k: v for k, v in r.items() if k not in hashes} | {hashes[0]: "q"},
             lambda r: {k: v or None for k, v in r.items()}, lambda r: r | {"a": (r.get("a") or "") + "!"}]
    df = spark.createDataFrame([(i, k, f(r)) for i, r in enumerate(recs) for k, f in enumerate(forms)], "i int, k int, m map<string,string>")
    got = {(r.i, r.k): r.h for r in df.select("i", "k", H.row_hash("m").alias("h")).collect()}
    for i in range(len(recs)):
        assert got[i, 0] == got[i, 1] == got[i, 2] == got[i, 3] != got[i, 4]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(min_size=1, max_size=12), min_size=1, max_size=8))
def test_point_id_property(spark, ids):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(ids)], "i int, d string")
    got = {r.i: r.p for r in df.select("i", H.point_id("d", 1).alias("p")).collect()}
    assert all(got[i] == str(uuid.uuid5(uuid.NAMESPACE_URL, f"doc:{d}|v1")) for i, d in enumerate(ids))
