"""T1-T6 and F1/F2 on small tables, one lease expiring exactly now."""
import datetime as dt

from corpusflow.functions.predicates import needs_index
from corpusflow.operators import state as S

NOW = dt.datetime(2024, 1, 31)


def leases(spark):
    return spark.createDataFrame([
        (1, "w0", NOW, NOW), (2, "w0", NOW - dt.timedelta(seconds=5), NOW), (3, "w1", NOW + dt.timedelta(seconds=60), NOW),
        (4, "w2", NOW + dt.timedelta(seconds=60), NOW), (5, "w1", None, NOW)],
        "doc_id long, owner string, expires_at timestamp_ntz, heartbeat_at timestamp_ntz")


def test_release_stale_and_acquire(spark):
    ls = leases(spark)
    assert sorted(r.doc_id for r in S.release_stale(ls, NOW).collect()) == [3, 4, 5]  # null expiry is held
    assert S.stale_count(ls, NOW).first().released == 2
    cand = spark.createDataFrame([(i,) for i in range(1, 8)], "doc_id long")
    new = {r.doc_id: r.owner for r in S.acquire(cand, ls, "me", NOW, 300).collect()}
    assert new == {1: "me", 2: "me", 3: "w1", 4: "w2", 5: "w1", 6: "me", 7: "me"}


def test_heartbeat_release(spark):
    ls = leases(spark)
    ids = spark.createDataFrame([(3,), (4,)], "doc_id long")
    hb = {r.doc_id: r.expires_at for r in S.heartbeat(ls, ids, "w1", NOW, 300).collect()}
    assert hb[3] == NOW + dt.timedelta(seconds=300) and hb[4] == NOW + dt.timedelta(seconds=60)
    rel = sorted(r.doc_id for r in S.release(ls, ids, "w1").collect())
    assert rel == [1, 2, 4, 5]
    assert sorted(r.doc_id for r in S.release(S.release(ls, ids, "w1"), ids, "w1").collect()) == rel


def test_mark_indexed_and_failed(spark):
    st = spark.createDataFrame([(1, "0", "h", NOW, "old", NOW)],
                               "doc_id long, embedding_version string, indexed_hash string, indexed_at timestamp_ntz, "
                               "last_error string, last_error_at timestamp_ntz")
    done = spark.createDataFrame([(1, None), (2, "h2")], "doc_id long, text_hash string")
    m = {r.doc_id: r for r in S.mark_indexed(st, done, 1, NOW).collect()}
    assert (m[1].embedding_version, m[1].indexed_hash, m[1].last_error) == ("1", "", "old")
    assert m[2]._action == "upserted"
    failed = spark.createDataFrame([(3, "boom", "w1"), (4, "boom", "w1"), (1, None, None)],
                                   "doc_id long, reason string, owner string")
    st2, ls2 = S.mark_failed(st, failed, leases(spark), NOW)
    f = {r.doc_id: r for r in st2.collect()}
    assert f[3].last_error == "boom" and 4 not in f          # w1 does not hold doc 4
    assert f[1].last_error == "old"                            # no reason: previous text kept
    assert sorted(r.doc_id for r in ls2.collect()) == [2, 4, 5]


def test_needs_index_combinations(spark):
    rows = [(1, False, None, "h", None), (2, True, "1", "h", "h"), (3, True, "2", "h", "h"),
            (4, True, "1", "h", "x"), (5, True, "1", "h", None), (6, True, "1", None, None), (7, True, None, "h", "h")]
    df = spark.createDataFrame(rows, "doc_id int, has_state boolean, embedding_version string, text_hash string, indexed_hash string")
    got = {r.doc_id: r.n for r in df.select("doc_id", needs_index(1).alias("n")).collect()}
    assert got == {1: True, 2: False, 3: True, 4: True, 5: True, 6: False, 7: True}


STATE = "doc_id long, embedding_version string, indexed_hash string, indexed_row_hash string, indexed_at timestamp_ntz, last_error string, last_error_at timestamp_ntz"


def test_two_hashes_choose_candidates_and_skip_known_texts(spark):
    st = spark.createDataFrame([(1, "1", "t1", "r1", NOW, None, None), (2, "1", "t2", "old", NOW, None, None), (3, "1", "old", "old", NOW, None, None),
                                (4, "0", "t4", "r4", NOW, None, None), (5, "1", "", "", NOW, None, None), (7, "1", "t7", "old", NOW, None, None)], STATE)
    stored = spark.createDataFrame([(i, f"r{i}") for i in range(1, 9)], "doc_id long, row_hash string")
    held = spark.createDataFrame([(7, "w1", NOW + dt.timedelta(seconds=9), NOW)], "doc_id long, owner string, expires_at timestamp_ntz, heartbeat_at timestamp_ntz")
    found = S.candidates(stored, st, held, 1, NOW)
    got = {r.doc_id: r.status for r in found.collect()}
    assert got == {1: "up_to_date", 2: "claimed", 3: "claimed", 4: "claimed", 5: "claimed", 6: "claimed", 7: "leased", 8: "claimed"}
    texts = spark.createDataFrame([(i, f"t{i}", i == 8) for i in (2, 3, 4, 5, 6, 8)], "doc_id long, text_hash string, blank boolean")
    got = {r.doc_id: r.status for r in S.settle(found, texts, 1).collect()}
    assert got == {1: "up_to_date", 2: "skipped_same_hash", 3: "embed", 4: "embed", 5: "embed", 6: "embed", 7: "leased", 8: "empty_text"}


def test_successes_and_failures_in_one_pass(spark):
    old = dt.datetime(2024, 1, 1)
    st = spark.createDataFrame([(1, "0", "h", "r", old, "e1", old), (2, "1", "h", "r", old, None, None), (9, "1", "h", "r", old, None, None)], STATE)
    ls = spark.createDataFrame([(1, "me", NOW, NOW), (2, "me", NOW, NOW), (3, "other", NOW, NOW), (4, "me", NOW, NOW)],
                               "doc_id long, owner string, expires_at timestamp_ntz, heartbeat_at timestamp_ntz")
    done = spark.createDataFrame([(1, None, "r1"), (5, "t5", None)], "doc_id long, text_hash string, row_hash string")
    bad = spark.createDataFrame([(2, "boom", "me"), (3, "boom", "me"), (4, None, "me")], "doc_id long, reason string, owner string")
    got = {r.doc_id: tuple(r)[1:] for r in S.mark_results(st, done, bad, ls, 1, NOW).collect()}
    assert got == {1: ("1", "", "r1", NOW, "e1", old), 5: ("1", "t5", "", NOW, None, None),
                   2: ("1", "h", "r", old, "boom", NOW), 4: (None, None, None, None, None, NOW)}     # 3 is held by another, 9 is untouched
