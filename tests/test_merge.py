"""J2 / W3 with the FIXTURES edge rows."""
from corpusflow.operators.merge import dedup_latest, merge_counts, merge_upsert, null_key_rows


def test_merge_upsert_edges(spark):
    target = spark.createDataFrame([("A", "a", "x", 1), ("B", "b", "y", 2), ("C", "c", "z", 3)],
                                   "id string, name string, vendor string, extra int")
    batch = spark.createDataFrame([("A", "a2", "x", 1), ("A", "a1", "x", 0),      # duplicate: seq 1 wins
                                   ("B", "b", None, 1),                            # explicit null overwrites
                                   ("C", "c", "z", 1),                             # identical: same
                                   ("D", "d", None, 1), (None, "n", "v", 1)],      # insert; null key left out
                                  "id string, name string, vendor string, seq int")
    m = {r.id: r for r in merge_upsert(target, batch, ["id"], "seq").collect()}
    assert (m["A"].name, m["A"]._action, m["A"].extra) == ("a2", "modified", 1)
    assert (m["B"].vendor, m["B"]._action) == (None, "modified")
    assert m["C"]._action == "same"
    assert (m["D"]._action, m["D"].extra) == ("upserted", None)
    assert None not in m
    c = merge_counts(merge_upsert(target, batch, ["id"], "seq")).first()
    assert (c.upserted, c.modified, c.same, c.written) == (1, 2, 1, 3)
    assert null_key_rows(batch, ["id"]).count() == 1


def test_merge_is_idempotent(spark):
    target = spark.createDataFrame([("A", "a")], "id string, name string")
    batch = spark.createDataFrame([("A", "b"), ("B", "c")], "id string, name string")
    once = merge_upsert(target, batch, ["id"]).drop("_action")
    twice = merge_upsert(once, batch, ["id"])
    assert {r._action for r in twice.collect()} == {"same"}


def test_dedup_latest_hot_key(spark):
    rows = [("hot", i, f"v{i}") for i in range(3000)] + [("k", 1, "only")]
    df = spark.createDataFrame(rows, "id string, seq int, v string")
    got = {r.id: (r.seq, r.v) for r in dedup_latest(df, ["id"], "seq").collect()}
    assert got == {"hot": (2999, "v2999"), "k": (1, "only")}


def test_merge_paths_agree(spark):
    target = spark.createDataFrame([(str(i), f"n{i}", i % 3) for i in range(200)], "id string, name string, x int")
    batch = spark.createDataFrame([(str(i), f"m{i}" if i % 2 else f"n{i}", i) for i in range(150, 260)] + [("5", None, 0)],
                                  "id string, name string, seq int")
    small = sorted(tuple(r) for r in merge_upsert(target, batch, ["id"], "seq").collect())
    big = sorted(tuple(r) for r in merge_upsert(target, batch, ["id"], "seq", max_broadcast_keys=0).collect())
    assert small == big and len(small) == 260


def test_repeated_ids_without_an_order_are_one_row_and_replay_changes_nothing(spark):
    from corpusflow.operators.merge import merge_upsert
    target = spark.createDataFrame([("a", 1)], "id string, v int")
    batch = spark.createDataFrame([("b", 1), ("b", 2), ("a", 5)], "id string, v int")
    once = merge_upsert(target, batch, ["id"]).select("id", "v")
    again = merge_upsert(once, batch, ["id"]).select("id", "v")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, again.collect())) == [("a", 5), ("b", 2)]


def test_repeated_chunk_id_is_one_point_with_one_vector(spark):
    from corpusflow.plans.search import chunk_points
    row = lambda i, t: (i, "s", "n", t, {"lang": "en"})
    schema = "chunk_id string, item_sequence string, name string, contents string, meta map<string,string>"
    two = chunk_points(spark.createDataFrame([row("1", "alpha beta"), row("1", "gamma")], schema)).collect()
    one = chunk_points(spark.createDataFrame([row("1", "gamma")], schema)).collect()
    assert len(two) == 1 and two[0]["vector"] == one[0]["vector"]


def test_empty_first_page_keeps_its_total(spark):
    from corpusflow.plans.ingest import page_totals
    rows = [("j", "d", 1, "json", '{"body":{"items":[],"totalCount":250}}'), ("j", "d", 2, "json", '{"body":{"items":[{"a":"1"}],"totalCount":250}}'),
            ("x", "d", 1, "xml", "<response><body><items></items><totalCount>7</totalCount></body></response>")]
    got = page_totals(spark.createDataFrame(rows, "api_name string, run_date string, page_no int, format string, body string")).collect()
    assert {r["api_name"]: r["total_count"] for r in got} == {"j": "250", "x": "7"}


def test_small_batch_scans_the_target_once_and_its_keys(spark, tmp_path):
    spark.createDataFrame([(str(i), f"n{i}", i) for i in range(50)], "id string, name string, x int").write.parquet(f"{tmp_path}/t")
    target = spark.read.parquet(f"{tmp_path}/t")
    batch = spark.createDataFrame([("3", "new"), ("99", "more")], "id string, name string")
    m = merge_upsert(target, batch, ["id"])
    scans = [line.split("ReadSchema: ")[1] for line in m._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line]
    assert sorted(scans) == ["struct<id:string,name:string,x:int>", "struct<id:string>"]
    got = {r.id: (r.name, r.x, r._action) for r in m.collect()}
    assert len(got) == 51 and got["3"] == ("new", 3, "modified") and got["99"] == ("more", None, "upserted") and got["4"] == ("n4", 4, "kept")
