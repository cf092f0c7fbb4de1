"""S1-S3 and P1 with the FIXTURES edge rows."""
import pytest
from pyspark.sql import functions as F

from corpusflow.sources.pages import (ColumnParser, FunctionParser, explode_json_pages, explode_xml_pages, map_to_variant, parse_records,
                                      plan_pages)


def _pages(spark, bodies, fmt="json"):
    return spark.createDataFrame([("api", "2024-01-31", i + 1, fmt, b) for i, b in enumerate(bodies)],
                                 "api_name string, run_date string, page_no int, format string, body string")


def test_json_shapes(spark):
    bodies = ['{"header": {}}', '{"body": {"items": null}}', '{"body": {"items": [{"a": "1"}, {"a": "2"}], "totalCount": 2}}',
              '{"body": {"items": {"item": [{"a": "3"}]}}}', '{"body": {"items": {"item": {"a": "4"}}}}', '{not json']
    out = explode_json_pages(_pages(spark, bodies)).select("page_no", "shape_status", "total_count",
                                                          F.variant_get("record", "$.a", "string").alias("a")).collect()
    by = {}
    for r in out:
        by.setdefault(r.page_no, []).append((r.shape_status, r.a))
    assert 1 not in by and 2 not in by              # missing path, null items: no records
    assert by[3] == [("list", "1"), ("list", "2")]
    assert by[4] == [("item_list", "3")]
    assert by[5] == [("unexpected", None)]          # single object under item: none, flagged
    assert by[6] == [("malformed", None)]


def test_xml_pages(spark):
    good = ("<response><body><items><item><ITEM_SEQ>1</ITEM_SEQ><X><Y>n</Y></X></item>"
            "<item><ITEM_SEQ>2</ITEM_SEQ></item></items><totalCount></totalCount></body></response>")
    out = explode_xml_pages(_pages(spark, [good, "<response><body><items"], "xml")).collect()
    assert [r.record_map["ITEM_SEQ"] for r in out] == ["1", "2"]
    assert all(r.total_count is None for r in out)   # empty totalCount -> null
    assert all(r.page_no == 1 for r in out)          # malformed page: no records


def test_page_plan(spark):
    totals = spark.createDataFrame([("a", "0"), ("b", "1"), ("c", "100"), ("d", "101"), ("e", "250"), ("f", "-3")],
                                   "api_name string, total_count string")
    plan = plan_pages(totals, page_size=100, batch_size=2)
    got = {r.api_name: r.n for r in plan.groupBy("api_name").agg(F.count("*").alias("n")).collect()}
    assert got == {"b": 1, "c": 1, "d": 2, "e": 3}
    e = sorted((r.page_no, r.batch_no) for r in plan.where("api_name = 'e'").collect())
    assert e == [(1, 0), (2, 0), (3, 1)]
    bad = spark.createDataFrame([("x", "lots")], "api_name string, total_count string")
    with pytest.raises(Exception):
        plan_pages(bad).collect()


def test_parse_records(spark):
    bodies = ['{"body": {"items": [{"ITEM_SEQ": "1", "ITEM_NAME": "n1", "ENTP_NAME": "v1", "EXTRA": "e"},'
              ' {"ITEM_NAME": "no id"}, {"ITEM_SEQ": 5}, {"id": "7", "name": "by field"}, {"ITEM_SEQ": null},'
              ' {"ITEM_SEQ": "9", "ITEM_NAME": null, "contentHash": "zzz"}]}}']
    good, bad = parse_records(explode_json_pages(_pages(spark, bodies)), keep=("record_idx",))
    g = {r.id: r for r in good.collect()}
    assert set(g) == {"1", "7", "9"}
    assert g["7"].name == "by field" and g["9"].name is None
    import hashlib
    assert g["1"].row_hash == hashlib.md5("v1|e|n1|1".encode()).hexdigest()
    assert g["9"].row_hash == hashlib.md5("|9".encode()).hexdigest()
    reasons = {r.record_idx: r.reason for r in bad.collect()}
    assert reasons == {1: "id:missing", 2: "id:not_string", 4: "id:missing"}


def test_xml_records_parse(spark):
    body = "<response><body><items><item><ITEM_SEQ>3</ITEM_SEQ><ENTP_NAME>v</ENTP_NAME></item></items></body></response>"
    r = explode_xml_pages(_pages(spark, [body], "xml")).withColumn("record", map_to_variant("record_map"))
    good, bad = parse_records(r)
    assert [(x.id, x.vendor) for x in good.collect()] == [("3", "v")] and bad.count() == 0


def test_custom_paths(spark):
    body = '{"response": {"data": {"rows": [{"ITEM_SEQ": "1"}, {"ITEM_SEQ": "2"}]}, "meta": {"n": 2}}}'
    out = explode_json_pages(_pages(spark, [body]), records_path=("response", "data", "rows"),
                             total_path=("response", "meta", "n")).collect()
    assert [r.record_idx for r in out] == [0, 1] and {r.total_count for r in out} == {"2"}


def test_payload_resolution(spark):
    from corpusflow.functions.payload import resolve_chunk
    df = spark.createDataFrame([('{"docId": "a", "itemSequence": "s", "name": "n"}',),
                                ('{"docId": "b", "contents": "x", "meta": {"k": "v"}}',), ("not json",)], "p string")
    got = [r.c for r in df.select(resolve_chunk("p").alias("c")).collect()]
    assert (got[0].contents, got[0].meta, got[0]._missing) == ("", {}, [])
    assert got[1]._missing == ["itemSequence", "name"] and got[1].meta == {"k": "v"}
    assert got[2]._missing


def test_xml_nested_duplicate_and_other_roots(spark):
    page = ("<answer><body><items><item><a>1</a><b><c>n</c></b><d>lead<e>x</e>tail</d><f/><g at='1'>007</g><a>2</a><h>&lt;i&gt;</h></item>"
            "<other/><item/></items><totalCount> 2 </totalCount></body></answer>")
    out = explode_xml_pages(_pages(spark, [page, "", None, "<a>&x;</a>"], "xml"), keep_empty=True).collect()
    rows = [r for r in out if r.page_no == 1]
    assert rows[0].record_map == {"a": "2", "b": None, "d": "lead", "f": None, "g": "007", "h": "<i>"}
    assert rows[1].record_map == {} and {r.total_count for r in rows} == {"2"}
    assert [(r.page_no, r.record_map, r.total_count) for r in out if r.page_no > 1] == [(2, None, None), (3, None, None), (4, None, None)]


def _records(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "i int, body string").select("i", F.parse_json("body").alias("record"))


def test_user_parser_collects_skips_and_survives_errors(spark):
    def all_of(rec):
        return {"y": rec["x"]}

    def odd(rec):
        return None if rec["x"] % 2 == 0 else {"y": rec["x"]}

    def strict(rec):
        if rec["x"] == "bad":
            raise ValueError("boom")
        return {"y": rec["x"]}

    plain = _records(spark, ['{"x": 1}', '{"x": 2}', '{"x": 3}'])
    good, bad = parse_records(plain, FunctionParser(all_of, "y long"))
    assert sorted(r.y for r in good.collect()) == [1, 2, 3] and bad.count() == 0
    good, bad = parse_records(plain, FunctionParser(odd, "y long"), keep=["i"])
    assert sorted((r.i, r.y) for r in good.collect()) == [(0, 1), (2, 3)] and bad.count() == 0
    good, bad = parse_records(_records(spark, ['{"x": 1}', '{"x": "bad"}', '{"x": 3}', '{"x": "no number"}', "{}"]), FunctionParser(strict, "y long"), keep=["i"])
    assert sorted((r.i, r.y) for r in good.collect()) == [(0, 1), (2, 3)]
    reasons = {r.i: r.reason for r in bad.collect()}
    assert reasons[1] == "ValueError: boom" and reasons[4] == "KeyError: 'x'" and "no number" in reasons[3] and len(reasons) == 3


def test_user_parser_of_columns(spark):
    x = lambda r: F.try_variant_get(r, "$.x", "long")
    parser = ColumnParser({"y": x}, skip=lambda r: x(r) % 2 == 0, error=lambda r: F.when(x(r).isNull(), F.lit("no x")))
    good, bad = parse_records(_records(spark, ['{"x": 1}', '{"x": 2}', '{"x": "bad"}', "{}"]), parser, keep=["i"])
    assert [(r.i, r.y) for r in good.collect()] == [(0, 1)]
    assert sorted((r.i, r.reason) for r in bad.collect()) == [(2, "no x"), (3, "no x")]


def test_default_parser_gives_the_example_record(spark):
    good, _ = parse_records(_records(spark, ['{"ITEM_SEQ": "123", "ITEM_NAME": "Foo", "ENTP_NAME": "Bar"}']))
    assert [(r.id, r.name, r.vendor) for r in good.collect()] == [("123", "Foo", "Bar")]


def test_xml_pages_reach_python_a_few_at_a_time(spark):
    """An Arrow batch holds thousands of pages of many records each; pickled batches hold 100 rows."""
    item = "<item><ITEM_SEQ>1</ITEM_SEQ><ITEM_NAME>a</ITEM_NAME></item>"
    out = explode_xml_pages(_pages(spark, [f"<response><body><items>{item * 50}</items></body></response>"] * 250, "xml"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" in plan
    assert out.count() == 12_500 and {tuple(r.record_map.items()) for r in out.collect()} == {(("ITEM_SEQ", "1"), ("ITEM_NAME", "a"))}
