"""W1, W2, J4, L1, L3, A4 against Python on shuffled ids over several partitions."""
import random

from pyspark.sql import functions as F

from corpusflow.operators.ranking import (assign_pages, global_rank, ids_by_page, page_anchors, page_ranges,
                                          scroll, total_pages)


def _ids(spark, n=997, seed=5):
    ids = random.Random(seed).sample(range(10 * n), n)
    return ids, spark.createDataFrame([(i,) for i in ids], "id long").repartition(7)


def test_global_rank_is_sorted_position(spark):
    ids, df = _ids(spark)
    got = {r.id: r.rank for r in global_rank(df, "id", num_partitions=5).collect()}
    assert got == {v: i + 1 for i, v in enumerate(sorted(ids))}


def test_anchors_ranges_pages(spark):
    ids, df = _ids(spark)
    s = sorted(ids)
    size = 100
    anchors = sorted((r.page_no, r.start_id) for r in page_anchors(df, "id", size).collect())
    assert anchors == [(p + 1, s[p * size]) for p in range((len(s) + size - 1) // size)]
    ranges = sorted((r.page_no, r.start_id, r.end_id) for r in page_ranges(page_anchors(df, "id", size)).collect())
    exp = [(p + 1, a, (anchors[p + 1][1] if p + 1 < len(anchors) else None)) for p, (_, a) in enumerate(anchors)]
    assert ranges == exp
    pages = {r.id: r.page_no for r in assign_pages(df, "id", size).collect()}
    assert all(pages[v] == i // size + 1 for i, v in enumerate(s))


def test_paging_edges(spark):
    ids, df = _ids(spark, n=120)
    s = sorted(ids)
    assert [r.id for r in sorted(ids_by_page(df, "id", 3, 50).collect(), key=lambda r: r.rank)] == s[100:120]
    assert ids_by_page(df, "id", 0, 50).count() == 0 and ids_by_page(df, "id", 1, 0).count() == 0
    assert total_pages(df, 50).first().total_pages == 3 and total_pages(df, 0).first().total_pages == 0
    assert [r.id for r in scroll(df, "id", after=s[9], limit=5).collect()] == s[10:15]


def test_page_directory_is_a_pushed_range_scan(spark, tmp_path):
    from corpusflow.sources.scan import page_directory, read_page
    rows = [(i * 7 % 1009, "en" if i % 3 else "de", f"v{i}") for i in range(1, 1009)]
    spark.createDataFrame(rows, "id long, lang string, v string").repartition(4).write.parquet(f"{tmp_path}/t")
    df, en = spark.read.parquet(f"{tmp_path}/t"), F.col("lang") == "en"
    page_directory(df, "id", 50, en).write.parquet(f"{tmp_path}/d")
    directory = spark.read.parquet(f"{tmp_path}/d")
    ids = sorted(i for i, lang, _ in rows if lang == "en")
    for page in (1, 2, 7, 14):
        got = sorted((r.position, r.id) for r in read_page(df, directory, "id", page, 50, en, ["id"]).collect())
        assert got == [(k + 1, i) for k, i in enumerate(ids)][(page - 1) * 50:page * 50]
    assert read_page(df, directory, "id", 15, 50, en, ["id"]).collect() == [] == read_page(df, directory, "id", 0, 50, en, ["id"]).collect()
    plan = read_page(df, directory, "id", 2, 50, en, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id," in plan and "LessThan(id," in plan and "Exchange" not in plan and "Scan ExistingRDD" not in plan
