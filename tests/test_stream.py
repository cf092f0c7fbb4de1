"""ST1-ST5: replaying a micro-batch is harmless; progress feeds the load view."""
import tempfile
import uuid

from pyspark.sql import functions as F

from conftest import SF
from corpusflow.plans import inputs as I
from corpusflow.sources.chunks import REQUEST_SCHEMA
from corpusflow.streaming.embed_stream import (process_batch, progress_rows, read_dead_letters, read_held, read_points, start_embed_stream,
                                               stream_load)


def test_replayed_batch_is_idempotent(spark):
    base = tempfile.mkdtemp(prefix="cf-stream-")
    batch = I.chunks(spark, SF).where(F.col("request_id").isin("src1", "src2", "pages"))
    process_batch(batch, 0, points_path=base + "/p", dead_path=base + "/d", max_items=100, max_bytes=100000)
    first = sorted((r.point_id, tuple(r.vector)) for r in read_points(spark, base + "/p").collect())
    process_batch(batch, 0, points_path=base + "/p", dead_path=base + "/d", max_items=100, max_bytes=100000)
    again = sorted((r.point_id, tuple(r.vector)) for r in read_points(spark, base + "/p").collect())
    assert first == again and len(first) > 0


def test_progress_and_load(spark):
    base = tempfile.mkdtemp(prefix="cf-stream-")
    I.chunks(spark, SF).repartition(4, "request_id").write.json(base + "/in")
    q = start_embed_stream(spark, base + "/in", base + "/p", base + "/d", base + "/ck", max_files_per_trigger=1)
    q.awaitTermination()
    prog = progress_rows(spark, q)
    assert prog.count() >= 4 and prog.agg(F.sum("input_rows")).first()[0] == I.chunks(spark, SF).count()
    load = stream_load(prog.select(F.col("input_rows").alias("size"), F.lit(500).alias("max_size")), 0.7)
    assert set(load.columns) >= {"usage", "available"}


def test_blocks_embed_every_chunk_that_fits_a_request(spark):
    import __spark_entry__ as E
    every = {r.chunk_id: len((r.contents or "").encode()) for r in I.chunks(spark, "/root/testdata/sf0.01").collect()}
    got = [r.point_id for r in E.queries()["embed_stream_blocks"](spark, "/root/testdata/sf0.01").collect()]
    assert sorted(got) == sorted(c for c, n in every.items() if n <= 100000) and len(got) >= 1000


def test_only_chunks_over_the_limits_are_dead(spark, tmp_path):
    """A block over the limits is split, not rejected; many small ids make many requests."""
    import __spark_entry__ as E
    docs = [(i, "x " * (60_000 if i == 7 else 30_000 if i < 10 else 5), "en", "s") for i in range(450)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, f"u{k}", "<p>x</p>") for k in range(50)], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    q = E.queries()
    dead = [tuple(r) for r in q["dead_letter_blocks"](spark, str(tmp_path)).collect()]
    assert dead == [("7", "s:0:7", "too_many_bytes")]
    assert q["embed_stream_blocks"](spark, str(tmp_path)).count() == 450 + 50 - 1


def _requests(spark, rows):
    """(request_id, number, contents, request_chunks) as chunk requests."""
    return spark.createDataFrame([(r, f"{r}-{i}", "s", "n", c, {}, n) for r, i, c, n in rows], REQUEST_SCHEMA)


def _streamed(spark, tmp_path, *files, **kw):
    for rows in files:
        _requests(spark, rows).coalesce(1).write.json(f"{tmp_path}/in/{uuid.uuid4().hex}")
        q = start_embed_stream(spark, f"{tmp_path}/in/*", f"{tmp_path}/p", f"{tmp_path}/d", f"{tmp_path}/ck", max_files_per_trigger=1, max_items=100, max_bytes=1000, **kw)
        q.awaitTermination()
    return (sorted(r.point_id for r in read_points(spark, f"{tmp_path}/p").collect()),
            sorted((r.chunk_id, r.reason) for r in read_dead_letters(spark, f"{tmp_path}/d").collect()),
            sorted(r.chunk_id for r in read_held(spark, f"{tmp_path}/ck").collect()))


def test_a_split_request_has_one_verdict(spark, tmp_path):
    big = [("big", i, "x", 120) for i in range(120)]
    ok = [("ok", i, "x y", 60) for i in range(60)]
    one = _streamed(spark, tmp_path / "one", big + ok)
    two = _streamed(spark, tmp_path / "two", big[:60] + ok[:30], big[60:] + ok[30:])
    three = _streamed(spark, tmp_path / "three", ok[:1] + big[:1], ok[1:59] + big[1:119], big[119:] + ok[59:])
    assert one == two == three
    assert len(one[0]) == 60 and len(one[1]) == 120 and {r for _, r in one[1]} == {"too_many_chunks"} and one[2] == []


def test_chunks_are_held_until_their_request_is_whole(spark, tmp_path):
    first = [("a", 0, "x" * 400, 3), ("b", 0, "x" * 900, 2), ("c", 0, "x", None)]
    points, dead, held = _streamed(spark, tmp_path, first)
    assert points == ["c-0"] and dead == [] and held == ["a-0", "b-0"]
    points, dead, held = _streamed(spark, tmp_path, [("d", 0, "x", 1)], [("a", 1, "x" * 400, 3), ("b", 1, "x" * 200, 2)])
    assert points == ["c-0", "d-0"] and dead == [("b-0", "too_many_bytes"), ("b-1", "too_many_bytes")] and held == ["a-0", "a-1"]


def test_a_request_rejected_early_stays_rejected(spark, tmp_path):
    points, dead, held = _streamed(spark, tmp_path, [("a", 0, "x" * 1001, 3)], [("a", 1, "x", 3)], [("a", 2, "x", 3), ("b", 0, "y", 1)], [("a", 3, "new", 1)])
    assert [c for c, _ in dead] == ["a-0", "a-1", "a-2"] and held == []
    assert points == ["a-3", "b-0"]                       # all its chunks have come: the id may be used again


def test_failures_are_dead_letters_with_their_error(spark, tmp_path):
    from corpusflow.operators.embed import ArrowEmbedder

    class Model:
        def encode(self, texts):
            if any("boom" in t for t in texts):
                raise ValueError("bad " + "text " * 200)
            return [[1.0, len(t)] for t in texts]
    points, dead, _ = _streamed(spark, tmp_path, [("a", i, "boom" if i == 3 else "fine", 5) for i in range(5)], embedder=ArrowEmbedder("m", Model))
    assert points == ["a-0", "a-1", "a-2", "a-4"]
    assert dead == [("a-3", "embed_failed: ValueError: bad " + "text " * 200)]     # the whole error, the one row


def test_a_held_chunk_is_written_once(spark, tmp_path):
    points, dead, held = _streamed(spark, tmp_path, [("a", 0, "x", 4)], [("a", 1, "x", 4)], [("a", 2, "x", 4)], [("b", 0, "x", 2)], [("a", 3, "x", 4)])
    assert points == ["a-0", "a-1", "a-2", "a-3"] and dead == [] and held == ["b-0"]
    rows = spark.read.parquet(f"{tmp_path}/ck-held/chunks").groupBy("chunk_id").count().collect()
    assert {tuple(r) for r in rows} == {("a-0", 1), ("a-1", 1), ("a-2", 1), ("b-0", 1)}


def test_a_request_id_used_again_leaves_its_first_chunks_alone(spark, tmp_path):
    _streamed(spark, tmp_path, [("a", 0, "old", 2), ("b", 0, "x", 2)], [("a", 1, "old", 2)])
    points, _, held = _streamed(spark, tmp_path, [("a", 0, "new", 2)], [("a", 1, "new", 2), ("b", 1, "x", 2)])
    assert points == ["a-0", "a-1", "b-0", "b-1"] and held == []
    last = spark.read.parquet(f"{tmp_path}/p").where("batch = 3").select("point_id", F.get_json_object("payload", "$.contents").alias("c"))
    assert sorted(map(tuple, last.collect())) == [("a-0", "new"), ("a-1", "new"), ("b-0", "x"), ("b-1", "x")]


def test_a_repeated_id_is_one_point_and_the_other_chunks_stay(spark, tmp_path):
    rows = [(f"r{i}", "same" if i < 3 else f"c{i}", "s", "n", f"text {i}", {}, 1) for i in range(6)]
    batch = spark.createDataFrame(rows, REQUEST_SCHEMA)
    process_batch(batch, 0, points_path=f"{tmp_path}/p", dead_path=f"{tmp_path}/d")
    got = {r.point_id: r.payload for r in read_points(spark, f"{tmp_path}/p").collect()}
    assert sorted(got) == ["c3", "c4", "c5", "same"] and "text 2" in got["same"]
    assert spark.read.parquet(f"{tmp_path}/p").count() == 4 and read_dead_letters(spark, f"{tmp_path}/d").count() == 0


def test_blocks_are_marked_where_their_chunks_are(spark):
    assert "hashpartitioning" not in I.block_chunks(spark, SF)._jdf.queryExecution().executedPlan().toString()
