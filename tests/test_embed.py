"""V3/V4/V6 and A5: embedder plug-ins and pooling."""
import numpy as np
from pyspark.sql import functions as F

from corpusflow.operators.embed import (ArrowEmbedder, HashingEmbedder, mean_pool, resolve_dim, role_prefix)


def test_arrow_embedder_isolates_failures(spark):
    class _LenModel:
        """Test model: [len, vowels, 1]; raises for a batch holding 'boom'."""
        def encode(self, texts):
            import numpy as np
            if any("boom" in t for t in texts):
                raise ValueError("bad batch")
            return np.array([[len(t), sum(c in "aeiou" for c in t), 1.0] for t in texts])

    df = spark.createDataFrame([(i, "boom" if i == 70 else "abc" * (i % 5)) for i in range(100)], "k long, text string")
    out = {r.k: r for r in ArrowEmbedder("e5-small", _LenModel, batch_size=64).embed(df, ["k"], "text", "query").collect()}
    assert len(out) == 100
    bad = [k for k, r in out.items() if r.embed_error]
    assert bad and all(out[k].vector is None for k in bad) and 70 in bad
    good = out[1]
    v = np.array(good.vector)
    assert abs(np.linalg.norm(v) - 1) < 1e-5          # L2-normalized
    t = "query: abc"                                  # e5 prefix for the query role
    exp = np.array([len(t), sum(c in "aeiou" for c in t), 1.0])
    assert np.allclose(v, exp / np.linalg.norm(exp), atol=1e-6)


def test_prefix_and_dim_rules():
    assert role_prefix("intfloat/multilingual-e5-base", "passage") == "passage: "
    assert role_prefix("BAAI/bge-m3", "query") == ""
    assert resolve_dim("all-MiniLM-L6-v2") == 384 and resolve_dim("e5-large") == 1024
    assert resolve_dim("bge-base") == 768 and resolve_dim("custom") == 768 and resolve_dim("x", 12) == 12


def test_hashing_dense_equals_sparse(spark):
    df = spark.createDataFrame([(1, "a b a c"), (2, "Zeta zeta ETA"), (3, "   ")], "k long, text string")
    e = HashingEmbedder(dim=8)
    dense = {r.k: r.vector for r in e.embed(df, ["k"], "text").collect()}
    sparse = {}
    for r in e.embed_sparse(df, ["k"], "text").collect():
        sparse.setdefault(r.k, {})[r.bucket] = r.value
    assert set(dense) == {1, 2}                       # no tokens, no vector
    for k, v in dense.items():
        assert np.allclose(v, [sparse[k].get(i, 0.0) for i in range(8)], atol=1e-6)
    e7 = HashingEmbedder(dim=7)                       # non power of two: full base conversion
    assert len(e7.embed(df, ["k"], "text").first().vector) == 7


def test_mean_pool_mask(spark):
    df = spark.createDataFrame([("g", [1.0, 3.0], 1), ("g", [3.0, 5.0], 1), ("g", [100.0, 100.0], 0), ("h", [1.0, 1.0], 0)],
                               "g string, v array<double>, m int")
    got = {(r.g, r.pos): r.value for r in mean_pool(df, ["g"], "v", "m").collect()}
    assert got[("g", 0)] == 2.0 and got[("g", 1)] == 4.0 and got[("h", 0)] == 0.0


def test_only_the_token_window_is_embedded(spark):
    rows = [(1, " \t" + "a " * 511 + "b c"), (2, "a " * 511 + "b"), (3, "a\nb"), (4, None)]
    df = spark.createDataFrame(rows, "k long, text string")
    e = HashingEmbedder(dim=16)
    got = {r.k: r.vector for r in e.embed(df, ["k"], "text").collect()}
    assert got[1] == got[2] and set(got) == {1, 2, 3}        # the 513th token is cut off
    short = {r.k: r.vector for r in HashingEmbedder(dim=16, max_tokens=1).embed(df, ["k"], "text").collect()}
    assert short[3] == short[1] != got[3]
    with_role = HashingEmbedder(dim=16, model_name="e5-small", max_tokens=2).embed(df.where("k = 3"), ["k"], "text").first().vector
    assert with_role == HashingEmbedder(dim=16).embed(spark.createDataFrame([(3, "passage: a")], "k long, text string"), ["k"], "text").first().vector


def test_counting_needs_no_exchange(spark):
    df = spark.range(10).select(F.col("id").alias("k"), F.lit("a b a").alias("text"))
    for out in (HashingEmbedder().embed(df, ["k"], "text"), HashingEmbedder().embed_sparse(df, ["k"], "text")):
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_model_sees_the_window_and_only_bad_rows_fail(spark):
    class Words:
        def encode(self, texts):
            if any("boom" in t for t in texts):
                raise ValueError("bad")
            return [[len(t.split()), 1.0] for t in texts]
    df = spark.createDataFrame([(i, "boom" if i == 7 else "w " * (600 if i == 3 else 2)) for i in range(20)], "k long, text string")
    out = {r.k: r for r in ArrowEmbedder("words", Words, normalize=False, max_length=512).embed(df, ["k"], "text").collect()}
    assert out[3].vector[0] == 512 and out[4].vector[0] == 2
    assert [k for k, r in out.items() if r.embed_error] == [7] and out[7].embed_error == "ValueError: bad"


def test_mean_vectors_moves_one_row_a_task(spark):
    from corpusflow.operators.embed import mean_vectors
    df = spark.createDataFrame([("g", [1.0, 3.0], 1), ("g", [3.0, None], 1), ("g", None, 1), ("g", [9.0, 9.0], None), ("h", [1.0], 1)], "g string, v array<double>, m int")
    got = mean_vectors(df, ["g"], "v", "m")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert {r.g: r.vector for r in got.collect()} == {"g": [2.0, 1.5], "h": [1.0, 0.0]}
    assert "Generate" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_a_text_is_worked_out_once(spark):
    df = spark.range(10).select(F.col("id").alias("k"), F.upper(F.concat(F.lit("a b "), F.col("id").cast("string"))).alias("text"))
    for out in (HashingEmbedder().embed(df, ["k"], "text"), HashingEmbedder().embed_sparse(df, ["k"], "text")):
        assert out._jdf.queryExecution().executedPlan().toString().count("upper(") == 1


def test_counts_of_any_dimension(spark):
    import hashlib
    words = [f"Word{i % 97}" for i in range(400)]
    df = spark.createDataFrame([(1, " ".join(words))], "k long, text string")
    for dim in (7, 64, 100, 256):
        want = np.zeros(dim)
        for w in words:
            want[int(hashlib.md5(w.lower().encode()).hexdigest()[:8], 16) % dim] += 1
        assert np.allclose(HashingEmbedder(dim=dim).embed(df, ["k"], "text").first().vector, want / np.linalg.norm(want), atol=1e-6)
