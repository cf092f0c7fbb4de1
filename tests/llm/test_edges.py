"""Cases that once gave wrong or undefined results, one small test each."""
import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpusflow.llm import chat_template, decontam, jaccard_join, language_id, mixing, sharding, token_output, toxicity
from corpusflow.llm.queries import tokenizer_path

RND = random.Random(3)
VOCAB = ["".join(RND.choice("abcdefghij") for _ in range(RND.randint(2, 7))) for _ in range(300)]


def prose(n):
    return " ".join(RND.choice(VOCAB) for _ in range(n))


def test_shard_columns_are_replaced_in_any_case(spark):
    df = spark.createDataFrame([(1, "old", 7, "kept"), (None, "old", 8, "kept")], "doc_id long, shard string, Slot int, other string")
    got = sharding.place(df, "doc_id", ["a", "b", "c"], 7)
    assert got.columns == ["doc_id", "other", "slot", "shard"]
    assert {r.shard for r in got.collect()} <= {"a", "b", "c"} and all(0 <= r.slot < 7 and r.other == "kept" for r in got.collect())
    by_old = sharding.place(df, "shard", ["a", "b", "c"], 7).collect()       # the replaced column may be the key
    assert by_old[0].shard == by_old[1].shard
    assert sharding.place(df.limit(0), "doc_id", ["a"], 7).collect() == []


def test_an_item_with_two_texts_matches_once_by_its_best(spark):
    a, b = prose(30), prose(12)
    docs = spark.createDataFrame([(1, f"{prose(5)} {a} {prose(3)} {b}"), (2, b), (3, a), (4, "one two three")], "doc_id long, text string")
    items = spark.createDataFrame([(7, a), (7, b), (7, a), (8, "two three"), (8, "nothing here"), (None, b)], "item_id long, text string")
    for block in (10, 1_000_000):
        got = sorted(((r.doc_id, r.item_id, r.n_item_shingles, r.containment) for r in decontam.contaminated(docs, items, block_shingles=block).collect()), key=str)
        assert got == sorted([(1, 7, 26, 1.0), (1, None, 8, 1.0), (2, 7, 8, 1.0), (2, None, 8, 1.0), (3, 7, 26, 1.0), (4, 8, 1, 1.0)], key=str)


def test_repeated_ids_do_not_multiply_the_toxicity_sample(spark):
    docs = spark.createDataFrame([(i % 4, prose(8) + (" vile" if i % 4 < 2 else "")) for i in range(2000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 2)) for i in range(4)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, per_class=2)
    assert len(model.index.ids) <= 4


def test_languages_are_learned_from_rows_without_ids(spark):
    rows = [(None, " ".join(RND.choices(["the", "and", "of", "that"] if i % 2 else ["der", "und", "nicht", "sch"], k=6)) + f" x{i}", "en" if i % 2 else "de") for i in range(4000)]
    rows += [(5, "the and of that", "en")] * 3000
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    langs, protos = language_id.learn(docs, per_lang=50)
    assert langs == ["de", "en"]
    got = language_id.predict(spark.createDataFrame([(1, "the and that"), (2, "der und nicht")], "doc_id long, text string"), (langs, protos)).collect()
    assert {r.doc_id: r.lang_pred for r in got} == {1: "en", 2: "de"}


def test_repeated_rows_give_the_mix_all_its_words(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g", "s", 13)] * 1000 + [(2, "x y z", "t", 5)] * 7, "doc_id long, text string, source string, n_chars long").repartition(5)
    planned = {r.source: r.w for r in mixing.mix_plan(docs).groupBy("source").agg(F.sum("taken").alias("w")).collect()}
    mixed = mixing.mixed_documents(docs).collect()
    words = {}
    for r in mixed:
        words[r.source] = words.get(r.source, 0) + len(r.text.split())
    assert words == {k: v for k, v in planned.items() if v}


def test_deep_templates_are_template_errors():
    for source in ("{{ " + "(" * 3000 + "1" + ")" * 3000 + " }}", "{{ " + " + ".join(["1"] * 3000) + " }}", "{{ " + "not " * 3000 + "x }}",
                   "{% if x %}" * 3000 + "{% endif %}" * 3000, "{{ " + "x[" * 50 + "0" + "]" * 50 + " }}"):
        with pytest.raises(chat_template.TemplateError, match="nested|symbols"):
            chat_template.compile_template(source)
    assert "".join(chat_template.compile_template("{{ " + "(" * 30 + "1" + ")" * 30 + " }}")()) == "1"


def test_the_least_id_is_not_null(spark, tmp_path):
    least = -(1 << 63)
    docs = spark.createDataFrame([(None, "a b"), (least, "a b"), (3, None), (least, "c")], "doc_id long, text string").repartition(2)
    got = token_output.token_records(docs, tokenizer_path(), f"{tmp_path}/out").orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, least, least, 3]
    assert got[0].ids_crc32 == got[1].ids_crc32 and got[0].n_tokens == got[1].n_tokens


def test_pieces_met_again_survive_a_full_cache(monkeypatch):
    monkeypatch.setattr(token_output, "CHUNK_CACHE", 40)
    enc = token_output.Encoder(tokenizer_path(), "<u2")
    texts = [" ".join([RND.choice(VOCAB[:5]), *RND.choices(VOCAB, k=30)]) + "!" for _ in range(60)]
    assert [enc(t) for t in texts] == [enc._bytes(t) for t in texts]
    assert len(enc.known) <= 40 + 31 and enc.old


def test_frequent_tokens_of_a_chunk_are_counted(spark, monkeypatch):
    import numpy as np
    import pyarrow as pa
    texts = [prose(3) + " a b c d e" for _ in range(5)] + ["p q r s t"] * 2 + [""]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array([t.encode() for t in texts], pa.binary())], ["doc_id", "text"])
    got = pa.Table.from_batches(jaccard_join._describe([batch])).to_pylist()
    found = {r["token"]: r["docs"] for r in got if r["docs"] is not None}
    all_ = np.concatenate([jaccard_join.shingles(jaccard_join.word_ids(t.encode())) for t in texts])
    tokens, counts = np.unique(all_, return_counts=True)
    assert found == {int(t): int(c) for t, c in zip(tokens.view(np.int64), counts) if c >= jaccard_join.HOT_IN_CHUNK} and 5 in found.values()


def _stage_input(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, key string, digest string, component_id string, __n int")


def test_pipeline_stages_keep_columns_of_any_name(spark):
    text = prose(60)
    rows = [(i, prose(60), "en", "s", 1, f"key{i}", f"d{i}", "c", i) for i in range(6)]
    rows += [(10, text, "en", "s", 1, "k10", "d", "c", 1), (11, text, "en", "s", 1, "k11", "d", "c", 1), (None, text, "en", "s", 1, "kn", "d", "c", 1)]
    other = prose(60)
    rows += [(20, other, "en", s, 1, "k20", "d", "c", 1) for s in ("b", "a", "c")] + [(21, "", "en", "s", 1, "k", "d", "c", 1)]
    docs = _stage_input(spark, rows).repartition(3)
    kept = corpus_pipeline.one_of_each_group(spark, docs, "")
    assert kept.columns == docs.columns
    got = sorted((tuple(r) for r in kept.collect()), key=str)
    want = [r for r in rows if r[0] is not None and r[0] not in (11,) and (r[0] != 20 or r[3] == "a")]
    assert got == sorted(want, key=str)


def test_pipeline_stages_of_an_empty_table(spark, tmp_path):
    empty = _stage_input(spark, [])
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    empty.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, empty, str(tmp_path))
        assert out.columns == empty.columns and out.collect() == [], name
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_later_micro_batches_meet_earlier_state_through_the_query(spark, tmp_path, monkeypatch):
    from corpusflow.llm import queries, stream_dedup
    rows = [(i, f"text {i % 7}" + " " * (i % 3)) for i in range(60)] + [(100, None), (3, "text 3")]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(8).write.parquet(f"{tmp_path}/documents.parquet")
    epochs = []
    state = stream_dedup.stream_state

    def watched(spark_, path, check, out, *a):
        got = state(spark_, path, check, out, *a)
        epochs.append(spark_.read.parquet(out).select("epoch").distinct().count())
        return got
    monkeypatch.setattr(stream_dedup, "stream_state", watched)
    whole = sorted(map(tuple, queries.op2_stream_dedup(spark, str(tmp_path)).collect()))
    monkeypatch.setattr(stream_dedup, "TRIGGER_BYTES", 1)
    assert sorted(map(tuple, queries.op2_stream_dedup(spark, str(tmp_path)).collect())) == whole
    assert epochs == [1, 8] and len(whole) == 62


def test_linked_lines_pass_the_filter_of_counts(spark):
    from corpusflow.llm import line_dedup
    rnd = random.Random(9)
    rows = []
    for n in (20, 60, 300, 5000):
        for k in range(60):
            a = "".join(rnd.choice("abcdefgh xyz\u00e9\u65e5\U0001f600") if k % 3 else "a" for _ in range(n))
            b = list(a)
            for _ in range(rnd.randint(0, 2)):
                at, what = rnd.randrange(len(b)), rnd.randrange(3)
                b[at:at + (what != 0)] = [rnd.choice("abz\u00e9")] * (what != 1)
            assert line_dedup.within(a, "".join(b), 2)
            rows.append((line_dedup.counts_of(a), line_dedup.counts_of("".join(b))))
    rows = [(i, x, y) for i, (x, y) in enumerate(rows)] + [(-1, line_dedup.counts_of("a" * 30), line_dedup.counts_of("a" * 25))]
    df = spark.createDataFrame(rows, "i int, a long, b long").selectExpr("i", "struct(a as counts, true as entry, true as probe) as x", "struct(b as counts, true as entry, true as probe) as y")
    assert [r.i for r in df.where(f"not ({line_dedup._meet(2)})").collect()] == [-1]
