"""The pipeline's stages, each on what the one before kept, against brute force on sf0.001."""
import zlib
from collections import Counter

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from corpusflow.llm.common import saved, table
from corpusflow.llm.queries import tokenizer_path
from test_operators import brute_components, edited, prose, shingle_set

SF = "/root/testdata/sf0.001"


def test_pipeline_stages(spark):
    docs = table(spark, SF, "documents")
    after = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after.append(saved(stage(spark, after[-1], SF), f"test-{name}"))
        assert after[-1].columns == docs.columns
    rows = [[(r["doc_id"], r["text"]) for r in d.select("doc_id", "text").collect()] for d in after]
    toxic = {r["doc_id"] for r in table(spark, SF, "labels").where("toxic = 1").collect()}
    clean = {r["doc_id"] for r in table(spark, SF, "labels").where("toxic = 0").collect()}
    scored = {i for i, _ in rows[1]}
    assert len(clean & scored) >= 0.95 * len(clean) and len(toxic & scored) <= 0.5 * len(toxic)
    parts = brute_components(rows[1])
    assert Counter(rows[2]) == Counter(r for r in rows[1] if any(i == r[0] == c for i, _, c in parts))
    items = [q for q in (shingle_set(r["text"]) for r in table(spark, SF, "benchmark").collect()) if q]
    assert Counter(rows[3]) == Counter(r for r in rows[2] if not any(100 * len(q & shingle_set(r[1])) >= 80 * len(q) for q in items))
    assert {i for i, _ in rows[4]} <= {i for i, _ in rows[3]}
    tok = Tokenizer.from_file(tokenizer_path())
    want = Counter()
    for i, t in rows[4]:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        want[i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    got = corpus_pipeline.run(spark, SF).collect()
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == want


def test_stages_decide_per_row(spark, tmp_path):
    """Null ids, repeated rows and ids that name several texts."""
    a, b, c, d, e, f, leak = (prose(60) for _ in range(7))
    rows = [(None, a), (None, a), (5, a), (None, edited(a, 1)),  # a: 5 stays
            (None, b), (None, b), (None, edited(b, 1)),          # b: one of them stays
            (1, c), (1, c), (1, c), (2, edited(c, 1)),           # c: one row of 1 stays
            (7, c), (7, d),                                      # 7: its copy of c goes, d stays
            (8, e), (8, prose(9) + " " + leak),                  # 8: the contaminated text goes, e stays
            (None, leak + " " + prose(9)), (9, f),
            (None, None), (None, " "), (3, ""), (3, "")]         # nothing to compare: all stay
    docs = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, source string")
    spark.createDataFrame([(0, leak), (1, prose(30))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = saved(docs.repartition(3), "test-rows")
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.one_of_each_group(spark, docs, str(tmp_path)).collect()]
    of_b = [r for r in got if r[0] is None and r[1] in {t for i, t in rows[4:7]}]
    assert len(of_b) == 1
    got.remove(of_b[0])
    assert Counter(got) == Counter([(5, a), (1, c), (7, d), *rows[13:]])
    clean = corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path))
    assert clean.columns == docs.columns
    assert Counter((r["doc_id"], r["text"]) for r in clean.collect()) == Counter(r for r in rows if leak not in (r[1] or ""))
    one = corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path)).where("doc_id = 8").collect()
    assert [(r["doc_id"], r["text"]) for r in one] == [(8, e)]
