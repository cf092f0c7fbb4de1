"""The operators against brute force on a small table with nulls, empty and long texts, ties, repeats and clashing columns."""
from __future__ import annotations

import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from corpusflow.llm import chat_template, decontam, jaccard_join, language_id, line_dedup, mixing, sharding, stream_dedup, token_output, toxicity
from corpusflow.llm.components import components
from corpusflow.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, n int, key string, token long, shard string, label int, norm string, taken int"
RND = random.Random(11)
VOCAB = ["".join(RND.choice("abcdefghij") for _ in range(RND.randint(2, 7))) for _ in range(300)]


def prose(n: int, rnd: random.Random = RND) -> str:
    return " ".join(rnd.choice(VOCAB) for _ in range(n))


def edited(text: str, n: int) -> str:
    w = text.split(" ")
    for _ in range(n):
        w[RND.randrange(len(w))] = RND.choice(VOCAB)
    return " ".join(w)


BASE = prose(120)
PASSAGE = prose(60)
TEXTS: list[tuple[int | None, str | None]] = [(1, None), (2, ""), (3, " \t\n "), (4, "One two"), (5, "one  two"), (6, "one\ttwo"), (7, "a b c d e"), (8, "A B C D E"), (None, BASE), (None, None)]
TEXTS += [(10 + k, edited(BASE, k % 4)) for k in range(12)] + [(30 + k, prose(40) + " " + PASSAGE + " " + prose(40)) for k in range(8)]
TEXTS += [(50, BASE), (51, BASE), (51, BASE), (52, prose(20000)), (53, "Über ßtraße é " + prose(30)), (54, prose(9))]
DOCS = [(i, t, "en", f"s{k % 3}" if k % 7 else None, len(t or ""), "x", 1, "k", 5, "sh", 0, "norm", 9) for k, (i, t) in enumerate(TEXTS)]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('llm')}/documents.parquet"
    spark.createDataFrame(DOCS, SCHEMA).repartition(3).write.parquet(path)
    return path


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('llm')}/documents.parquet"
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    return path


def words(t):
    return re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())


def shingle_set(t):
    w = words(t)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


# ---- 1
def test_checksums_against_the_standard_value_and_a_bitwise_one():
    def slow(b):
        c = 0xFFFFFFFF
        for x in b:
            c ^= x
            for _ in range(8):
                c = (c >> 1) ^ (0x82F63B78 if c & 1 else 0)
        return c ^ 0xFFFFFFFF
    parts = [b"123456789"] + [RND.randbytes(n) for n in (4, 5, 255, 256, 257, 511, 512, 513, 3000)]
    got = token_output.crc32c_many(parts).tolist()
    assert got[0] == 0xE3069283 and got == [slow(p) for p in parts]


def test_encoder_equals_the_tokenizer_on_whole_texts():
    enc = token_output.Encoder(tokenizer_path(), "<u2")
    al = ["a", "B", "é", "é", "İ", "Σ", "'s", "'T", "1", "²", ".", ",", "...", " ", "\n", "\t", "\xa0", " ", "<|endoftext|>", "ß", "中", "́", "😀", "x,", "\x1c", "don't", "﻿", "יִ", "###", "|>", ";"]
    rnd = random.Random(4)
    for _ in range(3000):
        t = "".join(rnd.choice(al) for _ in range(rnd.randint(0, 12)))
        assert enc(t) == np.array(enc.tok.encode(t, add_special_tokens=False).ids, "<u2").tobytes(), repr(t)


def test_token_records_round_trip(spark, docs, empty, tmp_path):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path())
    out = token_output.token_records(spark.read.parquet(docs), tokenizer_path()).collect()
    out.sort(key=lambda r: r["start"])
    rows = sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start = 0
    for r, (i, t) in zip(out, rows, strict=True):
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (i, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert token_output.token_records(spark.read.parquet(empty), tokenizer_path()).count() == 0


def test_records_in_any_order_and_damage(spark, docs, tmp_path):
    m = token_output.write_records(spark.read.parquet(docs), tokenizer_path(), str(tmp_path / "r"))
    row = max(m.collect(), key=lambda r: r["n_records"])
    order = list(range(row["n_records"]))[::-1]
    back = token_output.read_ids(row["path"], row["dtype"], order)
    assert [b[0] for b in back] == [b[0] for b in token_output.read_ids(row["path"], row["dtype"], order[::-1])][::-1]
    raw = bytearray(open(row["path"] + ".rec", "rb").read())
    assert struct.unpack("<Q", raw[:8])[0] == 8 + 2 * len(token_output.read_ids(row["path"], row["dtype"], [0])[0][1])
    raw[20] ^= 1
    open(row["path"] + ".rec", "wb").write(raw)
    with pytest.raises(Exception, match="checksum"):
        token_output.read_records(m).collect()


# ---- 2
@pytest.mark.parametrize("chars", [64, 2])
def test_stream_dedup(spark, docs, empty, chars):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = defaultdict(list)
    for i, t in TEXTS:
        groups[norm(t)].append(i)
    first = {n: min((i for i in g if i is not None), default=None) for n, g in groups.items()}
    got = stream_dedup.stateful_dedup(spark, docs, digest_chars=chars).collect()
    want = Counter((i, first[norm(t)], len(groups[norm(t)]), hashlib.sha256(norm(t).encode()).hexdigest()) for i, t in TEXTS)
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == want
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len(groups) and len({r["text_sha256"] for r in kept}) == len(groups) and all(r["doc_id"] == r["keep_id"] for r in kept)
    assert stream_dedup.stateful_dedup(spark, empty).count() == 0


def test_stream_state_takes_up_new_files(spark, tmp_path):
    path, check, out = str(tmp_path / "in"), str(tmp_path / "check"), str(tmp_path / "out")
    spark.createDataFrame([(5, "x"), (6, "y")], "doc_id long, text string").write.parquet(path)
    assert stream_dedup.stream_state(spark, path, check, out).count() == 2
    spark.createDataFrame([(3, "x"), (9, "z")], "doc_id long, text string").write.mode("append").parquet(path)
    got = {(r["first"]["doc_id"], r["n"]) for r in stream_dedup.stream_state(spark, path, check, out).collect()}
    assert got == {(3, 2), (6, 1), (9, 1)}


# ---- 3
def test_template_language():
    run = lambda t, **v: "".join(p for p in chat_template.compile_template(t)(**v) if isinstance(p, str))
    assert run("a{{ 1 + 2 }}b{% if x == 'u' and not y %}U{% elif x %}E{% else %}N{% endif %}", x="u", y=False) == "a3bU"
    assert run("{% for m in ms %}{{ loop.index }}{{ m.a | upper }}{% if not loop.first %}!{% endif %}{% endfor %}", ms=[{"a": "p"}, {"a": "q"}]) == "1P2Q!"
    assert run("{% set z = 'k' ~ n %}{{ z }}  {{- ' w' }}", n=4) == "k4 w"
    assert chat_template.parse("a{{ 'b' ~ 1 }}{% if 1 > 2 %}x{% else %}c{% endif %}") == [("text", "ab1c")]  # all folded
    got = list(chat_template.compile_template("x{% generation %}y{% endgeneration %}")())
    assert got == ["x", chat_template.START, "y", chat_template.END]
    for bad in ("{{ open('f') }}", "{{ a.__class__ }}", "{% if x %}", "{{ x | nothing }}", "{% while x %}{% endwhile %}", "{{ }}"):
        with pytest.raises(chat_template.TemplateError):
            run(bad, a="s", x=1)


def test_escape_is_reversible():
    rnd = random.Random(5)
    for _ in range(5000):
        t = "".join(rnd.choice(["<", "/", "s", ">", "[", "INST]", "\\", "|", " ", "</s>", "[/INST]"]) for _ in range(rnd.randint(0, 9)))
        e = chat_template.escape(t)
        assert chat_template.unescape(e) == t and not any(c in e for c in ("<s>", "</s>", "[INST]", "[/INST]", "<|", "|>"))


def test_conversations_round_trip(spark, monkeypatch):
    monkeypatch.setattr(chat_template, "PART_CHARS", 50)
    rows = [(1, 0, "user", "hi </s>"), (1, 1, "assistant", "[INST] <|x|> \\"), (1, 1, "assistant", "tie"), (1, None, None, None), (2, 0, "system|>", "s"), (2, 1, "assistant", ""),
            (None, 0, "user", "n"), (3, 0, "assistant", "x" * 200000), (3, 1, "user", "<|end|>"), (3, 1, "user", "<|end|>"), (-7, 0, "user", "</s>[INST] ok [/INST]")]
    df = spark.createDataFrame([(*r, "t", 1) for r in rows], "conv_id long, turn long, role string, text string, part string, starts int")
    got = {r["conv_id"]: r for r in chat_template.round_trip(df).collect()}
    by = defaultdict(list)
    for c, t, r, x in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        by[c].append((r or "", x or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        loss = "".join(x for r, x in turns if r == "assistant")
        assert got[c]["n_turns"] == len(turns) and got[c]["loss_chars"] == len(loss)
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest()
        assert got[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert chat_template.round_trip(df.limit(0)).count() == 0


# ---- 4
def test_water_filling_against_the_loop(spark):
    rnd = random.Random(6)
    for n in (1, 2, 5, 20):
        sizes = [rnd.choice([0, 1, 10, 1000, 50]) for _ in range(n)]
        weights = [(3, 1, 2)[k % 3] for k in range(n)]
        budget, live, target = 1.5 * sum(sizes), set(range(n)), [0.0] * n
        while live:  # clamp and deal out again
            level = budget / sum(weights[k] for k in live)
            over = {k for k in live if weights[k] * level > 2 * sizes[k]}
            for k in over or live:
                target[k] = 2.0 * sizes[k] if over else weights[k] * level
                budget -= target[k] if over else 0
            live = live - over if over else set()
        df = spark.createDataFrame([(f"s{k}", k + 1, weights[k], sizes[k]) for k in range(n)], "source string, rank int, weight int, source_size long")
        got = {r["source"]: r["target"] for r in mixing.water_fill(df, 1.5, 2.0).collect()}
        assert all(math.isclose(got[f"s{k}"], target[k], abs_tol=1e-6) for k in range(n))


def test_mix_meets_targets_and_repeats_rows(spark, docs, empty):
    df = spark.read.parquet(docs)
    plan = mixing.mix_plan(df).collect()
    assert len(plan) == len(TEXTS) and sorted(map(str, plan)) == sorted(map(str, mixing.mix_plan(df).collect()))
    by = defaultdict(list)
    for r in plan:
        by[r["source"]].append(r)
    for rows in by.values():
        assert sum(r["size"] for r in rows) == rows[0]["source_size"] and abs(sum(r["taken"] for r in rows) - rows[0]["target"]) <= 1 and all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    mixed = mixing.mixed_documents(df)
    assert mixed.columns == df.columns
    out = mixed.collect()
    got, want = sum(len(words(r["text"])) for r in out), sum(r["taken"] for r in plan)
    assert want - 2 <= got <= want and all(r["n_chars"] == len(r["text"]) for r in out)
    whole = {t for _, t in TEXTS}
    assert sum(r["text"] not in whole for r in out) <= 4 and all(any((t or "").startswith(r["text"]) for t in whole) for r in out)
    assert mixing.mix_plan(spark.read.parquet(empty)).count() == 0 and mixing.mixed_documents(spark.read.parquet(empty)).count() == 0


# ---- 5
def test_language_id(spark):
    al = {"aa": "abcde", "bb": "defgh", "cc": "ghijk"}
    rnd = random.Random(8)
    text = lambda a: " ".join("".join(rnd.choice(a) for _ in range(rnd.randint(2, 8))) for _ in range(rnd.randint(5, 60)))
    rows = [(i, text(al[lang]), lang) for i in range(300) for lang in [rnd.choice(list(al))]]
    extra = [(900, None, "aa"), (901, "123 ... 5", "aa"), (None, text("abcde"), None), (902, "", None), (0, rows[0][1], rows[0][2])]
    df = spark.createDataFrame([(*r, "x", 1.0) for r in rows + extra], "doc_id long, text string, lang string, lang_pred string, score double")
    got = language_id.identify(df).collect()
    assert len(got) == 305
    pred = {r["doc_id"]: r for r in got}
    assert all(pred[i]["lang_pred"] == "und" and pred[i]["score"] == 0 for i in (900, 901, 902)) and all(0 <= r["score"] <= 1 for r in got)
    held = [(i, lang) for i, _, lang in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(pred[i]["held_out"] for i, _ in held) and sum(pred[i]["lang_pred"] == lang for i, lang in held) >= 0.95 * len(held)
    assert {r["lang_pred"] for r in language_id.identify(df.withColumn("lang", df["lang"].substr(9, 1).cast("string")).where("doc_id >= 900")).collect()} <= {"und", ""}
    assert language_id.identify(df.limit(0)).count() == 0


def test_bundles_are_sums_of_bound_letters():
    s = language_id.Space(64, 1)
    v = sum(np.roll(s.letter(ord(a)), 2).astype(int) * np.roll(s.letter(ord(b)), 1) * s.letter(ord(c)) for a, b, c in (" ab", "abc", "bc "))
    assert s.bundles(["Abc", ""]).tolist() == [v.tolist(), [0.0] * 64]


# ---- 6
def test_nearest_is_exact():
    rnd = np.random.default_rng(3)
    vectors = []
    for _ in range(500):
        t = (0, *sorted(rnd.choice(np.arange(1, 40), rnd.integers(0, 5), replace=False).tolist()))
        v = rnd.random(len(t))
        vectors.append((t, tuple((v / np.linalg.norm(v)).tolist())))
    index = toxicity.ExampleIndex(list(range(500)), [k % 2 for k in range(500)], [1.0] * 500, vectors, 40)
    dense = np.zeros((500, 40))
    for k, (t, v) in enumerate(index.vectors):
        dense[k, list(t)] = v
    for k in range(0, 500, 7):
        found, cos = index.nearest(index.vectors[k], 10)
        assert np.allclose(cos, np.sort(dense @ dense[k])[::-1][:10])
        assert np.allclose(dense[found] @ dense[k], cos)


def test_toxicity_catches_and_leaves_alone(spark):
    rnd = random.Random(9)
    bad = ["vile", "scorn", "filthz"]
    rows, labels = [], []
    for i in range(400):
        w = prose(rnd.randint(5, 80), rnd).split()
        if i % 5 == 0:
            for _ in range(max(1, len(w) // 12)):
                w.insert(rnd.randrange(len(w)), rnd.choice(bad))
        rows.append((i, " ".join(w)))
        labels.append((i, int(i % 5 == 0)))
    df = spark.createDataFrame([(*r, "x", 1) for r in rows + [(None, None), (500, ""), (7, rows[7][1])]], "doc_id long, text string, score string, label int")
    lab = spark.createDataFrame(labels + [(7, 0), (None, 1), (8, None)], "doc_id long, toxic int")
    got = toxicity.toxicity(df, lab).collect()
    assert len(got) == 403 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 400]
    assert sum(r["predicted"] == int(r["doc_id"] % 5 == 0) for r in held) >= 0.95 * len(held)
    assert next(r for r in got if r["doc_id"] == 500)["predicted"] == 0
    assert {r["score"] for r in toxicity.toxicity(df, lab.limit(0)).collect()} == {0.0} and toxicity.toxicity(df.limit(0), lab).count() == 0


# ---- 7
def brute_components(rows, pct=80):
    sets = [(i, shingle_set(t)) for i, t in rows]
    up = {i: i for i, _ in rows if i is not None}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    for a in range(len(sets)):
        for b in range(a):
            (i, x), (j, y) = sets[a], sets[b]
            if i is not None and j is not None and x and y and 100 * len(x & y) >= pct * len(x | y):
                p, q = sorted((top(i), top(j)))
                up[q] = p
    return Counter((i, len(s), None if i is None else top(i)) for i, s in sets)


@pytest.mark.parametrize("hot", [1 << 18, 0])
def test_jaccard_components(spark, docs, empty, hot, monkeypatch):
    monkeypatch.setattr(jaccard_join, "HOT_TOKENS", hot)
    got = Counter(map(tuple, jaccard_join.jaccard_components(spark.read.parquet(docs)).collect()))
    assert got == brute_components(TEXTS)
    assert jaccard_join.jaccard_components(spark.read.parquet(empty)).count() == 0


def test_jaccard_links_without_any_group(spark, monkeypatch):
    """The matrix alone, when MinHash groups nothing, and chains of near copies."""
    monkeypatch.setattr(jaccard_join, "_verified", lambda pairs, docs, pct, f=jaccard_join._verified, n=[0]: (n.append(0), f(pairs, docs, pct) if len(n) > 2 else f(pairs.limit(0), docs, pct))[1])
    rows, t = [], prose(150)
    for k in range(60):
        rows.append((k * 3, t))
        t = edited(t, 2) if k % 9 else prose(RND.randint(5, 150))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(map(tuple, jaccard_join.jaccard_components(df).collect())) == brute_components(rows)


def test_components(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 7), (200, 201), (201, 202), (5, 5), (None, 3), (202, 200), (60, 61), (60, 61)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, 100: 0, 200: 200, 201: 200, 202: 200, 60: 60, 61: 60}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- 8
def distance(a, b):
    p = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        q = [i]
        for j, d in enumerate(b, 1):
            q.append(min(p[j] + 1, q[-1] + 1, p[j - 1] + (c != d)))
        p = q
    return p[-1]


def typo(t, n, rnd):
    t = list(t)
    for _ in range(n):
        p, what = rnd.randrange(len(t)), rnd.randrange(3)
        t[p:p + (what != 0)] = [rnd.choice("abc")] * (what != 1)
    return "".join(t)


def test_edit_distance_and_keys():
    rnd = random.Random(1)
    for _ in range(6000):
        a = "".join(rnd.choice("abc") for _ in range(rnd.randint(1, 14)))
        b, k = typo(a, rnd.randint(0, 4), rnd) if len(a) > 5 else "ab", rnd.randint(1, 3)
        near = distance(a, b) <= k
        assert line_dedup.within(a, b, k) == near
        if near and min(len(a), len(b)) > k:
            short, long_ = sorted((a, b), key=len)
            assert set(line_dedup.line_keys(short, k)[0]) & set(line_dedup.line_keys(long_, k)[1])
            assert set(line_dedup.character_classes(a, k)) & set(line_dedup.character_classes(b, k))


@pytest.mark.parametrize("bucket", [16, 2])
def test_line_dedup(spark, bucket, monkeypatch):
    monkeypatch.setattr(line_dedup.near_lines, "__defaults__", (2, 20, bucket))
    rnd = random.Random(2)
    pool = [prose(6, rnd) for _ in range(30)]
    rows = [(None, "x\n" + pool[0]), (1, None), (2, ""), (3, "\n \n")]
    for i in range(10, 60):
        rows.append((i, "\n".join(typo(x, rnd.choice([0, 0, 1, 2, 3]), rnd) if len(x) > 20 else x for x in rnd.choices([*pool, "x", "", " ", "Page 12 of the same long book"], k=6))))
    rows.append(rows[-1])
    df = spark.createDataFrame([(*r, 1, "y") for r in rows], "doc_id long, text string, pos int, line string")
    places = [(i, t, p, x) for i, t in dict.fromkeys(rows) if t for p, x in enumerate(t.split("\n")) if x.strip(" \t\r\x0b\x0c")]
    distinct = sorted({x for *_, x in places})
    up = {x: x for x in distinct}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    for a in distinct:
        for b in distinct:
            if a < b and len(a) >= 20 and len(b) >= 20 and abs(len(a) - len(b)) <= 2 and line_dedup.within(a, b, 2):
                up[max(top(a), top(b))] = min(top(a), top(b))
    keep = {}
    for i, t, p, x in sorted(places, key=lambda r: (r[0] is not None, r[0] or 0, r[2])):
        keep.setdefault(top(x), (i, p))
    want = {i: sorted(p for j, u, p, x in places if (j, u) == (i, t) and keep[top(x)] != (i, p)) for i, t in rows}
    got = line_dedup.line_dedup(df).collect()
    assert len(got) == len(set(rows)) and {r["doc_id"]: r["dropped"] for r in got} == want
    out = {r["doc_id"]: r["text"] for r in line_dedup.deduplicated(df).collect()}
    assert out[20] == "\n".join(x for p, x in enumerate(dict(rows)[20].split("\n")) if p not in want[20])
    assert line_dedup.line_dedup(df.limit(0)).count() == 0


# ---- 9
def test_sharding(spark, docs, empty):
    names, size = [f"n{k}" for k in range(7)], 211
    h = lambda s: int(hashlib.md5(s.encode()).hexdigest()[:15], 16)
    orders = [[(h(f"offset:{s}") % size + j * (h(f"step:{s}") % (size - 1) + 1)) % size for j in range(size)] for s in names]
    slots: dict[int, str] = {}
    while len(slots) < size:  # the definition, written plainly
        for s, order in zip(names, orders):
            if len(slots) < size:
                slots[next(x for x in order if x not in slots)] = s
    df = sharding.place(spark.read.parquet(docs), "doc_id", names, size)
    got = df.collect()
    assert len(got) == len(TEXTS) and all(r["slot"] == h("" if r["doc_id"] is None else str(r["doc_id"])) % size and r["shard"] == slots[r["slot"]] for r in got)
    assert "Exchange hashpartitioning" not in df._jdf.queryExecution().toString()
    counts = Counter(slots.values())
    assert max(counts.values()) - min(counts.values()) <= 1
    fewer = sharding.lookup_table(names[:-1], size)
    assert sum(names[fewer[k]] != s for k, s in slots.items() if s != names[-1]) < 0.15 * size
    assert sharding.place(spark.read.parquet(empty), "doc_id", names, size).count() == 0
    for bad in (([], 7), (["a", "a"], 7), (["a", "b"], 8)):
        with pytest.raises(ValueError):
            sharding.lookup_table(*bad)


# ---- 10
@pytest.mark.parametrize("block", [1_000_000, 10])
def test_decontamination(spark, docs, empty, block):
    items = [(0, PASSAGE), (1, prose(50)), (2, edited(PASSAGE, 2)), (3, "One two"), (4, None), (5, ""), (6, BASE[:400]), (6, BASE[:400]), (None, "a b c d e"), (7, "a b c d e f")]
    it = spark.createDataFrame([(*r, "z") for r in items], "item_id long, text string, doc_id string")
    want = Counter()
    for i, t in TEXTS:
        w = words(t)
        for k, x in dict.fromkeys(items):
            q, n = shingle_set(x), len(words(x))
            have = shingle_set(t) | ({tuple(w[j:j + n]) for j in range(len(w) - n + 1)} if 0 < n < 5 else set())
            if q and 100 * len(q & have) >= 80 * len(q):
                want[i, k, len(q), len(q & have)] += 1
    got = Counter((r["doc_id"], r["item_id"], r["n_item_shingles"], r["n_common"]) for r in decontam.contaminated(spark.read.parquet(docs), it, block_shingles=block).collect())
    assert got == want and len(want) > 10
    assert decontam.contaminated(spark.read.parquet(empty), it).count() == 0 and decontam.contaminated(spark.read.parquet(docs), it.limit(0)).count() == 0
