"""Spelling variant grouping by a dictionary of trie-node pairs (operator 13).

Words are counted over all texts. Their trie (prefixes) and the trie of the
reversed words (suffixes) get integer node numbers: words are sorted over range
partitions, a word shares the nodes of what it has in common with the word
before it, and a prefix that a partition's first word has too (so that it may
cross partitions) is numbered by the first such word and its depth.

A word's dictionary entries are the integer pairs (prefix node, suffix node)
around each skipped position and around each place between positions. Two words
of one length that share a skipped pair differ by a replaced code point; a word
with a skipped pair equal to another's unskipped one has one code point more.
(Of a run of equal code points only the first counts as skipped there, so each
pair of words meets once.) Under one pair lie at most one unskipped word and
one skipped word per code point of the alphabet, so a group is small by proof;
each member takes its number of partners and the best of them, and these are
summed per word. Pairs of words are never written out.

Defined cases: null and empty texts hold no run; a null doc_id counts as empty
in the hashed text; repeated rows count again (equal doc_ids give equal hashes);
a run of any length is a word, its entries grow with its length; equal counts go
to the smaller word by code points; an empty table gives no rows; other columns
are ignored.
"""
from __future__ import annotations

import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from corpusflow.llm.common import saved
from corpusflow.session import checkpoint_dir

MIN_LENGTH, MIN_COUNT, FORM_RATIO, DELETE_EVERY = 7, 2, 10, 31
HELD_WORDS = 200_000

# Runs are of A-Z, a-z and U+00C0 to U+00FF, one byte each in Latin-1; only A-Z are lower-cased.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def runs_of(text: str) -> list[bytes]:
    """Lower-cased runs of a text, in Latin-1."""
    return text.encode("latin-1", "replace").translate(_TABLE).split()


def _word(run: bytes, seed: int) -> bytes:
    """The run, less one code point if its hash (begun with the doc_id) says so."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode("utf-8"), seed)
    if h % DELETE_EVERY:
        return run
    i = h % len(run)
    return run[:i] + run[i + 1:]


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): words of ``MIN_LENGTH`` or more that occur ``MIN_COUNT`` times or more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            b = pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in held], pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return b

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for r, c in Counter(runs_of(text.as_py() or "")).items():
                    if len(r) >= MIN_LENGTH and len(w := _word(r, seed)) >= MIN_LENGTH:
                        held[w] += c
                if len(held) >= HELD_WORDS:
                    yield out()
        if held:
            yield out()

    counts = docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


def _common(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(i for i in range(n) if a[i] != b[i])


def number_nodes(words: DataFrame, key: str) -> DataFrame:
    """The rows of ``words`` with ``place`` (ascending with ``key``), ``nodes``: the trie nodes of the
    distinct ``key``s from the root down, and ``starts``: whether a position begins a run of equal code points."""
    checkpoint_dir(words.sparkSession)
    # The checkpoint fixes the ranges that the first words and the node numbers go by.
    ordered = words.repartitionByRange(key).sortWithinPartitions(key).checkpoint(eager=True)
    firsts = sorted(r["first"] for r in ordered.groupBy(F.spark_partition_id().alias("p")).agg(F.min(key).alias("first")).collect())  # one a partition
    shared = words.sparkSession.sparkContext.broadcast(firsts)
    at = words.columns.index(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts, base = shared.value, TaskContext.get().partitionId() << 33
        last, nodes, made, row = "", [], 0, 0
        for b in batches:
            if not b.num_rows:
                continue
            all_nodes, starts = [], []
            for w in b.column(at).to_pylist():
                nodes = nodes[:_common(last, w) + 1]
                j = bisect_left(firsts, w)
                crossing = max(_common(w, f) for f in firsts[max(0, j - 1):j + 1])
                for i in range(len(nodes), len(w) + 1):
                    if i <= crossing:
                        nodes.append(-(bisect_left(firsts, w[:i]) << 33 | i) - 1)
                    else:
                        made += 1
                        nodes.append(base | made)
                all_nodes.append(nodes)
                starts.append([i == 0 or w[i] != w[i - 1] for i in range(len(w))])
                last = w
            places = pa.array([base | (row + i) for i in range(b.num_rows)], pa.int64())
            row += b.num_rows
            yield pa.RecordBatch.from_arrays([*b.columns, places, pa.array(all_nodes, pa.list_(pa.int64())), pa.array(starts, pa.list_(pa.bool_()))], [*b.schema.names, "place", "nodes", "starts"])

    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in words.schema)
    return ordered.mapInArrow(run, ddl + ", place long, nodes array<long>, starts array<boolean>")


def near_words(words: DataFrame) -> DataFrame:
    """(id, n_near, best: (n, neg)): for each word with a near one (id, n, prefixes, suffixes, starts), how many and the greatest; neg is minus its id."""
    gap = "zip_with(prefixes, reverse(suffixes), (p, s) -> struct(p as p, s as s, false as skip, false as start))"
    skip = ("zip_with(zip_with(slice(prefixes, 1, size(starts)), slice(reverse(suffixes), 2, size(starts)), (p, s) -> struct(p, s)), starts, "
            "(x, f) -> struct(x.p as p, x.s as s, true as skip, f as start))")
    entries = words.select("id", "n", F.explode(F.expr(f"concat({gap}, {skip})")).alias("e")).select("e.*", "n", (-F.col("id")).alias("neg"))
    groups = (entries.groupBy("p", "s").agg(
        F.expr("sort_array(collect_list(struct(n, neg, start)) filter (where skip), false)").alias("skips"),
        F.expr("max(struct(n, neg)) filter (where not skip)").alias("gap"))
        .where("size(skips) > 1 or (size(skips) = 1 and gap is not null)").withColumn("longer", F.expr("filter(skips, x -> x.start)")))
    other = "if(x.neg = skips[0].neg, get(skips, 1), skips[0])"
    of_skip = (f"transform(skips, x -> struct(-x.neg as id, cast(size(skips) - 1 + int(x.start and gap is not null) as long) as near, "
               f"greatest(if(size(skips) > 1, struct({other}.n as n, {other}.neg as neg), null), if(x.start, gap, null)) as best))")
    of_gap = "if(gap is null, array(), array(struct(-gap.neg as id, cast(size(longer) as long) as near, struct(get(longer, 0).n as n, get(longer, 0).neg as neg) as best)))"
    found = groups.select(F.explode(F.expr(f"concat({of_skip}, {of_gap})")).alias("m")).select("m.*").where("near > 0")
    return found.groupBy("id").agg(F.sum("near").alias("n_near"), F.max("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(id, root): forms (id, form) followed to their last; each round doubles the way, counts along it rise tenfold a step, so there are few."""
    hops = saved(forms.select("id", F.col("form").alias("root"), F.lit(True).alias("moved")), "op13-roots")
    while not hops.where("moved").isEmpty():
        further = hops.select(F.col("id").alias("root"), F.col("root").alias("beyond"))
        hops = saved(hops.join(further, "root", "left").select("id", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "op13-roots")
    return hops.select("id", "root")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    words = number_nodes(count_words(docs, id_col, text_col), "word").withColumnsRenamed({"place": "id", "nodes": "prefixes"})
    words = saved(words, "op13-words")
    back = number_nodes(words.select("id", F.reverse("word").alias("key")), "key").select("id", F.col("nodes").alias("suffixes"))
    near = near_words(words.join(back, "id"))
    near = saved(near.select("id", "n_near", F.col("best.n").alias("best_n"), (-F.col("best.neg")).alias("best")), "op13-near")
    plain = words.select("id", "word", "n")
    found = saved(plain.join(near, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("best_n") >= FORM_RATIO * F.col("n"), F.col("best")).alias("form")), "op13-forms")
    last = roots(found.where("form is not null"))
    names = plain.select(F.col("id").alias("form"), F.col("word").alias("form_word"), F.col("n").alias("form_n"))
    root_names = last.join(plain.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root").select("id", "root_word")
    return found.join(names, "form", "left").join(root_names, "id", "left").select(
        "word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")
