"""Ranked lexical search by a pipeline of term owners (operator 12).

Documents are cut into slices of at most ``SLICE_DOCS`` rows; a posting list is
one row per term and slice, and holds the item terms only. The terms are dealt
to ``STAGES`` owners by weight, the heaviest (rarest) first. A bundle, one row
per item and slice, carries a sparse accumulator (documents and their scores so
far) through the owners one after the other: each stage cogroups the bundles
with its owner's posting lists by item block and slice and adds their integer
contributions. After the last owner each bundle gives its ten best, and a rank
limit per item, applied before its shuffle, selects among them.

An accumulator is dropped only when its score and all that the later owners can
still add (each term's greatest contribution in the corpus) stay below the
item's tenth best score so far, which final scores can only raise. So nothing
that could rank is lost, whatever the threshold; there is no cap.

Defined cases: null and empty texts hold no term and are not counted in N;
items without a term, or whose terms occur nowhere, have no rows; with equal
scores the smaller doc_id comes first, null doc_ids last; repeated rows (equal
doc_ids included) are documents of their own; items with equal ids are ranked
each by itself, a null item_id is an item; a term repeated in an item counts
each time; other columns are ignored; empty tables give no rows. Terms are
identified by 64-bit hashes.
"""
from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from corpusflow.llm.common import saved

TOP = 10
STAGES = 4
SLICE_DOCS, SLICE_POSTINGS = 2_048, 1_000_000
ITEM_BLOCK = 128
FILTER_LOG2 = 26
# The scale of the saturation, of document length, and of the weights.
UNIT, LENGTH_PART = 1_000_000_000, 75

# Term characters are ASCII letters and digits and all of U+0080 and above; A-Z are lower-cased.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if chr(c).isascii() and chr(c).isalnum() or c >= 128 else 32 for c in range(256))


def terms_of(text: str) -> list[bytes]:
    return text.encode("utf-8").translate(_TABLE).split()


def _hash(term: bytes) -> int:
    return xxhash.xxh3_64_intdigest(term) - (1 << 63)


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, item_id, h, times): the distinct terms of each item, each row of ``items`` numbered by itself."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, h, times = [], [], []
            for i, text in enumerate(b.column(2).to_pylist()):
                found = Counter(map(_hash, terms_of(text or "")))
                n += [i] * len(found)
                h += found.keys()
                times += found.values()
            if n:
                at = pa.array(n)
                yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(h, pa.int64()), pa.array(times, pa.int64())], ["item", "item_id", "h", "times"])

    rows = saved(items.select(F.monotonically_increasing_id().alias("item"), F.col(id_col).alias("item_id"), F.col(text_col).alias("text")), "op12-items")
    return saved(rows.mapInArrow(run, f"item long, item_id {rows.schema['item_id'].dataType.simpleString()}, h long, times long"), "op12-terms")


def _vocabulary(terms: DataFrame) -> np.ndarray:
    """A bit map of the items' terms: 2**FILTER_LOG2 bits whatever their number; postings it lets through in vain are dropped by the join on h."""
    words = 1 << (FILTER_LOG2 - 6)
    slot = F.shiftrightunsigned("h", 64 - FILTER_LOG2)
    bits = (terms.select(F.shiftright(slot, 6).cast("int").alias("w"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h, {64 - FILTER_LOG2}) & 63 as int))").alias("b"))
            .groupBy("w").agg(F.bit_or("b").alias("b")).collect())  # at most 2**(FILTER_LOG2 - 6) rows
    out = np.zeros(words, np.int64)
    for r in bits:
        out[r["w"]] = r["b"]
    return out.view(np.uint64)


def postings(docs: DataFrame, vocabulary: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One pass over the texts: rows (slice, h, at, tf, n) of the items' terms, and one row (slice, ids, n) a slice (h null).

    ``at`` is a document's place in its slice, in ascending doc_id order; n its length in terms.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    schema = pa.schema([("slice", pa.int64()), ("h", pa.int64()), ("at", pa.list_(pa.int32())), ("tf", pa.list_(pa.int32())), ("n", pa.list_(pa.int64())), ("ids", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, known = shared.value, {}
        base, slices = TaskContext.get().partitionId() << 32, 0
        ids: list[int | None] = []
        lengths: list[int] = []
        lists: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0

        def closed() -> Iterator[pa.RecordBatch]:
            nonlocal slices, held
            order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, i))
            n = np.array(lengths, np.int64)[order]
            sizes = [len(lists[i][0]) for i in order]
            h = np.concatenate([lists[i][0] for i in order])
            tf = np.concatenate([lists[i][1] for i in order])
            at = np.repeat(np.arange(len(order), dtype=np.int32), sizes)
            by = np.argsort(h, kind="stable")
            h, tf, at = h[by], tf[by], at[by]
            cuts = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.empty(0, np.int64)
            ends = pa.array(np.r_[cuts, len(h)].astype(np.int32))
            several = lambda x: pa.ListArray.from_arrays(ends, pa.array(x))
            k = len(cuts)
            number = base + slices
            if k:
                yield from pa.table([pa.array(np.full(k, number)), pa.array(h[cuts]), several(at), several(tf), several(n[at]), pa.nulls(k, pa.list_(pa.int64()))], schema=schema).to_batches(max_chunksize=4096)
            yield pa.RecordBatch.from_pylist([{"slice": number, "n": n.tolist(), "ids": [ids[i] for i in order]}], schema=schema)
            slices += 1
            held = 0
            ids.clear(), lengths.clear(), lists.clear()

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                words = terms_of(text.as_py() or "")
                if not words:
                    continue
                count = Counter(words)
                hs, tfs = [], []
                for w, c in count.items():
                    h = known.get(w, 0)
                    if h == 0:  # not seen; None: no item has it
                        h = _hash(w)
                        slot = (h & 0xFFFFFFFFFFFFFFFF) >> (64 - FILTER_LOG2)
                        if not int(bits[slot >> 6]) >> (slot & 63) & 1:
                            h = None
                        if len(known) > 200_000:
                            known.clear()
                        known[w] = h
                    if h is not None:
                        hs.append(h)
                        tfs.append(c)
                ids.append(doc_id)
                lengths.append(len(words))
                lists.append((np.array(hs, np.int64), np.array(tfs, np.int32)))
                held += len(hs)
                if len(ids) >= SLICE_DOCS or held >= SLICE_POSTINGS:
                    yield from closed()
        if ids:
            yield from closed()

    ddl = "slice long, h long, at array<int>, tf array<int>, n array<long>, ids array<long>"
    return saved(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, ddl), "op12-postings")


def _stage(key: tuple, left: pa.Table, right: pa.Table, schema: pa.Schema) -> pa.Table:
    """Add one owner's contributions to the bundles of an item block and slice.

    left: bundles (item, need, at, score); right: posting lists (at, gain, items: [(item, weight, need)]).
    """
    lists = [(a.values.to_numpy(), g.values.to_numpy().astype(np.int64), t.as_py()) for a, g, t in zip(right["at"], right["gain"], right["items"])]
    held = [(i, need, a.values.to_numpy(), s.values.to_numpy()) for i, need, a, s in zip(left["item"].to_pylist(), left["need"].to_pylist(), left["at"], left["score"])]
    width = 1 + max(int(x.max()) for x in [a for a, _, _ in lists] + [a for _, _, a, _ in held])
    scores: dict[int, np.ndarray] = {}
    needs: dict[int, int] = {}

    def of(item: int, need: int) -> np.ndarray:
        if item not in scores:
            scores[item], needs[item] = np.zeros(width, np.int64), need
        return scores[item]

    for item, need, at, score in held:
        of(item, need)[at] = score
    for at, gain, items in lists:
        for x in items:
            of(x["item"], x["need"])[at] += x["weight"] * gain
    rows = []
    for item, acc in sorted(scores.items()):
        at = np.flatnonzero(acc >= max(1, needs[item]))
        if len(at):
            rows.append((item, at.astype(np.int32), acc[at]))
    if not rows:
        return schema.empty_table()
    k, ends = len(rows), pa.array(np.cumsum([0] + [len(a) for _, a, _ in rows]).astype(np.int32))
    return pa.table([pa.repeat(key[0], k), pa.repeat(key[1], k), pa.array([i for i, _, _ in rows], pa.int64()),
                     pa.ListArray.from_arrays(ends, pa.array(np.concatenate([a for _, a, _ in rows]))),
                     pa.ListArray.from_arrays(ends, pa.array(np.concatenate([s for _, _, s in rows])))], schema=schema)


_BUNDLE = pa.schema([("block", pa.int32()), ("slice", pa.int64()), ("item", pa.int64()), ("at", pa.list_(pa.int32())), ("score", pa.list_(pa.int64()))])
_BUNDLE_DDL = "block int, slice long, item long, at array<int>, score array<long>"


def ranked(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text_col: str = "text", top: int = TOP) -> DataFrame:
    """Each item's ``top`` documents of highest score above 0: item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    terms = item_terms(items, item_id, text_col)
    lists = postings(docs, _vocabulary(terms), doc_id, text_col)
    slices = lists.where("h is null")
    n_docs, n_terms = slices.agg(F.sum(F.size("ids")), F.expr("sum(aggregate(n, 0L, (a, x) -> a + x))")).first()
    none = terms.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).limit(0)
    if not n_docs or terms.isEmpty():
        return none
    # What a unit of a term's weight adds to each document of its list: the contract's integer arithmetic.
    gain = F.expr(f"zip_with(tf, n, (t, x) -> cast(({UNIT}L * t) div (1000L * t + 8L * ({100 - LENGTH_PART}L + ({LENGTH_PART}L * x * {n_docs}L) div {n_terms}L)) as int))")
    lists = lists.where("h is not null").select("slice", "h", "at", gain.alias("gain"))
    weight = F.floor(F.lit(1000.0) * F.log((2.0 * n_docs + 2.0) / (2.0 * F.col("df") + 1.0))).cast("long")
    heaviest = 1000.0 * float(np.log((2.0 * n_docs + 2.0) / 3.0)) + 1.0
    owner = F.least(F.lit(STAGES - 1), F.floor((1.0 - F.col("w") / heaviest) * STAGES)).cast("int")
    stats = lists.groupBy("h").agg(F.sum(F.size("at")).alias("df"), F.max(F.array_max("gain")).alias("best")).withColumn("w", weight).withColumn("owner", owner)
    n_items = terms.agg(F.count_distinct("item")).first()[0]
    blocks = -(-n_items // ITEM_BLOCK)
    terms = saved(terms.join(stats, "h").where("w > 0").select(
        "item", "item_id", "h", "owner", (F.col("times") * F.col("w")).alias("weight"), (F.col("times") * F.col("w") * F.col("best")).alias("bound"),
        F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int").alias("block")), "op12-weights")

    bundles = spark.createDataFrame([], _BUNDLE_DDL)
    floors = terms.select("item", F.lit(0).cast("long").alias("floor")).distinct()
    for stage in range(STAGES):
        # What an accumulator needs now so that the owners to come could still lift it to the item's tenth best.
        later = terms.groupBy("item").agg(F.sum(F.when(F.col("owner") > stage, F.col("bound")).otherwise(0)).alias("later"))
        needs = later.join(floors, "item", "left").select("item", (F.coalesce("floor", F.lit(0)) - F.col("later")).alias("need"))
        needs = saved(needs, "op12-needs")
        owned = (terms.where(F.col("owner") == stage).join(needs, "item").groupBy("h", "block")
                 .agg(F.collect_list(F.struct("item", "weight", "need")).alias("items")))
        right = lists.join(owned, "h").select("block", "slice", "at", "gain", "items")
        left = bundles.join(needs, "item").select("block", "slice", "item", "need", "at", "score")
        step = left.groupBy("block", "slice").cogroup(right.groupBy("block", "slice")).applyInArrow(
            lambda key, a, b: _stage(key, a, b, _BUNDLE), _BUNDLE_DDL)
        bundles = saved(step, "op12-bundles")
        best = bundles.select("item", F.explode(F.slice(F.sort_array("score", False), 1, top)).alias("score"))
        by_score = Window.partitionBy("item").orderBy(F.desc("score"))
        floors = (best.withColumn("r", F.row_number().over(by_score)).where(F.col("r") <= top)
                  .groupBy("item").agg(F.when(F.count("*") == top, F.min("score")).otherwise(0).alias("floor")))
    # ``at`` follows doc_id inside a slice, so a bundle's best are its first by (score, at).
    pairs = F.expr("zip_with(score, at, (s, a) -> struct(-s as s, a as a))")
    best = bundles.select("item", "slice", F.explode(F.slice(F.array_sort(pairs), 1, top)).alias("x")).select("item", "slice", (-F.col("x.s")).alias("score"), "x.a")
    by_score = Window.partitionBy("item").orderBy(F.desc("score"))
    best = best.withColumn("r", F.rank().over(by_score)).where(F.col("r") <= top).drop("r")
    found = best.join(slices.select("slice", "ids"), "slice").select("item", "score", F.expr("ids[a]").alias("doc_id"))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return found.join(terms.select("item", "item_id").distinct(), "item").select("item_id", "rank", "doc_id", "score")
