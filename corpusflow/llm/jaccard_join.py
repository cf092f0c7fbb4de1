"""Exact n-gram Jaccard self-join by a token-group matrix (operator 7).

Documents are sets of word shingles; two link when the Jaccard similarity of
their sets is at least ``pct`` percent. All links between different sets count
for the result, which gives each document its connected component:

1. Equal sets become one representative.
2. Similar representatives are put into groups: MinHash bands name a leader
   per bucket (the member whose buckets are the largest, so that it stands in
   the middle of its copies), each member is compared with its leader only, and
   verified links are joined into components. No bucket is paired out.
3. The token-group matrix holds, for each group, the union of its members'
   rarest tokens (their prefixes), each with the sizes of the members that hold
   it and the most tokens that such a member has from there on. Two sets that
   link have their first common token in both prefixes, and all their common
   tokens stand from there on; so what the groups have left there bounds the
   overlap, and only entries whose bound reaches the threshold qualify a pair.
4. Only qualifying groups are opened: their members are bounded against the
   other group's entry in the same way. Of the pairs left, those go whose
   parity bitmaps differ in more bits than linked sets can in tokens; the
   others are verified.
5. Components of the verified links give component_id.

Stage 2 only saves work; stages 3 and 4 find every link that it left between
groups, and links inside a group cannot change a component. Token order: the
most frequent tokens last (a bounded list found by counting all documents),
others by hash; any order gives the same result.

Tokens are 64-bit hashes of shingles; see ``common.word_ids`` for words.
Defined cases: null, empty and blank texts have n_shingles 0 and link with
nothing; rows with a null doc_id get a null component and take part in no
link; repeated rows each get their row; rows with one doc_id and different
texts share a component; other columns are ignored; empty tables give no rows.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from corpusflow.llm.common import forget, id_filter, maybe_in, saved, shingles, text_bytes, word_ids
from corpusflow.llm.components import components

PCT = 80
BANDS, ROWS = 8, 3
HOT_TOKENS = 1 << 18   # longest list of frequent tokens that is broadcast
HOT_IN_CHUNK = 3       # a token counts as frequent from so many documents of one chunk
CHUNK_TOKENS = 4_000_000
PARITY_BITS = 512

_MULT = np.random.default_rng(7).integers(1 << 62, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SETS = "doc_id long, n long, set_key binary, bands array<long>, token long, docs long"
_SETS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("set_key", pa.binary()), ("bands", pa.list_(pa.int64())), ("token", pa.int64()), ("docs", pa.int64())])


def _signed(a: np.ndarray) -> np.ndarray:
    return a.view(np.int64)


def _bands(s: np.ndarray) -> list[int]:
    m = np.empty(len(_MULT), np.uint64)
    for k, f in enumerate(_MULT):
        h = s * f
        m[k] = (h ^ (h >> np.uint64(32))).min()
    m = m.reshape(BANDS, ROWS)
    out = np.arange(1, BANDS + 1, dtype=np.uint64)
    for r in range(ROWS):
        out = (out ^ m[:, r]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(31)
    return _signed(out).tolist()


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document its set's size, key and bands; per chunk of documents its frequent tokens."""
    seen, n_seen = [], 0

    def frequent():
        t = np.concatenate(seen)
        seen.clear()
        t.sort()
        # A token of c documents stands c - HOT_IN_CHUNK + 1 times among those equal to the one so many places on.
        far = HOT_IN_CHUNK - 1
        t, c = np.unique(t[far:][t[far:] == t[:len(t) - far]], return_counts=True)
        t, c = _signed(t), c + far
        none = pa.nulls(len(t))
        return pa.RecordBatch.from_arrays([none.cast(pa.int64()), none.cast(pa.int64()), none.cast(pa.binary()), none.cast(pa.list_(pa.int64())), pa.array(t), pa.array(c.astype(np.int64))], schema=_SETS)

    for batch in batches:
        ids = batch.column(0).to_pylist()
        for lo in range(0, len(ids), 1024):
            n, key, bands = [], [], []
            for t in batch.column(1).slice(lo, 1024).to_pylist():
                s = shingles(word_ids(t))
                n.append(len(s))
                key.append(xxhash.xxh3_128_digest(s.tobytes()))
                bands.append(_bands(s) if len(s) else [])
                if len(s):
                    seen.append(s)
                    n_seen += len(s)
            none = pa.nulls(len(n)).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(ids[lo:lo + 1024], pa.int64()), pa.array(n, pa.int64()), pa.array(key, pa.binary()), pa.array(bands, pa.list_(pa.int64())), none, none], schema=_SETS)
            if n_seen >= CHUNK_TOKENS:
                yield frequent()
                n_seen = 0
    if seen:
        yield frequent()
    forget()


def _verified(pairs: DataFrame, docs: DataFrame, pct: int) -> DataFrame:
    """The pairs (a, b) whose sets link; texts of other documents do not move."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id"))
    texts = maybe_in(docs, "doc_id", id_filter(ids, "id"))
    ta, tb = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb"))
    both = pairs.join(ta, "a").join(tb, "b").select("a", "b", "ta", "tb")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_set = None, None  # a leader's rows come together
        for batch in batches:
            out = []
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo in range(0, len(a), 256):
                xs, ys = batch.column(2).slice(lo, 256).to_pylist(), batch.column(3).slice(lo, 256).to_pylist()
                for i, j, x, y in zip(a[lo:], b[lo:], xs, ys):
                    if y != last:
                        last, last_set = y, shingles(word_ids(y))
                    s = shingles(word_ids(x))
                    common = len(s) + len(last_set) - len(np.union1d(s, last_set))
                    if len(s) and len(last_set) and 100 * common >= pct * (len(s) + len(last_set) - common):
                        out.append((i, j))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=schema)
        forget()

    return both.mapInArrow(check, "a long, b long").distinct()


def _fits(a: str, b: str, pct: int) -> str:
    """Sizes of two sets that can link at all."""
    return f"100 * least({a}, {b}) >= {pct} * greatest({a}, {b})"


def _reaches(left: str, n: str, other: str, pct: int) -> str:
    """Whether ``left`` common tokens can link sets of at least these sizes."""
    return f"{100 + pct} * {left} >= {pct} * ({n} + {other})"


def _prefixes(docs: DataFrame, hot: tuple[np.ndarray, np.ndarray], pct: int) -> DataFrame:
    """(doc_id, n, tokens, bits): the rarest n - ceil(pct n) + 1 tokens of each set, in one order for all sets, and its parity bitmap."""
    shared = docs.sparkSession.sparkContext.broadcast(hot)
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("tokens", pa.list_(pa.int64())), ("bits", pa.list_(pa.int64()))])

    def prefix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, counts = shared.value
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for lo in range(0, len(ids), 1024):
                out = []
                for i, t in zip(ids[lo:lo + 1024], batch.column(1).slice(lo, 1024).to_pylist()):
                    s = shingles(word_ids(t))
                    n = len(s)
                    if not n:
                        continue
                    bits = np.packbits(np.bincount(s & np.uint64(PARITY_BITS - 1), minlength=PARITY_BITS) & 1).view(np.int64)
                    if len(tokens):
                        at = np.minimum(np.searchsorted(tokens, s), len(tokens) - 1)
                        s = s[np.argsort(np.where(tokens[at] == s, counts[at], 0), kind="stable")]
                    out.append((i, n, _signed(s[:n - -(-pct * n // 100) + 1]), bits))
                if out:
                    i, n, t, bits = zip(*out)
                    yield pa.RecordBatch.from_arrays([pa.array(i, pa.int64()), pa.array(n, pa.int64()), pa.array(t, pa.list_(pa.int64())), pa.array(bits, pa.list_(pa.int64()))], schema=schema)
        forget()

    return docs.mapInArrow(prefix, "doc_id long, n long, tokens array<long>, bits array<long>")


def _grouped(reps: DataFrame, found: DataFrame) -> DataFrame:
    """reps plus grp: the component found so far, else the representative itself."""
    return reps.join(found, reps["rep"] == found["id"], "left").select("rep", "n", F.coalesce("component", "rep").alias("grp"))


def jaccard_components(docs: DataFrame, pct: int = PCT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id: one row per row of ``docs``."""
    spark: SparkSession = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_bytes(text).alias("text"))
    described = saved(rows.mapInArrow(_describe, SETS), "jaccard-sets")
    sets = described.where("docs is null")

    # 1. One representative of equal sets.
    known = sets.where("n > 0 and doc_id is not null")
    of_set = saved(known.groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n")), "jaccard-reps")
    reps = of_set.groupBy("rep").agg(F.max("n").alias("n"))

    # 2. Groups: each member of a MinHash bucket against the bucket's first.
    banded = (known.select("doc_id", "set_key", F.explode("bands").alias("band"))
              .join(of_set.select("set_key", "rep", F.col("n").alias("m")), "set_key").where("doc_id = rep").select("band", "rep", "m"))
    banded = saved(banded, "jaccard-bands")
    large = banded.groupBy("band").agg(F.count("*").alias("c")).where("c > 1")
    banded = banded.join(large, "band")
    central = banded.groupBy("rep").agg(F.sum("c").alias("near"))
    banded = saved(banded.drop("c").join(central, "rep"), "jaccard-bands")
    leads = banded.groupBy("band").agg(F.max(F.struct("near", (-F.col("rep")).alias("first"), "rep", "m")).alias("l")).select("band", "l.rep", "l.m").toDF("band", "lead", "lead_n")
    pairs = saved(banded.join(leads, "band").where(f"rep <> lead and {_fits('m', 'lead_n', pct)}").select(F.col("rep").alias("a"), F.col("lead").alias("b")).distinct(), "jaccard-leads")
    known_docs = rows.where("doc_id is not null")
    found = saved(components(saved(_verified(pairs, known_docs, pct), "jaccard-links")), "jaccard-groups")
    member = saved(_grouped(reps, found), "jaccard-members")

    # 3. The token-group matrix, over the rarest tokens.
    top = (described.where("docs is not null").groupBy("token").agg(F.sum("docs").alias("docs"))
           .orderBy(F.desc("docs"), "token").limit(HOT_TOKENS).collect())  # at most HOT_TOKENS rows
    t = np.array([r["token"] for r in top], np.int64).view(np.uint64)
    order = np.argsort(t)
    hot = (t[order], np.array([r["docs"] for r in top], np.int64)[order])
    postings = saved(_prefixes(known_docs, hot, pct).join(member.select(F.col("rep").alias("doc_id"), "grp"), "doc_id"), "jaccard-prefixes")
    held = postings.select("doc_id", "n", "grp", F.posexplode("tokens").alias("pos", "token")).withColumn("rest", F.expr("n - pos"))  # tokens from here on
    tokens = held.groupBy("token", "grp").agg(*[f(c).cast("int").alias(a) for f, c, a in ((F.min, "n", "lo"), (F.max, "n", "hi"), (F.max, "rest", "rest"))])
    shared = saved(tokens.withColumn("groups", F.count("*").over(Window.partitionBy("token"))).where("groups > 1").drop("groups"), "jaccard-matrix")
    x, y = shared.toDF("token", "g", "g_lo", "g_hi", "g_rest"), shared.toDF("token", "h", "h_lo", "h_hi", "h_rest")
    can = f"100 * g_hi >= {pct} * h_lo and 100 * h_hi >= {pct} * g_lo and {_reaches('least(g_rest, h_rest)', 'g_lo', 'h_lo', pct)}"
    met = x.join(y, (x["token"] == y["token"]) & F.expr("g < h") & F.expr(can)).drop(y["token"])
    met = saved(met, "jaccard-open")

    # 4. Open them: members against the other group's entry, then pair by pair.
    sides = met.select(F.col("g").alias("grp"), "token", "h", "h_lo", "h_hi", "h_rest").union(met.select("h", "token", "g", "g_lo", "g_hi", "g_rest"))
    member_can = f"100 * n >= {pct} * h_lo and 100 * h_hi >= {pct} * n and {_reaches('least(rest, h_rest)', 'n', 'h_lo', pct)}"
    opened, other = held.alias("m"), sides.alias("o")
    bounded = opened.join(other, F.expr(f"m.grp = o.grp and m.token = o.token and {member_can}")).select("doc_id", "n", "m.grp", "h").distinct()
    bounded = saved(bounded, "jaccard-bounded")
    p, q = bounded.toDF("a", "na", "g", "h"), bounded.toDF("b", "nb", "h", "g")
    pairs2 = saved(p.where("g < h").join(q, ["g", "h"]).where(_fits("na", "nb", pct)).select("a", "b").distinct(), "jaccard-pairs")
    # A token in one set only flips one bit, so the bitmaps differ in no more bits than the sets in tokens.
    ba, bb = postings.select("doc_id", "n", "bits").toDF("a", "na", "ba"), postings.select("doc_id", "n", "bits").toDF("b", "nb", "bb")
    apart = "aggregate(zip_with(ba, bb, (u, v) -> bit_count(u ^ v)), 0, (s, c) -> s + c)"
    pairs2 = saved(pairs2.join(ba, "a").join(bb, "b").where(f"{100 + pct} * {apart} <= {100 - pct} * (na + nb)").select("a", "b"), "jaccard-near")
    links = _verified(pairs2, known_docs, pct)

    # 5. Components over groups.
    over = (links.join(member.select(F.col("rep").alias("a"), F.col("grp").alias("ga")), "a").join(member.select(F.col("rep").alias("b"), F.col("grp").alias("gb")), "b").select("ga", "gb"))
    joined = saved(components(saved(over, "jaccard-links"), "ga", "gb"), "jaccard-components")
    final = member.join(joined, member["grp"] == joined["id"], "left").select("rep", F.coalesce("component", "grp").alias("component_id"))
    # Every set's component by its key; ids that name several sets are joined by their representative.
    by_key = of_set.select("set_key", "rep").join(final, "rep").select("set_key", "component_id")
    plain = sets.select("doc_id", "n", "set_key")  # texts without a word share one key and need no join
    out = plain.where("n > 0").join(by_key, "set_key", "left").union(plain.where("n = 0").select("set_key", "doc_id", "n", F.lit(None).cast("long")))
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component_id", "doc_id")).cast("long").alias("component_id"))
