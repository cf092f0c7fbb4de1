"""Line deduplication with a segment-partition edit join (operator 8).

Equal lines, and lines within ``max_edits`` insertions, deletions and
replacements (of ``min_chars`` characters or more), are linked; of each
connected class the first line (smallest doc_id, then position) stays and the
others go. Blank lines always stay.

Edit join: each distinct line is cut into ``max_edits`` + 1 segments; a line
within that many edits holds one of them unchanged. The index has (length,
number, segment); a line probes it for every length up to ``max_edits`` below
its own, with the substrings whose place a match could have. Pairs that meet
are verified by a banded bit-parallel edit distance.

Keys are shuffled as 64-bit hashes; only keys that two different lines share go
on, so most rows end there. All lines of a key are first compared with one of
them, its leader (the line that meets most others under its keys, which stands in
the middle of its copies); what is linked is contracted to components, the leader
leaves, and a key whose lines are in one component is settled. Of the others,
keys that more than ``BUCKET`` lines share go through ``ROUNDS`` further rounds,
and are then refined: an edit changes how often at most two characters occur, so of
2 * max_edits + 3 classes of characters three at least have the same counts in
both lines, and one key per three classes, with those classes' characters of the
whole line, takes the key's place. Under the short keys that are left, lines of
different components are paired if their counts of characters in eight classes
differ by 2 * max_edits at most in all, as those of linked lines do. None of this
loses a link between components.

Lines are identified by 63-bit hashes. Defined cases: null and empty texts have
no lines; rows with a null doc_id come first; rows with the same doc_id are told
apart by their text; repeated rows are one document; other columns are
ignored; empty tables give no rows; lines of any length are compared whole.
"""
from __future__ import annotations

import itertools
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from corpusflow.llm.common import id_filter, maybe_in, saved
from corpusflow.llm.components import components

MAX_EDITS, MIN_CHARS, BUCKET = 2, 20, 512
ROUNDS = 3


def _shared_start(a: str, b: str) -> int:
    lo, hi = 0, min(len(a), len(b))
    if a[:hi] == b[:hi]:
        return hi
    while hi - lo > 1:  # a[:lo] is shared, a[:hi] is not
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def within(a: str, b: str, k: int) -> bool:
    """Whether the edit distance is k at most: a band of 2k + 2 cells a column, held in the bits of an integer."""
    if abs(len(a) - len(b)) > k:
        return False
    n = _shared_start(a, b)
    a, b = a[n:], b[n:]
    n = _shared_start(a[::-1], b[::-1])
    if n:
        a, b = a[:-n], b[:-n]
    m = len(a)
    if not m or not b:
        return max(m, len(b)) <= k
    width = 2 * k + 2
    top, full = width - 1, (1 << width) - 1
    above = ((1 << (k + 1)) - 1) << (top - k)  # cells one larger than the one above, in the column before
    below = 0
    cost = min(k, m)
    for j, c in enumerate(b, 1):
        first = j + k - top - 1  # place in a of bit 0
        equal = 0
        for t in range(max(0, -first), min(width, m - first)):
            if a[first + t] == c:
                equal |= 1 << t
        same = ((((equal & above) + above) ^ above) | equal | below) & full  # as large as the cell diagonally before
        right_up, right_down = (below | ~(same | above)) & full, same & above
        if j + k <= m:
            cost += not (same >> top) & 1
        else:
            t = top - (j + k - m)
            cost += ((right_up >> t) & 1) - ((right_down >> t) & 1)
        # What is left can lower the cost by one a column after the band has met the last row.
        if cost - max(0, len(b) - max(j, m - k)) > k:
            return False
        down = same >> 1
        above, below = (right_down | ~(down | right_up)) & full, down & right_up
    return cost <= k


def segments(n: int, parts: int) -> list[tuple[int, int]]:
    """(start, length) of each of ``parts`` segments of a line of n characters; the later ones are longer by one."""
    short, longer = divmod(n, parts)
    out, at = [], 0
    for k in range(parts):
        size = short + (k >= parts - longer)
        out.append((at, size))
        at += size
    return out


def _hash(text: str, length: int, number: int) -> int:
    h = xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"), seed=length * 64 + number)
    return h - (1 << 64) if h >> 63 else h


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of the base and of its inverse, modulo 2**64."""
    if len(_POWERS[0]) <= n:
        for k, base in enumerate((_BASE, _INVERSE)):
            p = np.full(2 * n + 1, base, np.uint64)
            p[0] = 1
            _POWERS[k] = np.multiply.accumulate(p)
    return _POWERS[0][:n + 1], _POWERS[1][:n + 1]


def keys_of(lines: list[str], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, probe, owner) of the index entries and probes of all lines side by side.

    The hash of any substring is the difference of two sums of a polynomial over
    the characters; it depends on the characters, not on their place.
    """
    n = np.fromiter(map(len, lines), np.int64, len(lines))
    start = np.cumsum(n) - n
    codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), "<u4")
    power, inverse = _powers(len(codes))
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(_mixed(codes.astype(np.uint64) + np.uint64(1)) * power[:len(codes)], out=sums[1:])
    keys, probes, owners = [], [], []

    def add(which, at, size, length, number, probe):
        s = (start + at)[which]
        h = (sums[s + size[which]] - sums[s]) * inverse[s]
        keys.append(_mixed(h ^ _mixed((length[which] * 64 + number).astype(np.uint64))))
        owners.append(np.flatnonzero(which))
        probes.append(np.full(len(s), probe))

    def cut(length):
        """(start, size) of each segment, as ``segments`` has them."""
        short, longer = np.divmod(length, k + 1)
        at = np.zeros_like(length)
        for i in range(k + 1):
            size = short + (i >= k + 1 - longer)
            yield i, at, size
            at = at + size

    every = np.ones(len(lines), bool)
    for i, at, size in cut(n):
        add(every, at, size, n, i, False)
    for less in range(k + 1):
        for i, at, size in cut(n - less):
            # Of the edits, at least i come before the segment if it is the first that matches,
            # so its place differs by i at most on the left and by the rest of the edits on the right.
            lo = np.maximum(0, np.maximum(at - i, at + less - (k - i)))
            hi = np.minimum(n - size, np.minimum(at + i, at + less + (k - i)))
            for step in range(2 * k + 1):
                which = (lo + step <= hi) & (n - less > k)
                if which.any():
                    add(which, lo + step, size, n - less, i, True)
    return np.concatenate(keys).view(np.int64), np.concatenate(probes), np.concatenate(owners)


def line_keys(line: str, k: int) -> tuple[list[int], list[int]]:
    """The keys of a line's index entries, and of its probes."""
    key, probe, _ = keys_of([line], k)
    return key[~probe].tolist(), key[probe].tolist()


def line_id(line: str = "line"):
    """63 bits of a line's hash; the lowest bit is free, for a row of its keys to say that it is a probe."""
    return F.shiftleft(F.shiftright(F.xxhash64(line), 1), 1)


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, pos, line): the lines of all texts."""
    return docs.where("text is not null and text <> ''").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_id"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))


def character_classes(line: str, k: int) -> list[int]:
    """For each three of 2k + 3 classes of characters, a hash of how many of each the line has."""
    n = 2 * k + 3
    held: list[list[str]] = [[] for _ in range(n)]
    for c in sorted(line):
        held[ord(c) % n].append(c)
    texts = ["".join(h) for h in held]
    return [_hash("".join(texts[i] for i in three), 0, no) for no, three in enumerate(itertools.combinations(range(n), 3))]


def _linked(pairs: DataFrame, texts: DataFrame, max_edits: int) -> DataFrame:
    """The pairs (a, b) of line ids that are within max_edits."""
    both = pairs.join(texts.toDF("a", "la"), "a").join(texts.toDF("b", "lb"), "b")
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                a, b, la, lb = (batch.column(k).slice(lo, 1024) for k in range(4))
                keep = pa.array([within(p, q, max_edits) for p, q in zip(la.to_pylist(), lb.to_pylist())], pa.bool_())
                yield pa.RecordBatch.from_arrays([a, b], schema=out).filter(keep)

    return saved(both.select("a", "b", "la", "lb").mapInArrow(check, "a long, b long"), "line-links")


def _line(tag: str):
    return F.shiftleft(F.shiftright(tag, 1), 1)


def _members(tagged: DataFrame) -> DataFrame:
    """(key, line, probe, entry): one row per key and line, from rows (key, tag)."""
    probe = F.col("tag").bitwiseAND(1)
    return tagged.groupBy("key", _line("tag").alias("line")).agg((F.max(probe) == 1).alias("probe"), (F.min(probe) == 0).alias("entry"))


def counts_of(line: str) -> int:
    """How many characters of each of eight classes a line has, modulo 256, in the bytes of an integer."""
    n = [0] * 8
    for c, times in Counter(line).items():
        n[ord(c) * 11 >> 2 & 7] += times
    return int.from_bytes(bytes(x & 255 for x in n), "little", signed=True)


def _meet(max_edits: int) -> str:
    """Whether lines x and y can be linked under a key that both have."""
    byte = lambda side, i: f"(shiftright({side}.counts, {8 * i}) & 255)"
    apart = " + ".join(f"least(abs({d}), 256 - abs({d}))" for d in (f"{byte('x', i)} - {byte('y', i)}" for i in range(8)))
    return f"((x.entry and y.probe) or (x.probe and y.entry)) and {apart} <= {2 * max_edits}"


HELD = ["key", "line", "probe", "entry", "near", "counts"]


def _labelled(held: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The members with the component of their line, and the keys whose members are in several: (key, n, x: the leader)."""
    found = components(links)
    lab = saved(held.join(found, held["line"] == found["id"], "left").select(*HELD, F.coalesce("component", "line").alias("comp")), "line-labels")
    per = lab.groupBy("key").agg(F.count("*").alias("n"), F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.max(F.struct("near", "line", "probe", "entry", "counts", "comp")).alias("x"))
    return lab, saved(per.where("lo <> hi").select("key", "n", "x"), "line-open")


def _contracted(lab: DataFrame, per: DataFrame, links: DataFrame, texts: DataFrame, max_edits: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rounds of comparing a key's members with one of them. Returns all links, and the labelled members and keys that are still open."""
    for _ in range(ROUNDS):
        if per.isEmpty():
            break
        members = saved(lab.alias("y").join(per, "key").where("y.line <> x.line").select("key", *[f"y.{c}" for c in HELD[1:]], "y.comp", "x"), "line-members")
        stars = members.alias("y").where(f"comp <> x.comp and {_meet(max_edits)}").select(F.col("x.line").alias("a"), F.col("line").alias("b")).distinct()
        links = links.union(_linked(saved(stars, "line-stars"), texts, max_edits))
        lab, per = _labelled(members.select(*HELD), links)  # the leader has met all others
    return links, lab, per


def _across(lab: DataFrame, per: DataFrame, max_edits: int) -> DataFrame:
    """Pairs of different components that meet under an open key."""
    rows = lab.join(per.select("key"), "key", "left_semi")
    x, y = rows.alias("x"), rows.alias("y")
    met = x.join(y, F.expr(f"x.key = y.key and x.line < y.line and x.comp <> y.comp and {_meet(max_edits)}"))
    return met.select(F.col("x.line").alias("a"), F.col("y.line").alias("b")).distinct()


def near_lines(docs: DataFrame, max_edits: int = MAX_EDITS, min_chars: int = MIN_CHARS, bucket: int = BUCKET) -> DataFrame:
    """(a, b): links between different lines within ``max_edits`` that have all their components."""
    long_lines = _lines(docs).where(F.length("line") >= min_chars).select(line_id().alias("id"), "line")
    schema = pa.schema([("key", pa.int64()), ("tag", pa.int64())])

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # lines of this task; forgotten when large, which only repeats rows
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                fresh = {}
                for i, line in zip(batch.column(0).slice(lo, 2048).to_pylist(), batch.column(1).slice(lo, 2048).to_pylist()):
                    if i not in seen:
                        fresh[i] = line
                if len(seen) > 500_000:
                    seen.clear()
                seen.update(fresh)
                if fresh:
                    key, probe, owner = keys_of(list(fresh.values()), max_edits)
                    ids = np.fromiter(fresh, np.int64, len(fresh))
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(ids[owner] | probe)], schema=schema)

    rows = long_lines.mapInArrow(keys, "key long, tag long")
    w = Window.partitionBy("key")
    shared = rows.withColumn("lo", F.min("tag").over(w)).withColumn("hi", F.max("tag").over(w)).where("shiftright(lo, 1) <> shiftright(hi, 1)")
    held = saved(_members(shared.select("key", "tag")), "line-members")
    texts = maybe_in(long_lines, "id", id_filter(held.select("line").distinct(), "line")).groupBy("id").agg(F.first("line").alias("line"))
    texts = saved(texts, "line-texts")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(counts_of, batch.column(1).to_pylist()), pa.int64())], names=["line", "counts"])

    # The first round, in which each line is a component of its own.
    near = held.join(held.groupBy("key").agg(F.count("*").alias("n")), "key").groupBy("line").agg(F.sum("n").alias("near"))
    about = near.join(texts.mapInArrow(counted, "line long, counts long"), "line")
    held = saved(held.join(about, "line"), "line-members")
    leads = held.groupBy("key").agg(F.max(F.struct("near", "line", "probe", "entry", "counts")).alias("x"))
    held = saved(held.join(leads, "key").where("line <> x.line"), "line-members")
    stars = held.alias("y").where(_meet(max_edits)).select(F.col("x.line").alias("a"), F.col("line").alias("b")).distinct()
    links = _linked(saved(stars, "line-stars"), texts, max_edits)
    lab, per = _labelled(held.select(*HELD), links)
    short, long_ = per.where(F.col("n") <= bucket), per.where(F.col("n") > bucket)
    pairs = _across(lab, short, max_edits)
    if not long_.isEmpty():
        links, lab, per = _contracted(lab, long_, links, texts, max_edits)
        links, more = _refined(lab, per, links, texts, max_edits, bucket)
        pairs = pairs.union(more).distinct()
    return links.union(_linked(saved(pairs, "line-pairs"), texts, max_edits))


def _refined(lab: DataFrame, per: DataFrame, links: DataFrame, texts: DataFrame, max_edits: int, bucket: int) -> tuple[DataFrame, DataFrame]:
    """Long keys that are still open: one key for each three classes of characters instead. Returns all links, and the pairs that are left."""
    cls = pa.schema([("id", pa.int64()), ("classes", pa.list_(pa.int64()))])

    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                part = batch.slice(lo, 2048)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([character_classes(t, max_edits) for t in part.column(1).to_pylist()], pa.list_(pa.int64()))], schema=cls)

    open_ = lab.join(per.select("key"), "key", "left_semi")
    by_line = texts.join(open_.select(F.col("line").alias("id")).distinct(), "id", "left_semi").mapInArrow(classes, "id long, classes array<long>")
    finer = open_.join(by_line, F.col("line") == F.col("id")).select(*HELD, F.posexplode("classes").alias("c", "h")).withColumn("key", F.xxhash64("key", "c", "h")).select(*HELD).distinct()
    lab, per = _labelled(saved(finer, "line-finer"), links)
    pairs = _across(lab, per.where(F.col("n") <= bucket), max_edits)
    long_ = per.where(F.col("n") > bucket)
    if not long_.isEmpty():
        links, lab, per = _contracted(lab, long_, links, texts, max_edits)
        pairs = pairs.union(_across(lab, per, max_edits))
    return links, pairs


def line_dedup(docs: DataFrame, max_edits: int = MAX_EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per document: doc_id, n_lines (not blank), n_dropped, n_near (dropped for an unequal line), dropped (positions), text_id."""
    lines = saved(_lines(docs).where(F.col("line").rlike(r"[^\x20\x09-\x0D]")).select("doc_id", "text_id", "pos", line_id().alias("id")), "lines")
    found = components(saved(near_lines(docs, max_edits, min_chars), "line-links"))
    place = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "text_id", "pos")
    firsts = lines.groupBy("id").agg(F.min(place).alias("own")).join(found, "id", "left").select("id", "own", F.coalesce("component", "id").alias("cls"))
    firsts = saved(firsts, "line-firsts")
    keeps = firsts.select("id", "own", "cls").join(firsts.groupBy("cls").agg(F.min("own").alias("keep")), "cls").select("id", "own", "keep")
    marked = lines.join(keeps, "id").select("doc_id", "text_id", "pos", F.when(place != F.col("keep"), F.col("pos")).alias("gone"), F.when((place == F.col("own")) & (place != F.col("keep")), F.col("pos")).alias("near"))
    per = marked.groupBy("doc_id", "text_id").agg(F.collect_set("pos").alias("all"), F.collect_set("gone").alias("gone"), F.collect_set("near").alias("near"))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_id")).distinct()
    none = F.array().cast("array<int>")
    return (base.alias("d").join(per.alias("p"), F.col("d.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("d.text_id") == F.col("p.text_id")), "left")
            .select("d.doc_id", F.size(F.coalesce("all", none)).cast("long").alias("n_lines"), F.size(F.coalesce("gone", none)).cast("long").alias("n_dropped"),
                    F.size(F.coalesce("near", none)).cast("long").alias("n_near"), F.sort_array(F.coalesce("gone", none)).alias("dropped"), "d.text_id"))


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with the dropped lines taken out of their texts; one row per distinct document."""
    per = line_dedup(docs, **options).select(F.col("doc_id").alias("__id"), F.col("text_id").alias("__text"), F.col("dropped").alias("__dropped"))
    rows = docs.dropDuplicates(["doc_id", "text"])
    j = rows.join(per, rows["doc_id"].cast("long").eqNullSafe(per["__id"]) & (F.xxhash64(rows["text"]) == per["__text"]))
    kept = F.expr("array_join(filter(split(text, '\n'), (l, k) -> not array_contains(__dropped, k)), '\n')")
    return j.withColumn("text", F.when(F.size("__dropped") > 0, kept).otherwise(F.col("text"))).select(*docs.columns)
