"""Benchmark decontamination by size-partitioned MinHash containment search (operator 10).

Test items are short and documents long, so their Jaccard similarity says
little; what counts is the share of an item's word shingles that a document
holds. Items are partitioned by size (powers of two of their number of
shingles). Each partition has a bottom-k MinHash sketch per item, with k from
the partition's upper size so that k is more than the shingles a match may
lack: a document with the required share of an item then holds one of its k
sketch values at least, and the search loses nothing. Whatever a document hits
is verified by the exact share of the item's shingles (64-bit hashes of all).

Shingles: five words ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased; an item of
fewer words is one shingle of that many, looked for among the document's runs
of as many words. Defined cases: null or empty texts match nothing and are
matched by nothing; null ids are kept as null; repeated rows of documents each
give their rows, of repeated items (same item_id, null included) the text counts of which
the document holds the largest share, of equal shares the longest; other columns are ignored; empty tables give no rows.

The items reach the tasks in blocks of bounded size (``block_shingles``
hashes), each block in one pass over the documents, which are not shuffled.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusflow.llm.common import SHINGLE_WORDS, forget, shingles, text_bytes, word_ids

THRESHOLD_PCT = 80
BLOCK_SHINGLES = 1_000_000
MATCHES = "doc_id long, item_id long, n_item_shingles long, n_common long, containment double"
_MATCHES = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("n_item_shingles", pa.int64()), ("n_common", pa.int64()), ("containment", pa.float64())])


class ItemIndex:
    """Sketches and full shingle sets of a block of items. items: (item_id, text as bytes)."""

    def __init__(self, items: list[tuple[int | None, bytes]], pct: int):
        self.pct, self.ids, self.sets, self.widths = pct, [], [], {SHINGLE_WORDS}
        values, owners = [], []
        for item_id, text in items:
            ids = word_ids(text)
            s = shingles(ids)
            if not len(s):
                continue
            if len(ids) < SHINGLE_WORDS:
                self.widths.add(len(ids))
            upper = (1 << int(len(s)).bit_length()) - 1  # of the item's size partition
            k = upper - -(-upper * pct // 100) + 1
            values.append(s[:k])  # ascending hashes: the smallest are the bottom-k sketch
            owners.append(np.full(len(values[-1]), len(self.ids), np.int64))
            self.ids.append(item_id)
            self.sets.append(s)
        v, o = (np.concatenate(values), np.concatenate(owners)) if values else (np.empty(0, np.uint64), np.empty(0, np.int64))
        order = np.argsort(v, kind="stable")
        self.values, self.owners = v[order], o[order]

    def matches(self, text: bytes) -> list[tuple[int | None, int, int]]:
        ids = word_ids(text)
        have = shingles(ids)
        short = [w for w in self.widths if w < SHINGLE_WORDS and w <= len(ids)]
        if short:
            have = np.unique(np.concatenate([have, *(shingles(ids, w) for w in short)]))
        if not len(have) or not len(self.values):
            return []
        lo, hi = np.searchsorted(self.values, have, "left"), np.searchsorted(self.values, have, "right")
        hit = hi > lo
        if not hit.any():
            return []
        found = np.unique(np.concatenate([self.owners[a:b] for a, b in zip(lo[hit].tolist(), hi[hit].tolist())]))
        best: dict[int | None, tuple[int, int]] = {}
        for k in found.tolist():
            s = self.sets[k]
            at = np.minimum(np.searchsorted(have, s), len(have) - 1)
            common = int((have[at] == s).sum())
            if 100 * common >= self.pct * len(s):
                n, c = best.get(self.ids[k], (1, 0))
                if (common * n, len(s)) > (c * len(s), n):
                    best[self.ids[k]] = len(s), common
        return [(i, n, c) for i, (n, c) in best.items()]


def _blocks(items: DataFrame, id_col: str, text_col: str, block_shingles: int) -> Iterator[list[tuple[int | None, bytes]]]:
    """Items in blocks of bounded size; the texts of one item_id are in one block."""
    block, n = [], 0
    rows = items.select(F.col(id_col).cast("long").alias("i"), text_bytes(text_col).alias("t")).distinct()
    for row in rows.repartitionByRange("i").sortWithinPartitions("i").toLocalIterator():
        if n >= block_shingles and row["i"] != block[-1][0]:
            yield block
            block, n = [], 0
        block.append((row["i"], bytes(row["t"])))
        n += len(row["t"]) // 2 + 1  # a word takes two bytes at least
    if block:
        yield block


def contaminated(docs: DataFrame, items: DataFrame, pct: int = THRESHOLD_PCT, block_shingles: int = BLOCK_SHINGLES,
                 doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, n_item_shingles, n_common, containment) for all pairs with enough of the item in the document."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_bytes(doc_text).alias("text"))
    out = None
    for block in _blocks(items, item_id, item_text, block_shingles):
        shared = spark.sparkContext.broadcast(ItemIndex(block, pct))

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                ids = batch.column(0).to_pylist()
                for lo in range(0, len(ids), 1024):
                    found = []
                    for i, t in zip(ids[lo:lo + 1024], batch.column(1).slice(lo, 1024).to_pylist()):
                        found += [(i, item, n, c, c / n) for item, n, c in index.matches(t)]
                    if found:
                        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*found), _MATCHES)], schema=_MATCHES)
            forget()

        part = rows.mapInArrow(search, MATCHES)
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], MATCHES)
    return out


def filtered(docs: DataFrame, items: DataFrame, pct: int = THRESHOLD_PCT, block_shingles: int = BLOCK_SHINGLES,
             doc_text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` (all columns) that hold enough of no item, judged in place: no join, no shuffle."""
    at = docs.columns.index(doc_text)
    for block in _blocks(items, item_id, item_text, block_shingles):
        shared = docs.sparkSession.sparkContext.broadcast(ItemIndex(block, pct))

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                for lo in range(0, batch.num_rows, 1024):
                    part = batch.slice(lo, 1024)
                    yield part.filter(pa.array([not index.matches(t or b"") for t in part.column(at).cast(pa.binary()).to_pylist()], pa.bool_()))
            forget()

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
