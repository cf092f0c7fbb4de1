"""Token ids as length-delimited binary records (operator 1).

Record: ``u64 length | u32 masked CRC-32C of the length | payload | u32 masked
CRC-32C of the payload``, all little-endian; payload: ``i64 doc_id`` followed by
the ids as u16 (vocabularies up to 65,536 ids) or u32. Each shard ``NAME.rec``
has an index ``NAME.idx`` with one u64 offset per record, so a reader can visit
records in any order; its highest bit is set where the doc_id is null (stored as the smallest i64). Shards hold ascending ranges of doc_id.

Defined cases: a null text is an empty sequence (the end id alone); a null
doc_id sorts first; repeated doc_ids and
repeated rows each get a record, ordered by text; other columns are ignored.
An empty table gives no records. Texts of any length are encoded whole.
"""
from __future__ import annotations

import codecs
import os
import struct
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from corpusflow.llm.common import saved, work_path

CHUNK_CACHE = 600_000  # pieces that a worker remembers, in two generations
NULL_ID, NULL_BIT = -(1 << 63), 1 << 63
MANIFEST = "shard int, path string, n_records long, n_tokens long"
RECORDS = "shard int, rec long, doc_id long, in_shard long, n_tokens long, ids_crc32 long, byte_offset long, n_bytes long"

# ---- CRC-32C over many byte strings at once -------------------------------------------------
_POLY, _LANE = 0x82F63B78, 256


def _crc_tables():
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(_POLY), t >> 1).astype(np.uint32)
    x = np.arange(65536, dtype=np.uint32)
    step = lambda c: t[c & 255] ^ (c >> 8)  # noqa: E731  one zero byte more
    two = step(step(x))
    # What 256 further zero bytes make of each byte of a checksum.
    far = []
    for k in range(4):
        c = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
        for _ in range(_LANE // 2):
            c = two[c & 0xFFFF] ^ (c >> 16)
        far.append(c)
    return two, far


_TWO, _FAR = _crc_tables()


def crc32c_many(parts: list[bytes]) -> np.ndarray:
    """CRC-32C of each byte string (of at least four bytes), computed in lanes of 256 bytes side by side."""
    if not parts:
        return np.empty(0, np.uint32)
    size = np.array([len(p) for p in parts])
    lanes = -(-size // _LANE)
    ends = np.cumsum(lanes)
    buf = np.zeros(int(ends[-1]) * _LANE, np.uint8)
    for p, end in zip(parts, (ends * _LANE).tolist()):
        at = end - len(p)
        buf[at:end] = np.frombuffer(p, np.uint8)
        buf[at:at + 4] ^= 255  # the initial value; zeros in front change nothing
    words = np.ascontiguousarray(buf.view("<u2").reshape(-1, _LANE // 2).T).astype(np.uint32)
    c = np.zeros(words.shape[1], np.uint32)
    for w in words:
        c = _TWO[(c ^ w) & 0xFFFF] ^ (c >> 16)
    out, order = np.zeros(len(parts), np.uint32), np.argsort(-lanes, kind="stable")
    first, n_lanes = (ends - lanes)[order], lanes[order]
    acc = np.zeros(len(parts), np.uint32)
    top = int(n_lanes[0])
    live = np.searchsorted(-n_lanes, -np.arange(top, 0, -1), side="right")  # strings with so many lanes or more
    for left, n in zip(range(top, 0, -1), live.tolist()):
        a = acc[:n]
        a = _FAR[0][a & 255] ^ _FAR[1][(a >> 8) & 255] ^ _FAR[2][(a >> 16) & 255] ^ _FAR[3][a >> 24]
        acc[:n] = a ^ c[first[:n] + n_lanes[:n] - left]
    out[order] = acc
    return out ^ np.uint32(0xFFFFFFFF)


def masked(crc: np.ndarray) -> np.ndarray:
    """Rotated and shifted, as record files store checksums of data that may hold checksums."""
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(0xA282EAD8)


def frame(payloads: list[bytes]) -> list[bytes]:
    heads = [struct.pack("<Q", len(p)) for p in payloads]
    a, b = masked(crc32c_many(heads)).tolist(), masked(crc32c_many(payloads)).tolist()
    return [h + struct.pack("<I", x) + p + struct.pack("<I", y) for h, x, p, y in zip(heads, a, payloads, b)]


# ---- encoding -------------------------------------------------------------------------------
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^`{|}~"
_CONTROL = "\x1c\x1d\x1e\x1f"


# Byte-level vocabularies spell a byte that is no printable Latin-1 character by one from U+0100 on.
_PRINTED = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)]
_OTHERS = [b for b in range(256) if b not in _PRINTED]
_BYTES = "".join(chr(b) if b in _PRINTED else chr(256 + _OTHERS.index(b)) for b in range(256))


def _spelled(word: str) -> str:
    """A word of Latin-1 letters as a byte-level model takes it."""
    word = word.lower()
    return word if word.isascii() else codecs.charmap_decode(word.encode(), "strict", _BYTES)[0]


def _letters(word: str) -> bool:
    """Whether normalising and lower-casing leave nothing but letters."""
    return word.isalpha() and (word.isascii() or unicodedata.normalize("NFC", word).lower().isalpha())


class Encoder:
    """Whole texts to id bytes with a tokenizer that never joins anything across white space.

    The text is cut at blanks and line feeds; each distinct piece goes through
    the tokenizer once and is remembered (bounded). New words of letters only are
    encoded side by side in one text and told apart by the mark that the
    vocabulary puts at a word's end; of Latin-1 letters, by the model alone, where
    all that comes before it does is lower-case them and spell their bytes. This holds for tokenizers whose
    pre-tokenizer drops white space; others get each text in one piece.
    """

    def __init__(self, path: str, dtype: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tok, self.dtype = Tokenizer.from_file(path), dtype
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}  # the generation before: what is met again is taken over
        self.split = self._ids("a b") == self._ids("a") + self._ids("b") and not self._ids(" \n")
        suffix = getattr(self.tok.model, "end_of_word_suffix", None)
        size = self.tok.get_vocab_size()
        self.ends = np.array([bool(suffix) and (self.tok.id_to_token(i) or "").endswith(suffix) for i in range(size)])
        self.marks = bool(suffix) and self.split and self._ids("a,.") == self._ids("a") + self._ids(",.")
        letters = [c for c in map(chr, range(256)) if c.isalpha()]
        probes = [*letters, "".join(letters), "theThEtHe", *(a + b for a in letters for b in letters)]
        self.direct = self.split and all(self._ids(w) == self._model_ids(w) for w in probes)

    def _ids(self, text: str) -> list[int]:
        return self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _model_ids(self, word: str) -> list[int]:
        return [t.id for t in self.tok.model.tokenize(_spelled(word))]

    def _bytes(self, text: str) -> bytes:
        return np.array(self._ids(text), self.dtype).tobytes()

    def _learn(self, pieces: set[str]) -> None:
        known, words, marked, rest = self.known, {}, [], []
        for p in pieces:
            if p.isalpha():
                words[p] = None
            else:
                core = p.rstrip(_MARKS) if self.marks else p
                if len(core) < len(p) and _letters(core):  # marks after letters are a token run of their own
                    marked.append((p, core))
                    if core not in known:
                        words[core] = None
                else:
                    rest.append(p)
        if self.direct:
            tokenize, plain, others, flat, ends = self.tok.model.tokenize, [], [], [], []
            for w in words:
                if not w.isascii():
                    try:
                        w.encode("latin-1")
                    except UnicodeEncodeError:
                        others.append(w)
                        continue
                plain.append(w)
                flat += [t.id for t in tokenize(_spelled(w))]
                ends.append(len(flat))
            words = others
            raw, at, step = np.array(flat, self.dtype).tobytes(), 0, np.dtype(self.dtype).itemsize
            for w, end in zip(plain, ends):
                known[w] = raw[at:end * step]
                at = end * step
        words = list(words)
        if self.marks and words:
            ids = np.array(self._ids(" ".join(words)), self.dtype)
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(words) and ends[-1] == len(ids):
                raw, at, step = ids.tobytes(), 0, ids.itemsize
                for w, end in zip(words, (ends * step).tolist()):
                    known[w] = raw[at:end]
                    at = end
                words = []
        rest += words
        if rest:
            for p, e in zip(rest, self.tok.encode_batch_fast(rest, add_special_tokens=False)):
                known[p] = np.array(e.ids, self.dtype).tobytes()
        for p, core in marked:
            tail = p[len(core):]
            if tail not in known:
                known[tail] = self._bytes(tail)
            known[p] = known[core] + known[tail]

    def __call__(self, text: str) -> bytes:
        return self.many([text])[0]

    def many(self, texts: list[str]) -> list[bytes]:
        """The ids of each text; what is new in them is learned together."""
        if not self.split:
            return [self._bytes(t) for t in texts]
        known, old = self.known, self.old
        texts_found, waiting, new = [], [], set()
        for text in texts:
            # Python's white space is the tokenizer's and four control characters.
            pieces = text.replace("\n", " ").split(" ") if any(c in text for c in _CONTROL) else text.split()
            found = list(map(known.get, pieces))
            texts_found.append(found)
            if None in found:
                at = [k for k, f in enumerate(found) if f is None]
                if old:
                    for k in at:
                        if (f := old.get(pieces[k])) is not None:
                            found[k] = known[pieces[k]] = f
                    at = [k for k in at if found[k] is None]
                new.update([pieces[k] for k in at])
                waiting.append((found, pieces, at))
        if new:
            self._learn(new)
        for found, pieces, at in waiting:
            for k in at:
                found[k] = known[pieces[k]]
        if len(known) > CHUNK_CACHE // 2:
            self.known, self.old = {}, known
        return [b"".join(found) for found in texts_found]


_ENC: dict[tuple, Encoder] = {}


def encoder(path: str, dtype: str) -> Encoder:
    if (path, dtype) not in _ENC:
        _ENC[path, dtype] = Encoder(path, dtype)
    return _ENC[path, dtype]


def _fs(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return (pafs.LocalFileSystem(), uri) if uri.startswith("/") else pafs.FileSystem.from_uri(uri)


def _payload(p: bytes, dtype: str, null: bool) -> tuple[int | None, np.ndarray]:
    """doc_id and ids of a payload."""
    return None if null else struct.unpack("<q", p[:8])[0], np.frombuffer(p, dtype, offset=8)


def write_records(docs: DataFrame, tokenizer: str, out_dir: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and write all texts in ascending order of id; one shard and one index file a task.

    Returns the manifest (shard, path, n_records, n_tokens). The texts move once, to
    ranges of ids. A task writes under a name of its own attempt and renames at
    the end, so a repeated task replaces its shard by an equal one.
    """
    import json
    fs, root = _fs(out_dir)
    with open(tokenizer, encoding="utf-8") as f:
        spec = json.load(f)
    n_ids = 1 + max([end_id, *spec["model"]["vocab"].values(), *(t["id"] for t in spec.get("added_tokens", []))])
    dtype = "<u2" if n_ids <= 1 << 16 else "<u4"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _fs(out_dir)
        enc, ctx = encoder(tokenizer, dtype), TaskContext.get()
        end = np.array([end_id], dtype).tobytes()
        name = f"{root}/shard-{ctx.partitionId():06d}"
        own = f"{name}.{ctx.taskAttemptId()}"
        rec, offsets, at, n_tokens = None, [], 0, 0
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for lo in range(0, len(ids), 256):
                texts = batch.column(1).slice(lo, 256).to_pylist()
                payloads = [struct.pack("<q", NULL_ID if i is None else i) + e + end for i, e in zip(ids[lo:lo + 256], enc.many(texts))]
                if rec is None:
                    fs.create_dir(root, recursive=True)
                    rec = fs.open_output_stream(own + ".rec")
                for i, p, r in zip(ids[lo:lo + 256], payloads, frame(payloads)):
                    offsets.append(at | NULL_BIT if i is None else at)
                    at += len(r)
                    n_tokens += (len(p) - 8) // np.dtype(dtype).itemsize
                    rec.write(r)
        if rec is None:
            return
        rec.close()
        with fs.open_output_stream(own + ".idx") as f:
            f.write(np.array(offsets, "<u8").tobytes())
        fs.move(own + ".rec", name + ".rec")
        fs.move(own + ".idx", name + ".idx")
        yield pa.RecordBatch.from_pylist([{"shard": ctx.partitionId(), "path": name, "n_records": len(offsets), "n_tokens": n_tokens}],
                                         schema=pa.schema([("shard", pa.int32()), ("path", pa.string()), ("n_records", pa.int64()), ("n_tokens", pa.int64())]))

    fs.create_dir(root, recursive=True)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    placed = rows.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    out = saved(placed.mapInArrow(write, MANIFEST), "record-manifest")
    return out.withColumn("dtype", F.lit(dtype)).withColumn("out_dir", F.lit(out_dir))


def read_records(manifest: DataFrame) -> DataFrame:
    """Read every record back from its shard, checking lengths and checksums; one row a record.

    ``in_shard``: ids before the record in its shard. A damaged file raises.
    """
    schema = pa.schema([("shard", pa.int32()), ("rec", pa.int64()), ("doc_id", pa.int64()), ("in_shard", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids_crc32", pa.int64()), ("byte_offset", pa.int64()), ("n_bytes", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, _ = _fs(row["out_dir"])
                with fs.open_input_file(row["path"] + ".idx") as f:
                    offsets = np.frombuffer(f.read(), "<u8").tolist()
                before = 0
                with fs.open_input_stream(row["path"] + ".rec") as f:
                    for lo in range(0, len(offsets), 512):
                        part, heads, payloads, sums = offsets[lo:lo + 512], [], [], []
                        for _ in part:
                            h = f.read(12)
                            heads.append(h)
                            payloads.append(f.read(struct.unpack("<Q", h[:8])[0]))
                            sums.append(struct.unpack("<I", f.read(4))[0])
                        if masked(crc32c_many([h[:8] for h in heads])).tolist() != [struct.unpack("<I", h[8:])[0] for h in heads] or masked(crc32c_many(payloads)).tolist() != sums:
                            raise ValueError(f"{row['path']}.rec: a checksum differs in records {lo} to {lo + len(part)}")
                        docs, sizes, sums = [], [], []
                        for p, o in zip(payloads, part):
                            doc, ids = _payload(p, row["dtype"], o >= NULL_BIT)
                            docs.append(doc)
                            sizes.append(len(ids))
                            sums.append(zlib.crc32(ids.astype("<u4")))
                        ends = before + np.cumsum(sizes)
                        columns = [np.full(len(part), row["shard"], np.int32), lo + np.arange(len(part)), docs, ends - sizes, sizes, sums,
                                   [o & ~NULL_BIT for o in part], [len(p) + 16 for p in payloads]]
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
                        before = int(ends[-1])

    n = max(1, manifest.count())
    return manifest.repartition(n, "shard").mapInArrow(read, RECORDS)


def read_ids(path: str, dtype: str, order: list[int], out_dir: str = "/") -> list[tuple[int, np.ndarray]]:
    """Records of one shard in any order, through the offset index."""
    fs, _ = _fs(out_dir)
    with fs.open_input_file(path + ".idx") as f:
        offsets = np.frombuffer(f.read(), "<u8")
    out = []
    with fs.open_input_file(path + ".rec") as f:
        for k in order:
            f.seek(int(offsets[k]) & ~NULL_BIT)
            p = f.read(struct.unpack("<Q", f.read(12)[:8])[0])
            out.append(_payload(p, dtype, int(offsets[k]) >= NULL_BIT))
    return out


def token_records(docs: DataFrame, tokenizer: str, out_dir: str | None = None, end_id: int = 1) -> DataFrame:
    """Write and read back: doc_id, start, n_tokens, ids_crc32, shard, rec, byte_offset, n_bytes."""
    spark: SparkSession = docs.sparkSession
    manifest = write_records(docs, tokenizer, out_dir or work_path(spark, "records"), end_id)
    w = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row a shard
    first = manifest.select("shard", F.coalesce(F.sum("n_tokens").over(w), F.lit(0)).cast("long").alias("first"))
    return (read_records(manifest).join(F.broadcast(first), "shard")
            .select("doc_id", (F.col("first") + F.col("in_shard")).alias("start"), "n_tokens", "ids_crc32", "shard", "rec", "byte_offset", "n_bytes"))
