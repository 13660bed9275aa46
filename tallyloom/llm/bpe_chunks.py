"""Operator 4: byte-level BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over 16 bytes cuts each text into chunks of about half a kilobyte, so equal passages give equal chunks
wherever they stand. Documents are dealt to tasks by the smallest of their chunk hashes: documents that share most of
their chunks meet in one task, which encodes each different chunk once (chunks are told apart by their bytes). A chunk is
encoded in pieces that begin at likely cuts (ASCII white space after a letter, digit or mark). Where two chunks join, the
``NEAR`` pieces before and after are encoded again together. If that gives the outermost piece on either side the ids that its
chunk has for it, the two encodings agree from there on and the new ids stand between; else all joins of the text are
encoded again with twice the pieces, until they agree or the window is the whole text.

A group of copies may be any part of the corpus: keys with over 1 / ``PARTS`` of the rows (at most that many) are
dealt to several tasks, in parts of about that size. Null is the empty text and has no tokens; repeated rows stay; an
empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, mix, slices, span_hashes, table, texts
from .encoding import byte_characters, span_encoder

PARTS = 1000
WINDOW, MASK, LEAST = 16, 511, 64
#: Pieces on each side of a join that are encoded again at first; the outermost one must come out as before.
NEAR = 2
#: Bytes of chunks that a worker keeps; beyond that it begins anew.
MOST_KEPT = 16 << 20
_GEAR = np.random.default_rng(7).integers(1, 2**32, 256, dtype=np.uint32)


def chunk_starts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where the chunks of the texts of a slice begin: at each text's start and at characters before which the rolling hash says so."""
    n = len(data)
    h = _GEAR[data]
    step, factor = 1, 0x01000193
    while step < WINDOW:  # the hash of twice the bytes from two hashes
        h[step:] = h[step:] + h[:-step] * np.uint32(factor)
        step, factor = step * 2, factor * factor % 2**32
    h ^= h >> np.uint32(15)
    cut = np.flatnonzero((h * np.uint32(0x85EBCA6B) >> np.uint32(16)) & np.uint32(MASK) == 0) + 1
    cut = cut[cut < n]
    cut = cut[(data[cut] & 0xC0) != 0x80]
    if len(cut):
        near = np.searchsorted(at, cut, "right") - 1
        cut = cut[(cut - at[near] >= LEAST) & (np.diff(cut, prepend=-LEAST) >= LEAST)]
    return np.unique(np.concatenate([at[:-1][np.diff(at) > 0], cut]))


def safe_cuts(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Sorted starts of the pieces of chunks that begin at ``begins``: the chunk's start, and each ASCII white space after a
    printable ASCII character or a letter of two bytes of which the first is C3."""
    n = len(data)
    flag = np.zeros(n, bool)
    if n > 1:
        before = data[:-1]
        good = (before > 0x20) & (before < 0x7F)
        good[1:] |= (data[:-2] == 0xC3) & (before[1:] >= 0x80)
        flag[1:] = SPACE[data[1:]] & good
        two = begins + 1  # what stands before the chunk must not count
        two = two[two < n]
        flag[two] &= data[two - 1] < 0x7F
    flag[begins] = True
    return np.flatnonzero(flag)


class ChunkEncoder:
    def __init__(self, path: str):
        self.spans = span_encoder(path)
        self.kept: dict[bytes, tuple[np.ndarray, list[int], list[int]]] = {}
        self.size = self.repairs = 0

    def _learn(self, new: list[bytes]) -> None:
        """Encodes chunks: the ids, and where each piece and the end stand in the bytes and in the ids."""
        data = np.frombuffer(b"".join(new), np.uint8)
        ends = np.cumsum([len(c) for c in new])
        begins = np.concatenate([[0], ends[:-1]])
        starts = safe_cuts(data, begins)
        ids, counts = self.spans.encode_plain(data, starts, np.append(starts[1:], len(data)))
        upto = np.concatenate([[0], np.cumsum(counts)])
        first = np.searchsorted(starts, begins)
        last = np.append(first[1:], len(starts))
        for c, b, f, l in zip(new, begins.tolist(), first.tolist(), last.tolist(), strict=True):
            own = ids[upto[f] : upto[l]].astype(np.uint16)
            self.kept[c] = (own, [*(starts[f:l] - b).tolist(), len(c)], (upto[f : l + 1] - upto[f]).tolist())
            self.size += len(c) + 2 * len(own) + 16 * (l - f) + 400

    def windows(self, chunks: list[bytes], begin: int, near: int) -> tuple[list, list[tuple[int, int, np.ndarray, np.ndarray]]]:
        """Of a text that begins at the byte ``begin``: the parts of its ids, None for each window; and the windows as (first byte,
        end byte, ids that the window's must begin with, ids that they must end with)."""
        parts, found = [], []
        low, head, at = begin, None, begin  # an open window's first byte and the ids it must begin with
        for k, c in enumerate(chunks):
            ids, cut, upto = self.kept[c]
            left, right, n = k > 0, k + 1 < len(chunks), len(cut) - 1
            if n < near * (left + right) + 1:  # the window goes on over this chunk
                if not left:
                    low, head = at, ids[:0]
                if not right:
                    found.append((low, at + len(c), head, ids[:0]))
                    parts.append(None)
            else:
                if left:
                    found.append((low, at + cut[near], head, ids[upto[near - 1] : upto[near]]))
                    parts.append(None)
                a, b = near if left else 0, n - near if right else n
                parts.append(ids[upto[a] : upto[b]])
                if right:
                    low, head = at + cut[b], ids[upto[b] : upto[b + 1]]
            at += len(c)
        return parts, found

    def encode(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a slice, and each text's bounds in them."""
        if self.size > MOST_KEPT:
            self.kept, self.size = {}, 0
        begins = chunk_starts(data, at)
        raw = data.tobytes()
        chunks = [raw[s:e] for s, e in zip(begins.tolist(), np.append(begins[1:], len(data)).tolist(), strict=True)]
        if new := [c for c in dict.fromkeys(chunks) if c not in self.kept]:
            self._learn(new)
        edge = np.searchsorted(begins, at).tolist()
        first = at[:-1].tolist()
        done: list[list[np.ndarray]] = [[] for _ in first]
        near, todo = NEAR, [t for t in range(len(first)) if edge[t + 1] > edge[t]]
        while todo:
            asked = [self.windows(chunks[edge[t] : edge[t + 1]], first[t], near) for t in todo]
            ids, counts = self.spans.encode_plain(data, np.array([w[0] for _, ws in asked for w in ws], np.int64), np.array([w[1] for _, ws in asked for w in ws], np.int64))
            upto = np.concatenate([[0], np.cumsum(counts)]).tolist()
            k, again = 0, []
            for t, (parts, ws) in zip(todo, asked, strict=True):
                got = [ids[upto[k + i] : upto[k + i + 1]] for i in range(len(ws))]
                k += len(ws)
                if all(np.array_equal(g[: len(h)], h) and np.array_equal(g[len(g) - len(e) :], e) for g, (_, _, h, e) in zip(got, ws, strict=True)):
                    new_ids = iter(got)
                    done[t] = [next(new_ids) if p is None else p for p in parts]
                else:
                    again.append(t)
            todo, near = again, 2 * near
            self.repairs += len(again)
        upto = np.concatenate([[0], np.cumsum([sum(map(len, d)) for d in done])]).astype(np.int64)
        every = [p for d in done for p in d]
        return (np.concatenate(every) if every else np.zeros(0, np.uint16)), upto


def byte_table(path: str) -> list[bytes]:
    """The bytes of every id of a byte-level BPE file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    byte_of = {c: b for b, c in enumerate(byte_characters())}
    out = [b""] * (1 + max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])]))
    for token, i in spec["model"]["vocab"].items():
        out[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
    for t in spec["added_tokens"]:
        out[t["id"]] = t["content"].encode()
    return out


_chunk_encoders: dict[str, tuple] = {}


def _state(path: str) -> tuple:
    if path not in _chunk_encoders:
        table_ = byte_table(path)
        _chunk_encoders[path] = (ChunkEncoder(path), table_, [str(i).encode() for i in range(len(table_))])
    return _chunk_encoders[path]


def _with_key(batches: Iterator[pa.RecordBatch], keys_only: bool) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i, j, data, at in slices(b["text"]):
            begins = chunk_starts(data, at)
            h = span_hashes(data, begins, np.append(begins[1:], len(data))).view(np.int64)
            key = np.zeros(j - i, np.int64)
            full = np.flatnonzero(np.diff(at) > 0)
            if len(full):
                key[full] = np.minimum.reduceat(h, np.searchsorted(begins, at[full]))
            # empty texts cost nothing and are dealt by their id
            empty = np.setdiff1d(np.arange(j - i), full)
            key[empty] = mix(np.nan_to_num(b["doc_id"].slice(i, j - i).fill_null(0).to_numpy()[empty]).astype(np.uint64)).view(np.int64)
            cut = pa.array(key)
            if keys_only:
                yield pa.RecordBatch.from_arrays([cut], ["key"])
            else:
                yield pa.RecordBatch.from_arrays([cut, b["doc_id"].slice(i, j - i), b["text"].slice(i, j - i)], ["key", "doc_id", "text"])


def deal(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text), documents of like chunks together."""
    counted = docs.mapInArrow(lambda x: _with_key(x, True), "key long").groupBy("key").count()
    # Any key with over 1 / PARTS of the rows: fewer than PARTS of them, whatever the size.
    total = docs.count()
    share = max(32, total // PARTS)
    heavy = {r["key"]: -(-r["count"] // share) for r in counted.where(F.col("count") > share).collect()}
    keyed = docs.mapInArrow(lambda x: _with_key(x, False), "key long, doc_id long, text string")
    if heavy:
        parts = docs.sparkSession.createDataFrame(sorted(heavy.items()), "key long, parts int")
        keyed = keyed.join(F.broadcast(parts), "key", "left").withColumn("part", F.pmod(F.xxhash64("doc_id"), F.coalesce("parts", F.lit(1))))
    else:
        keyed = keyed.withColumn("part", F.lit(0))
    return keyed.repartition("key", "part").select("doc_id", "text")


def encode_decode(docs: DataFrame, tokenizer: str, keep: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each text; with ``keep`` also ids (array of int) and decoded (string)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, as_bytes, as_text = _state(tokenizer)
        for b in batches:
            for i, j, data, at in slices(b["text"]):
                ids, bounds = encoder.encode(data, at)
                every, cut = ids.tolist(), bounds.tolist()
                rows = [every[s:e] for s, e in zip(cut[:-1], cut[1:], strict=True)]
                digests = [hashlib.sha256(b",".join(map(as_text.__getitem__, r))).hexdigest() for r in rows]
                decoded = [b"".join(map(as_bytes.__getitem__, r)).decode("utf-8", "replace") for r in rows]
                out = [b["doc_id"].slice(i, j - i), pa.array(np.diff(bounds)), pa.array(digests), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in decoded])]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep:
                    out, names = [*out, pa.array(rows, pa.list_(pa.int32())), pa.array(decoded, pa.string())], [*names, "ids", "decoded"]
                yield pa.RecordBatch.from_arrays(out, names)

    kind = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * keep
    return deal(docs).mapInArrow(run, kind)


def op4_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_decode(texts(table(spark, sf_dir, "documents")), public_tokenizers.path("byte_bpe_50k.json"))
