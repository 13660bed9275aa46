"""Operator 6: benchmark decontamination by size-partitioned MinHash containment search.

Test items are grouped by their number of word shingles into sizes up to 16, 32, 64 and so on. For each size the
shingles of a document are covered by windows of twice that many, half overlapping, so an item of the size that stands
in the document lies wholly in one window of at most four times its shingles, however long the document is. Windows
and items get one-permutation MinHash signatures of ``BINS`` bins; a window and an item that agree in any bin are
candidates, and a candidate pair counts if the document holds at least ``threshold`` of the item's different shingles
exactly (compared as 64-bit hashes of five lower-cased words).

Items of at most ``FEW`` shingles have too few bins to be found for sure: of n shingles of which m must stand in a document,
n - m + 1 are looked up themselves, so that one of them is there if the item is.

Equal items are one. Items are indexed in blocks of at most ``ITEMS`` rows, which the driver makes and writes to shared storage one
at a time; a task holds one block at a time too and loads it once for ``GROUP_BYTES`` of texts, of which the shingles are made once, so
a benchmark of any size takes more searches of each group, not more memory or more scans. Null and empty texts, on either side, match nothing; a text of fewer than five words is one shingle; repeated rows give
repeated pairs of documents and one of items; empty tables give no rows. Extra columns are ignored.
"""

from __future__ import annotations

import os
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import file_system, mix, ranges, row_of, shared_dir, slices, span_hashes, spans, table, texts, windows

WORDS, THRESHOLD, BINS, SMALLEST, FEW = 5, 0.8, 128, 16, 8
#: Most items, and most bytes of their texts, in a pass over the documents.
ITEMS, ITEM_BYTES = 20_000, 32 << 20
#: Bytes of texts for which a task loads each block of items once.
GROUP_BYTES = 32 << 20
_NONE = np.uint64(2**64 - 1)


def shingles(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, shingle hashes, bounds by text) of runs of texts."""
    for i, j, _, _ in slices(column):
        for _, _, data, at in slices(pc.utf8_lower(column.slice(i, j - i)), 1 << 40):
            starts, ends, bounds = spans(data, at)
            yield i, j, *windows(span_hashes(data, starts, ends), bounds, WORDS)


def signature(hashes: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    """Groups by bins: the smallest permuted hash of the group's elements that fall into the bin."""
    h = mix(hashes ^ np.uint64(0x5851F42D4C957F2D))
    out = np.full(groups * BINS, _NONE, np.uint64)
    np.minimum.at(out, group * BINS + (h >> np.uint64(57)).astype(np.int64), h)
    return out.reshape(groups, BINS)


class Index:
    """Signatures of a block of items by size, and their shingles."""

    def __init__(self, ids: list[int], texts_: list[str], threshold: float):
        self.threshold = threshold
        sets = {}
        for i, j, hashes, bounds in shingles(pa.array(texts_, pa.string())):
            for k in range(i, j):
                if len(own := np.unique(hashes[bounds[k - i] : bounds[k - i + 1]])):
                    sets.setdefault(tuple(own.tolist()), []).append(ids[k])
        self.items = [(sorted(set(v)), np.array(k, np.uint64)) for k, v in sorted(sets.items(), key=lambda x: x[1])]
        by_size: dict[int, list[int]] = {}
        looked: list[tuple[int, int]] = []
        for n, (_, own) in enumerate(self.items):
            if len(own) <= FEW:
                must = int(np.ceil(threshold * len(own) - 1e-9))
                looked += [(h, n) for h in own[: len(own) - max(must, 1) + 1].tolist()]
                continue
            by_size.setdefault(max(SMALLEST, 1 << (len(own) - 1).bit_length()), []).append(n)
        self.sizes = {}
        for size, members in sorted(by_size.items()):
            sig = signature(np.concatenate([self.items[n][1] for n in members]), np.repeat(np.arange(len(members)), [len(self.items[n][1]) for n in members]), len(members))
            at, _ = np.nonzero(sig != _NONE)
            keys = sig[sig != _NONE]  # a permuted hash names its bin too
            order = np.argsort(keys, kind="stable")
            flags = np.zeros(1 << 16, bool)
            flags[(keys & np.uint64(0xFFFF)).astype(np.int64)] = True
            self.sizes[size] = (keys[order], np.array(members)[at[order]], flags)
        looked.sort()
        self.few = np.array([h for h, _ in looked], np.uint64), np.array([n for _, n in looked], np.int64)

    def candidates(self, hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Rows of (text, item) of windows and items that agree in a bin, each pair once."""
        text = row_of(bounds)
        place = np.arange(len(hashes)) - bounds[text]
        count = np.diff(bounds)
        found = []

        def add(value: np.ndarray, owner: np.ndarray, keys: np.ndarray, item: np.ndarray) -> None:
            low, high = np.searchsorted(keys, value, "left"), np.searchsorted(keys, value, "right")
            n = high - low
            if n.any():
                found.append(np.stack([np.repeat(owner, n), item[ranges(low, n)]], 1))

        if len(self.few[0]):
            add(hashes, text, *self.few)
        for size, (keys, item, flags) in self.sizes.items():
            for phase in (0, size):
                per = np.where(count > 0, (count + phase - 1) // (2 * size) + 1, 0)
                base = np.cumsum(per) - per
                window = base[text] + (place + phase) // (2 * size)
                mins = signature(hashes, window, int(per.sum())).ravel()
                hit = np.flatnonzero(flags[(mins & np.uint64(0xFFFF)).astype(np.int64)] & (mins != _NONE))
                add(mins[hit], np.repeat(np.arange(len(per)), per)[hit // BINS], keys, item)
        return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)

    def search(self, hashes: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, float]]:
        """(text, item, containment) of every exact hit among the shingles of some texts."""
        text_before, own = -1, None
        for text, n in self.candidates(hashes, bounds).tolist():
            if text != text_before:
                text_before, own = text, np.unique(hashes[bounds[text] : bounds[text + 1]])
            ids, wanted = self.items[n]
            at = np.minimum(np.searchsorted(own, wanted), len(own) - 1)
            share = float((own[at] == wanted).sum()) / len(wanted)
            if share >= self.threshold:
                for item in ids:
                    yield text, item, share


def write_indexes(benchmark: DataFrame, threshold: float) -> list[str]:
    """The items in blocks of bounded size, each written to the shared folder; the URIs."""
    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    sizes = items.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("b")).first()
    n, size = sizes["n"], sizes["b"] or 0
    blocks = 1 if n <= ITEMS and size <= ITEM_BYTES else 2 * max(-(-n // ITEMS), -(-size // ITEM_BYTES))
    to, out = shared_dir(benchmark.sparkSession, "items"), []
    for k in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).orderBy("item_id", "text").collect()
        fs, path = file_system(f"{to}/{k}.index")
        fs.create_dir(os.path.dirname(path), recursive=True)
        with fs.open_output_stream(path) as stream:
            stream.write(pickle.dumps(Index([r["item_id"] for r in rows], [r["text"] for r in rows], threshold)))
        out.append(f"{to}/{k}.index")
    return out


_loaded: dict[str, Index] = {}


def load_index(uri: str) -> Index:
    """A worker keeps the block that it used last."""
    if uri not in _loaded:
        _loaded.clear()
        fs, path = file_system(uri)
        with fs.open_input_stream(path) as stream:
            _loaded[uri] = pickle.loads(stream.read())
    return _loaded[uri]


def grouped(batches: Iterator[pa.RecordBatch], place: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches of a task together, up to ``GROUP_BYTES`` of texts."""
    group, size = [], 0
    for b in batches:
        group.append(b)
        size += b.column(place).nbytes
        if size >= GROUP_BYTES:
            yield group
            group, size = [], 0
    if group:
        yield group


def hits(group: list[pa.RecordBatch], place: int, blocks: list[str]) -> Iterator[tuple[int, list[tuple[int, int, float]]]]:
    """(number of a batch, its hits by row, item and containment). The shingles of the group are made once, and each block of items
    is loaded once for all of them."""
    made = [(k, i, hashes, bounds) for k, b in enumerate(group) for i, _, hashes, bounds in shingles(b.column(place).fill_null(""))]
    for uri in blocks:
        index = load_index(uri)
        for k, i, hashes, bounds in made:
            yield k, [(i + text, item, share) for text, item, share in index.search(hashes, bounds)]


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, item_id, containment of every pair at or over ``threshold``. docs: doc_id, text; benchmark: item_id, text."""
    blocks = write_indexes(benchmark, threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, 1):
            for k, rows in hits(group, 1, blocks):
                yield pa.RecordBatch.from_arrays(
                    [group[k]["doc_id"].take(pa.array([r[0] for r in rows], pa.int64())), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.float64())],
                    ["doc_id", "item_id", "containment"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, item_id long, containment double")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no test item, with all their columns; judged where they stand, so no text is shuffled."""
    blocks = write_indexes(benchmark, threshold)
    place = docs.columns.index(text_col)
    plain = docs.toDF(*(f"c{k}" for k in range(len(docs.columns))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, place):
            keep = [np.ones(len(b), bool) for b in group]
            for k, rows in hits(group, place, blocks):
                keep[k][[r for r, _, _ in rows]] = False
            for b, own in zip(group, keep, strict=True):
                yield b.filter(pa.array(own))

    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(texts(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))
