"""Operator 2: line dedup by pairwise alignment.

A run is a stretch of lines of at least ``words`` words together: from each line the shortest one that begins there, and the
shortest one that ends there (one long line is both). How many documents hold a run is counted. A rare run (``RARE`` documents at
most) pairs all its holders with each other; a frequent one pairs each of its holders with the first one only, so that documents that
have only frequent runs in common with earlier ones are aligned too, and pairs are never more than RARE times the runs.

A pair is aligned by patience diff over the runs that both have: runs that stand once in each, their longest rising chain, then
between its links. An aligned block is a matched run with the equal lines around it; it has at least ``words`` words and goes from the
document with the larger id. What is left because it stands in another order, or repeats, is aligned again in further rising chains
until the two have no run in common. Nothing else is deleted. The pairs of the rarest runs come first, and a later pair of a
document looks only at what the earlier ones have left of it.

Lines are equal if the bytes between their first and last word are (told apart by 128-bit BLAKE2b digests). Lines without a word
belong to no block and stay; so do copies of a passage that begin or end inside a line. Null texts are empty and stay empty; rows
without an id, and rows of the same id, never delete from each other; an empty table gives no rows. Extra columns come through
``dedup_lines`` untouched, whatever their names.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import NEWLINE, copied, dealt, drop_stage, materialize, places_of, slices, spans, table, texts

WORDS = 25
#: A run that at most so many documents hold is rare.
RARE = 3
#: Rounds of alignment between the links of the last; what is left then is aligned again with what else is left.
DEPTH = 64
SIZE = 16


def digest(line: bytes, size: int = SIZE) -> bytes:
    return hashlib.blake2b(line, digest_size=size).digest()


def line_table(data: np.ndarray, at: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Digests (one after the other) and number of words of each line that has a word, and the bounds by text."""
    starts, ends, _ = spans(data, at)
    low, high, _ = spans(data, at, NEWLINE)
    first, last = np.searchsorted(starts, low), np.searchsorted(starts, high)
    full = last > first
    first, last = first[full], last[full]
    raw = data.tobytes()
    every = b"".join([digest(raw[s:e]) for s, e in zip(starts[first].tolist(), ends[last - 1].tolist(), strict=True)])
    return every, last - first, np.searchsorted(low[full], at)


def split_digests(every: bytes) -> list[bytes]:
    return [every[k : k + SIZE] for k in range(0, len(every), SIZE)]


def lines(docs: DataFrame) -> DataFrame:
    """doc_id, version, digests (binary) and words: of the lines with a word, in order, once for equal rows. version: a hash of the text,
    which tells rows of the same id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, at in slices(b["text"]):
                every, n, bounds = line_table(data, at)
                cut = (bounds * SIZE).tolist()
                column = pa.array([every[s:e] for s, e in zip(cut[:-1], cut[1:], strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([b["doc_id"].slice(i, j - i), b["version"].slice(i, j - i), column, pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(n.astype(np.int32)))], ["doc_id", "version", "digests", "words"])

    known = docs.where("doc_id is not null").select("doc_id", F.xxhash64("text").alias("version"), "text")
    again = materialize(known.groupBy("doc_id", "version").count().where("count > 1").select("doc_id", "version"), "again")
    every = known.mapInArrow(run, "doc_id long, version long, digests binary, words array<int>")
    if again.isEmpty():
        return every
    once = every.join(again, ["doc_id", "version"], "left_anti")
    return once.union(every.join(again, ["doc_id", "version"], "left_semi").dropDuplicates(["doc_id", "version"]))


def run_bounds(words: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """First and end lines of all runs, each once."""
    n = len(words)
    upto = np.concatenate([[0], np.cumsum(words)])
    end = np.searchsorted(upto, upto[:-1] + least)
    ahead = np.flatnonzero(end <= n)
    begin = np.searchsorted(upto, upto[1:] - least, "right") - 1
    back = np.flatnonzero(begin >= 0)
    both = np.unique(np.concatenate([ahead * (n + 1) + end[ahead], begin[back] * (n + 1) + back + 1]))
    return both // (n + 1), both % (n + 1)


def runs(kept: DataFrame, least: int) -> DataFrame:
    """doc_id, version, run: a key of each different run of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            w, bounds = np.asarray(b["words"].flatten()), np.asarray(b["words"].offsets)
            bounds = (bounds - bounds[0]).tolist()
            found, n = [], []
            for every, s, e in zip(b["digests"].to_pylist(), bounds[:-1], bounds[1:], strict=True):
                own = {digest(every[SIZE * x : SIZE * y], 8) for x, y in zip(*(k.tolist() for k in run_bounds(w[s:e], least)), strict=True)}
                found += own
                n.append(len(own))
            row = pa.array(np.repeat(np.arange(len(n)), n), pa.int64())
            yield pa.RecordBatch.from_arrays([b["doc_id"].take(row), b["version"].take(row), pa.array(np.frombuffer(b"".join(found), np.int64))], ["doc_id", "version", "run"])

    return kept.mapInArrow(run, "doc_id long, version long, run long")


def rising_chains(pairs: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """Pairs of places (in a, in b), in the order of a, dealt into the fewest chains that rise in both, the longest first."""
    tops: list[int] = []  # minus the last place in b of each chain, rising
    chains: list[list[tuple[int, int]]] = []
    for k, (i, j) in enumerate(pairs):
        p = bisect_right(tops, -j)  # the first chain that ends before j
        if p == len(tops):
            tops.append(-j)
            chains.append([(i, j)])
        else:
            tops[p] = -j
            chains[p].append((i, j))
    return sorted(chains, key=len, reverse=True)


def longest_rise(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest chain of pairs, in the order of a, that rises in b too: patience sorting."""
    tops: list[int] = []
    chain: list[int] = []
    back: list[int] = []
    for k, (_, j) in enumerate(pairs):
        p = bisect_left(tops, j)
        back.append(chain[p - 1] if p else -1)
        if p == len(tops):
            tops.append(j)
            chain.append(k)
        else:
            tops[p], chain[p] = j, k
    k = chain[-1] if chain else -1
    out = []
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Matched places (in a, in b) of two lists, rising in both: what both begin and end with, the longest rising chain of what stands
    once in each, and between its links again. Where nothing stands once, the rarest that both have links its first places."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b), 0)]
    while todo:
        la, ha, lb, hb, depth = todo.pop()
        while la < ha and lb < hb and a[la] == b[lb]:
            out.append((la, lb))
            la, lb = la + 1, lb + 1
        while la < ha and lb < hb and a[ha - 1] == b[hb - 1]:
            ha, hb = ha - 1, hb - 1
            out.append((ha, hb))
        if la >= ha or lb >= hb or depth == DEPTH:
            continue
        in_a: dict = {}
        for i in range(la, ha):
            in_a.setdefault(a[i], [i, 0])[1] += 1
        in_b: dict = {}
        for j in range(lb, hb):
            in_b.setdefault(b[j], [j, 0])[1] += 1
        common = [(n * in_b[x][1], i, in_b[x][0]) for x, (i, n) in in_a.items() if x in in_b]
        if not common:
            continue
        links = longest_rise([(i, j) for n, i, j in common if n == 1]) or [min(common)[1:]]
        edge_a, edge_b = la, lb
        for i, j in links:
            out.append((i, j))
            todo.append((edge_a, i, edge_b, j, depth + 1))
            edge_a, edge_b = i + 1, j + 1
        todo.append((edge_a, ha, edge_b, hb, depth + 1))
    return sorted(out)


class Pair:
    """The runs that a document (a) has in common with an earlier one (b), and what of it has been aligned."""

    def __init__(self, a: list, words: list[int], b: list, least: int):
        number = {x: k for k, x in enumerate(dict.fromkeys(a))}
        self.a, self.b = np.array([number[x] for x in a], np.int64), np.array([number.get(x, -1) for x in b], np.int64)
        size = np.zeros(len(number) + 1, np.int64)
        size[self.a] = words
        size[-1] = least  # of lines that a doesn't have; a run with one is in common with nothing
        runs_a, runs_b = (list(zip(*(k.tolist() for k in run_bounds(size[x], least)), strict=True)) for x in (self.a, self.b))
        raw_a, raw_b = self.a.tobytes(), self.b.tobytes()
        keys_a, keys_b = ([raw[8 * s : 8 * e] for s, e in x] for raw, x in ((raw_a, runs_a), (raw_b, runs_b)))
        both = set(keys_a) & set(keys_b)
        self.at_a, self.keys_a = [x for x, k in zip(runs_a, keys_a, strict=True) if k in both], [k for k in keys_a if k in both]
        self.at_b, self.keys_b = [x for x, k in zip(runs_b, keys_b, strict=True) if k in both], [k for k in keys_b if k in both]
        self.gone = np.zeros(len(a), bool)

    def take(self, matched: list[tuple[int, int]]) -> None:
        """Deletes the aligned blocks: each matched run, and the equal lines next to it on either side."""
        a, b, done = self.a, self.b, (0, -1)  # the offset of the last block, and where it ends in a
        for x, y in matched:
            (s, e), j = self.at_a[x], self.at_b[y][0]
            if done[0] == j - s and e <= done[1]:
                continue
            off = j - s
            while s > 0 and s + off > 0 and a[s - 1] == b[s + off - 1] and not self.gone[s - 1]:
                s -= 1
            while e < len(a) and e + off < len(b) and a[e] == b[e + off]:
                e += 1
            self.gone[s:e] = True
            done = (off, e)


def common_lines(a: list, words: list[int], b: list, least: int) -> np.ndarray:
    """Flags of the lines of ``a`` in the aligned blocks, of at least ``least`` words, of ``a`` and the earlier ``b``. What the
    patience diff leaves because its order is another, or because it repeats, is aligned again until no run is left."""
    pair = Pair(a, words, b, least)
    matched = patience(pair.keys_a, pair.keys_b)
    if matched:
        pair.take(matched)
        left = [x for x, (s, e) in enumerate(pair.at_a) if not pair.gone[s:e].all()]
        first = {k: y for y, k in reversed(list(enumerate(pair.keys_b)))}
        for chain in rising_chains([(x, first[pair.keys_a[x]]) for x in left]):
            pair.take(chain)
    return pair.gone


def document_pairs(by_run: DataFrame) -> DataFrame:
    """doc_id, version, earlier_id, earlier_version, rarest (holders of the rarest run that pairs them). by_run: doc_id, version, run."""
    holder = F.struct("doc_id", "version")
    held = by_run.groupBy("run").agg(F.min(holder).alias("first"), F.max("doc_id").alias("last_id"), F.count("*").alias("holders"))
    held = materialize(held.where("first.doc_id < last_id").select("run", "first", "holders"), "held")
    shared = by_run.join(held.hint("merge"), "run")
    # a rare run pairs all its holders; of a frequent one, each with the first
    lists = shared.where(F.col("holders") <= RARE).groupBy("run", "holders").agg(F.collect_list(holder).alias("all"))
    rare = lists.select("holders", "all", F.explode("all").alias("own")).select("own.*", F.explode("all").alias("first"), "holders")
    frequent = shared.where(F.col("holders") > RARE).select("doc_id", "version", "first", "holders")
    found = rare.union(frequent).where("first.doc_id < doc_id")
    found = found.groupBy("doc_id", "version", F.col("first.doc_id").alias("earlier_id"), F.col("first.version").alias("earlier_version")).agg(F.min("holders").alias("rarest"))
    return materialize(found, "pairs")


def find_lines(docs: DataFrame, least: int = WORDS) -> DataFrame:
    """doc_id, version, gone (the numbers of its lines that go), earlier_ids (the documents that hold them) for each text
    that shares a block with an earlier one."""
    kept = materialize(lines(docs), "lines")
    by_run = materialize(runs(kept, least), "runs")
    pairs = document_pairs(by_run)
    # an earlier document of many pairs goes to several places, each with a part of its pairs
    earlier = ["earlier_id", "earlier_version"]
    places = places_of(pairs, earlier)
    asks = dealt(pairs, places, earlier, "doc_id")
    first = copied(kept.select(F.col("doc_id").alias("earlier_id"), F.col("version").alias("earlier_version"), "digests"), places, earlier)
    partners = asks.join(first.hint("merge"), [*earlier, "place"]).select("doc_id", "version", "rarest", "earlier_id", "digests", F.lit(None).cast("array<int>").alias("words"))
    key = ["doc_id", "version"]
    own = kept.join(pairs.select(*key).distinct().hint("merge"), key, "left_semi").select(*key, F.lit(-1).cast("long").alias("rarest"), F.lit(None).cast("long").alias("earlier_id"), "digests", "words")
    # each text's own lines come first and then its partners one by one, those of the rarest runs first, so no task holds its pairs together
    rows = own.union(partners).repartition(*key).sortWithinPartitions(*key, "rarest", "earlier_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, mine, done = None, None, []

        def close() -> None:
            if mine is not None and mine[3]:
                done.append((*at, np.flatnonzero(mine[2]).tolist(), sorted(mine[3])))

        def result() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64())]
            out = pa.RecordBatch.from_arrays([pa.array([x[k] for x in done], kind) for k, kind in enumerate(kinds)], ["doc_id", "version", "gone", "earlier_ids"])
            done.clear()
            return out

        for b in batches:
            for doc, version, earlier, every, words in zip(*(b[c] for c in ("doc_id", "version", "earlier_id", "digests", "words")), strict=True):
                if (now := (doc.as_py(), version.as_py())) != at:
                    close()
                    at, mine = now, None
                if mine is None:
                    every = every.as_py()
                    mine = (split_digests(every), words.as_py(), np.zeros(len(every) // SIZE, bool), set())
                elif not mine[2].all():
                    found = common_lines(*mine[:2], split_digests(every.as_py()), least)
                    if (found & ~mine[2]).any():
                        np.logical_or(mine[2], found, out=mine[2])
                        mine[3].add(earlier.as_py())
            if done:
                yield result()
        close()
        if done:
            yield result()

    out = materialize(rows.mapInArrow(run, "doc_id long, version long, gone array<int>, earlier_ids array<long>"), "gone")
    drop_stage(kept, by_run, pairs, places)
    return out


def cut_lines(text: str, gone: list[int]) -> str:
    """The text without the lines (numbers of lines with a word) that go."""
    away, k, out = set(gone), 0, []
    for p in text.split("\n"):
        if p.strip(" \t\n\v\f\r"):
            k += 1
            if k - 1 in away:
                continue
        out.append(p)
    return "\n".join(out)


def dedup_lines(docs: DataFrame, least: int = WORDS, counts: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the later copies of common blocks deleted from the text; with ``counts`` also removed_lines (long) and
    earlier_ids (sorted list of the documents that hold what was removed)."""
    cuts = find_lines(texts(docs, id_col, text_col), least)
    place = docs.columns.index(text_col)
    plain = docs.toDF(*(f"c{k}" for k in range(len(docs.columns))))
    own = [plain[f"c{docs.columns.index(id_col)}"].cast("long") == cuts["doc_id"], F.xxhash64(F.coalesce(plain[f"c{place}"], F.lit(""))) == cuts["version"]]
    joined = plain.join(cuts.hint("merge"), own, "left").drop("doc_id", "version")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text, cut = b.column(place), b.column(b.num_columns - 2)
            if cut.null_count < len(b):
                text = pa.array([t if t is None or g is None else cut_lines(t, g) for t, g in zip(text.to_pylist(), cut.to_pylist(), strict=True)], pa.string())
            columns = [text if k == place else b.column(k) for k in range(b.num_columns - 2)]
            names = [f"c{k}" for k in range(len(columns))]
            if counts:
                ids = [x or [] for x in b.column(b.num_columns - 1).to_pylist()]
                columns, names = [*columns, pa.array([len(g or ()) for g in cut.to_pylist()], pa.int64()), pa.array(ids, pa.list_(pa.int64()))], [*names, "removed_lines", "earlier_ids"]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = ", ".join(f"c{k} {f.dataType.simpleString()}" for k, f in enumerate(docs.schema)) + ", removed_lines long, earlier_ids array<long>" * counts
    out = joined.mapInArrow(run, schema)
    return out.toDF(*docs.columns, *(["removed_lines", "earlier_ids"] if counts else []))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(table(spark, sf_dir, "documents"))
    return dedup_lines(docs, counts=True).select("doc_id", "removed_lines", "earlier_ids", "text")
