"""Operator 9: language identification by cross-parsing entropy.

For each language a suffix automaton is built over labelled text (a bounded, documented sample: ``DOCS`` documents, of which each
gives a like share of at most ``BYTES`` bytes a language). A text is parsed against it from left to right into longest matches; the
language that needs the fewest phrases, weighted by the bits that name a place in its reference, wins. Letters are lower-cased, all
else is a single space; both sides are bytes in UTF-8, so no script has too many letters to be told apart.

Texts are parsed in blocks of ``BLOCK`` bytes side by side. Each block begins in the state that the bytes before it suggest; where
the block before it in fact ends in another, it is parsed again from there, ``ROUNDS`` times at most; blocks that are off after that
(a periodic text hands a wrong phase on from block to block) are parsed once more from left to right, each from the true end of the
one before it. So the phrases are those of the whole text, and no block is parsed more than ROUNDS + 2 times.

A text that is null or has no letter is ``und`` with score 0; ties go to the first language by name; with no learned
language every text is ``und``. Repeated rows stay, an empty table gives no rows, extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import buffers, held_out, ranges, slices, table

#: Bounds of what is learned from: documents and bytes a language.
DOCS, BYTES = 64, 20_000
#: Bytes of a block, and bytes before it that suggest the state in which it begins.
BLOCK, BEFORE = 1024, 48
#: Times that blocks are parsed again side by side.
ROUNDS = 3


def normalise(codes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points with each run of non-letters as one 0."""
    kinds, inverse = np.unique(codes, return_inverse=True)
    alpha = np.fromiter((chr(c).isalpha() for c in kinds.tolist()), bool, len(kinds))[inverse]
    codes = np.where(alpha, codes, 0)
    keep = np.ones(len(codes), bool)
    keep[1:] = alpha[1:] | alpha[:-1] | (owner[1:] != owner[:-1])
    return codes[keep], owner[keep]


def code_points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case code points of all texts of a column, and the row of each."""
    low = pc.utf8_lower(column.fill_null("") if column.null_count else column)
    data, at = buffers(low)
    codes = np.frombuffer(data[at[0] : at[-1]].tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    lengths = pc.utf8_length(low).to_numpy(zero_copy_only=False).astype(np.int64)
    return codes, np.repeat(np.arange(len(low)), lengths)


def as_bytes(codes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points as UTF-8, and the row of each byte."""
    data = np.frombuffer(codes.astype("<u4").tobytes().decode("utf-32-le", "replace").encode(), np.uint8)
    return data, np.repeat(owner, 1 + (codes > 0x7F).astype(np.int64) + (codes > 0x7FF) + (codes > 0xFFFF))


def automaton(word: np.ndarray, letters: int) -> np.ndarray:
    """The suffix automaton of ``word`` as a table of states by letters: twice the next state, plus 1 where a phrase begins.

    State 0 is the root and state 1 stands before any phrase: from there each letter begins one."""
    links, lengths, nexts = [-1], [0], [{}]
    last = 0
    for c in word.tolist():
        cur = len(links)
        links.append(0)
        lengths.append(lengths[last] + 1)
        nexts.append({})
        p = last
        while p >= 0 and c not in nexts[p]:
            nexts[p][c] = cur
            p = links[p]
        if p >= 0:
            q = nexts[p][c]
            if lengths[q] == lengths[p] + 1:
                links[cur] = q
            else:
                clone = len(links)
                links.append(links[q])
                lengths.append(lengths[p] + 1)
                nexts.append(dict(nexts[q]))
                while p >= 0 and nexts[p].get(c) == q:
                    nexts[p][c] = clone
                    p = links[p]
                links[q] = links[cur] = clone
        last = cur
    shift = lambda s: s + 1 if s else 0  # noqa: E731  makes room for state 1
    begin = np.full(letters, 2 * 1 + 1, np.int32)
    for c, t in nexts[0].items():
        begin[c] = 2 * shift(t) + 1
    out = np.tile(begin, (len(links) + 1, 1))
    for s, row in enumerate(nexts):
        for c, t in row.items():
            out[shift(s), c] = 2 * shift(t)
    return out


class Parser:
    def __init__(self, references: dict[str, str]):
        self.languages = sorted(references)
        words = []
        for k in self.languages:
            codes = np.frombuffer(references[k].lower().encode("utf-32-le"), np.uint32)
            words.append(as_bytes(*normalise(codes, np.zeros(len(codes), np.int8)))[0])
        # a column for each byte of the language's reference, and one for all others
        self.column, tables = np.zeros((len(words), 256), np.int32), []
        for k, word in enumerate(words):
            have = np.unique(word)
            self.column[k] = len(have)
            self.column[k, have] = np.arange(len(have))
            tables.append(automaton(self.column[k, word], len(have) + 1))
        # states as the place of their row in the one table
        base = np.cumsum([0, *(t.size for t in tables)])
        self.fresh = np.array([b + t.shape[1] for b, t in zip(base, tables)], np.int64)
        self.table = np.concatenate([((t >> 1).astype(np.int64) * t.shape[1] + b) * 2 + (t & 1) for b, t in zip(base, tables)], axis=None).astype(np.int32 if 2 * base[-1] < 2**31 else np.int64)
        self.bits = np.array([np.log2(max(2, len(w))) for w in words])

    def parse(self, text: np.ndarray, low: np.ndarray, length: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Phrases that begin in each block and the state after it, by language and block. state: that before it."""
        order = np.argsort(-length, kind="stable")
        low, length, state = low[order], length[order], state[:, order]
        count = np.zeros(state.shape, np.int32)
        longest = int(length[0]) if len(length) else 0
        active = np.searchsorted(-length, -np.arange(longest), "left")  # blocks longer than each step
        for step in range(longest):
            n = active[step]
            got = self.table[state[:, :n] + self.column[:, text[low[:n] + step]]]
            count[:, :n] += got & 1
            state[:, :n] = got >> 1
        back = np.argsort(order)
        return count[:, back], state[:, back]

    def walk(self, language: int, text: np.ndarray, state: int) -> tuple[int, int]:
        """Phrases that begin in one block, and the state after it, byte by byte."""
        table, count = memoryview(self.table), 0
        for c in self.column[language, text].tolist():
            got = table[state + c]
            count += got & 1
            state = got >> 1
        return count, state

    def phrases(self, text: np.ndarray, owner: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
        """Phrases by row and language, and bytes by row."""
        size = np.bincount(owner, minlength=rows)
        blocks = -(-size // BLOCK)
        row = np.repeat(np.arange(rows), blocks)
        k = ranges(np.zeros(rows, np.int64), blocks)
        low = (np.cumsum(size) - size)[row] + k * BLOCK
        length = np.minimum(BLOCK, size[row] - k * BLOCK)
        begin = np.repeat(self.fresh[:, None], len(row), 1)
        later = np.flatnonzero(k > 0)
        begin[:, later] = self.parse(text, low[later] - BEFORE, np.full(len(later), BEFORE), begin[:, later])[1]
        count, end = self.parse(text, low, length, begin)
        for _ in range(ROUNDS):
            if not len(off := later[(begin[:, later] != end[:, later - 1]).any(0)]):
                break
            begin[:, off] = end[:, off - 1]
            count[:, off], end[:, off] = self.parse(text, low[off], length[off], begin[:, off])
        for m, _ in enumerate(self.languages):
            for block in later[begin[m, later] != end[m, later - 1]].tolist():
                while block < len(k) and k[block] > 0 and begin[m, block] != end[m, block - 1]:
                    begin[m, block] = end[m, block - 1]
                    count[m, block], end[m, block] = self.walk(m, text[low[block] : low[block] + length[block]], int(begin[m, block]))
                    block += 1
        out = np.zeros((rows, len(self.languages)), np.int64)
        np.add.at(out, row, count.T)
        return out, size


_parsers: dict[tuple, Parser] = {}


def parser(references: dict[str, str]) -> Parser:
    key = tuple(sorted(references.items()))
    if key not in _parsers:
        _parsers.clear()
        _parsers[key] = Parser(references)
    return _parsers[key]


def shares(texts: list[str]) -> str:
    """The texts one after the other, each cut at the most bytes with which all fit into ``BYTES``."""
    raw = [t.encode() for t in texts]
    left, most = BYTES, 0
    for k, n in enumerate(sorted(map(len, raw))):
        most = left // (len(raw) - k)
        if n > most:
            break
        left -= n
        most = n
    return "\n".join(r[:most].decode("utf-8", "ignore") for r in raw)


def learn(docs: DataFrame) -> dict[str, str]:
    """Reference text by language from ``docs`` (doc_id, text, lang): of each language the ``DOCS`` rows that are not held out and
    have the smallest hashes of id and text, a like share of ``BYTES`` bytes of each. At most DOCS x BYTES characters a language come
    to the driver, however often an id is repeated."""
    key = ["lang", "h", "t"]
    open_ = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", F.xxhash64("doc_id").alias("h"), F.xxhash64("text").alias("t"), "text")
    ranked = open_.select(*key).distinct().withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("h", "t")))  # each task sends DOCS rows a language
    chosen = [tuple(r) for r in ranked.where(F.col("k") <= DOCS).select(*key).collect()]
    if not chosen:
        return {}
    wanted = F.broadcast(docs.sparkSession.createDataFrame(chosen, "lang string, h long, t long"))
    got = open_.join(wanted, key).select(*key, F.substring("text", 1, BYTES).alias("text")).dropDuplicates(key)
    by: dict[str, list[str]] = {}
    for r in sorted(got.collect()):
        by.setdefault(r["lang"], []).append(r["text"])
    found = {k: shares(v) for k, v in by.items()}
    return {k: v for k, v in found.items() if any(map(str.isalpha, v))}


def identify(docs: DataFrame, references: dict[str, str]) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of ``docs`` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = parser(references) if references else None
        for b in batches:
            for i, j, _, _ in slices(b["text"], 1 << 22):
                data, owner = as_bytes(*normalise(*code_points(b["text"].slice(i, j - i))))
                letters = np.bincount(owner[data > 0], minlength=j - i) > 0
                names, scores = ["und"] * (j - i), np.zeros(j - i)
                if model is not None:
                    n, size = model.phrases(data, owner, j - i)
                    bits = n * model.bits / np.maximum(size, 1)[:, None]
                    best = bits.argmin(1)
                    share = np.exp2(-8 * (bits - bits.min(1, keepdims=True)))
                    scores = np.where(letters, 1 / share.sum(1), 0.0)
                    names = [model.languages[k] if ok else "und" for k, ok in zip(best.tolist(), letters.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*(b[c].slice(i, j - i) for c in ("doc_id", "held_out")), pa.array(names, pa.string()), pa.array(scores)], ["doc_id", "held_out", "lang_pred", "score"])

    asked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    return asked.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs.select("doc_id", "text"), learn(docs.select("doc_id", "text", "lang")))
