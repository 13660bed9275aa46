"""Operator 13: token counts of whole texts.

An Arrow function cuts its rows into batches of about equal bytes: many short texts together, and a long text in several
batches, cut only at safe boundaries, so that the counts of its parts add up to the count of the text. A batch is encoded at
once and only lengths come back; no row is shuffled, and memory is bounded by ``BATCH_BYTES`` beside the Arrow batch itself.

Safe boundaries of a byte-level vocabulary: before ASCII white space after a printable ASCII character or a letter of two bytes that
begins with C3, and between an ideographic mark (``MARKS``) and a letter of U+5000 to U+8FFF; the split into words can't look over
either. Of a sentencepiece model: a lone space between two ASCII letters or digits, which the next part's own word mark stands for,
if no piece of the vocabulary goes on over a word mark. Of any other file none is known and texts stay whole. A stretch without any
safe boundary (a word of many megabytes) is one part, whatever its length, as only so its count is right.

``.json`` files are read by tokenizers, ``.model`` files by sentencepiece; no begin, end or added special tokens, special strings
inside texts as the library's default has them, no truncation or padding. A null text is empty and has no tokens; rows without an
id and repeated rows stay rows; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe_chunks import safe_cuts
from .common import SPACE, buffers, separators, table, texts
from .encoding import span_encoder

BATCH_BYTES = 1 << 20
LIMIT = 1024
#: Ideographic full stop and comma, full-width comma, exclamation and question mark.
MARKS = "。、，！？"
_MARKS = np.array([int.from_bytes(c.encode(), "big") for c in MARKS])
_WORD = ~separators(bytes(b for b in range(256) if not (b < 128 and chr(b).isalnum())))


def byte_level_cuts(data: np.ndarray) -> np.ndarray:
    """Safe boundaries inside some bytes of a text, for byte-level vocabularies."""
    n = len(data)
    flag = np.zeros(n, bool)
    if n > 1:
        before = data[:-1]
        good = (before > 0x20) & (before < 0x7F)
        good[1:] |= (data[:-2] == 0xC3) & (before[1:] >= 0x80)
        flag[1:] = SPACE[data[1:]] & good
    if n > 3:
        wide = data.astype(np.int64)
        flag[3:] |= np.isin((wide[:-3] << 16) | (wide[1:-2] << 8) | wide[2:-1], _MARKS) & (data[3:] >= 0xE5) & (data[3:] <= 0xE8)
    return np.flatnonzero(flag)


def lone_spaces(data: np.ndarray) -> np.ndarray:
    """Lone spaces between ASCII letters or digits; the space itself is to be left out."""
    if len(data) < 3:
        return np.zeros(0, np.int64)
    return np.flatnonzero((data[1:-1] == 0x20) & _WORD[data[:-2]] & _WORD[data[2:]]) + 1


def parts(data: np.ndarray, most: int, cuts: Callable[[np.ndarray], np.ndarray] | None, skip: int = 0) -> Iterator[tuple[int, int]]:
    """First and end bytes of the parts of a long text, at most ``most`` bytes each if it has a boundary that often. ``skip``: bytes
    at a boundary that belong to no part."""
    at, n = 0, len(data)
    while cuts and n - at > most:
        size, low = most, 0
        while True:
            found = cuts(data[at + max(0, low - 8) : at + size]) + max(0, low - 8)
            found = found[found > 0]
            if len(found) or at + size >= n:
                break
            low, size = size, 2 * size
        if not len(found):
            break
        cut = at + int(found[-1] if size == most else found[0])
        yield at, cut
        at = cut + skip
    yield at, n


def batches(column: pa.Array, most: int, cuts: Callable[[np.ndarray], np.ndarray] | None, skip: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(row of each part, bytes, first and end of each part in them) of batches of about ``most`` bytes."""
    data, at = buffers(column)
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + most, "right")) - 1)
        own = data[at[i] : at[j]]
        if len(own) > most:  # one long text
            for s, e in parts(own, most, cuts, skip):
                yield np.array([i]), own[s:e], np.zeros(1, np.int64), np.array([e - s])
        else:
            yield np.arange(i, j), own, at[i:j] - at[i], at[i + 1 : j + 1] - at[i]
        i = j


class Counter:
    """Token counts of the parts of a batch by one vocabulary file."""

    def __init__(self, path: str):
        self.cuts, self.skip = None, 0
        if path.endswith(".model"):
            from sentencepiece import SentencePieceProcessor

            self.model = SentencePieceProcessor(model_file=path)
            pieces = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
            plain = self.model.encode("a  b", out_type=str) == ["▁a", "▁", "▁b"]  # neither joined spaces nor pieces of several
            if plain and not any("▁" in p[1:] and p.strip("▁") for p in pieces):
                self.cuts, self.skip = lone_spaces, 1
            self.count = self._sentencepiece
            return
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        first = spec["pre_tokenizer"] or {}
        if first.get("type") == "ByteLevel" and first.get("use_regex", True) and not first["add_prefix_space"] and not spec["normalizer"] and not any(t["lstrip"] or t["rstrip"] or set(t["content"]) & set(" \t\n\v\f\r" + MARKS) for t in spec["added_tokens"]):
            self.cuts, self.spans = byte_level_cuts, span_encoder(path)
            self.count = self._byte_level
            return
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()
        self.count = self._whole

    def _byte_level(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Each different stretch between safe boundaries is encoded once; repeated ones only add their length."""
        full = np.flatnonzero(ends > starts)
        out = np.zeros(len(starts), np.int64)
        if len(full):
            begin = safe_cuts(data, starts[full])
            _, counts = self.spans.encode_plain(data, begin, np.append(begin[1:], len(data)))
            out[full] = np.add.reduceat(counts, np.searchsorted(begin, starts[full]))
        return out

    def _strings(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[str]:
        raw = data.tobytes()
        return [raw[s:e].decode("utf-8", "replace") for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]

    def _whole(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return np.array([len(x.ids) for x in self.model.encode_batch_fast(self._strings(data, starts, ends), add_special_tokens=False)], np.int64)

    def _sentencepiece(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return np.array([len(x) for x in self.model.encode(self._strings(data, starts, ends), num_threads=1)], np.int64)


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = LIMIT, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of each text of ``docs`` (doc_id, text)."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(tokenizer)
        for b in rows:
            tokens = np.zeros(len(b), np.int64)
            for row, data, starts, ends in batches(b["text"], batch_bytes, own.cuts, own.skip):
                tokens[row] += own.count(data, starts, ends)
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(np.diff(buffers(b["text"])[1])), pa.array(tokens)], ["doc_id", "n_bytes", "n_tokens"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(texts(table(spark, sf_dir, "documents")), public_tokenizers.path("byte_bpe_50k.json"))
