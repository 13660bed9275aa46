"""Encoding of many short spans with a public tokenizer, each different span once per worker process.

Most words need none of the tokenizer's general steps: of ASCII and of letters of two bytes that begin with C3
(Latin-1 letters, composed as they stand), the lower-casing and the split into runs of letters, single digits and runs
of other marks are done here on whole slices, and only the tokenizer's own model sees the pieces. Any other span goes
through the whole tokenizer.
"""

from __future__ import annotations

import os

import numpy as np

from .common import SPACE, distinct_spans, ranges, separators

#: A worker forgets what it has encoded beyond so many spans or ids; that costs time only.
MOST_SPANS, MOST_IDS = 250_000, 2_500_000

#: Bytes that always need the whole tokenizer: controls, the apostrophe (contractions), < (special tokens), and every
#: byte over 7F but C3 and those that follow one.
_ODD = separators(bytes([*range(9), *range(14, 32), 127, ord("'"), ord("<"), *(b for b in range(128, 256) if b != 0xC3)]))
_KIND = np.full(256, 3, np.int8)
_KIND[SPACE] = 0
_KIND[[b for b in range(256) if b > 127 or chr(b).isalpha()]] = 1
_KIND[[b for b in range(128) if chr(b).isdigit()]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def odd_bytes(data: np.ndarray) -> np.ndarray:
    """Flags of the bytes that need the whole tokenizer."""
    odd = _ODD[data]
    after = np.zeros(len(data), bool)
    after[1:] = data[:-1] == 0xC3
    odd[after] = (data[after] == 0x97) | (data[after] == 0xB7) | (data[after] < 0x80)  # the two signs among the letters
    return odd


def lower_pieces(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """White-space words as pieces of a lower-casing word tokenizer: (bytes, piece starts, piece ends, whole, first piece of each
    word and the end). ``whole`` marks words that go through the whole tokenizer in one piece."""
    n = len(data)
    if not len(starts):
        return data, starts, ends, np.zeros(0, bool), np.zeros(1, np.int64)
    odd = np.concatenate([[0], np.cumsum(odd_bytes(data))])
    whole = odd[ends] > odd[starts]
    kept = _covered(n, starts[whole], ends[whole])
    low = _LOWER[data]
    accent = np.zeros(n, bool)
    accent[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    low[accent] += 32
    low[kept] = data[kept]
    kind = _KIND[data]
    kind[kept] = 4
    begin = np.zeros(n, bool)
    begin[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    begin &= kind > 0
    begin[starts] = True
    piece = np.flatnonzero(begin)
    first = np.searchsorted(piece, starts)
    stop = np.append(piece[1:], n)
    last = np.append(first[1:], len(piece)) - 1
    stop[last] = ends
    return low, piece, stop, kept[piece], np.append(first, len(piece))


def _covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    mark = np.zeros(n + 1, np.int8)
    np.add.at(mark, starts, 1)
    np.add.at(mark, ends, -1)
    return np.cumsum(mark[:-1], dtype=np.int8).astype(bool)


def plain_pieces(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rising spans as pieces of a byte-level tokenizer that splits into runs of letters, digits and other marks, each with one
    space before it: (piece starts, piece ends, whole, first piece of each span and the end). ``whole`` marks spans that go through
    the whole tokenizer in one piece: those with odd bytes, or white space other than one space at their begin."""
    n = len(data)
    if not len(starts):
        return starts, ends, np.zeros(0, bool), np.zeros(1, np.int64)
    lead = data[starts] == 0x20
    rest = starts + lead
    odd = np.concatenate([[0], np.cumsum(odd_bytes(data) | SPACE[data])])
    whole = (odd[ends] > odd[rest]) | (rest == ends)
    kind = _KIND[data]
    kind[_covered(n, starts[whole], ends[whole])] = 4
    begin = np.zeros(n, bool)
    begin[1:] = kind[1:] != kind[:-1]
    begin &= _covered(n, starts, ends)
    begin[rest[lead & ~whole]] = False
    begin[starts] = True
    piece = np.flatnonzero(begin)
    first = np.searchsorted(piece, starts)
    stop = np.append(piece[1:], n)
    last = np.append(first[1:], len(piece)) - 1
    stop[last] = ends
    return piece, stop, whole[np.searchsorted(starts, piece, "right") - 1], np.append(first, len(piece))


def byte_characters() -> list[str]:
    """The printable characters by which byte-level vocabularies write the 256 bytes: printable ones of Latin-1 stand for
    themselves, the others, in order, are 256 and on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class SpanEncoder:
    """Ids of spans of a text slice. Spans must be such that a text's ids are those of its spans, one after the other."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.written = dict(enumerate(byte_characters()))
        self.forget()

    def forget(self) -> None:
        self.index: tuple[dict[bytes, int], dict[bytes, int]] = ({}, {})  # of spans for the model, and for the whole tokenizer
        self.start, self.count = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.flat, self.used = np.zeros(1 << 18, np.uint16), 0

    def _grow(self, spans: int, ids: int) -> None:
        while len(self.start) < spans:
            self.start, self.count = np.concatenate([self.start, self.start]), np.concatenate([self.count, self.count])
        while len(self.flat) < ids:
            self.flat = np.concatenate([self.flat, self.flat])

    def _ids(self, texts: list[bytes], whole: np.ndarray) -> list[list[int]]:
        model, out = self.tokenizer.model, [None] * len(texts)
        rest = np.flatnonzero(whole).tolist()
        for i, x in zip(rest, self.tokenizer.encode_batch([texts[i].decode("utf-8", "replace") for i in rest], add_special_tokens=False), strict=True):
            out[i] = x.ids
        for i in np.flatnonzero(~whole).tolist():
            out[i] = [t.id for t in model.tokenize(texts[i].decode("latin-1").translate(self.written))]
        return out

    def encode(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, whole: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all spans together, and how many each span has. whole: which spans need more than the model (else all)."""
        if not len(starts):
            return np.zeros(0, np.uint16), np.zeros(0, np.int64)
        if len(self.index[0]) + len(self.index[1]) > MOST_SPANS or self.used > MOST_IDS:
            self.forget()
        whole = np.ones(len(starts), bool) if whole is None else whole
        first, inverse = distinct_spans(data, starts, ends, whole)
        raw, general = data.tobytes(), whole[first]
        keys = [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
        at = np.fromiter((self.index[w].get(k, -1) for k, w in zip(keys, general.astype(int).tolist(), strict=True)), np.int64, len(keys))
        if len(new := np.flatnonzero(at < 0)):
            found = self._ids([keys[i] for i in new.tolist()], general[new])
            counts = np.fromiter(map(len, found), np.int64, len(found))
            base = len(self.index[0]) + len(self.index[1])
            self._grow(base + len(found), self.used + int(counts.sum()))
            self.start[base : base + len(found)] = self.used + np.cumsum(counts) - counts
            self.count[base : base + len(found)] = counts
            flat = [i for ids in found for i in ids]
            self.flat[self.used : self.used + len(flat)] = flat
            self.used += len(flat)
            at[new] = np.arange(base, base + len(found))
            for i, n in zip(new.tolist(), range(base, base + len(found)), strict=True):
                self.index[int(general[i])][keys[i]] = n
        at = at[inverse]
        counts = self.count[at]
        return self.flat[ranges(self.start[at], counts)], counts

    def encode_plain(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As encode, of rising spans and by plain_pieces."""
        piece, stop, whole, first = plain_pieces(data, starts, ends)
        ids, counts = self.encode(data, piece, stop, whole)
        return ids, np.diff(np.concatenate([[0], np.cumsum(counts)])[first])


_encoders: dict[str, SpanEncoder] = {}


def span_encoder(path: str) -> SpanEncoder:
    if path not in _encoders:
        _encoders[path] = SpanEncoder(path)
    return _encoders[path]
