"""Operator 7: toxicity by a factorization machine over hashed terms.

Terms are words without case and punctuation, and their first ``PREFIXES`` bytes (stems carry the sense of inflected
and compound words), hashed to ``BUCKETS``; the machine adds to the linear weights the inner
products of the factors of every pair of terms in a text, so that an insult beside a mention of a group can weigh
more than both alone. It is fitted on a bounded, documented sample of labelled rows (``DOCS``, those of the smallest
hashes), over the ``TERMS`` buckets that tell most about the label there by themselves and up to ``PAIRED`` more that tell in a pair what
neither tells alone; scoring covers every word of every text.

Null and empty texts get the score of no terms; equal texts get equal scores; without labels of both kinds every
score is 0. Repeated rows stay, an empty table gives no rows, extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import PUNCTUATION, held_out, row_of, slices, span_hashes, spans, table

#: Bounds of the fit: labelled documents, buckets, terms and factors.
DOCS, BUCKETS, TERMS, FACTORS = 8_000, 1 << 20, 1536, 8
PREFIXES = (4, 5, 6, 7)
#: Terms taken for their pairs, the terms among which pairs are sought (those nearest to standing in half of the texts), and the least
#: gain of a pair over each of its terms, in nats over the whole sample: of millions of idle pairs, hardly one has as much.
PAIRED, SOUGHT, LEAST_GAIN = 384, 2048, 20.0


def terms(column: pa.Array, wanted: np.ndarray | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, text of each term, bucket) with each bucket of a text once. wanted: a flag for each bucket."""
    for i, j, _, _ in slices(column):
        low = pc.utf8_lower(column.slice(i, j - i))
        for _, _, data, at in slices(low, 1 << 40):
            starts, ends, bounds = spans(data, at, PUNCTUATION)
            text = row_of(bounds)
            found = []
            for most in (*PREFIXES, None):
                part = np.arange(len(starts)) if most is None else np.flatnonzero(ends - starts > most)
                s = starts[part]
                bucket = (span_hashes(data, s, ends[part] if most is None else s + most) % np.uint64(BUCKETS)).astype(np.int64)
                if wanted is not None:
                    keep = wanted[bucket]
                    part, bucket = part[keep], bucket[keep]
                found.append(text[part] * BUCKETS + bucket)
            pairs = np.unique(np.concatenate(found))
            yield i, j, pairs // BUCKETS, pairs % BUCKETS


class Machine:
    """Score of a set of terms: bias + linear weights + inner products of the factors of all pairs."""

    def __init__(self, buckets: np.ndarray, bias: float, linear: np.ndarray, factors: np.ndarray):
        self.buckets, self.bias, self.linear, self.factors = buckets, bias, linear, factors

    def wanted(self) -> np.ndarray:
        flags = np.zeros(BUCKETS, bool)
        flags[self.buckets] = True
        return flags

    def raw(self, rows: int, text: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log-odds, and the summed factors, of each text. term: positions in ``buckets``."""
        total = np.zeros((rows, self.factors.shape[1]))
        np.add.at(total, text, self.factors[term])
        own = np.bincount(text, (self.factors[term] ** 2).sum(1), rows)
        return self.bias + np.bincount(text, self.linear[term], rows) + 0.5 * ((total**2).sum(1) - own), total

    def score(self, rows: int, text: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.buckets, bucket), len(self.buckets) - 1)
        ours = self.buckets[at] == bucket
        z, _ = self.raw(rows, text[ours], at[ours])
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def information(has: np.ndarray, total: np.ndarray, yes: float, n: int) -> np.ndarray:
    """The mutual information of a label that ``yes`` of ``n`` texts have and flags of ``total`` texts, ``has`` of them with the label."""
    out = np.zeros(np.shape(has))
    for part, of, share in ((has, total, yes), (total - has, total, n - yes), (yes - has, n - total, yes), (n - total - yes + has, n - total, n - yes)):
        out += np.where(part > 0, part / n * np.log(np.maximum(part, 1e-9) * n / (np.maximum(of, 1e-9) * share)), 0)
    return out


def telling_pairs(text: np.ndarray, term: np.ndarray, total: np.ndarray, gain: np.ndarray, labels: np.ndarray, block: int = 256) -> np.ndarray:
    """The terms of the pairs whose standing together tells most beyond what each of the two tells. total, gain: of each term."""
    n, yes = len(labels), float(labels.sum())
    sought = np.sort(np.argsort(-np.minimum(total, n - total), kind="stable")[:SOUGHT])
    place = np.full(len(total), -1)
    place[sought] = np.arange(len(sought))
    x = np.zeros((n, len(sought)), np.float32)  # DOCS x SOUGHT at most
    ours = place[term] >= 0
    x[text[ours], place[term[ours]]] = 1
    x_yes, alone = x[labels > 0], gain[sought]
    best, partner = np.zeros(len(sought)), np.zeros(len(sought), np.int64)
    for i in range(0, len(sought), block):
        part = slice(i, i + block)
        more = information((x_yes[:, part].T @ x_yes).astype(float), (x[:, part].T @ x).astype(float), yes, n) - np.maximum(alone[part, None], alone)
        best[part], partner[part] = more.max(1), more.argmax(1)
    order = np.argsort(-best, kind="stable")
    order = order[n * best[order] >= LEAST_GAIN]
    both = np.stack([order, partner[order]], 1).ravel()
    _, first = np.unique(both, return_index=True)
    return sought[both[np.sort(first)[:PAIRED]]]


def fit(texts: list[str], labels: np.ndarray, rounds: int = 200, rate: float = 0.1, decay: float = 2e-3, seed: int = 5) -> Machine | None:
    """Logistic loss with weight decay, by AdaGrad over the whole sample."""
    labels = np.asarray(labels, np.float32)
    n = len(labels)
    if not n or labels.min() == labels.max():
        return None
    text, bucket = [np.concatenate(x) for x in zip(*((t + i, b) for i, _, t, b in terms(pa.array(texts, pa.string()))), strict=True)]
    kinds, inverse = np.unique(bucket, return_inverse=True)
    all_ = np.bincount(inverse, minlength=len(kinds)).astype(float)
    gain = information(np.bincount(inverse, labels[text], len(kinds)), all_, float(labels.sum()), n)
    best = np.lexsort((kinds, -np.where(all_ >= 3, gain, 0)))[:TERMS]
    best = np.union1d(best, telling_pairs(text, inverse, all_, gain, labels))
    place = np.full(len(kinds), -1)
    place[best] = np.arange(len(best))
    term = place[inverse]
    x = np.zeros((n, len(best)), np.float32)  # DOCS x (TERMS + PAIRED) at most
    x[text[term >= 0], term[term >= 0]] = 1
    draw = np.random.default_rng(seed)
    m = Machine(kinds[best], float(np.log(labels.sum() / (n - labels.sum()))), np.zeros(len(best), np.float32), draw.normal(0, 0.01, (len(best), FACTORS)).astype(np.float32))
    seen = [1e-8, np.full(len(best), 1e-8, np.float32), np.full((len(best), FACTORS), 1e-8, np.float32)]
    for _ in range(rounds):
        total = x @ m.factors
        z = m.bias + x @ m.linear + 0.5 * ((total**2).sum(1) - x @ (m.factors**2).sum(1))
        off = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - labels) / n
        slope = off @ x
        grads = [off.sum(), slope + decay / n * m.linear, x.T @ (off[:, None] * total) - slope[:, None] * m.factors + decay / n * m.factors]
        seen = [s + g * g for s, g in zip(seen, grads, strict=True)]
        steps = [rate * g / np.sqrt(s) for g, s in zip(grads, seen, strict=True)]
        m.bias, m.linear, m.factors = float(m.bias - steps[0]), m.linear - steps[1], m.factors - steps[2]
    return m


def learn(docs: DataFrame, labels: DataFrame) -> Machine | None:
    """Fits on rows of ``labels`` (doc_id, toxic) that are not held out, with their ``docs`` (doc_id, text): at most ``DOCS`` ids, and of
    their texts at most ``DOCS`` (those of the smallest hashes), however often an id is repeated."""
    open_ = labels.where(~held_out() & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = [(r["doc_id"], r["toxic"]) for r in open_.orderBy(F.xxhash64("doc_id"), "doc_id").limit(DOCS).collect()]
    if not chosen:
        return None
    known = F.broadcast(docs.sparkSession.createDataFrame(chosen, "doc_id long, toxic int"))
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).join(known, "doc_id")

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each text as its different words only, in order, so that little goes to the driver."""
        for b in batches:
            words = [" ".join(sorted(set("".join(c if c.isalnum() or ord(c) > 127 else " " for c in t.lower()).split()))) for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["toxic"], pa.array(words, pa.string())], ["doc_id", "toxic", "words"])

    rows = sample.mapInArrow(reduce, "doc_id long, toxic int, words string").orderBy(F.xxhash64("doc_id", "words"), "doc_id", "words").limit(DOCS).toArrow().sort_by([("doc_id", "ascending"), ("words", "ascending")])
    return fit(rows["words"].to_pylist(), rows["toxic"].to_numpy())


def score(docs: DataFrame, machine: Machine | None) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs`` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column = b["text"]
            out = np.zeros(len(b))
            if machine is not None:
                for i, j, text, bucket in terms(column, machine.wanted()):
                    out[i:j] = machine.score(j - i, text, bucket)
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["held_out"], pa.array(out), pa.array((out >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    asked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    return asked.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, learn(docs, table(spark, sf_dir, "labels")))
