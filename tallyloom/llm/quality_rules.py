"""Operator 8: quality rules as weak supervision.

Each rule votes good, bad or abstains on a text's counts. Expectation-maximisation over the counts of all vote
patterns of the texts that pass the base rule (at most 3 ** rules of them, so they may go to the driver) estimates the share
of good texts and how often each rule votes how on good and on bad ones; a text is kept if it passes the base rule and its
posterior probability of being good is at least a half.

A null or empty text has no words and fails the base rule; equal texts get equal verdicts; an empty table gives no
rows. Extra columns are ignored. Lines and word windows are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import NEWLINE, materialize, mix, ranges, row_of, separators, slices, span_hashes, spans, table, texts, windows

_SYMBOL = separators(b"#*$%&|<>")
_UPPER = separators(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTER = separators(bytes(b for b in range(256) if b >= 128 or chr(b).isalpha()))
_STOP = separators(b".!?\"';:")
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stopped_lines", "n_letter_words", "n_letters", "n_upper", "n_bang"]


def counts(data: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of each text of a slice."""

    def by_text(mask: np.ndarray, bounds: np.ndarray = at) -> np.ndarray:
        upto = np.concatenate([[0], np.cumsum(mask)])
        return upto[bounds[1:]] - upto[bounds[:-1]]

    starts, ends, bounds = spans(data, at)
    lead = (data & 0xC0) != 0x80
    in_word = np.zeros(len(data) + 1, np.int8)
    in_word[starts] += 1
    np.add.at(in_word, ends, -1)
    inside = np.cumsum(in_word[:-1], dtype=np.int8).astype(bool)
    letters = np.concatenate([[0], np.cumsum(_LETTER[data] & lead)])

    three, three_bounds = windows(span_hashes(data, starts, ends), bounds, 3)
    _, inverse, times = np.unique(mix(three ^ mix(row_of(three_bounds).astype(np.uint64) + np.uint64(1))), return_inverse=True, return_counts=True)
    first = ranges(bounds[:-1], np.diff(three_bounds))[times[inverse] > 1] if len(three) else np.zeros(0, np.int64)
    repeated = np.zeros(len(starts), bool)
    for k in range(3):
        repeated[first + k] = True

    line_starts, line_ends, _ = spans(data, at, NEWLINE)
    real = np.searchsorted(starts, line_starts) < np.searchsorted(starts, line_ends)
    hashes = span_hashes(data, line_starts, line_ends)[real]
    line_ends = line_ends[real]
    line_bounds = np.searchsorted(line_starts[real], at)
    _, seen = np.unique(mix(hashes ^ mix(row_of(line_bounds).astype(np.uint64) + np.uint64(1))), return_index=True)
    again = np.ones(len(hashes), bool)
    again[seen] = False
    return {
        "n_words": np.diff(bounds),
        "word_chars": by_text(inside & lead),
        "n_symbols": by_text(_SYMBOL[data]),
        "n_dup_lines": by_text(again, line_bounds),
        "n_repeat_words": by_text(repeated, bounds),
        "n_lines": np.diff(line_bounds),
        "n_stopped_lines": by_text(_STOP[data[line_ends - 1]] if len(line_ends) else np.zeros(0, bool), line_bounds),
        "n_letter_words": by_text(letters[ends] > letters[starts], bounds),
        "n_letters": by_text(_LETTER[data] & lead),
        "n_upper": by_text(_UPPER[data]),
        "n_bang": by_text(data == ord("!")),
    }


def votes(c: dict[str, np.ndarray]) -> list[np.ndarray]:
    """1 good, -1 bad, 0 abstains; one array for each rule. Each rule looks at one share (the last at the mean length of words)
    and votes on its own: bad where it is high, good where it is clearly fine, neither between."""
    w, lines, letters = c["n_words"], c["n_lines"], c["n_letters"]
    some = np.maximum(w, 1)
    mean = c["word_chars"] / some
    share = {
        "symbols": c["n_symbols"] / some,
        "repeated lines": np.where(lines > 3, c["n_dup_lines"] / np.maximum(lines, 1), 0),
        "repeated words": np.where(w >= 20, c["n_repeat_words"] / some, 0),
        "no letters": (w - c["n_letter_words"]) / some,
        "upper case": c["n_upper"] / np.maximum(letters, 1),
        "open lines": (lines - c["n_stopped_lines"]) / np.maximum(lines, 1),
        "bangs": c["n_bang"] / some,
    }
    bad = {"symbols": 0.1, "repeated lines": 0.3, "repeated words": 0.3, "no letters": 0.3, "upper case": 0.5, "open lines": 0.95, "bangs": 0.3}
    good = {"symbols": 0.05, "repeated lines": 0.15, "repeated words": 0.15, "no letters": 0.1, "upper case": 0.2, "open lines": 0.7, "bangs": 0.1}
    out = [np.where(share[k] >= bad[k], -1, np.where(share[k] <= good[k], 1, 0)) for k in bad]
    out.append(np.where((mean < 2.5) | (mean > 12), -1, np.where((mean >= 3) & (mean <= 9), 1, 0)))
    return [v.astype(np.int8) for v in out]


RULES = 8


def score(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, and votes: the pattern in base 3."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, at in slices(b["text"]):
                c = counts(data, at)
                pattern = sum((v.astype(np.int32) + 1) * 3**k for k, v in enumerate(votes(c)))
                yield pa.RecordBatch.from_arrays([b["doc_id"].slice(i, j - i), *(pa.array(c[k].astype(np.int64)) for k in COUNTS), pa.array(pattern, pa.int32())], ["doc_id", *COUNTS, "votes"])

    return docs.mapInArrow(run, "doc_id long, " + "".join(f"{k} long, " for k in COUNTS) + "votes int")


def label_model(patterns: np.ndarray, weight: np.ndarray, rounds: int = 200) -> np.ndarray:
    """The posterior probability of good of each vote pattern, by expectation-maximisation over the share of good texts and how
    often each rule votes how (bad, abstains, good) on texts of each class, so that what a rule's vote weighs, and for which
    class, is learnt alone. Begins with rules that are mostly right; the class with the higher sum of votes is the good one."""
    v = patterns[:, None] // 3 ** np.arange(RULES) % 3
    cast = np.eye(3)[v]  # pattern, rule, vote
    rates = np.repeat(np.log([[[0.3, 0.2, 0.5]], [[0.02, 0.08, 0.9]]]), RULES, axis=1)
    prior, post = np.log([0.2, 0.8]), None
    for _ in range(rounds):
        odds = np.einsum("prv,crv->pc", cast, rates) + prior
        before, post = post, 1 / (1 + np.exp(np.clip(odds[:, 0] - odds[:, 1], -500, 500)))
        if before is not None and np.abs(post - before).max() < 1e-9:
            break
        of_class = np.stack([weight * (1 - post), weight * post])
        rates = np.log((np.einsum("cp,prv->crv", of_class, cast) + 0.1) / (of_class.sum(1)[:, None, None] + 0.3))
        prior = np.log((of_class.sum(1) + 1) / (weight.sum() + 2))
    leaning = (np.exp(rates) @ [-1, 0, 1]).sum(1)
    return post if leaning[1] >= leaning[0] else 1 - post


def base_failed():
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def passing(scored: DataFrame) -> list:
    """Of each vote pattern, how many texts pass the base rule; the model learns from them, as it judges no others."""
    return scored.groupBy("votes").agg(F.sum(F.when(base_failed(), 0).otherwise(1)).alias("passing")).orderBy("votes").collect()


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, quality (posterior), kept, of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    scored = materialize(score(docs), "quality")
    seen = passing(scored)
    patterns = np.array([r["votes"] for r in seen], np.int64)
    posterior = label_model(patterns, np.array([r["passing"] for r in seen], float)) if seen else np.zeros(0)
    known = spark.createDataFrame(list(zip(patterns.tolist(), posterior.tolist(), strict=True)), "votes int, quality double")
    failed = base_failed()
    out = scored.join(F.broadcast(known), "votes").withColumn("base_failed", failed)
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5)).drop("votes")


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass the base rule and the label model, with all their columns. The model is fitted over all
    rows first; then each row is judged where it stands, so no text is shuffled."""
    patterns = score(docs.select(F.lit(None).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")))
    seen = passing(patterns)
    number = np.array([r["votes"] for r in seen], np.int64)
    good = np.zeros(3**RULES, bool)
    if seen:
        good[number] = label_model(number, np.array([r["passing"] for r in seen], float)) >= 0.5
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, at in slices(b.column(place)):
                c = counts(data, at)
                pattern = sum((v.astype(np.int32) + 1) * 3**k for k, v in enumerate(votes(c)))
                failed = (c["n_words"] < 50) | (100 * c["n_repeat_words"] > 50 * c["n_words"])
                yield b.slice(i, j - i).filter(pa.array(~failed & good[pattern]))

    plain = docs.toDF(*(f"c{k}" for k in range(len(docs.columns))))
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(texts(table(spark, sf_dir, "documents"))).select("doc_id", *COUNTS[:5], "base_failed", "kept", "quality")
