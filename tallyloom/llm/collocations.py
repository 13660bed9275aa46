"""Operator 11: collocations of two to five words, by prefix-free parsing.

A trigger is a run of four words whose hash says so. Each text is parsed into chunks that begin at its start or at a trigger and
go on to the end of the next trigger (or of the text), so neighbours share four words, no trigger stands inside a chunk, and equal
passages give equal chunks wherever they stand. The dictionary has each distinct chunk of a language once, with its frequency in
the parse; hot chunks are summed before they are shuffled. Phrases are then counted inside distinct chunks only, with the chunk's
frequency as weight. The four shared words count in the second chunk only: a phrase counts where it begins.

Lengths are counted one after the other. Sums of 64-bit hashes first say which phrases can reach ``least``: of a phrase of n words
that can, both parts of n - 1 words can, so longer phrases are looked at only there. Hashes of the phrases of one length that can
are sent to the tasks if there are at most ``most`` of them; beyond that, that length filters nothing and the next one is counted
whole. Collisions only let too much through: in the end the phrases themselves, as strings, are counted, and all figures come from that.

A candidate inside a longer one of the same frequency is dropped; one word more is enough to look at, as frequencies never rise with
length. Arithmetic is in decimals of 38 digits. The best of a language are found in two steps, so no task sorts all its phrases.

Null texts are empty; a null language is ``und``; texts of under two words give no phrase but their words count; repeated rows count
each time; doc_id and extra columns aren't looked at; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import distinct_spans, drop_stage, materialize, mix, ranges, row_of, separators, slices, span_hashes, spans, table, windows

LONGEST, LEAST, TOP = 5, 100, 2000
#: A trigger's words, and one in how many runs of words is one.
TRIGGER, EVERY = LONGEST - 1, 48
#: Hashes of the phrases of one length that are sent to tasks (eight bytes each).
MOST = 4_000_000
#: Parts in which a language's best are looked for first.
SALTS = 64

_BREAK = separators(b".,;:!?\n\v\f\r")
_APART = separators(b".,;:!?\n\v\f\r \t")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def chunks_of(data: np.ndarray, at: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Chunks of the texts of a slice: bytes (words joined by a space, by a newline between pieces), own words (all but those shared
    with the next chunk), words in all, and the text of each."""
    low = _LOWER[data]
    starts, ends, bounds = spans(low, at, _APART)
    n = len(starts)
    if not n:
        return [], np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    size = ends - starts
    place = np.cumsum(size + 1) - size - 1  # of each word in the text that is written anew
    plain = np.full(int(size.sum()) + n, 0x20, np.uint8)
    plain[ranges(place, size)] = low[ranges(starts, size)]
    breaks = np.concatenate([[0], np.cumsum(_BREAK[low])])
    plain[(place + size)[:-1][breaks[starts[1:]] > breaks[ends[:-1]]]] = 0x0A
    runs, run_bounds = windows(span_hashes(low, starts, ends), bounds, TRIGGER)
    text = row_of(run_bounds)
    whole = np.diff(bounds)[text] >= TRIGGER
    first = bounds[:-1][text] + np.arange(len(text)) - run_bounds[:-1][text]
    trigger = first[whole & (runs % np.uint64(EVERY) == 0)]
    begin = np.unique(np.concatenate([bounds[:-1][np.diff(bounds) > 0], trigger]))
    owner = np.searchsorted(bounds, begin, "right") - 1
    stop = np.append(begin[1:], n)  # of the own words
    last = stop == bounds[owner + 1]
    end = np.where(last, stop, stop + TRIGGER)
    raw = plain.tobytes()
    out = [raw[s:e] for s, e in zip(place[begin].tolist(), (place[end - 1] + size[end - 1]).tolist(), strict=True)]
    return out, stop - begin, end - begin, owner


def parse(docs: DataFrame) -> DataFrame:
    """The dictionary of ``docs`` (lang, text): lang, chunk (binary), own (words that are counted in it), times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, at in slices(b["text"]):
                found, own, _, owner = chunks_of(data, at)
                yield pa.RecordBatch.from_arrays([b["lang"].slice(i, j - i).take(pa.array(owner)), pa.array(found, pa.binary()), pa.array(own.astype(np.int32))], ["lang", "chunk", "own"])

    return docs.mapInArrow(run, "lang string, chunk binary, own int").groupBy("lang", "chunk", "own").agg(F.count("*").alias("times"))


class Grams:
    """The words of a batch of chunks, and hashes of the phrases that begin at each."""

    def __init__(self, b: pa.RecordBatch):
        langs = b["lang"].dictionary_encode()
        salt = span_hashes(*_flat(langs.dictionary.cast(pa.binary())))
        self.data, at = _flat_at(_with_ends(b["chunk"]))
        self.starts, self.ends, self.bounds = spans(self.data, at, _APART)
        row = row_of(self.bounds)
        self.lang = np.asarray(langs.indices)[row]
        self.names = langs.dictionary
        self.times = b["times"].to_numpy()[row]
        self.own = np.arange(len(row)) - self.bounds[row] < b["own"].to_numpy()[row]
        gaps = np.concatenate([[0], np.cumsum(self.data == 0x0A)])
        self.piece = row + gaps[self.starts]  # rises at each break and each chunk
        self.words = span_hashes(self.data, self.starts, self.ends)
        self.salt = salt[self.lang] if len(salt) else np.zeros(0, np.uint64)

    def hashes(self, size: int) -> np.ndarray:
        """At each word, the hash of the language and of the phrase of ``size`` words from there (any number where there is none)."""
        total, n = self.salt + np.uint64(size), len(self.words)
        for k in range(size):
            total = total * np.uint64(0xD6E8FEB86659FD93)
            total[: n - k] += self.words[k:]
        return mix(total)

    def whole(self, size: int) -> np.ndarray:
        """Whether a phrase of ``size`` words begins at each word."""
        out = np.zeros(len(self.words), bool)
        n = len(self.words) - size + 1
        if n > 0:
            out[:n] = self.piece[:n] == self.piece[size - 1 :]
        return out


def _with_ends(column: pa.Array) -> pa.Array:
    """The same chunks, each followed by a newline."""
    return pc.binary_join_element_wise(column.cast(pa.large_binary()), pa.scalar(b"\n", pa.large_binary()), pa.scalar(b"", pa.large_binary()))


def _flat_at(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8)[: at[-1]] if data is not None and len(column) else np.zeros(0, np.uint8)), at if len(column) else np.zeros(1, np.int64)


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data, at = _flat_at(column.cast(pa.large_binary()))
    return data, at[:-1], at[1:]


def inside(keys: np.ndarray | None, h: np.ndarray) -> np.ndarray:
    """Whether each hash is among the sorted ``keys``; None: all are."""
    if keys is None:
        return np.ones(len(h), bool)
    if not len(keys):
        return np.zeros(len(h), bool)
    return keys[np.minimum(np.searchsorted(keys, h), len(keys) - 1)] == h


def frequent_hashes(parsed: DataFrame, size: int, below, least: int) -> DataFrame:
    """h, n: the hashes of ``size`` words whose sums reach ``least``. below: the broadcast hashes of one word less, or None."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            g = Grams(b)
            at = np.flatnonzero(g.own & g.whole(size))
            if size > 1 and below is not None:
                part = g.hashes(size - 1)
                at = at[inside(below.value, part[at])]
                at = at[inside(below.value, part[at + 1])]
            h, which = np.unique(g.hashes(size)[at], return_inverse=True)
            n = np.zeros(len(h), np.int64)
            np.add.at(n, which, g.times[at])
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["h", "n"])

    return parsed.mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("h")


def count_phrases(parsed: DataFrame, least: int = LEAST, longest: int = LONGEST, most: int = MOST) -> DataFrame:
    """lang, size, phrase, f: every phrase of 1 to ``longest`` words that occurs at least ``least`` times in its language."""
    sc, known = parsed.sparkSession.sparkContext, []
    for size in range(1, longest + 1):
        found = materialize(frequent_hashes(parsed, size, known[-1] if known else None, least), "hashes")
        keys = None
        if found.count() <= most:
            keys = sc.broadcast(np.sort(found.toArrow()["h"].to_numpy().view(np.uint64)))
        known.append(keys)
        drop_stage(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            g = Grams(b)
            for size, keys in enumerate(known, 1):
                at = np.flatnonzero(g.own & g.whole(size))
                at = at[inside(None if keys is None else keys.value, g.hashes(size)[at])]
                if not len(at):
                    continue
                starts, ends = g.starts[at], g.ends[at + size - 1]
                first, which = distinct_spans(g.data, starts, ends, g.lang[at].astype(np.int64))
                n = np.zeros(len(first), np.int64)
                np.add.at(n, which, g.times[at])
                raw = g.data.tobytes()
                names = [raw[s:e] for s, e in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([g.names.take(pa.array(g.lang[at][first])), pa.array(np.full(len(first), size, np.int32)), pa.array(names, pa.binary()).cast(pa.string()), pa.array(n)], ["lang", "size", "phrase", "n"])

    counted = parsed.mapInArrow(run, "lang string, size int, phrase string, n long").groupBy("lang", "size", "phrase").agg(F.sum("n").alias("f"))
    return counted.where(F.col("f") >= least)


def scored(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, n, score of each candidate that no longer one of the same frequency holds. totals: lang, n."""
    f = phrases.select("lang", "phrase", "f")
    words = phrases.where("size > 1").select("lang", "size", "phrase", F.col("f").alias("a"), F.split("phrase", " ", -1).alias("w"))
    part = lambda a, n: F.array_join(F.slice("w", a, n), " ")
    cuts = words.select("lang", "size", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", part(1, F.col("k")).alias("left"), part(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    cuts = cuts.join(f.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"]).join(f.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    wide = lambda c: f"cast({c} as decimal(38, 0))"
    cuts = cuts.join(totals, "lang").withColumn("score", F.expr(f"({wide('1000')} * {wide('a')} * {wide('n')}) div ({wide('l')} * {wide('r')})"))
    best = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("best"))
    longer = words.where("size > 2").select("lang", "a", F.explode(F.array(part(1, F.col("size") - 1), part(2, F.col("size") - 1))).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = best.join(longer, ["lang", "phrase"], "left").where("longer is null or longer < best.a")
    return kept.select("lang", "phrase", *(F.col(f"best.{c}") for c in ("a", "l", "r", "n", "score")))


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, most: int = MOST) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` best phrases of each language of ``docs`` (lang, text)."""
    if not 2 <= longest <= LONGEST:
        raise ValueError(f"longest must be 2 to {LONGEST}: neighbouring chunks share {TRIGGER} words")
    parsed = materialize(parse(docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))), "chunks")
    totals = parsed.groupBy("lang").agg(F.sum(F.col("own") * F.col("times")).alias("n"))
    phrases = materialize(count_phrases(parsed, least, longest, most), "phrases")
    kept = materialize(scored(phrases, totals), "scored")
    drop_stage(parsed, phrases)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    some = kept.withColumn("rank", F.row_number().over(W.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*order))).where(F.col("rank") <= top)
    best = some.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return best.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents").select("lang", "text"))


#: The rule itself, over all phrases.
ORACLE_SQL = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
worded as (select lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') as ws from pieces),
totals as (select lang, sum(len(ws)) as n from worded group by lang),
placed as (select lang, ws, unnest(generate_series(1, len(ws))) as i from worded),
sized as (select lang, ws, i, unnest([1, 2, 3, 4, 5]) as size from placed),
f as (
  select lang, size, array_to_string(list_slice(ws, i, i + size - 1), ' ') as phrase, count(*)::hugeint as f
  from sized where i + size - 1 <= len(ws) group by lang, size, phrase having count(*) >= 100),
candidates as (select lang, size, phrase, f as a, string_split(phrase, ' ') as ws from f where size > 1),
cuts as (select *, unnest(generate_series(1, size - 1)) as k from candidates),
scores as (
  select c.lang, c.phrase, c.a, c.k, x.f as l, y.f as r, t.n::hugeint as n, (1000 * c.a * t.n::hugeint) // (x.f * y.f) as score
  from cuts c
  join f x on x.lang = c.lang and x.phrase = array_to_string(list_slice(c.ws, 1, c.k), ' ')
  join f y on y.lang = c.lang and y.phrase = array_to_string(list_slice(c.ws, c.k + 1, c.size), ' ')
  join totals t on t.lang = c.lang),
lowest as (select *, row_number() over (partition by lang, phrase order by score, k) as cut from scores),
longer as (
  select c.lang, c.a, array_to_string(list_slice(c.ws, s.i, s.i + s.m - 1), ' ') as phrase
  from candidates c, (select i, m from range(1, 5) a(i), range(2, 5) b(m)) s
  where s.m < c.size and s.i + s.m - 1 <= c.size),
kept as (
  select o.* from lowest o
  where o.cut = 1 and not exists (select 1 from longer x where x.lang = o.lang and x.phrase = o.phrase and 100 * x.a >= 100 * o.a)),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select lang, rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score::bigint as score
from ranked where rank <= 2000
"""
