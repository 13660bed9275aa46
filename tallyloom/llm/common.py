"""Vectorised text kernels and shared-storage helpers of the operators in this folder.

Texts are handled as slices of an Arrow string column: one byte buffer and its row offsets. A slice holds whole
texts (at most ``SLICE_BYTES`` together, or one longer text), so memory is bounded by the longest text.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 20
ASCII_SPACE = b" \t\n\v\f\r"

#: The bytes that count of a block of eight of which so many belong to the span.
_PART = np.array([256**n - 1 for n in range(9)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser: every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 row offsets of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), at


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of runs of whole texts."""
    data, at = buffers(column)
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + most, "right")) - 1)
        yield i, j, data[at[i] : at[j]], at[i : j + 1] - at[i]
        i = j


def separators(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[np.frombuffer(chars, np.uint8)] = True
    return table


SPACE = separators(ASCII_SPACE)
NEWLINE = separators(b"\n")
#: White space, ASCII punctuation and control characters: what is left are ASCII letters, digits and all bytes of other characters.
PUNCTUATION = separators(bytes(b for b in range(128) if not chr(b).isalnum()))


def spans(data: np.ndarray, at: np.ndarray, apart: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of a slice, and where each text's words begin and end in them.

    A word is a longest run of bytes that ``apart`` doesn't name; it never crosses from one text to the next."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    inside = ~apart[data]
    edge = np.ones(n + 1, bool)
    edge[1:n] = ~inside[:-1]
    edge[at] = True
    starts = np.flatnonzero(inside & edge[:n])
    edge[1:n] = ~inside[1:]
    edge[at] = True
    ends = np.flatnonzero(inside & edge[1:]) + 1
    return starts, ends, np.searchsorted(starts, at)


def _blocks(data: np.ndarray) -> np.ndarray:
    """At each byte, that byte and the seven after it as one number (zeros after the end)."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes. Each block of eight bytes is mixed with its place before the blocks are added, so no
    pattern of bytes cancels out; spans are still to be compared where a collision would give a wrong result."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    blocks, size = _blocks(data), ends - starts
    total = mix(blocks[starts] & _PART[np.minimum(size, 8)])
    if len(long := np.flatnonzero(size > 8)):
        more = (size[long] - 1) // 8
        k = ranges(np.ones(len(long), np.int64), more)
        at = np.repeat(starts[long], more) + 8 * k
        part = blocks[at] & _PART[np.minimum(np.repeat(ends[long], more) - at, 8)]
        total[long] += np.add.reduceat(mix(mix(part) + k.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), np.cumsum(more) - more)
    return mix(total + size.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def same_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, like: np.ndarray) -> np.ndarray:
    """Whether each span has the bytes of the span at the place that ``like`` names."""
    blocks, size = _blocks(data), ends - starts
    same = (size == size[like]) & (((blocks[starts] ^ blocks[starts[like]]) & _PART[np.minimum(size, 8)]) == 0)
    long = np.flatnonzero(same & (size > 8) & (like != np.arange(len(like))))
    if len(long):
        more = (size[long] - 1) // 8
        k = 8 * ranges(np.ones(len(long), np.int64), more)
        at = np.repeat(starts[long], more) + k
        off = (blocks[at] ^ blocks[np.repeat(starts[like[long]], more) + k]) & _PART[np.minimum(np.repeat(ends[long], more) - at, 8)]
        same[long] = ~np.logical_or.reduceat(off != 0, np.cumsum(more) - more)
    return same


def distinct_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, kind: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The place of one of each different span, and for each span which of them it is. Hashes sort the spans, their bytes decide.
    kind: a small number of each span, by which equal spans may differ."""
    h = span_hashes(data, starts, ends)
    if kind is not None:
        h = h ^ mix(kind.astype(np.uint64))
    _, first, inverse = np.unique(h, return_index=True, return_inverse=True)
    odd = ~same_spans(data, starts, ends, first[inverse])
    if kind is not None:
        odd |= kind != kind[first[inverse]]
    if odd.any():  # different spans of one hash
        raw, known, more = data.tobytes(), {}, []
        for i in np.flatnonzero(odd).tolist():
            span = (raw[starts[i] : ends[i]], 0 if kind is None else int(kind[i]))
            if span not in known:
                known[span] = len(first) + len(more)
                more.append(i)
            inverse[i] = known[span]
        first = np.concatenate([first, more])
    return first, inverse


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """arange(s, s + n) of each pair, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)


def windows(hashes: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's runs of ``size`` words, and their bounds by text. A text with fewer words, but any, has one run of all."""
    counts = np.diff(bounds)
    runs = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    out_bounds = np.concatenate([[0], np.cumsum(runs)])
    if not len(hashes):
        return np.zeros(0, np.uint64), out_bounds
    first = ranges(bounds[:-1], runs)
    left = np.repeat(bounds[1:], runs) - first
    padded = np.concatenate([hashes, np.zeros(size, np.uint64)])
    total = np.zeros(len(first), np.uint64)
    for k in range(size):
        total = total * np.uint64(0xD6E8FEB86659FD93) + np.where(left > k, padded[first + k], np.uint64(k + 1))
    return mix(total), out_bounds


def row_of(bounds: np.ndarray) -> np.ndarray:
    """For each element, the text that it belongs to."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


_own: list[str] = []


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all machines share (spark.checkpoint.dir). Where that isn't set, a temporary one of this
    machine, but only if Spark runs on this machine alone."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not _own:
            _own.append("file://" + tempfile.mkdtemp(prefix="tallyloom-"))
        base = _own[0]
    if "://" not in base:
        base = "file://" + os.path.abspath(base.removeprefix("file:"))
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: a lost executor costs no earlier stage."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tallyloom_path = path
    return out


def drop_stage(*stages: DataFrame) -> None:
    """Deletes what materialize() wrote; nothing may read those rows later."""
    for df in stages:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._tallyloom_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Rows of one key that a join takes to one place.
SPLIT = 1024


def places_of(many: DataFrame, keys: list[str], split: int = SPLIT) -> DataFrame:
    """keys, places: of the keys with over ``split`` rows, how many places they are dealt to. At most rows / split rows."""
    heavy = many.groupBy(*keys).count().where(F.col("count") > split)
    return materialize(heavy.select(*keys, F.ceil(F.col("count") / split).cast("int").alias("places")), "places")


def dealt(many: DataFrame, places: DataFrame, keys: list[str], by: str) -> DataFrame:
    """``many`` with its place, by the hash of the column ``by``: 0 for keys of few rows."""
    out = many.join(places, keys, "left").withColumn("place", F.pmod(F.xxhash64(by), F.coalesce("places", F.lit(1))).cast("int"))
    return out.drop("places")


def copied(few: DataFrame, places: DataFrame, keys: list[str]) -> DataFrame:
    """``few`` (one row a key) with a copy for each place of its key."""
    out = few.join(places, keys, "left").withColumn("place", F.explode(F.sequence(F.lit(0), F.coalesce("places", F.lit(1)) - 1)))
    return out.drop("places")


def file_system(uri: str):
    """pyarrow's file system for a URI, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Two columns only, ``doc_id`` and ``text``; a null text is empty."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def held_out():
    """crc32 of the id's decimal text modulo 5 is 0: rows that no model learns from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
