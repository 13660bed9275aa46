"""Operator 3: token ids in a binary file format of frequency-ranked ids with separate control bytes.

Each text is encoded (white-space words, each different word once per worker), an end id is appended, and the ids are
replaced by their rank in the corpus' frequency order, so the most frequent 256 take one byte. Values are stored as
1 to 4 bytes, the lengths apart from them as 2-bit codes, four to a control byte; the decoder looks the lengths of
four values up in a 256-row table. Files hold ascending ids, one file a range of ids, in blocks that are written and
read one at a time.

A null text is empty (the end id alone); repeated ids stand next to each other in their file, ordered by content; an
empty table gives no files and no rows. Extra columns are ignored.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_stage, file_system, materialize, row_of, shared_dir, slices, spans, table, texts
from .encoding import lower_pieces, span_encoder

_BLOCK = "<8sQQQ"  # magic, documents, values, data bytes
_MAGIC = b"RANKVB01"
#: Lengths of the four values of each control byte.
LENGTHS = (((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1).astype(np.uint8)


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    v = values.astype(np.uint32)
    size = 1 + (v > 0xFF).astype(np.int64) + (v > 0xFFFF) + (v > 0xFFFFFF)
    codes = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    codes[: len(v)] = size - 1
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | (codes[:, 1] << 2) | (codes[:, 2] << 4) | (codes[:, 3] << 6)
    at = np.cumsum(size) - size
    data = np.zeros(int(size.sum()), np.uint8)
    for k in range(4):
        has = size > k
        if not has.any():
            break
        data[at[has] + k] = (v[has] >> np.uint32(8 * k)) & np.uint32(0xFF)
    return control.astype(np.uint8), data


def unpack(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    size = LENGTHS[control].ravel()[:n].astype(np.int64)
    at = np.cumsum(size) - size
    out = np.zeros(n, np.uint32)
    for k in range(4):
        has = np.flatnonzero(size > k)
        if not len(has):
            break
        out[has] |= data[at[has] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def tokenize(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """doc_id, ids (binary, unsigned 16-bit little-endian, with the end id)."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = span_encoder(tokenizer)
        for b in batches:
            for i, j, data, at in slices(b["text"]):
                starts, ends, bounds = spans(data, at)
                low, piece, stop, whole, first = lower_pieces(data, starts, ends)
                ids, counts = encoder.encode(low, piece, stop, whole)
                total = np.concatenate([[0], np.cumsum(counts)])[first[bounds]]
                out = np.full(len(ids) + j - i, end_id, np.uint16)
                out[np.arange(len(ids)) + row_of(total)] = ids
                cut = (total + np.arange(j - i + 1)) * 2
                column = pa.Array.from_buffers(pa.binary(), j - i, [None, pa.py_buffer(cut.astype(np.int32).tobytes()), pa.py_buffer(out.astype("<u2").tobytes())])
                yield pa.RecordBatch.from_arrays([b["doc_id"].slice(i, j - i), column], ["doc_id", "ids"])

    return docs.mapInArrow(encode, "doc_id long, ids binary")


def _ids(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for i, j, data, at in slices(column, 1 << 21):
        yield i, j, data.view("<u2") if data.flags["C_CONTIGUOUS"] and data.ctypes.data % 2 == 0 else np.frombuffer(data.tobytes(), "<u2"), at // 2


def id_counts(tokens: DataFrame) -> DataFrame:
    """id, n over all rows; each task sends one row an id at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for b in batches:
            for _, _, ids, _ in _ids(b["ids"]):
                total += np.bincount(ids, minlength=1 << 16)
        have = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"id": pa.array(have, pa.int32()), "n": pa.array(total[have], pa.int64())})

    return tokens.select("ids").mapInArrow(count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_files(tokens: DataFrame, ranked: np.ndarray, to: str) -> list[dict]:
    """One file for each range of doc_ids. ranked: the ids by falling frequency (at most 65,536, so it may go to every task).
    Each attempt of a task writes a file of its own name; the manifest has those of the attempts that Spark took."""
    rank = np.zeros(1 << 16, np.uint32)
    rank[ranked] = np.arange(len(ranked), dtype=np.uint32)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = name = part = None
        docs = n = 0
        for b in batches:
            if not len(b):
                continue
            if out is None:
                part = b["part"][0].as_py()
                name = f"{to}/part-{part:06d}-{uuid.uuid4().hex}.rvb"
                fs, path = file_system(name)
                fs.create_dir(os.path.dirname(path), recursive=True)
                out = fs.open_output_stream(path)
            for i, j, ids, at in _ids(b["ids"]):
                control, data = pack(rank[ids])
                keys = b["doc_id"].slice(i, j - i)
                out.write(struct.pack(_BLOCK, _MAGIC, j - i, len(ids), len(data)))
                out.write(np.asarray(keys.is_valid()).astype(np.uint8).tobytes() + keys.fill_null(0).to_numpy().astype("<i8").tobytes() + np.diff(at).astype("<u4").tobytes())
                out.write(control.tobytes())
                out.write(data.tobytes())
                docs, n = docs + j - i, n + len(ids)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "uri": [name], "docs": pa.array([docs], pa.int64()), "n": pa.array([n], pa.int64())})

    sorted_ = tokens.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "ids").select("doc_id", "ids", F.spark_partition_id().alias("part"))
    return [r.asDict() for r in sorted_.mapInArrow(write, "part int, uri string, docs long, n long").collect()]


def blocks(stream) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """(doc_ids, lengths, ranks) of each block of a file."""
    while head := stream.read(struct.calcsize(_BLOCK)):
        magic, docs, n, size = struct.unpack(_BLOCK, head)
        if magic != _MAGIC:
            raise ValueError("this isn't a file of ranked ids")
        valid = np.frombuffer(stream.read(docs), np.uint8)
        keys = np.frombuffer(stream.read(8 * docs), "<i8")
        lengths = np.frombuffer(stream.read(4 * docs), "<u4").astype(np.int64)
        control = np.frombuffer(stream.read(-(-n // 4)), np.uint8)
        yield [k if v else None for k, v in zip(keys.tolist(), valid.tolist(), strict=True)], lengths, unpack(control, np.frombuffer(stream.read(size), np.uint8), n)


def read_files(spark: SparkSession, files: list[dict], ranked: np.ndarray) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, decoded from the files, a task for each file."""
    start, rows = 0, []
    for f in sorted(files, key=lambda f: f["part"]):
        rows.append((f["uri"], start))
        start += f["n"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri, at in zip(b["uri"].to_pylist(), b["start"].to_pylist(), strict=True):
                fs, path = file_system(uri)
                with fs.open_input_stream(path) as stream:
                    for keys, lengths, ranks in blocks(stream):
                        raw = memoryview(ranked[ranks].astype("<u4").tobytes())
                        ends = np.cumsum(lengths)
                        crc = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(at + ends - lengths), pa.array(lengths), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])
                        at += int(ends[-1]) if len(ends) else 0

    listed = spark.createDataFrame(rows, "uri string, start long")
    return listed.repartition(max(1, len(rows))).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer: str, end_id: int = 1) -> tuple[list[dict], np.ndarray]:
    """Writes the files of all ``docs`` (doc_id, text) and returns their manifest and the ranked ids."""
    tokens = materialize(tokenize(docs, tokenizer, end_id), "tokens")
    counted = sorted(((-r["n"], r["id"]) for r in id_counts(tokens).collect()))
    ranked = np.array([i for _, i in counted], np.uint32)
    files = write_files(tokens, ranked, shared_dir(docs.sparkSession, "token-files"))
    drop_stage(tokens)
    return files, ranked


def op3_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    files, ranked = token_files(texts(table(spark, sf_dir, "documents")), public_tokenizers.path("word_bpe_49k.json"))
    return read_files(spark, files, ranked)
