"""Operator 10: URL filter over a sorted digest array.

Rules (``host/path-prefix`` and a verdict, allow or block) are hashed to 64-bit xxhash keys. Spark range-partitions and sorts
them by key and each task writes one shard: the sorted keys, then offsets, verdicts and the full strings. A probe finds the
shards of a batch's keys by their first keys, maps those into memory, finds the keys by vectorised binary search and confirms
every hit with the stored string, so a hash collision cannot give a verdict.

A rule's host is what stands before its first ``/``; a rule without one fits any path of its host, a rule without a host fits nothing.
Of a URL's host only suffixes of the lengths that rules' hosts have are looked up, so a host of any length costs its own length.

Nulls and URLs without ``://`` have an empty host and path and so no rule; repeated rules keep the smallest verdict
("allow"); rules or verdicts that are null are ignored, other verdicts raise a ValueError; an empty rule table gives the default
verdict to all; repeated pages stay and an empty page table gives no rows. Extra columns of the page table are ignored.
"""

from __future__ import annotations

import mmap
import os
import struct
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_stage, file_system, materialize, shared_dir, table

VERDICTS = ("allow", "block")
_HEAD = "<8sQQ"
_MAGIC = b"DIGESTS1"
#: First ``://``, host up to / ? or #, path up to ? or #.
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_path(url):
    """Columns host (A-Z lower-cased) and path of a URL column; both empty if it is null or has no ``://``."""
    url = F.coalesce(url, F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.regexp_extract(url, URL, 1), upper, upper.lower()), F.regexp_extract(url, URL, 2)


def key(rule: str) -> int:
    """As Spark's xxhash64: signed, of the UTF-8 bytes."""
    h = xxhash.xxh64_intdigest(rule.encode(), 42)
    return h - (h >> 63 << 64)


def write_index(rules: DataFrame, shard_rows: int = 4_000_000) -> dict:
    """Shards of ``rules`` (rule, verdict) in the shared folder, written by the executors. Returns the manifest:
    per shard its URI and first and last key, and the different lengths of the rules' hosts and of the paths for each (both small)."""
    spark = rules.sparkSession
    rules = rules.where("rule is not null and verdict is not null").groupBy("rule").agg(F.min("verdict").alias("verdict"))
    rules = materialize(rules.select("rule", "verdict", F.xxhash64("rule").alias("key")), "rules")
    if unlike := rules.where(~F.col("verdict").isin(*VERDICTS)).select("rule", "verdict").first():
        raise ValueError(f"a rule's verdict is allow or block: {tuple(unlike)}")
    total = rules.count()
    slash = F.instr("rule", "/")
    shape = rules.select(F.when(slash == 0, F.length("rule")).otherwise(slash - 1).alias("host"), F.when(slash == 0, 0).otherwise(F.length("rule") - slash + 1).alias("path"))
    lengths: dict[int, list[int]] = {}
    for r in shape.where("host > 0").distinct().orderBy("host", "path").collect() if total else []:
        lengths.setdefault(r["host"], []).append(r["path"])
    to = shared_dir(spark, "digests")

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(k, r.encode(), VERDICTS.index(v)) for b in batches for k, r, v in zip(b["key"].to_pylist(), b["rule"].to_pylist(), b["verdict"].to_pylist(), strict=True)]
        if not rows:
            return
        rows.sort()
        strings = [r[1] for r in rows]
        name = f"{to}/{uuid.uuid4().hex}.digests"  # of this attempt alone; the manifest has the one that Spark took
        fs, path = file_system(name)
        fs.create_dir(os.path.dirname(path), recursive=True)
        with fs.open_output_stream(path) as out:
            out.write(struct.pack(_HEAD, _MAGIC, len(rows), sum(map(len, strings))))
            out.write(np.array([r[0] for r in rows], np.int64).tobytes())
            out.write(np.concatenate([[0], np.cumsum([len(s) for s in strings])]).astype(np.uint64).tobytes())
            out.write(np.array([r[2] for r in rows], np.uint8).tobytes())
            out.write(b"".join(strings))
        yield pa.RecordBatch.from_pydict({"uri": [name], "first": [rows[0][0]], "last": [rows[-1][0]]})

    parts = max(1, -(-total // shard_rows))
    dealt = rules.repartitionByRange(parts, "key") if parts > 1 else rules.coalesce(1)
    found = dealt.mapInArrow(shards, "uri string, first long, last long").collect() if total else []
    drop_stage(rules)
    return {"shards": sorted((r["first"], r["last"], r["uri"]) for r in found), "lengths": lengths}


_open: dict[str, tuple] = {}


def _shard(uri: str) -> tuple:
    """Keys, offsets, verdicts and strings of a shard, mapped into memory. A remote one is copied once per worker."""
    if uri not in _open:
        from pyarrow import fs as pafs

        fs, path = file_system(uri)
        if isinstance(fs, pafs.LocalFileSystem):
            f = open(path, "rb")  # noqa: SIM115
        else:
            f = tempfile.TemporaryFile()  # noqa: SIM115
            with fs.open_input_stream(path) as src:
                while piece := src.read(1 << 22):
                    f.write(piece)
            f.flush()
        m = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        f.close()
        magic, n, _ = struct.unpack_from(_HEAD, m)
        if magic != _MAGIC:
            raise ValueError(f"{uri} isn't a digest shard")
        at = struct.calcsize(_HEAD)
        keys = np.frombuffer(m, np.int64, n, at)
        offsets = np.frombuffer(m, np.uint64, n + 1, at + 8 * n)
        verdicts = np.frombuffer(m, np.uint8, n, at + 8 * (2 * n + 1))
        _open[uri] = (keys, offsets, verdicts, m, at + 8 * (2 * n + 1) + n)
    return _open[uri]


def probe(manifest: dict, candidates: list[str]) -> list[str | None]:
    """The verdict of each candidate that is a stored rule, else None."""
    out: list[str | None] = [None] * len(candidates)
    if not candidates:
        return out
    keys = np.fromiter(map(key, candidates), np.int64, len(candidates))
    order = np.argsort(keys)
    for first, last, uri in manifest["shards"]:
        own = order[np.searchsorted(keys, first, "left", sorter=order) : np.searchsorted(keys, last, "right", sorter=order)]
        if not len(own):  # this shard isn't opened
            continue
        stored, offsets, verdicts, m, base = _shard(uri)
        at = np.zeros(len(keys), np.int64)
        at[own] = np.searchsorted(stored, keys[own])
        for i in own[stored[np.minimum(at[own], len(stored) - 1)] == keys[own]].tolist():
            j, want = int(at[i]), candidates[i].encode()
            while j < len(stored) and stored[j] == keys[i]:  # equal keys stand together
                if m[base + int(offsets[j]) : base + int(offsets[j + 1])] == want:
                    out[i] = VERDICTS[verdicts[j]]
                    break
                j += 1
    return out


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict of every row. A rule fits its host and all its subdomains if the path starts
    with the rule's path; the longest fitting rule wins (of equal lengths the one with the longer host); else ``default``."""
    manifest = write_index(rules)
    host, path = host_path(F.col(url_col))
    asked = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            owner, asks = [], []
            for i, (h, p) in enumerate(zip(b["host"].to_pylist(), b["path"].to_pylist(), strict=True)):
                for host_length, path_lengths in manifest["lengths"].items():
                    if host_length == len(h) or host_length < len(h) and h[-host_length - 1] == ".":  # only suffixes that a rule may have
                        tail = h[len(h) - host_length :]
                        for n in path_lengths:
                            if n > len(p):
                                break
                            owner.append(i)
                            asks.append(tail + p[:n])
            rule: list[str | None] = [None] * len(b)
            verdict = [default] * len(b)
            for i, ask, found in zip(owner, asks, probe(manifest, asks), strict=True):
                if found and (rule[i] is None or len(ask) > len(rule[i])):
                    rule[i], verdict[i] = ask, found
            yield pa.RecordBatch.from_arrays([b["page_id"], b["host"], b["path"], pa.array(rule, pa.string()), pa.array(verdict, pa.string())], ["page_id", "host", "path", "rule", "verdict"])

    kind = asked.schema["page_id"].dataType.simpleString()
    return asked.mapInArrow(judge, f"page_id {kind}, host string, path string, rule string, verdict string")


#: The rules of the page filter.
RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]


def page_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RULES, "rule string, verdict string")


ORACLE_SQL = """
WITH p AS (SELECT page_id, coalesce(url, '') AS u FROM pages),
h AS (SELECT page_id,
  translate(regexp_extract(u, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(u, '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM p),
r(rule, rhost, rpath, verdict) AS (VALUES ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
  ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'), ('com/de/', 'com', '/de/', 'block')),
m AS (SELECT h.page_id, r.rule, r.verdict, row_number() OVER (PARTITION BY h.page_id ORDER BY length(r.rule) DESC, length(r.rhost) DESC) AS k
  FROM h JOIN r ON (h.host = r.rhost OR ends_with(h.host, '.' || r.rhost)) AND starts_with(h.path, r.rpath))
SELECT h.page_id, h.host, h.path, m.rule, coalesce(m.verdict, 'allow') AS verdict
FROM h LEFT JOIN m ON m.page_id = h.page_id AND m.k = 1
"""


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), page_rules(spark))
