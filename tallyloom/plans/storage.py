"""Scratch folders, and tables whose parts are replaced together.

A published table has its rows in folders by key and version (``data/<key>=.../v=<version>``) and numbered lists of the folders that
are live (``live/00000001`` and on). A writer adds folders that no list names yet, then puts the next list in place by one rename: a
reader sees either all parts as before or all as after, and a job that is killed before the rename has changed nothing. A reader that
has begun keeps its folders until ``vacuum`` deletes what no kept list names.
"""

from __future__ import annotations

import json
import os
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

c = F.col


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder (spark.checkpoint.dir); a temporary one only where that isn't set and Spark runs on this
    machine alone."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + os.path.abspath(tempfile.mkdtemp())
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = file_system(spark, path)
    return fs.exists(at)


def delete(spark: SparkSession, path: str) -> None:
    fs, at = file_system(spark, path)
    fs.delete(at, True)


def staged(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to ``path`` and read back."""
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Lets Spark delete the files of shuffles that nothing reads any more: it does so when the driver collects its garbage, which may be long
    after a step of a job, with the files of all steps beside one another until then."""
    spark._jvm.System.gc()


def few_rows(df: DataFrame) -> DataFrame:
    """A frame of few rows (a row for each day, metric or traced order), made now and kept in the plan itself."""
    return df.sparkSession.createDataFrame(df.toArrow(), df.schema)


class Published:
    """A table at ``path``, replaced by parts: the values of ``keys``, which have no nulls."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str]):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), keys

    def _lists(self) -> list[str]:
        fs, at = file_system(self.spark, f"{self.path}/live")
        if not fs.exists(at):
            return []
        return sorted(n for f in fs.listStatus(at) if (n := f.getPath().getName()).isdigit())

    def live(self, number: str | None = None) -> dict:
        """The newest list, or the one of a number: schema (or null), and the version of each part."""
        lists = self._lists()
        if not lists:
            return {"schema": None, "parts": []}
        fs, at = file_system(self.spark, f"{self.path}/live/{number or lists[-1]}")
        stream = fs.open(at)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def exists(self) -> bool:
        return bool(self._lists())

    def _folder(self, part: list[str]) -> str:
        return "/".join([f"{self.path}/data", *(f"{k}={v}" for k, v in zip(self.keys, part[:-1], strict=True)), f"v={part[-1]}"])

    def _read(self, parts: list[list[str]], schema: StructType) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], schema)
        read = self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*(self._folder(p) for p in parts))
        return read.select(*schema.names)

    def read(self, number: str | None = None) -> DataFrame:
        """The live rows now (or as a list of another number has them)."""
        found = self.live(number)
        if found["schema"] is None:
            raise FileNotFoundError(f"nothing is published at {self.path}")
        return self._read(found["parts"], StructType.fromJson(found["schema"]))

    def add(self, df: DataFrame) -> tuple[str, list[list[str]], DataFrame]:
        """Writes ``df`` beside what is live: the version, its parts, and its rows read back. Rows are dealt by key, and adaptive execution
        splits a large part over several tasks and joins small ones."""
        version = uuid.uuid4().hex
        df.hint("rebalance", *self.keys).withColumn("v", F.lit(version)).write.mode("append").partitionBy(*self.keys, "v").parquet(f"{self.path}/data")
        fs, at = file_system(self.spark, f"{self.path}/data" + "/*" * len(self.keys) + f"/v={version}")
        parts = []
        for f in fs.globStatus(at) or []:
            names = f.getPath().toString().split("/")[-len(self.keys) - 1 :]
            parts.append([n.partition("=")[2] for n in names])
        return version, sorted(parts), self._read(sorted(parts), df.schema)

    def publish(self, parts: Iterable[list[str]], schema: StructType, without: Iterable[tuple[str, ...]] = ()) -> str:
        """Makes parts live in place of those of the same keys, and drops those of the keys ``without``. If another writer is quicker, its
        list is taken as the base and this one comes after it."""
        parts = list(parts)
        gone = {tuple(p[:-1]) for p in parts} | {tuple(map(str, k)) for k in without}
        while True:
            lists = self._lists()
            kept = [p for p in self.live(lists[-1])["parts"] if tuple(p[:-1]) not in gone] if lists else []
            text = json.dumps({"schema": json.loads(schema.json()), "parts": sorted(kept + parts)})
            number = f"{int(lists[-1]) + 1 if lists else 1:08d}"
            fs, temporary = file_system(self.spark, f"{self.path}/live/_new-{uuid.uuid4().hex}")
            out = fs.create(temporary)
            out.write(bytearray(text.encode()))
            out.close()
            _, final = file_system(self.spark, f"{self.path}/live/{number}")
            if not fs.exists(final) and fs.rename(temporary, final):
                return number
            fs.delete(temporary, False)

    def drop(self, parts: Iterable[list[str]]) -> None:
        """Deletes folders that aren't to be published."""
        for p in parts:
            delete(self.spark, self._folder(p))

    def replace(self, df: DataFrame, without: Iterable[tuple[str, ...]] = ()) -> str:
        """Replaces all parts that ``df`` has, together."""
        _, parts, _ = self.add(df)
        return self.publish(parts, df.schema, without)

    def vacuum(self, keep: int = 1) -> int:
        """Deletes all but the newest ``keep`` lists, and the folders that none of those names; how many folders went. Not while a writer runs."""
        lists = self._lists()
        named = {self._folder(p) for n in lists[-keep:] for p in self.live(n)["parts"]}
        fs, at = file_system(self.spark, f"{self.path}/data" + "/*" * len(self.keys) + "/v=*")
        plain = {n.split("/data/")[-1] for n in named}
        gone = [f.getPath() for f in fs.globStatus(at) or [] if f.getPath().toString().split("/data/")[-1] not in plain]
        for p in gone:
            fs.delete(p, True)
        for n in lists[:-keep]:
            delete(self.spark, f"{self.path}/live/{n}")
        return len(gone)
