"""Reading of day-partitioned sources, as typed Parquet or as delimited text."""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import DAY, SOURCES


#: Bytes of the sources' files for one task of a join by order.
PART_BYTES = 8 << 20

#: The column in which the reader of text leaves a line that doesn't fit.
BAD = "__bad"


class Sources(NamedTuple):
    orders: DataFrame
    items: DataFrame
    additions: DataFrame
    payments: DataFrame


def read_raw_text(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A table of pipe-delimited text in folders by day (``t_open_date=...``). An empty field is null, as \\N is; the sales rules take
    a blank text and none for the same."""
    return spark.read.schema(f"{SOURCES[name]}, {DAY}").option("sep", "|").option("nullValue", "\\N").option("quote", "").csv(path)


def read_source(spark: SparkSession, path: str, name: str, start: str, end: str) -> DataFrame:
    """A Parquet table inside a window of days, both ends included; other days' folders aren't read."""
    return in_window(spark.read.schema(f"{SOURCES[name]}, {DAY}").parquet(path), start, end)


def in_window(df: DataFrame, start: str | None, end: str | None) -> DataFrame:
    if start is not None:
        df = df.where(F.col("t_open_date") >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col("t_open_date") <= F.lit(end).cast("date"))
    return df


def columns_of(name: str) -> list[tuple[str, str]]:
    """The declared columns of a source, without the day."""
    return [tuple(f.split()[:2]) for f in " ".join(SOURCES[name].split()).split(", ")]


def read_checked_text(spark: SparkSession, path: str, name: str) -> tuple[DataFrame, DataFrame]:
    """The rows of a text table that fit the schema, and those that don't (a bad number or date, too few or too many fields): t_open_date,
    source_table, source_file, readable (the fields that can be read, as JSON) and line as it stands. Every line is in one of the two if
    all columns are taken; Spark converts and so judges only those that are."""
    reader = spark.read.schema(f"{SOURCES[name]}, {BAD} string, {DAY}").option("sep", "|").option("nullValue", "\\N").option("quote", "").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD).option("columnPruning", "false")
    rows = reader.csv(path)
    good = rows.where(F.col(BAD).isNull()).drop(BAD)
    bad = rows.withColumn("source_file", F.col("_metadata.file_path")).where(F.col(BAD).isNotNull()).select("t_open_date", F.lit(name).alias("source_table"), "source_file", F.to_json(F.struct(*(n for n, _ in columns_of(name)))).alias("readable"), F.col(BAD).alias("line"))
    return good, bad


def raw_to_parquet(spark: SparkSession, path: str, name: str, to: str) -> None:
    _by_day(read_raw_text(spark, path, name), to)


def _by_day(df: DataFrame, to: str) -> None:
    """Adaptive execution splits a large day over several tasks and joins small ones."""
    df.hint("rebalance", "t_open_date").write.mode("overwrite").partitionBy("t_open_date").parquet(to)


def ingest_raw(spark: SparkSession, path: str, name: str, to: str, quarantine: str) -> DataFrame:
    """Text to Parquet by day; rows that don't fit go to the quarantine (added to what is there). Returns the gate: rows of both kinds by day,
    and whether all fitted. Counts are of what was written."""
    good, bad = read_checked_text(spark, path, name)
    _by_day(good, to)
    run = uuid.uuid4().hex
    bad.withColumn("run_id", F.lit(run)).write.mode("append").parquet(quarantine)
    kept = spark.read.schema(good.schema).parquet(to).groupBy("t_open_date").agg(F.count("*").alias("good_rows"))
    lost = spark.read.parquet(quarantine).where(F.col("run_id") == run).groupBy("t_open_date").agg(F.count("*").alias("bad_rows"))
    zero = lambda k: F.coalesce(k, F.lit(0)).alias(k)
    out = kept.join(lost, "t_open_date", "full_outer").select("t_open_date", F.lit(name).alias("source_table"), zero("good_rows"), zero("bad_rows"))
    return out.withColumn("passed", F.col("bad_rows") == 0)


def parts_for(src: Sources) -> int:
    """Into how many parts joins by order deal the sources: one for every PART_BYTES of their files and at least one for each core, so that what a
    task holds doesn't grow with the tables. (Adaptive execution goes by compressed bytes, of which a task that sorts, groups and ranks holds a
    multiple.) Sources that aren't files count as empty."""
    total = 0
    for df in src:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        sizes = (int(leaves.apply(k).stats().sizeInBytes()) for k in range(leaves.size()))
        total += sum(n for n in sizes if n < 1 << 60)  # Spark's word for unknown is the largest long
    return max(src.orders.sparkSession.sparkContext.defaultParallelism, -(-total // PART_BYTES))


def bucketed(src: Sources, path: str, buckets: int | None = None) -> Sources:
    """The sources written under ``path`` as tables in buckets by order and day, sorted by both: what is joined or grouped by these then
    needs no exchange, and a large day is spread over all buckets. A table holds the days of one load; for a few of its days the readers
    by day are better, as buckets are read whole. Without a number of ``buckets`` there are as many as the files' bytes ask for."""
    spark, buckets = src.orders.sparkSession, buckets or parts_for(src)
    out = []
    for name, df in zip(src._fields, src, strict=True):
        keys = ["id" if name == "orders" else "order_id", "t_open_date"]
        table = f"{name}_{uuid.uuid4().hex}"
        df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).option("path", f"{path.rstrip('/')}/{name}").saveAsTable(table)
        out.append(spark.table(table))
    return Sources(*out)


def write_raw_text(df: DataFrame, path: str) -> None:
    """The text twin of a source, by day."""
    df.write.mode("overwrite").partitionBy("t_open_date").option("sep", "|").option("nullValue", "\\N").option("emptyValue", "").option("quote", "\u0000").option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path)


def window(src: Sources, start: str | None = None, end: str | None = None) -> Sources:
    return Sources(*(in_window(df, start, end) for df in src))
