"""Gated writing of the fact day by day, planning of days, the ledger of runs, and run summaries."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.allocation import Chain, hourly_fact
from ..schemas import GRAIN, MEASURES
from ..sources.readers import Sources, parts_for
from . import gates
from .storage import Published, delete, exists, few_rows, staged

c = F.col


def fact_table(spark: SparkSession, path: str) -> Published:
    """The fact at ``path``, published by owner and day."""
    return Published(spark, path, gates.KEY)


def write_fact_day_replace(fact: DataFrame, path: str) -> None:
    """Replaces the days that ``fact`` has, all together, and leaves all others."""
    fact_table(fact.sparkSession, path).replace(fact)


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    return fact_table(spark, path).read().select(*GRAIN, *MEASURES)


DAY_COLUMNS = [*gates.KEY, "row_count", *gates.DIMENSION_COUNTS, "metrics_passed", "reasons", "passed", "post_passed", "status", "rows_written"]


class Candidate:
    """The fact of a chain, written beside what is live but not published, read back, and the sums of its source.

    The chain runs once, to lines in staging (``run`` reads them). They are dealt by the fact's grain before they are written, into as
    many buckets as the chain has parts, so the fact and the sums of its source, each made of them by itself, need no exchange."""

    def __init__(self, chain: Chain, path: str, mode: str = "write", owner: int = 1):
        if mode not in ("validate", "plan", "write"):
            raise ValueError(mode)
        self.mode, self.spark = mode, chain.orders.sparkSession
        self.place = f"{path.rstrip('/')}-staging-{uuid.uuid4().hex}"
        self.table = fact_table(self.spark, path if mode == "write" else f"{self.place}/fact")
        self.owner, self.buckets = owner, chain.parts or parts_for(chain.src)
        self.parts: list[list[str]] = []
        self.lines = f"lines_{uuid.uuid4().hex}"
        try:
            self.run = chain.written_once(self._in_buckets)
        except BaseException:
            self.close([])
            raise

    def _in_buckets(self, df: DataFrame, name: str) -> DataFrame:
        keys = GRAIN[1:]  # the owner is one
        df.repartition(self.buckets, *keys).write.bucketBy(self.buckets, *keys).option("path", f"{self.place}/{name}").saveAsTable(self.lines)
        return self.spark.table(self.lines)

    def beside(self, work: Callable[[Chain], object]) -> object:
        """Writes the fact and the sums of its source, and does other ``work`` on the run at the same time; gives back what that returns."""
        try:
            with ThreadPoolExecutor(3) as pool:
                fact = pool.submit(self.table.add, hourly_fact(self.run.allocations, self.owner))
                source = pool.submit(staged, gates.source_metrics(self.run.allocations, self.run.orders, self.owner), f"{self.place}/source")
                other = pool.submit(work, self.run)
            if not fact.exception():
                _, self.parts, self.written = fact.result()
            fact.result()
            self.source = source.result()
            return other.result()
        except BaseException:
            self.close([])
            raise

    def close(self, live: list[list[str]]) -> None:
        """Deletes staging and what isn't live."""
        self.table.drop(p for p in self.parts if p not in live)
        self.spark.sql(f"DROP TABLE IF EXISTS {self.lines}")
        delete(self.spark, self.place)

    def finish(self, products: DataFrame, branches: DataFrame, codes: DataFrame) -> DataFrame:
        """One pass of gates compares what was read back with the source and the dimensions. The days before the first that fails go
        live together (mode write); the others' files are deleted. Returns a row for each day: gates, status and rows written."""
        live: list[list[str]] = []
        try:
            days = few_rows(gates.gate_days(self.source, self.written, products, branches, codes))
            first = days.where(~c("passed") | ~c("post_passed")).agg(F.min("business_date")).first()[0]
            good = F.lit(True) if first is None else c("business_date") < F.lit(first)
            if self.mode == "write":
                live = [p for p in self.parts if first is None or p[1] < first.isoformat()]
                self.table.publish(live, self.written.schema)
            else:
                days = days.withColumn("post_passed", F.lit(None).cast("boolean"))
            done = {"validate": "validated", "plan": "planned", "write": "succeeded"}[self.mode]
            status = F.when(~c("passed") | (c("post_passed") == F.lit(False)), "failed").when(~good, "skipped").otherwise(done)
            rows = F.when(F.lit(self.mode == "write") & (c("status") == done), F.coalesce("row_count", F.lit(0))).otherwise(0)
            return days.withColumn("status", status).withColumn("rows_written", rows).select(*DAY_COLUMNS)
        finally:
            self.close(live)


#: A dimension, or how it is made of a chain.
Dimension = DataFrame | Callable[[Chain], DataFrame]


def write_fact(chain: Chain, products: Dimension, branches: Dimension, codes: DataFrame, path: str, mode: str = "write", owner: int = 1) -> DataFrame:
    """Gates, then writes: validate stops after the gates, plan too but reports days, write publishes. See ``Candidate``. The keys of the
    dimensions are written while the fact is, so the gate knows their size and doesn't deal the fact by them."""
    made = Candidate(chain, path, mode, owner)

    def keys(run: Chain) -> list[DataFrame]:
        given = {"product_no": products, "branch_id": branches}
        return [staged((d(run) if callable(d) else d).select("owner_user_id", k), f"{made.place}/{k}") for k, d in given.items()]

    return made.finish(*made.beside(keys), codes)


def persisted_daily_counts(fact: DataFrame, owner: int = 1, start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows by day of an owner, in a window of days with both ends."""
    mine = fact.where(c("owner_user_id") == owner)
    mine = mine if start is None else mine.where(c("business_date") >= F.lit(start).cast("date"))
    mine = mine if end is None else mine.where(c("business_date") <= F.lit(end).cast("date"))
    return mine.groupBy("business_date").agg(F.count("*").alias("row_count"))


def plan_days(spark: SparkSession, fact: DataFrame | None, start: str, end: str, force: bool = False, owner: int = 1, ledger: DataFrame | None = None) -> DataFrame:
    """One row for each day of the window: completed if the fact has it or its last attempt in the ``ledger`` succeeded (a day without
    sales has no row in the fact), else pending; forced days are pending too."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("business_date"))
    if fact is None:
        days = days.withColumn("row_count", F.lit(None).cast("bigint"))
    else:
        days = days.join(persisted_daily_counts(fact, owner, start, end), "business_date", "left")
    done = c("row_count").isNotNull()
    if ledger is not None:
        last = last_attempts(ledger).where(c("owner_user_id") == owner).select("business_date", c("status").alias("last_status"))
        days = days.join(last, "business_date", "left")
        # what the ledger says of a day is newer than what the fact still has of it
        done = F.when(c("last_status").isNull(), done).otherwise(c("last_status") == "succeeded")
    return days.select("business_date", F.coalesce("row_count", F.lit(0)).alias("persisted_rows"), F.when(done & ~F.lit(force), "completed").otherwise("pending").alias("status"))


LEDGER = "run_id string, attempt int, finished_at timestamp, " + ", ".join(f"{k} {t}" for k, t in {"owner_user_id": "bigint", "business_date": "date", "row_count": "bigint", **dict.fromkeys(gates.DIMENSION_COUNTS, "bigint"), "metrics_passed": "boolean", "reasons": "string", "passed": "boolean", "post_passed": "boolean", "status": "string", "rows_written": "bigint"}.items())


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """One row for each owner, day and attempt: the gates' counts and what became of the day. Rows are only ever added."""
    return spark.read.schema(LEDGER).parquet(path) if exists(spark, path) else spark.createDataFrame([], LEDGER)


def last_attempts(ledger: DataFrame) -> DataFrame:
    """The newest attempt of each owner and day. Attempts that only validate or plan don't count."""
    rows = ledger.where(c("status").isin("succeeded", "failed", "skipped"))
    values = [k for k in ledger.columns if k not in gates.KEY]
    return rows.groupBy(*gates.KEY).agg(F.max_by(F.struct(*values), F.struct("attempt", "finished_at", "run_id")).alias("v")).select(*gates.KEY, "v.*")


def write_window(src: Sources, products: DataFrame, branches: DataFrame, codes: DataFrame, path: str, ledger: str, start: str, end: str, mode: str = "write", owner: int = 1, force: bool = False) -> DataFrame:
    """Runs the pending days of a window and adds an attempt for each to the ``ledger`` (a path); days that are done already are left
    out, after a crash too. A day whose sources have no sales succeeds with no rows, and what the fact had of it goes. Returns the
    rows that were added."""
    spark = products.sparkSession
    table = fact_table(spark, path)
    known = read_ledger(spark, ledger)
    plan = plan_days(spark, table.read() if table.exists() else None, start, end, force, owner, known)
    pending = sorted(r["business_date"] for r in plan.where("status = 'pending'").collect())  # at most the days of the window
    if not pending:
        return spark.createDataFrame([], LEDGER)
    attempt = (known.where((c("owner_user_id") == owner) & c("business_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))).agg(F.max("attempt")).first()[0] or 0) + 1
    due = Sources(*(df.where(c("t_open_date").isin(pending)) for df in src))
    days = write_fact(Chain(due), products, branches, codes, path, mode, owner)
    seen = {r["business_date"]: r["status"] for r in days.select("business_date", "status").collect()}
    stopped = min((d for d, s in seen.items() if s == "failed"), default=None)
    done = {"validate": "validated", "plan": "planned", "write": "succeeded"}[mode]
    empty = [d for d in pending if d not in seen]
    if mode == "write" and (gone := [d for d in empty if stopped is None or d < stopped]) and table.exists():
        table.publish([], table.read().schema, [(str(owner), d.isoformat()) for d in gone])
    nothing = dict.fromkeys([*gates.DIMENSION_COUNTS, "row_count", "rows_written"], 0) | {"owner_user_id": owner, "metrics_passed": True, "reasons": "", "passed": True, "post_passed": True if mode == "write" else None}
    of = lambda d: nothing | {"business_date": d, "status": done if stopped is None or d < stopped else "skipped"}
    rows = [tuple(of(d)[k] for k in DAY_COLUMNS) for d in empty]
    every = days.unionByName(spark.createDataFrame(rows, days.schema)) if rows else days
    added = every.select(F.lit(uuid.uuid4().hex).alias("run_id"), F.lit(attempt).alias("attempt"), F.current_timestamp().alias("finished_at"), *DAY_COLUMNS)
    added = few_rows(added.select(*(c(f.name).cast(f.dataType) for f in known.schema)))
    added.coalesce(1).write.mode("append").parquet(ledger)
    return added


def attempt_summary(ledger: DataFrame) -> DataFrame:
    """run_summary of each attempt in a ledger, by run, and of the last attempts of all days together (attempt 0)."""
    each = run_summary(ledger, "run_id", "attempt")
    return each.unionByName(run_summary(last_attempts(ledger)).select(F.lit("").alias("run_id"), F.lit(0).alias("attempt"), "*"))


def run_summary(days: DataFrame, *by: str) -> DataFrame:
    """One row over the days of a run (for each value of ``by``): their numbers by status (skipped ones aren't processed), whether source and candidate, and
    source and what was written, were equal on all days that were compared, misses, failed days and rows written."""
    count = lambda name, *s: F.count(F.when(c("status").isin(*s), 1)).alias(name)
    judged = ~c("status").isin("planned", "skipped")
    every = lambda test, of: F.coalesce(F.bool_and(F.when(of, test)), F.lit(True))
    total = lambda k: F.coalesce(F.sum(F.when(judged, c(k))), F.lit(0))
    return days.groupBy(*by).agg(
        F.count(F.when(c("status") != "skipped", 1)).alias("processed_days"), count("succeeded_days", "succeeded", "validated", "planned"), count("failed_days", "failed"), count("skipped_days", "skipped"),
        every(c("metrics_passed"), judged).alias("source_candidate_equal"), (every(c("post_passed"), judged) & (F.count("post_passed") > 0)).alias("source_persisted_equal"),
        *(total(k).alias(k) for k in gates.DIMENSION_COUNTS), F.count(F.when(judged & (c("status") == "failed"), 1)).alias("failed_gate_days"), F.coalesce(F.sum("rows_written"), F.lit(0)).alias("rows_written"),
    )
