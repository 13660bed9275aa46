"""The jobs that a user runs from day to day: syncing the dimensions, and dry runs of all reports."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import orders as o
from ..operators.allocation import Chain
from . import dims, reports, writing
from .storage import Published, delete, few_rows, release, scratch, staged

c = F.col


def product_dim(k: Chain, owner: int = 1) -> DataFrame:
    return dims.product_dim(dims.candidates(dims.product_ranked(dims.product_dim_source(k))), owner)


def branch_dim(k: Chain, owner: int = 1) -> DataFrame:
    return dims.branch_dim(dims.candidates(dims.branch_ranked(dims.branch_dim_source(k))), owner)


# Each dimension's file, key, ranked variants, label of a variant, and candidates in its shape.
DIMENSIONS: dict[str, tuple[str, Callable, Callable, Callable]] = {
    "pos_product_dim": ("product_no", lambda k: dims.product_ranked(dims.product_dim_source(k)), dims.product_label, dims.product_dim),
    "pos_branch_dim": ("branch_id", lambda k: dims.branch_ranked(dims.branch_dim_source(k)), dims.branch_label, dims.branch_dim),
}


#: Parts of a dimension that are replaced apart, by a hash of owner and key.
BUCKETS = 32


def dim_table(spark: SparkSession, path: str, name: str) -> Published:
    return Published(spark, f"{path.rstrip('/')}/{name}", ["bucket"])


def read_dim(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A dimension as it is published now."""
    return dim_table(spark, path, name).read().drop("bucket")


def sync_dims(chain: Chain, path: str, mode: str = "plan", owner: int = 1, samples: int = 10) -> DataFrame:
    """Plans or applies the dimensions that the sales give. A row for each dimension: candidates, keys of several variants and the
    first of them as text, keys that are new and that were there, rows afterwards, and whether it was written.

    plan writes nothing. apply rewrites only the buckets in which a row is new or changes, beside the old ones, and then publishes them
    together: readers always find a whole dimension. The variants of each dimension are made once."""
    if mode not in ("plan", "apply"):
        raise ValueError(mode)
    spark = chain.orders.sparkSession
    place = scratch(spark, "dims")
    one = lambda name: _sync_one(chain, path, f"{place}/{name}", name, mode == "apply", owner, samples)
    with ThreadPoolExecutor(len(DIMENSIONS)) as pool:  # neither needs the other
        rows = list(pool.map(one, DIMENSIONS))
    delete(spark, place)
    return spark.createDataFrame(rows, "dimension string, candidate_count long, inserted long, updated long, conflict_count long, conflict_samples string, rows_before long, rows_after long, written boolean")


def _sync_one(chain: Chain, path: str, place: str, name: str, apply: bool, owner: int, samples: int) -> tuple:
    spark = chain.orders.sparkSession
    key, variants, label, shape = DIMENSIONS[name]
    ranked = staged(variants(chain), place)
    bucket = F.pmod(F.xxhash64("owner_user_id", key), F.lit(BUCKETS)).cast("int")
    new = shape(dims.candidates(ranked), owner).withColumn("bucket", bucket)
    table = dim_table(spark, path, name)
    current = table.read() if table.exists() else new.where("false")
    values = [k for k in new.columns if k not in ("owner_user_id", key, "bucket")]
    had = current.select("owner_user_id", key, F.struct(*values).alias("had"))
    after = F.struct(*(F.coalesce(k, f"had.{k}").alias(k) if k == "last_seen_at" else c(k) for k in values))
    seen = new.join(had, ["owner_user_id", key], "left").withColumn("changes", ~after.eqNullSafe(c("had")))
    counts = seen.agg(F.count("*").alias("all"), F.count_if(c("had").isNull()).alias("inserted"), F.count("had").alias("updated"), F.collect_set(F.when(c("changes"), c("bucket"))).alias("touched"))
    # each key has one variant of rank 1, and one of rank 2 if it has several
    n = counts.crossJoin(ranked.agg(F.count_if(c("variant_rank") == 2).alias("several"))).crossJoin(current.agg(F.count("*").alias("before"))).first()
    shown = sorted(f"{r[key]}: {r['variants']}" for r in dims.conflict_samples(ranked, key, label(), samples).collect()) if n["several"] else []
    if apply and n["touched"]:
        mine = c("bucket").isin(n["touched"])
        merged = dims.upsert(current.where(mine).drop("bucket"), new.where(mine).drop("bucket"), key)
        table.replace(merged.withColumn("bucket", bucket))
    return (name, n["all"], n["inserted"], n["updated"], n["several"], "\n".join(shown), n["before"], n["before"] + n["inserted"], apply)


def sync_and_write(chain: Chain, path: str, mode: str = "write", owner: int = 1) -> DataFrame:
    """The whole job: the chain runs once, to lines in staging; of these the dimensions are synced and the candidate fact is written at the
    same time, then the fact is gated against the dimensions as they are now and published. Dimensions and fact stand under ``path``.
    Returns a row for each day."""
    spark = chain.orders.sparkSession
    made = writing.Candidate(chain, f"{path.rstrip('/')}/fact", mode, owner)
    made.beside(lambda run: sync_dims(run, path, "apply", owner))
    return made.finish(*(read_dim(spark, path, n) for n in DIMENSIONS), dims.code_dims(spark))


FAST = ["source_counts", "preview_count", "reconciliation_summary", "top_tax_delta_sample", "status_excluded_summary"]


#: Of an order, what the reports of a dry run read besides its keys: of a newest sale, and of a version of an excluded status.
OF_ORDER = ["order_status", "destination_raw", "has_invalid_amount", "is_amount_outlier", "is_completed_proxy", "item_count", "order_included_tax", "order_excluded_tax", "order_gross_sales", "order_discount_total", "order_surcharge_total", "order_net_sales", "order_sales_ex_tax", "addition_discount_total", "addition_surcharge_total", "addition_include_tax_total"]
OF_EXCLUDED = ["order_status", "destination_raw", "order_total", "order_payment_subtotal", "order_included_tax", "transaction_voided", "transaction_submitted"]


class DryRun(dict):
    """Reports by name. What they read stands in scratch until ``close`` (or the end of a with block)."""

    def __init__(self, spark: SparkSession, place: str):
        super().__init__()
        self.spark, self.place = spark, place

    def close(self) -> None:
        delete(self.spark, self.place)

    def __enter__(self) -> DryRun:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()


def dry_run(chain: Chain, mode: str = "fast", legacy: Chain | None = None, samples: int = 20) -> DryRun:
    """The reports of a run without writing, by name. All share the lines and orders of one run of the chain, which are written to
    scratch once, with what the reports read of them; of the fact only the keys are shuffled, as no report reads it whole. Close the
    result when its reports have been read.

    fast: counts, reconciliation, largest differences, excluded statuses. full: also samples, mappings, breakdowns, traces,
    duplicates, and (with ``legacy``, the chain without de-duplication) the comparisons with it."""
    if mode not in ("fast", "full"):
        raise ValueError(mode)
    spark = chain.orders.sparkSession
    place = scratch(spark, "dry-run")

    def write(df: DataFrame, name: str) -> DataFrame:
        out = staged(df, f"{place}/{name}")
        release(spark)
        return out

    chain.keep(write, OF_ORDER, fact=False)
    chain.kept["excluded"] = write(o.excluded_candidates(chain.base).select(*OF_EXCLUDED), "excluded")
    chain.count_groups(few_rows)
    release(spark)
    out = DryRun(spark, place)
    out |= {
        "source_counts": reports.source_counts(chain), "preview_count": chain.totals().select("preview_group_count"), "reconciliation_summary": reports.reconciliation_summary(chain),
        "top_tax_delta_sample": reports.top_tax_delta_sample(chain), "status_excluded_summary": reports.status_excluded_summary(chain),
    }
    if mode == "fast":
        return out
    stats = write(o.order_duplicate_stats(chain.src.orders, chain.deal, presence=True), "stats")
    out |= {
        "preview_sample": chain.first_groups(samples), "order_mapping_summary": reports.order_mapping_summary(chain), "payment_mapping_summary": reports.payment_mapping_summary(chain),
        "tax_reconciliation_breakdown": reports.tax_reconciliation_breakdown(chain), "additions_tax_debug": reports.additions_tax_debug(chain), "rounding_debug": reports.rounding_debug(chain),
        "order_trace": reports.order_trace(chain, place=f"{place}/trace"), "duplicate_order_summary": reports.duplicate_order_summary(stats), "duplicate_order_trace": reports.duplicate_order_trace(chain),
        "status_dedup_candidate_summary": reports.status_dedup_candidate_summary(chain, stats),
    }
    if legacy is not None:
        legacy.kept["deltas"] = write(reports.deltas(legacy), "deltas")
        out["status_dedup_reconciliation_comparison"] = reports.status_dedup_reconciliation_comparison(chain, legacy)
        out["top_delta_before_after"] = reports.top_delta_before_after(chain, legacy)
    return out
