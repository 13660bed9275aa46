"""Dimensions, gates, writing, planning, analytics and contracts by name, each with DuckDB SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as x
from ..operators.allocation import Chain
from ..schemas import GRAIN, MEASURES
from ..sources import readers
from ..sources.pos_adapter import pos_sources
from . import analytics, contracts, dims, gates, jobs, oracle, writing
from .catalog import ORACLE, QUERIES, register
from .jobs import branch_dim, product_dim
from .storage import few_rows, scratch, staged

c = F.col


# dimensions
PDS = f"""pds AS (SELECT trim(i.product_no) AS product_no, {oracle.blank('i.product_name', 'UNKNOWN_PRODUCT_NAME')} AS product_name, nullif(trim(i.cate_no), '') AS cate_no, nullif(trim(i.cate_name), '') AS cate_name, max(i.t_open_date) AS last_seen, count(*) AS row_count
 FROM od o JOIN pos_items i ON i.order_id = o.order_id AND i.t_open_date = o.business_date WHERE trim(coalesce(i.product_no, '')) <> '' GROUP BY 1, 2, 3, 4),
pr AS (SELECT *, row_number() OVER (PARTITION BY product_no ORDER BY row_count DESC, last_seen DESC NULLS LAST, product_name DESC NULLS LAST, cate_no DESC NULLS LAST, cate_name DESC NULLS LAST) AS variant_rank FROM pds)"""
BDS = """bds AS (SELECT o.branch_id, r.branch_name, max(coalesce(r.modified, r.transaction_submitted, r.transaction_created, cast(r.business_date AS timestamp))) AS last_seen, count(*) AS row_count, cast(NULL AS varchar) AS group_code
 FROM od o JOIN ob r ON r.order_id = o.order_id AND r.business_date = o.business_date AND r.branch_id = o.branch_id AND r.order_status = 1 GROUP BY 1, 2),
br AS (SELECT *, row_number() OVER (PARTITION BY branch_id ORDER BY row_count DESC, last_seen DESC NULLS LAST, branch_name DESC) AS variant_rank FROM bds)"""
DIMS = f"{PDS}, {BDS}"
register("product_dim_source", dims.product_dim_source, "SELECT * FROM pds", PDS)
register("branch_dim_source", dims.branch_dim_source, "SELECT * FROM bds", BDS)
register("product_ranked", lambda k: dims.product_ranked(dims.product_dim_source(k)), "SELECT * FROM pr", PDS)
register("branch_ranked", lambda k: dims.branch_ranked(dims.branch_dim_source(k)), "SELECT * FROM br", BDS)
register("product_conflict_keys", lambda k: dims.conflict_keys(dims.product_dim_source(k), "product_no"), "SELECT product_no, count(*) AS variant_count FROM pds GROUP BY 1 HAVING count(*) > 1", PDS)
register("branch_conflict_keys", lambda k: dims.conflict_keys(dims.branch_dim_source(k), "branch_id"), "SELECT branch_id, count(*) AS variant_count FROM bds GROUP BY 1 HAVING count(*) > 1", BDS)


def _samples(ranked: str, key: str, label: str) -> str:
    return f"""SELECT r.{key}, t.variant_count, string_agg({label}, ' ; '
  ORDER BY variant_rank) AS variants
  FROM {ranked} r JOIN (SELECT {key}, count(*) AS variant_count
  FROM {ranked}
  GROUP BY 1
  HAVING count(*) > 1
  ORDER BY 2 DESC, 1 LIMIT 10) t ON t.{key} = r.{key}
  WHERE variant_rank <= 3
  GROUP BY 1, 2"""


register("product_conflict_samples", lambda k: dims.conflict_samples(dims.product_ranked(dims.product_dim_source(k)), "product_no", dims.product_label()), _samples("pr", "product_no", "product_name || '|' || coalesce(cate_no, '') || '|' || coalesce(cate_name, '') || '|rows=' || cast(row_count AS varchar)"), PDS)
register("branch_conflict_samples", lambda k: dims.conflict_samples(dims.branch_ranked(dims.branch_dim_source(k)), "branch_id", dims.branch_label()), _samples("br", "branch_id", "branch_name || '|group=' || coalesce(group_code, '') || '|rows=' || cast(row_count AS varchar)"), BDS)


_norm = "regexp_replace(lower(trim({c})), '\\s+', ' ', 'g')"
PD = f"""pd AS (SELECT cast(1 AS bigint) AS owner_user_id, product_no, product_name, {_norm.format(c='product_name')} AS product_name_normalized, cate_no, cate_name, true AS is_active, cast(last_seen AS timestamp) AS last_seen_at
  FROM pr
  WHERE variant_rank = 1)"""
BD = f"""bd AS (SELECT cast(1 AS bigint) AS owner_user_id, branch_id, branch_name, {_norm.format(c='branch_name')} AS branch_name_normalized, group_code, true AS is_active, last_seen AS last_seen_at
  FROM br
  WHERE variant_rank = 1)"""
ALL = f"{DIMS}, {PD}, {BD}"




register(
    "upsert_product_dim",
    lambda k: dims.upsert(old_products(k), product_dim(k).where("product_no not like 'P1%'"), "product_no"),
    """SELECT owner_user_id, product_no, CASE WHEN product_no LIKE 'P1%' THEN 'old' ELSE product_name END AS product_name, CASE WHEN product_no LIKE 'P1%' THEN 'old' ELSE product_name_normalized END AS product_name_normalized, cate_no, cate_name, product_no NOT LIKE 'P1%' AS is_active, last_seen_at
  FROM pd""", ALL)
register(
    "upsert_branch_dim",
    lambda k: dims.upsert(branch_dim(k).withColumns({"branch_name": F.lit("old"), "is_active": F.lit(False)}), branch_dim(k).where("branch_id <> 'B3'"), "branch_id"),
    """SELECT owner_user_id, branch_id, CASE WHEN branch_id = 'B3' THEN 'old' ELSE branch_name END AS branch_name, branch_name_normalized, group_code, branch_id <> 'B3' AS is_active, last_seen_at
  FROM bd""", ALL)


def old_products(k: Chain) -> DataFrame:
    return product_dim(k).withColumns({"product_name": F.lit("old"), "product_name_normalized": F.lit("old"), "is_active": F.lit(False)})


# gates over the fact and its dimensions
ZERO = ", ".join(f"cast(0 AS bigint) AS {m}_delta" for m in ["row_count", *MEASURES])
SUMS = ", ".join(f"cast(sum({m}) AS bigint) AS {m}" for m in MEASURES)
register("candidate_metrics", lambda k: gates.fact_metrics(k.fact()), f"SELECT owner_user_id, business_date, count(*) AS row_count, {SUMS} FROM fact GROUP BY 1, 2")
SRC = f"""srcm AS (SELECT f.*, l.item_count, o.n AS status_1_row_count, cast(0 AS bigint) AS non_status_1_row_count, o.n AS latest_row_count
  FROM (SELECT owner_user_id, business_date, count(*) AS row_count, {SUMS}
  FROM fact
  GROUP BY 1, 2) f
  LEFT JOIN (SELECT business_date, count(*) AS item_count
  FROM al
  GROUP BY 1) l ON l.business_date = f.business_date
  LEFT JOIN (SELECT business_date, count(*) AS n
  FROM od
  GROUP BY 1) o ON o.business_date = f.business_date)"""
register("source_metrics", lambda k: gates.source_metrics(k.allocations, k.orders), "SELECT * FROM srcm", SRC)


def once(k: Chain) -> tuple[DataFrame, DataFrame]:
    """The source's metrics (a row for each day) and the fact, both of lines that one run of the chain wrote; as ``writing.Candidate`` does."""
    place = scratch(k.orders.sparkSession, "once")
    k.keep_lines(lambda df, name: staged(df, f"{place}/{name}"))
    return few_rows(gates.source_metrics(k.allocations, k.orders)), staged(k.fact(), f"{place}/fact")


def spoiled(k: Chain, fact: DataFrame | None = None) -> DataFrame:
    """The fact with a thousandth more discount on product P3 on each 7th."""
    wrong = (c("product_no") == "P3") & (F.dayofmonth("business_date") == 7)
    return (k.fact() if fact is None else fact).withColumn("discount_milli", F.when(wrong, c("discount_milli") + 1).otherwise(c("discount_milli")))


SPOILED = "(SELECT owner_user_id, business_date, count(*) FILTER (product_no = 'P3' AND day(business_date) = 7) AS n FROM fact GROUP BY 1, 2)"


def compared(k: Chain) -> DataFrame:
    target = gates.fact_metrics(spoiled(k)).withColumn("rounding_delta_milli", F.dayofmonth("business_date").cast("bigint"))
    out = gates.compare_metrics(gates.source_metrics(k.allocations, k.orders), target)
    return out.select(*gates.KEY, "discount_milli_delta", "net_sales_milli_delta", "reasons", "passed", "rounding_warning")


register(
    "compare_metrics",
    compared,
    f"""SELECT owner_user_id, business_date, 0 - n AS discount_milli_delta, cast(0 AS bigint) AS net_sales_milli_delta,
  CASE WHEN n > 0 THEN 'discount_milli_delta=' || cast(0 - n AS varchar) ELSE '' END AS reasons, n = 0 AS passed, day(business_date) > 1 AS rounding_warning
 FROM {SPOILED}""",
)
register(
    "post_insert_report",
    lambda k: gates.post_insert_report(gates.source_metrics(k.allocations, k.orders), spoiled(k)).select(*gates.KEY, "scope", "reasons", "passed"),
    f"""SELECT owner_user_id, business_date, 'persisted_fact' AS scope, CASE WHEN n > 0 THEN 'discount_milli_delta=' || cast(0 - n AS varchar) ELSE '' END AS reasons,
  n = 0 AS passed FROM {SPOILED}""",
)


def gate_with_faults(k: Chain) -> DataFrame:
    """Every count of the dimension gate above 0 on some day: a product, a branch and two codes are missing, rows of product P2 are
    written for the day after theirs, and the metrics name orders of another status and older versions."""
    day = F.dayofmonth("business_date")
    source, fact = once(k)
    fact = fact.withColumn("sale_period", F.when(c("product_no") == "P2", F.date_add("business_date", 1)).otherwise(c("business_date")))
    source = source.withColumn("non_status_1_row_count", F.when(day == 3, 2).otherwise(0)).withColumn("latest_row_count", c("status_1_row_count") - F.when(day == 4, 1).otherwise(0))
    codes = dims.code_dims(k.orders.sparkSession).where("not (kind = 'order_type' and id = 7) and not (kind = 'payment_type' and id = 5)")
    return gates.dimension_gate(fact, product_dim(k).where("product_no <> 'P5'"), branch_dim(k).where("branch_id <> 'B3'"), codes, source)


FAULTS = """gf AS (SELECT owner_user_id, CASE WHEN product_no = 'P2' THEN business_date + interval 1 day ELSE business_date END :: date AS business_date,
  count(*) FILTER (product_no = 'P5') AS product_miss_count, count(*) FILTER (branch_id = 'B3') AS branch_miss_count, count(*) FILTER (order_type_id = 7) AS order_type_miss_count,
  count(*) FILTER (payment_type_id = 5) AS payment_type_miss_count, count(*) FILTER (product_no = 'P2') AS other_day_count FROM fact GROUP BY 1, 2),
 days AS (SELECT DISTINCT business_date FROM fact),
 gt AS (SELECT gf.*, cast(CASE WHEN days.business_date IS NOT NULL AND day(gf.business_date) = 3 THEN 2 ELSE 0 END AS bigint) AS non_status_1_count,
  cast(CASE WHEN days.business_date IS NOT NULL AND day(gf.business_date) = 4 THEN 1 ELSE 0 END AS bigint) AS not_latest_count FROM gf LEFT JOIN days ON days.business_date = gf.business_date)"""
_counted = ", ".join(f"CASE WHEN {n} > 0 THEN '{n}=' || cast({n} AS varchar) END" for n in gates.DIMENSION_COUNTS)
register("dimension_gate", gate_with_faults, f"SELECT *, concat_ws(';', {_counted}) AS dim_reasons, {' + '.join(gates.DIMENSION_COUNTS)} = 0 AS passed FROM gt", FAULTS)


def pre_insert(k: Chain) -> DataFrame:
    """The report before writing, of a spoiled candidate with a forbidden column and a missing product."""
    source, fact = once(k)
    fact = spoiled(k, fact)
    candidate = gates.fact_metrics(fact).join(source.select(*gates.KEY, "item_count"), gates.KEY, "left")
    gate = gates.dimension_gate(fact, product_dim(k).where("product_no <> 'P5'"), branch_dim(k), dims.code_dims(k.orders.sparkSession), source)
    return gates.pre_insert_report(source, candidate, gate, [*fact.columns, "order_num"]).select(*gates.KEY, "reasons", "metrics_passed", "dims_passed", "forbidden_columns", "passed")


register(
    "pre_insert_report",
    pre_insert,
    """SELECT owner_user_id, business_date, concat_ws(';', CASE WHEN n > 0 THEN 'discount_milli_delta=' || cast(0 - n AS varchar) END,
  CASE WHEN m > 0 THEN 'product_miss_count=' || cast(m AS varchar) END, 'forbidden_column_count=1') AS reasons, n = 0 AS metrics_passed, m = 0 AS dims_passed, 'order_num' AS forbidden_columns, false AS passed
 FROM (SELECT owner_user_id, business_date, count(*) FILTER (product_no = 'P3' AND day(business_date) = 7) AS n, count(*) FILTER (product_no = 'P5') AS m FROM fact GROUP BY 1, 2)""",
)
register(
    "forbidden_columns",
    lambda k: k.orders.select(*(F.lit(n).alias(n) for n in gates.forbidden_columns(k.orders.columns))).limit(1).select(F.concat_ws(",", "*").alias("forbidden_columns")),
    "SELECT 'void_sale_period' AS forbidden_columns FROM od LIMIT 1",
)
register(
    "fact_contract_check",
    lambda k: gates.fact_contract_check(k.fact().union(k.fact().where("product_no = 'P3'"))),
    """SELECT count(*) FILTER (product_no = 'P3') AS duplicate_rows, cast(0 AS bigint) AS hour_violations, cast(0 AS bigint) AS null_key_rows,
  cast(0 AS bigint) AS identity_violations FROM fact""",
)

# writing and planning


def gated_write(k: Chain, mode: str = "write") -> DataFrame:
    """Syncs the dimensions and writes the fact against them."""
    return jobs.sync_and_write(k, scratch(k.orders.sparkSession, "job"), mode)


DAYS = [*gates.KEY, "row_count", *gates.DIMENSION_COUNTS, "metrics_passed", "reasons", "passed", "post_passed", "status", "rows_written"]
DAILY = "(SELECT owner_user_id, business_date, count(*) AS n FROM fact GROUP BY 1, 2)"
_none = ", ".join(f"cast(0 AS bigint) AS {n}" for n in gates.DIMENSION_COUNTS)
register(
    "gated_write",
    lambda k: gated_write(k).select(*DAYS),
    f"""SELECT owner_user_id, business_date, n AS row_count, {_none}, true AS metrics_passed, '' AS reasons, true AS passed, true AS post_passed,
  'succeeded' AS status, n AS rows_written FROM {DAILY}""",
)
register(
    "gated_validate",
    lambda k: gated_write(k, "validate").select(*DAYS),
    f"""SELECT owner_user_id, business_date, n AS row_count, {_none}, true AS metrics_passed, '' AS reasons, true AS passed, cast(NULL AS boolean) AS post_passed,
  'validated' AS status, cast(0 AS bigint) AS rows_written FROM {DAILY}""",
)
FIRST_BAD = "(SELECT min(business_date) FROM fact WHERE product_no = 'P5')"


def write_without_product(k: Chain) -> DataFrame:
    """A product isn't in the dimension: its first day fails, and the days from there aren't written."""
    spark = k.orders.sparkSession
    out = writing.write_fact(k, lambda run: product_dim(run).where("product_no <> 'P5'"), branch_dim, dims.code_dims(spark), scratch(spark, "fact"))
    return out.select(*gates.KEY, "product_miss_count", "status", "rows_written")


register(
    "gated_write_stops",
    write_without_product,
    f"""SELECT owner_user_id, business_date, m AS product_miss_count, CASE WHEN m > 0 THEN 'failed' WHEN business_date < {FIRST_BAD} THEN 'succeeded' ELSE 'skipped' END AS status,
  CASE WHEN business_date < {FIRST_BAD} THEN n ELSE 0 END AS rows_written
 FROM (SELECT owner_user_id, business_date, count(*) AS n, count(*) FILTER (product_no = 'P5') AS m FROM fact GROUP BY 1, 2)""",
)
register(
    "run_summary",
    lambda k: writing.run_summary(gated_write(k)),
    f"""SELECT count(*) AS processed_days, count(*) AS succeeded_days, cast(0 AS bigint) AS failed_days, cast(0 AS bigint) AS skipped_days, true AS source_candidate_equal,
  true AS source_persisted_equal, {_none}, cast(0 AS bigint) AS failed_gate_days, cast(sum(n) AS bigint) AS rows_written FROM {DAILY}""",
)


def smoked(k: Chain) -> DataFrame:
    """The checks of a fact and dimensions that are written, each read once."""
    place = scratch(k.orders.sparkSession, "smoke")
    return gates.smoke_checks(*(staged(df, f"{place}/{n}") for n, df in (("fact", k.fact()), ("products", product_dim(k)), ("branches", branch_dim(k)))))


register(
    "smoke_checks",
    smoked,
    """SELECT *, least(product_count, branch_count, fact_count, leaderboard_count, summary_count) > 0 AS passed FROM (SELECT (SELECT count(*) FROM pd) AS product_count,
  (SELECT count(*) FROM bd) AS branch_count, (SELECT count(*) FROM fact) AS fact_count, cast(5 AS bigint) AS leaderboard_count, (SELECT count(DISTINCT product_no) FROM fact) AS summary_count)""",
    ALL,
)


def synced_twice(k: Chain) -> tuple[DataFrame, DataFrame]:
    """The report of a second sync over all days, after a first one over those until the middle of 1996, and the product dimension then."""
    spark = k.orders.sparkSession
    place = scratch(spark, "dims")
    jobs.sync_dims(Chain(readers.window(k.src, None, "1996-06-30")), place, "apply")
    report = jobs.sync_dims(k, place, "apply")
    return report, jobs.read_dim(spark, place, "pos_product_dim")


def _synced(dim: str, rows: str, key: str, first: str, samples: str, mode: str) -> str:
    return f"""SELECT '{dim}' AS dimension, count(*) AS candidate_count, count(*) FILTER (f.k IS NULL) AS inserted, count(f.k) AS updated,
  (SELECT count(*) FROM (SELECT {key} FROM {rows} GROUP BY 1 HAVING count(*) > 1)) AS conflict_count, coalesce((SELECT string_agg({key} || ': ' || variants, chr(10) ORDER BY {key} || ': ' || variants) FROM ({samples})), '') AS conflict_samples,
  (SELECT count(*) FROM {first}) AS rows_before, (SELECT count(*) FROM {first}) + count(*) FILTER (f.k IS NULL) AS rows_after, {mode} AS written
 FROM (SELECT DISTINCT {key} AS k FROM {rows}) a LEFT JOIN {first} f ON f.k = a.k"""


SYNCED = f"""{ALL}, pf AS (SELECT DISTINCT trim(i.product_no) AS k FROM od o JOIN pos_items i ON i.order_id = o.order_id AND i.t_open_date = o.business_date
  WHERE trim(coalesce(i.product_no, '')) <> '' AND o.business_date <= date '1996-06-30'),
 bf AS (SELECT DISTINCT branch_id AS k FROM od WHERE business_date <= date '1996-06-30'), nf AS (SELECT k FROM pf WHERE false)"""
_PS = _samples("pr", "product_no", "product_name || '|' || coalesce(cate_no, '') || '|' || coalesce(cate_name, '') || '|rows=' || cast(row_count AS varchar)")
_BS = _samples("br", "branch_id", "branch_name || '|group=' || coalesce(group_code, '') || '|rows=' || cast(row_count AS varchar)")
register(
    "sync_dims_apply",
    lambda k: synced_twice(k)[0],
    _synced("pos_product_dim", "pds", "product_no", "pf", _PS, "true") + " UNION ALL " + _synced("pos_branch_dim", "bds", "branch_id", "bf", _BS, "true"),
    SYNCED,
)
register(
    "sync_dims_plan",
    lambda k: jobs.sync_dims(k, scratch(k.orders.sparkSession, "dims")),
    _synced("pos_product_dim", "pds", "product_no", "nf", _PS, "false") + " UNION ALL " + _synced("pos_branch_dim", "bds", "branch_id", "nf", _BS, "false"),
    SYNCED,
)
register("synced_product_dim", lambda k: synced_twice(k)[1], "SELECT * FROM pd", ALL)

# The columns of each report that a dry run's lines have; the reports' own entries compare all columns.
DRY = {
    "source_counts": ["source_table", "row_count"],
    "preview_count": ["preview_group_count"],
    "reconciliation_summary": ["source_order_count", "source_net_milli", "source_tax_milli", "preview_group_count", "preview_net_sales_milli", "preview_tax_milli"],
    "top_tax_delta_sample": ["business_date", "order_id", "delta_milli", "status"],
    "status_excluded_summary": ["status", "order_keys", "raw_rows", "total_milli", "destination_distribution"],
    "preview_sample": ["business_date", "branch_id", "product_no", "net_sales_milli"],
    "order_mapping_summary": ["order_type_id", "row_count", "raw_destination_count"],
    "payment_mapping_summary": ["payment_type_id", "row_count", "raw_payment_name_count"],
    "tax_reconciliation_breakdown": ["sort_order", "metric", "order_count", "net_sales_milli", "included_tax_milli"],
    "additions_tax_debug": ["sort_order", "metric", "tax_milli"],
    "rounding_debug": ["sort_order", "metric", "value_milli"],
    "order_trace": ["trace_rank", "section_order", "section", "row_order", "order_id", "delta_milli"],
    "duplicate_order_summary": ["sort_order", "metric", "value"],
    "duplicate_order_trace": ["trace_rank", "raw_row_rank", "order_id", "sequence"],
    "status_dedup_candidate_summary": ["sort_order", "metric", "value"],
    "status_dedup_reconciliation_comparison": ["sort_order", "metric", "value_milli"],
    "top_delta_before_after": ["order_id", "business_date", "raw_status_list", "current_delta_milli", "status_dedup_delta_milli"],
}


def dry_lines(reports_: dict[str, DataFrame]) -> DataFrame:
    """The rows of all reports as text, with the report's name."""
    out = None
    for name, df in reports_.items():
        part = df.select(F.lit(name).alias("section"), F.concat_ws("|", *(F.coalesce(c(k).cast("string"), F.lit("")) for k in DRY[name])).alias("line"))
        out = part if out is None else out.union(part)
    return out


def _dry_sql(names: list[str]) -> str:
    line = lambda n: "concat_ws('|', " + ", ".join(f"coalesce(cast({k} AS varchar), '')" for k in DRY[n]) + ")"
    return " UNION ALL ".join(f"SELECT '{n}' AS section, {line(n)} AS line FROM ({ORACLE[n]})" for n in names)


def dry(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    """The lines of a dry run (metrics, top-k samples and traces: few), made before its scratch is deleted. One report is made after the other:
    a single plan of all would hold much of the driver's memory, and all their shuffle files until its end."""
    src = pos_sources(spark, sf_dir)
    with jobs.dry_run(Chain(src), mode, Chain(src, False) if mode == "full" else None) as made:
        lines = [few_rows(dry_lines({name: df})) for name, df in made.items()]
    return reduce(DataFrame.union, lines)


QUERIES["dry_run_fast"] = lambda spark, sf_dir: dry(spark, sf_dir, "fast")
QUERIES["dry_run_full"] = lambda spark, sf_dir: dry(spark, sf_dir, "full")
ORACLE["dry_run_fast"], ORACLE["dry_run_full"] = _dry_sql(jobs.FAST), _dry_sql(list(DRY))


def target_metrics(k: Chain) -> DataFrame:
    """The chain runs once; the days of each March are made of the fact as it was published, and replace those."""
    spark, path = k.orders.sparkSession, scratch(k.orders.sparkSession, "fact")
    writing.write_fact_day_replace(k.fact(), path)
    march = writing.read_fact(spark, path).where("month(business_date) = 3")
    writing.write_fact_day_replace(march.withColumn("qty_milli", c("qty_milli") + 1), path)
    return gates.fact_metrics(writing.read_fact(spark, path)).select(*gates.KEY, "row_count", "qty_milli", "net_sales_milli")


register(
    "target_metrics_after_replace",
    target_metrics,
    """SELECT owner_user_id, business_date, count(*) AS row_count, cast(sum(qty_milli) + CASE WHEN month(business_date) = 3 THEN count(*) ELSE 0 END AS bigint) AS qty_milli, cast(sum(net_sales_milli) AS bigint) AS net_sales_milli
  FROM fact
  GROUP BY 1, 2""")
register(
    "persisted_daily_counts",
    lambda k: writing.persisted_daily_counts(k.fact().union(k.fact(2)), 2, "1995-01-01", "1996-06-30"),
    "SELECT business_date, count(*) AS row_count FROM fact WHERE business_date BETWEEN date '1995-01-01' AND date '1996-06-30' GROUP BY 1",
)
register(
    "plan_days",
    lambda k: writing.plan_days(k.orders.sparkSession, k.fact(), "1995-01-01", "2001-12-31"),
    """SELECT cast(d AS date) AS business_date, coalesce(n, 0) AS persisted_rows, CASE WHEN n IS NULL THEN 'pending' ELSE 'completed' END AS status
  FROM (SELECT unnest(generate_series(date '1995-01-01', date '2001-12-31', interval 1 day)) AS d)
  LEFT JOIN (SELECT business_date, count(*) AS n
  FROM fact
  GROUP BY 1) f ON f.business_date = cast(d AS date)""")


def raw_round_trip(spark: SparkSession, sf_dir: str, name: str = "order_payments") -> DataFrame:
    """A source as text by day, converted to Parquet and read back; columns that the source hasn't are null."""
    declared = [f.split()[:2] for f in " ".join(readers.SOURCES[name].split()).split(", ")]
    rows = dict(zip(("orders", "order_items", "order_additions", "order_payments"), pos_sources(spark, sf_dir), strict=True))[name]
    full = rows.select(*((c(n) if n in rows.columns else F.lit(None)).cast(kind).alias(n) for n, kind in declared), "t_open_date")
    text, parquet = scratch(spark, "text"), scratch(spark, "parquet")
    readers.write_raw_text(full.repartition("t_open_date"), text)
    readers.raw_to_parquet(spark, text, name, parquet)
    return readers.read_source(spark, parquet, name, "1900-01-01", "2999-12-31")


QUERIES["raw_text_to_parquet"] = lambda spark, sf_dir: raw_round_trip(spark, sf_dir).select("id", "order_id", "name", c("amount").cast("double").alias("amount"), "t_open_date")
ORACLE["raw_text_to_parquet"] = oracle.sql("SELECT id, order_id, name, amount, t_open_date FROM pos_payments")
def coded(k: Chain) -> DataFrame:
    """Orders by status and type, with codes of a table whose labels were changed and then seeded again."""
    fixed = dims.code_dims(k.orders.sparkSession)
    codes = F.broadcast(dims.reseed(fixed.withColumn("code", F.lit("changed")), fixed))
    by = k.base.groupBy("order_status", "order_type_id").agg(F.count("*").alias("row_count"))
    of = lambda kind, key: codes.where(c("kind") == kind).select(c("id").alias(key), c("code").alias(f"{kind}_code"))
    return by.join(of("status", "order_status"), "order_status", "left").join(of("order_type", "order_type_id"), "order_type_id", "left")


register(
    "seed_dims",
    coded,
    f"""SELECT order_status, order_type_id, count(*) AS row_count, {oracle.names("order_status", x.STATUSES)} AS status_code,
  {oracle.names("order_type_id", x.ORDER_TYPES)} AS order_type_code FROM ob GROUP BY 1, 2""",
)

# analytics
NORMAL = f"NOT regexp_matches(p.product_name, '{x.SPECIAL_PRODUCT}') AND NOT contains(lower(p.product_name), 'test')"
FP = "fact f JOIN pd p ON p.owner_user_id = f.owner_user_id AND p.product_no = f.product_no"
QN = "cast(sum(qty_milli) AS bigint) AS qty_milli, cast(sum(net_sales_milli) AS bigint) AS net_sales_milli"
register(
    "product_leaderboard",
    lambda k: analytics.product_leaderboard(k.fact(), product_dim(k)),
    f"""SELECT f.owner_user_id, f.product_no, p.product_name, {QN}
  FROM {FP}
  WHERE {NORMAL}
  GROUP BY 1, 2, 3
  ORDER BY net_sales_milli DESC, qty_milli DESC, product_no LIMIT 5""", ALL)
SUMMARY = f"SELECT f.owner_user_id, f.product_no, p.product_name, {QN} FROM {FP} GROUP BY 1, 2, 3"
register("product_summary", lambda k: analytics.product_summary(k.fact(), product_dim(k)), SUMMARY, ALL)
register("product_summary_top", lambda k: analytics.product_summary_top(k.fact(), product_dim(k)), f"{SUMMARY} ORDER BY net_sales_milli DESC NULLS LAST, product_no LIMIT 5", ALL)
register("fact_sorted", lambda k: k.fact().orderBy(*GRAIN[1:]), f"SELECT * FROM fact ORDER BY {', '.join(GRAIN[1:])}")
register(
    "excluded_products_audit",
    lambda k: analytics.excluded_products_audit(k.fact(), product_dim(k), deny=("P3",)),
    f"""SELECT f.owner_user_id, f.product_no, p.product_name, {QN}
  FROM {FP}
  WHERE NOT ({NORMAL}) OR f.product_no = 'P3'
  GROUP BY 1, 2, 3""", ALL)
for _m in ("qty_milli", "gross_sales_milli", "net_sales_milli", "sales_ex_tax_milli"):
    register(f"top_products_by_{_m.removesuffix('_milli')}", lambda k, m=_m: analytics.top(k.fact(), "product_no", m), f"SELECT product_no, {SUMS} FROM fact GROUP BY 1 ORDER BY {_m} DESC NULLS LAST, product_no LIMIT 5")
for _m in ("net_sales_milli", "qty_milli", "tax_milli", "discount_milli", "surcharge_milli"):
    register(
        f"top_branches_by_{_m.removesuffix('_milli')}",
        lambda k, m=_m: analytics.top_branches(k.fact(), branch_dim(k), m),
        f"""SELECT t.*, b.branch_name FROM (SELECT branch_id, {SUMS} FROM fact GROUP BY 1 ORDER BY {_m} DESC NULLS LAST, branch_id LIMIT 5) t
 LEFT JOIN bd b ON b.branch_id = t.branch_id""",
        ALL,
    )
for _n, _by in {"hourly_sales": ("hour_of_day",), "branch_hour_sales": ("branch_id", "hour_of_day"), "product_hour_sales": ("product_no", "hour_of_day"), "product_branch_cross": ("product_no", "branch_id"), "daily_trend": ("business_date",)}.items():
    register(_n, lambda k, by=_by: analytics.sums(k.fact(), *by), f"SELECT {', '.join(_by)}, {QN} FROM fact GROUP BY ALL")
for _n, _key, _codes in (("order_type_mix", "order_type_id", x.ORDER_TYPES), ("payment_type_mix", "payment_type_id", x.PAYMENT_TYPES)):
    register(
        _n,
        lambda k, key=_key: analytics.with_code(analytics.mix(k.fact(), key), key),
        f"""SELECT *, cast(net_sales_milli AS double) / cast(cast(sum(net_sales_milli) OVER () AS bigint) AS double) AS net_share,
  {oracle.names(_key, _codes)} AS code FROM (SELECT {_key}, {QN} FROM fact GROUP BY 1)""",
    )
register(
    "tax_discount_summary",
    lambda k: analytics.sums(k.fact(), "owner_user_id", "business_date", measures=("discount_milli", "surcharge_milli", "included_tax_milli", "tax_milli")),
    """SELECT owner_user_id, business_date, cast(sum(discount_milli) AS bigint) AS discount_milli, cast(sum(surcharge_milli) AS bigint) AS surcharge_milli, cast(sum(included_tax_milli) AS bigint) AS included_tax_milli, cast(sum(tax_milli) AS bigint) AS tax_milli
  FROM fact
  GROUP BY 1, 2""")
for _key in ("product_no", "branch_id", "hour_of_day"):
    register(f"share_of_sales_by_{_key}", lambda k, key=_key: analytics.share_of_sales(k.fact(), key), f"""SELECT *, cast(net_sales_milli AS double) / cast(cast(sum(net_sales_milli) OVER () AS bigint) AS double) AS share
  FROM (SELECT owner_user_id, {_key}, cast(sum(net_sales_milli) AS bigint) AS net_sales_milli
  FROM fact
  GROUP BY 1, 2)""")
register("category_mix", lambda k: analytics.sums(analytics.with_products(k.fact(), product_dim(k)), "cate_no", "cate_name"), f"SELECT p.cate_no, p.cate_name, {QN} FROM {FP} GROUP BY 1, 2", ALL)

# contracts: mapping and signals made from the sales themselves
LOCATIONS = """loc AS (SELECT cast(1 AS bigint) AS owner_user_id, branch_id, 'S' || branch_id AS station_id, min(business_date) AS valid_from, cast(NULL AS date) AS valid_to,
 cast(CASE WHEN branch_id = 'B1' THEN 95 ELSE 25 END AS double) AS latitude, CASE WHEN branch_id = 'B2' THEN cast(NULL AS double) ELSE cast(121 AS double) END AS longitude,
 cast(CASE WHEN branch_id = 'B3' THEN -1 ELSE 100 END AS double) AS distance_meters, 'manual' AS source_type, CASE WHEN branch_id = 'B4' THEN ' ' ELSE 'sheet' END AS source_reference,
 CASE WHEN branch_id = 'B5' THEN 'guess' WHEN branch_id = 'B6' THEN 'unverified' ELSE 'verified' END AS verification_status, CASE WHEN branch_id = 'B7' THEN NULL ELSE max(business_date) END AS verified_at, 'me' AS verified_by,
 CASE WHEN branch_id = 'B8' THEN 'lost' ELSE 'matched' END AS location_status FROM ob GROUP BY branch_id)"""
WEATHER = """wea AS (SELECT DISTINCT cast(1 AS bigint) AS owner_user_id, CASE WHEN month(business_date) = 1 THEN NULL ELSE branch_id END AS location, business_date AS signal_date, CASE WHEN day(business_date) % 2 = 0 THEN 'forecast' ELSE 'actual' END AS observation_kind,
 cast(day(business_date) AS double) AS value, business_date AS updated_at FROM ob WHERE order_status = 1)"""
#: A third of the days each: for a product in a branch, for a product, for a branch; and for all on each 28th. Each scope has another value.
PROMOTION = """prom AS (SELECT DISTINCT cast(1 AS bigint) AS owner_user_id, CASE WHEN day(business_date) % 3 = 0 OR day(business_date) % 3 = 2 THEN branch_id END AS location,
  CASE WHEN day(business_date) % 3 < 2 THEN product_no END AS item, business_date AS signal_date, cast(100 + month(business_date) * 10 + day(business_date) % 3 AS double) AS value, business_date AS updated_at
 FROM il0 WHERE product_no IN ('P10', 'P20', 'P30', 'P40', 'P50') AND branch_id <> 'B4'
 UNION ALL SELECT DISTINCT cast(1 AS bigint), cast(NULL AS string), cast(NULL AS string), business_date, cast(7 AS double), business_date FROM il0 WHERE day(business_date) >= 20
 UNION ALL SELECT DISTINCT cast(1 AS bigint), branch_id, cast(NULL AS string), business_date, cast(8 AS double), business_date FROM il0 WHERE day(business_date) IN (21, 24) AND branch_id IN ('B1', 'B2'))"""


def _made(k: Chain, sql: str) -> DataFrame:
    """The same SQL that the check runs, over this chain's frames."""
    body = sql[sql.index("(") + 1 : sql.rindex(")")]
    frames = {"ob": k.base, "il0": k.lines}
    used = {n: f for n, f in frames.items() if f"FROM {n}" in body}
    for n in used:
        body = body.replace(f"FROM {n}", f"FROM {{{n}}}")
    return k.orders.sparkSession.sql(body, **used)


register(
    "location_contract_check",
    lambda k: contracts.location_contract_check(_made(k, LOCATIONS)),
    """SELECT count(*) FILTER (valid_to < valid_from) AS valid_range, count(*) FILTER ((latitude IS NULL) <> (longitude IS NULL)) AS coordinate_pair, count(*) FILTER (abs(latitude) > 90 OR abs(longitude) > 180) AS coordinate_bounds, count(*) FILTER (distance_meters < 0) AS distance, count(*) FILTER (trim(source_type) = '') AS source_type, count(*) FILTER (trim(source_reference) = '') AS source_reference, count(*) FILTER (verification_status = 'guess') AS verification_status, count(*) FILTER (verification_status = 'verified' AND verified_at IS NULL) AS verified_without_proof, count(*) FILTER (location_status = 'lost') AS location_status, cast(0 AS bigint) AS version_not_unique
  FROM loc""", LOCATIONS)
register("location_current", lambda k: contracts.location_current(_made(k, LOCATIONS)).select("branch_id", "station_id", "valid_from"), "SELECT branch_id, station_id, valid_from FROM loc WHERE verification_status = 'verified' AND valid_to IS NULL", LOCATIONS)


def imported(k: Chain) -> tuple[DataFrame, DataFrame]:
    current = _made(k, LOCATIONS)
    batch = current.where("branch_id in ('B9', 'B10')").withColumns({"station_id": F.lit("new"), "valid_from": F.lit("1998-01-01").cast("date")})
    return contracts.location_replace_import(current, batch, "1998-01-01")


register(
    "location_replace_import",
    lambda k: imported(k)[0].select("branch_id", "station_id", "valid_from", "valid_to"),
    """SELECT branch_id, station_id, valid_from, CASE WHEN branch_id IN ('B9', 'B10') THEN date '1997-12-31' END AS valid_to
  FROM loc
  UNION ALL SELECT branch_id, 'new', date '1998-01-01', NULL
  FROM loc
  WHERE branch_id IN ('B9', 'B10')""", LOCATIONS)
_json = "'{\"branch_id\":\"' || branch_id || '\",\"station_id\":\"' || {station} || '\",\"valid_from\":\"' || cast({day} AS varchar) || '\"}}'"


def _snapshot(station: str, day: str, test: str) -> str:
    row = _json.replace("{station}", station).replace("{day}", day).replace("}}", "}")
    return f"'[' || string_agg({row}, ',' ORDER BY branch_id) FILTER ({test}) || ']'"


register(
    "location_import_audit",
    lambda k: imported(k)[1],
    f"""SELECT cast(1 AS bigint) AS owner_user_id, count(*) FILTER ({{b}}) AS row_count, count(*) AS previous_current, count(*) FILTER ({{b}}) AS closed, count(*) FILTER ({{b}}) AS inserted,
  {_snapshot("station_id", "valid_from", "true")} AS previous_mappings, {_snapshot("'new'", "date '1998-01-01'", "{b}")} AS imported_mappings FROM loc""".replace("{b}", "branch_id IN ('B9', 'B10')"),
    LOCATIONS,
)
register(
    "location_as_of",
    lambda k: contracts.location_as_of(k.fact(), imported(k)[0]).groupBy("branch_id", "station_id").agg(F.count("*").alias("row_count")),
    """SELECT f.branch_id, CASE WHEN l.verification_status <> 'verified' THEN NULL WHEN f.branch_id IN ('B9', 'B10') AND f.business_date >= date '1998-01-01' THEN 'new' ELSE l.station_id END AS station_id, count(*) AS row_count
  FROM fact f
  LEFT JOIN loc l ON l.branch_id = f.branch_id
  GROUP BY 1, 2""", LOCATIONS)
register(
    "signal_upsert_weather",
    lambda k: contracts.signal_upsert(w := _made(k, WEATHER), w.where("day(signal_date) < 15").withColumn("value", c("value") + 100), "weather").select("owner_user_id", "location", "signal_date", "observation_kind", "value"),
    "SELECT owner_user_id, location, signal_date, observation_kind, max(value) + CASE WHEN day(signal_date) < 15 THEN 100 ELSE 0 END AS value FROM wea GROUP BY 1, 2, 3, 4",
    WEATHER,
)
for _kind, _test in (("promotion", "true"), ("availability", "item IS NOT NULL")):
    register(
        f"signal_upsert_{_kind}",
        lambda k, kind=_kind, test=_test: contracts.signal_upsert(p := _made(k, PROMOTION).where(test), p.where("day(signal_date) < 24").withColumn("value", c("value") + 100), kind).select("owner_user_id", "location", "item", "signal_date", "value"),
        f"SELECT owner_user_id, location, item, signal_date, max(value) + CASE WHEN day(signal_date) < 24 THEN 100 ELSE 0 END AS value FROM prom WHERE {_test} GROUP BY 1, 2, 3, 4",
        PROMOTION,
    )
register(
    "signal_contract_check",
    lambda k: contracts.signal_contract_check(_made(k, WEATHER), _made(k, PROMOTION)),
    """SELECT (SELECT count(*)
  FROM wea
  WHERE observation_kind NOT IN ('forecast', 'actual')) AS weather_kind, cast(0 AS bigint) AS weather_date, (SELECT count(*)
  FROM prom
  WHERE item IS NULL) AS availability_item, cast(0 AS bigint) AS availability_date""", f"{WEATHER}, {PROMOTION}")
_key = ["business_date", "hour_of_day", "branch_id", "product_no", "order_type_id", "payment_type_id"]
_frame = lambda k: k.fact().withColumn("location", c("branch_id"))


def _best(table: str, scopes: list[str], more: str = "true") -> str:
    """The value of the first scope that has one."""
    return "coalesce(" + ", ".join(f"(SELECT max(value) FROM {table} s WHERE s.signal_date = f.business_date AND {scope} AND {more})" for scope in scopes) + ")"


_at, _any = "s.location = f.branch_id", "s.location IS NULL"
_of, _all = "s.item = f.product_no", "s.item IS NULL"
FOUR = [f"{a} AND {b}" for a, b in ((_at, _of), (_at, _all), (_any, _of), (_any, _all))]
_forecast, _actual = (_best("wea", [_at, _any], f"observation_kind = '{kind}'") for kind in ("forecast", "actual"))


def framed(k: Chain, frame: object, names: list[str]) -> DataFrame:
    """The signals are written, as an import leaves them; their maps are made once, and the frame is built on those."""
    spark = k.orders.sparkSession
    place = scratch(spark, "signals")
    promotions = _made(k, PROMOTION)
    weather, promotion, availability = (staged(df, f"{place}/{n}") for n, df in (("weather", _made(k, WEATHER)), ("promotion", promotions), ("availability", promotions.where("item is not null"))))
    maps = staged(contracts.scope_maps(weather, promotion, availability), f"{place}/maps")
    return frame(_frame(k), maps).select(*_key, *names)


register(
    "forecast_frame",
    lambda k: framed(k, contracts.forecast_frame, contracts.FORECAST),
    f"SELECT {', '.join(_key)}, {_forecast} AS weather_forecast, {_best('prom', FOUR)} AS promotion FROM fact f",
    f"{WEATHER}, {PROMOTION}",
)
register(
    "retrospective_frame",
    lambda k: framed(k, contracts.retrospective_frame, contracts.RETROSPECTIVE),
    f"""SELECT {', '.join(_key)}, {_forecast} AS weather_forecast, {_best('prom', FOUR)} AS promotion, {_actual} AS weather_actual,
  {_best('prom', [FOUR[0], FOUR[2]])} AS availability FROM fact f""",
    f"{WEATHER}, {PROMOTION}",
)

#: Ten versions of each branch, one every 200 days; each third is closed after 90 days, all others are open, so versions overlap.
VERSIONS = """ver AS (SELECT cast(1 AS bigint) AS owner_user_id, branch_id, 'S' || cast(k AS string) AS station_id, cast(first_day + cast(200 * k AS int) AS date) AS valid_from,
 CASE WHEN k % 3 = 1 THEN cast(first_day + cast(200 * k + 90 AS int) AS date) END AS valid_to, 'verified' AS verification_status
 FROM (SELECT branch_id, min(business_date) AS first_day FROM ob GROUP BY branch_id) b CROSS JOIN (SELECT order_type_id AS k FROM (SELECT DISTINCT order_type_id FROM ob)) n)"""
register(
    "location_as_of_overlapping",
    lambda k: contracts.location_as_of(k.fact(), _made(k, VERSIONS)).groupBy("branch_id", "business_date", "station_id").agg(F.count("*").alias("row_count")),
    """SELECT f.branch_id, f.business_date, (SELECT arg_max(v.station_id, v.valid_from) FROM ver v WHERE v.branch_id = f.branch_id AND v.valid_from <= f.business_date
   AND coalesce(v.valid_to, date '9999-12-31') >= f.business_date) AS station_id, f.n AS row_count
  FROM (SELECT branch_id, business_date, count(*) AS n FROM fact GROUP BY 1, 2) f""", VERSIONS)

# all analytics from one reading of the fact
_FIVE = "qty_milli gross_sales_milli net_sales_milli sales_ex_tax_milli"


def _one_pass_sql() -> str:
    out = []
    text = lambda k: f"cast({k} AS varchar)"
    for report, keys in analytics.SETS.items():
        one, two = text(keys[0]), text(keys[1]) if len(keys) > 1 else "cast(NULL AS varchar)"
        grouped = f"SELECT owner_user_id, {', '.join(keys)}, {SUMS} FROM fact GROUP BY {', '.join(['owner_user_id', *keys])}"
        out.append(f"""SELECT owner_user_id, '{report}' AS report, 'all' AS measure, cast(NULL AS integer) AS rank, {one} AS key_1, {two} AS key_2, qty_milli, net_sales_milli,
  cast(net_sales_milli AS double) / cast(cast(sum(net_sales_milli) OVER (PARTITION BY owner_user_id) AS bigint) AS double) AS net_share FROM ({grouped})""")
        for m in analytics.RANKED.get(report, ()):
            out.append(f"""SELECT owner_user_id, '{report}', '{m}', rank, key_1, key_2, qty_milli, net_sales_milli, net_share FROM (SELECT *, {one} AS key_1, {two} AS key_2,
  cast(row_number() OVER (PARTITION BY owner_user_id ORDER BY {m} DESC, {one}) AS integer) AS rank,
  cast(net_sales_milli AS double) / cast(cast(sum(net_sales_milli) OVER (PARTITION BY owner_user_id) AS bigint) AS double) AS net_share FROM ({grouped})) WHERE rank <= 5""")
    return " UNION ALL ".join(out)


register("analytics_in_one_pass", lambda k: analytics.in_one_pass(k.fact(), lambda df: staged(df, scratch(df.sparkSession, "sums"))), _one_pass_sql())


# text with broken rows
def raw_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments as text in which every row of an id that ends in 7 has a word for its amount: the gate's counts by day."""
    declared = readers.columns_of("order_payments")
    rows = pos_sources(spark, sf_dir).payments
    full = rows.select(*((c(n) if n in rows.columns else F.lit(None)).cast(kind).alias(n) for n, kind in declared), "t_open_date")
    text = full.select(*(F.when((F.lit(n) == "amount") & c("id").endswith("7"), F.lit("much")).otherwise(F.coalesce(c(n).cast("string"), F.lit("\\N"))).alias(n) for n, _ in declared), "t_open_date")
    place = scratch(spark, "raw")
    readers.write_raw_text(text.hint("rebalance", "t_open_date"), f"{place}/text")
    return readers.ingest_raw(spark, f"{place}/text", "order_payments", f"{place}/parquet", f"{place}/quarantine").select("t_open_date", "good_rows", "bad_rows", "passed")


QUERIES["raw_text_gate"] = raw_gate
ORACLE["raw_text_gate"] = oracle.sql("""SELECT t_open_date, count(*) FILTER (NOT ends_with(id, '7')) AS good_rows, count(*) FILTER (ends_with(id, '7')) AS bad_rows, count(*) FILTER (ends_with(id, '7')) = 0 AS passed
  FROM pos_payments GROUP BY 1""")


def bucketed_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact over sources that were written in buckets by order."""
    buckets = readers.bucketed(pos_sources(spark, sf_dir), scratch(spark, "buckets"))
    return Chain(buckets, dealt=True).fact()


QUERIES["hourly_sales_fact_bucketed"] = bucketed_fact
ORACLE["hourly_sales_fact_bucketed"] = ORACLE["hourly_sales_fact"]


def windows_with_ledger(k: Chain) -> DataFrame:
    """A run over the months of 1996 that stops at a product which isn't in the dimension, and a second one with it that goes on from there: the
    summary of each attempt."""
    spark = k.orders.sparkSession
    place = scratch(spark, "runs")
    products, branches = (staged(df, f"{place}/{n}") for n, df in (("products", product_dim(k)), ("branches", branch_dim(k))))
    run = lambda p: writing.write_window(k.src, p, branches, dims.code_dims(spark), f"{place}/fact", f"{place}/ledger", "1996-01-01", "1996-02-29")
    run(products.where("product_no <> 'P5'"))
    run(products)
    out = writing.attempt_summary(writing.read_ledger(spark, f"{place}/ledger"))
    return few_rows(out.select("attempt", "processed_days", "succeeded_days", "failed_days", "skipped_days", "rows_written"))


_window = "SELECT d, coalesce(n, 0) AS n, coalesce(bad, 0) AS bad FROM (SELECT cast(unnest(generate_series(date '1996-01-01', date '1996-02-29', interval 1 day)) AS date) AS d) LEFT JOIN (SELECT business_date, count(*) AS n, count(*) FILTER (product_no = 'P5') AS bad FROM fact GROUP BY 1) ON business_date = d"
register(
    "window_attempts",
    windows_with_ledger,
    """SELECT 1 AS attempt, count(*) FILTER (d < f OR bad > 0) AS processed_days, count(*) FILTER (d < f) AS succeeded_days, count(*) FILTER (d >= f AND bad > 0) AS failed_days, count(*) FILTER (d > f AND bad = 0) AS skipped_days,
  cast(coalesce(sum(n) FILTER (d < f), 0) AS bigint) AS rows_written FROM w
 UNION ALL SELECT 2, count(*) FILTER (d >= f), count(*) FILTER (d >= f), 0, 0, cast(sum(n) FILTER (d >= f) AS bigint) FROM w HAVING count(*) FILTER (d >= f) > 0
 UNION ALL SELECT 0, count(*), count(*), 0, 0, cast(sum(n) AS bigint) FROM w""",
    f"w0 AS ({_window}), w AS (SELECT *, coalesce((SELECT min(d) FROM w0 WHERE bad > 0), date '1996-03-01') AS f FROM w0)",
)
