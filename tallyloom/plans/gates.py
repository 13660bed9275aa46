"""Gates: exact comparison of what is written with its source, by owner and day, and contract checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import FORBIDDEN, GRAIN, MEASURES, D
from . import analytics

c = F.col
KEY = ["owner_user_id", "business_date"]
COMPARED = ["row_count", *MEASURES]


def fact_metrics(fact: DataFrame) -> DataFrame:
    """Sums of a fact by owner and day: of a candidate before it is written or of what was read back."""
    return fact.groupBy(*KEY).agg(F.count("*").alias("row_count"), *(F.sum(m).alias(m) for m in MEASURES))


def source_metrics(allocations: DataFrame, orders: DataFrame, owner: int = 1) -> DataFrame:
    """What the allocated lines add up to by day, with the number of fact rows and lines that they make, and of the chosen orders
    those of status 1, of another status, and the newest ones (one for each order and day)."""
    keyed = allocations.withColumn("owner_user_id", F.lit(owner).cast("bigint"))
    grain = keyed.groupBy(*GRAIN).agg(*(F.sum(m).alias(m) for m in MEASURES), F.count("*").alias("lines"))
    days = grain.groupBy(*KEY).agg(F.count("*").alias("row_count"), *(F.sum(m).alias(m) for m in MEASURES), F.sum("lines").alias("item_count"))
    by_order = orders.groupBy(*D).agg(F.count_if(c("order_status") == 1).alias("ones"), F.count("*").alias("n"))
    counts = by_order.groupBy("business_date").agg(F.sum("ones").alias("status_1_row_count"), F.sum(c("n") - c("ones")).alias("non_status_1_row_count"), F.count("*").alias("latest_row_count"))
    return days.join(counts, "business_date", "left")


def compare_metrics(source: DataFrame, target: DataFrame, scope: str = "persisted_fact") -> DataFrame:
    """Per owner and day: the deltas (source - target), whether all are 0 and both sides are there, and the reasons if not.
    Scope pre_insert_candidate compares item_count too, which must be known on both sides. If a side has a column
    rounding_delta_milli, one over 1 warns but fails nothing."""
    items = scope == "pre_insert_candidate"
    measures = COMPARED + ["item_count"] * items
    given = lambda df: [k for k in (*measures, "rounding_delta_milli") if k in df.columns]
    side = lambda df, tag: df.select(*KEY, *(c(m).alias(f"{tag}{m}") for m in given(df)))
    joined = side(source, "s_").join(side(target, "t_"), KEY, "full_outer")
    value = lambda m, df, tag: c(f"{tag}{m}") if m in df.columns else F.lit(None).cast("bigint")
    delta = {m: F.coalesce(f"s_{m}", F.lit(0)) - F.coalesce(f"t_{m}", F.lit(0)) for m in COMPARED}
    if items:
        delta["item_count"] = value("item_count", source, "s_") - value("item_count", target, "t_")
    rounding = F.coalesce(value("rounding_delta_milli", source, "s_"), value("rounding_delta_milli", target, "t_"), F.lit(0))
    out = joined.select(*KEY, F.lit(scope).alias("scope"), c("s_row_count").isNull().alias("source_missing"), c("t_row_count").isNull().alias("target_missing"), *(d.alias(f"{m}_delta") for m, d in delta.items()), (F.abs(rounding) > 1).alias("rounding_warning"))
    tests = [F.when(c("source_missing"), "source missing"), F.when(c("target_missing"), "target missing"), *(F.when(c(f"{m}_delta") != 0, F.concat(F.lit(f"{m}_delta="), c(f"{m}_delta").cast("string"))) for m in measures)]
    tests += [F.when(c("item_count_delta").isNull(), "item_count unknown")] * items
    return out.withColumn("reasons", F.array_join(F.array_compact(F.array(*tests)), ";")).withColumn("passed", c("reasons") == "")


MISSES = ["product_miss_count", "branch_miss_count", "order_type_miss_count", "payment_type_miss_count"]
DIMENSION_COUNTS = [*MISSES, "other_day_count", "non_status_1_count", "not_latest_count"]


ORDERS = ["status_1_row_count", "non_status_1_row_count", "latest_row_count"]


def dimension_counts(fact: DataFrame, products: DataFrame, branches: DataFrame, codes: DataFrame, fact_sums: bool = False) -> DataFrame:
    """By owner and day: fact rows whose product, branch or codes aren't in the dimensions, and rows of another day than the one they are
    written for (column sale_period, if the fact has it); with ``fact_sums`` also the fact's metrics. Each dimension is a set of keys
    that is joined to the fact's keys; the fixed codes are a test of a list. Spark chooses how to join by size."""
    ids = {kind: [r["id"] for r in codes.where(c("kind") == kind).select("id").collect()] for kind in ("order_type", "payment_type")}  # 22 fixed rows
    rows = fact if "sale_period" in fact.columns else fact.withColumn("sale_period", c("business_date"))
    joined = rows.join(products.select("owner_user_id", "product_no", F.lit(1).alias("has_product")), ["owner_user_id", "product_no"], "left")
    joined = joined.join(branches.select("owner_user_id", "branch_id", F.lit(1).alias("has_branch")), ["owner_user_id", "branch_id"], "left")
    missing = {"product_miss_count": c("has_product").isNull(), "branch_miss_count": c("has_branch").isNull()}
    missing |= {f"{kind}_miss_count": ~F.coalesce(c(f"{kind}_id").isin(ids[kind]), F.lit(False)) for kind in ids}
    other_day = F.count_if(~c("business_date").eqNullSafe(c("sale_period"))).alias("other_day_count")
    sums = [F.count("*").alias("row_count"), *(F.sum(m).alias(m) for m in MEASURES)] if fact_sums else []
    return joined.groupBy("owner_user_id", c("sale_period").alias("business_date")).agg(*sums, *(F.count_if(v).alias(k) for k, v in missing.items()), other_day)


def dimension_gate(fact: DataFrame, products: DataFrame, branches: DataFrame, codes: DataFrame, source: DataFrame) -> DataFrame:
    """dimension_counts, and of the ``source`` metrics orders of another status and older versions; with reasons and whether all are 0."""
    counts = dimension_counts(fact, products, branches, codes)
    zero = lambda v: F.coalesce(v, F.lit(0))
    status = source.select(*KEY, zero(c("non_status_1_row_count")).alias("non_status_1_count"), F.greatest(zero(c("status_1_row_count") - c("latest_row_count")), F.lit(0)).alias("not_latest_count"))
    out = counts.join(status, KEY, "left").withColumns({k: zero(c(k)) for k in ("non_status_1_count", "not_latest_count")})
    reasons = F.array_compact(F.array(*(F.when(c(k) > 0, F.concat(F.lit(f"{k}="), c(k).cast("string"))) for k in DIMENSION_COUNTS)))
    return out.select(*KEY, *DIMENSION_COUNTS).withColumn("dim_reasons", F.array_join(reasons, ";")).withColumn("passed", F.greatest(*DIMENSION_COUNTS) == 0)


def forbidden_columns(names: list[str]) -> list[str]:
    return sorted(set(names) & set(FORBIDDEN))


def fact_contract_check(fact: DataFrame) -> DataFrame:
    """One row of violation counts: rows over one a grain, hours out of 0 to 23, null keys, broken sums."""
    grain = fact.groupBy(*GRAIN).agg(F.count("*").alias("n"), F.count_if((c("net_sales_milli") != c("gross_sales_milli") - c("discount_milli") + c("surcharge_milli")) | (c("tax_milli") != c("included_tax_milli") + c("excluded_tax_milli")) | (c("sales_ex_tax_milli") != c("net_sales_milli") - c("tax_milli"))).alias("bad"))
    null = F.greatest(*(c(k).isNull().cast("int") for k in GRAIN)) == 1
    zero = lambda v: F.coalesce(v, F.lit(0))
    return grain.agg(zero(F.sum(c("n") - 1)).alias("duplicate_rows"), zero(F.sum(F.when(~c("hour_of_day").between(0, 23), c("n")))).alias("hour_violations"), zero(F.sum(F.when(null, c("n")))).alias("null_key_rows"), zero(F.sum("bad")).alias("identity_violations"))


def pre_insert_report(source: DataFrame, candidate: DataFrame, dims: DataFrame, names: list[str]) -> DataFrame:
    """Comparison, dimension gate and forbidden columns together, by owner and day, with the reasons of all three."""
    bad = forbidden_columns(names)
    compared = compare_metrics(source, candidate, "pre_insert_candidate").withColumnRenamed("passed", "metrics_passed")
    joined = compared.join(dims.withColumnRenamed("passed", "dims_passed"), KEY, "left")
    columns = f"forbidden_column_count={len(bad)}" if bad else ""
    reasons = F.array_join(F.filter(F.array(c("reasons"), F.coalesce("dim_reasons", F.lit("dimension gate missing")), F.lit(columns)), lambda r: r != ""), ";")
    return joined.withColumn("reasons", reasons).withColumn("forbidden_columns", F.lit(",".join(bad))).withColumn("passed", c("metrics_passed") & F.coalesce("dims_passed", F.lit(False)) & F.lit(not bad))


def post_insert_report(source: DataFrame, persisted: DataFrame) -> DataFrame:
    """The source against what was written and read back, by owner and day."""
    return compare_metrics(source, fact_metrics(persisted), "persisted_fact")


def gate_days(source: DataFrame, written: DataFrame, products: DataFrame, branches: DataFrame, codes: DataFrame) -> DataFrame:
    """All gates of what was written and read back, by owner and day, in one pass: its sums against those of the ``source`` (both as the
    candidate, with the item count, and as the persisted fact), the dimensions, and the columns. Sums and misses of the written rows
    come from one aggregation."""
    one = dimension_counts(written, products, branches, codes, fact_sums=True)
    joined = source.select(*KEY, *COMPARED, "item_count", *ORDERS).join(one.withColumnsRenamed({k: f"t_{k}" for k in COMPARED}), KEY, "full_outer")
    zero = lambda v: F.coalesce(v, F.lit(0))
    joined = joined.withColumn("non_status_1_count", zero(c("non_status_1_row_count"))).withColumn("not_latest_count", F.greatest(zero(c("status_1_row_count") - c("latest_row_count")), F.lit(0)))
    joined = joined.withColumns({k: zero(c(k)) for k in (*MISSES, "other_day_count")})
    bad = forbidden_columns(written.columns)
    deltas = {m: zero(c(m)) - zero(c(f"t_{m}")) for m in COMPARED}
    compared = [F.when(c("row_count").isNull(), "source missing"), F.when(c("t_row_count").isNull(), "target missing"), *(F.when(d != 0, F.concat(F.lit(f"{m}_delta="), d.cast("string"))) for m, d in deltas.items()), F.when(c("row_count").isNotNull() & c("item_count").isNull(), "item_count unknown")]
    dims = [F.when(c(k) > 0, F.concat(F.lit(f"{k}="), c(k).cast("string"))) for k in DIMENSION_COUNTS]
    columns = [F.lit(f"forbidden_column_count={len(bad)}")] * bool(bad)
    text = lambda tests: F.array_join(F.array_compact(F.array(*tests)), ";")
    out = joined.withColumn("metrics_passed", text(compared) == "").withColumn("post_passed", text(compared[:-1]) == "").withColumn("reasons", text([*compared, *dims, *columns]))
    return out.select(*KEY, "row_count", *DIMENSION_COUNTS, "metrics_passed", "reasons", (c("reasons") == "").alias("passed"), "post_passed")


def smoke_checks(fact: DataFrame, products: DataFrame, branches: DataFrame, top: int = 5) -> DataFrame:
    """One row: products, branches, fact rows, rows of the leaderboard and of the product summary, and whether there are any of each.
    The fact and each dimension are read once: the fact is summed by product, and all counts but the branches' come from those rows
    beside the products."""
    by_product = fact.groupBy("owner_user_id", "product_no").agg(F.count("*").alias("rows"))
    named = products.select("owner_user_id", "product_no", "product_name", (c("is_active") & analytics.allowed()).alias("ranked"))
    joined = by_product.join(named.withColumn("known", F.lit(True)), ["owner_user_id", "product_no"], "full_outer")
    sold = c("rows").isNotNull() & c("known").isNotNull()
    names = F.struct("owner_user_id", "product_no", "product_name")
    one = joined.agg(
        F.count("known").alias("product_count"), F.coalesce(F.sum("rows"), F.lit(0)).alias("fact_count"),
        F.least(F.countDistinct(F.when(sold & c("ranked"), names)), F.lit(top)).cast("bigint").alias("leaderboard_count"), F.countDistinct(F.when(sold, names)).alias("summary_count"),
    )
    one = one.crossJoin(branches.agg(F.count("*").alias("branch_count")))
    counts = ["product_count", "branch_count", "fact_count", "leaderboard_count", "summary_count"]
    return one.select(*counts, (F.least(*counts) > 0).alias("passed"))
