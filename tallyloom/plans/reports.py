"""Reconciliation reports. A report of many metrics is one pass of conditional sums, turned into rows by one explode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as x
from ..operators import orders as o
from ..operators.allocation import ITEM, ORDER_MONEY, Chain, line_allocations
from ..schemas import D, GRAIN, MEASURES
from ..sources.readers import Sources
from .storage import few_rows, scratch, staged

c = F.col
PARTS = ["gross_sales", "discount", "surcharge", "net_sales", "included_tax", "sales_ex_tax"]


#: What a metric means, where its name doesn't say it.
NOTES = {
    "source_orders_all": "every order row of the scope",
    "source_orders_valid": "finite amounts within the limit",
    "source_completed_orders": "valid, completed and not voided",
    "preview_allocatable_orders": "completed, with items and money to allocate by",
    "preview_excluded_zero_denominator": "completed, with items but nothing to allocate by",
    "preview_excluded_no_items": "completed, without items",
    "preview_excluded_status": "orders of an excluded or uncompleted status",
    "preview_after_allocation": "what the lines of allocatable orders were given",
    "rounding_delta": "given less source",
    "preview_excluded_invalid_or_outlier": "an amount is not finite or over the limit",
    "orders_minus_items_tax_milli": "tax of orders that no line was given",
    "orders_minus_items_minus_additions_tax_milli": "the same, less the tax of additions",
    "affected_order_count": "orders whose lines add up to another tax than theirs",
    "avg_abs_order_delta_milli": "over all allocatable orders, rounded",
}


def rows_of(df: DataFrame, metrics: list[tuple[str, dict[str, Column]]]) -> DataFrame:
    """One row for each metric of an aggregated one-row frame: sort_order, metric, the named values, and a note (may be empty)."""
    structs = [
        F.struct(F.lit(k).alias("sort_order"), F.lit(m).alias("metric"), *(v.cast("bigint").alias(n) for n, v in values.items()), F.lit(NOTES.get(m, "")).alias("note"))
        for k, (m, values) in enumerate(metrics, 1)
    ]
    return df.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def total(v: Column, when: Column | None = None) -> Column:
    return F.coalesce(F.sum(v if when is None else F.when(when, v)), F.lit(0))


def number(when: Column) -> Column:
    return F.count(F.when(when, 1))


OK = "has_invalid_amount = 0 AND is_amount_outlier = 0"
DONE = f"{OK} AND is_completed_proxy = 1"
ALLOCATABLE = f"{DONE} AND has_valid_items = 1 AND has_tax_allocation_denominator = 1"


def tax_reconciliation_breakdown(chain: Chain) -> DataFrame:
    """Ten scopes by seven measures."""
    no_items, no_base = f"{DONE} AND has_valid_items = 0", f"{DONE} AND has_valid_items = 1 AND has_tax_allocation_denominator = 0"
    tests = [F.expr(t) for t in ("true", OK, DONE, ALLOCATABLE, no_base, no_items, f"{OK} AND is_completed_proxy = 0", ALLOCATABLE, ALLOCATABLE, f"NOT ({OK})")]
    names = ["source_orders_all", "source_orders_valid", "source_completed_orders", "preview_allocatable_orders", "preview_excluded_zero_denominator", "preview_excluded_no_items", "preview_excluded_status", "preview_after_allocation", "rounding_delta", "preview_excluded_invalid_or_outlier"]
    aggs = []
    for k, test in enumerate(tests):
        aggs.append(number(test).alias(f"n{k}"))
        for p in PARTS:
            source, given = c(f"source_{p}_milli"), c(f"allocated_{p}_milli")
            aggs.append(total({7: given, 8: given - source}.get(k, source), test).alias(f"{p}{k}"))
    one = chain.scope().agg(*aggs)
    values = [{"order_count": c(f"n{k}"), **{f"{p}_milli": c(f"{p}{k}") for p in PARTS}} for k in range(10)]
    values[8]["order_count"] = F.lit(0)
    if chain.dedup:
        one = one.crossJoin(chain.excluded().agg(F.count("*").alias("excluded")))
        values[6] = {"order_count": c("excluded"), **{f"{p}_milli": F.lit(0) for p in PARTS}}
    return rows_of(one, list(zip(names, values, strict=True)))


def additions_tax_debug(chain: Chain) -> DataFrame:
    source, given, added = c("source_included_tax_milli"), c("allocated_included_tax_milli"), c("addition_include_tax_milli")
    done, allocatable = F.expr(DONE), F.expr(ALLOCATABLE)
    one = chain.scope().agg(total(added, done).alias("a"), total(source, done).alias("s"), total(given, allocatable).alias("g"), total(given, done).alias("h"))
    return rows_of(one, [(k, {"tax_milli": v}) for k, v in (("additions_include_tax_milli_total", c("a")), ("orders_included_tax_milli_total", c("s")), ("items_included_tax_milli_total", c("g")), ("orders_minus_items_tax_milli", c("s") - c("h")), ("orders_minus_items_minus_additions_tax_milli", c("s") - c("h") - c("a")))])


def rounding_orders(chain: Chain) -> DataFrame:
    return chain.scope().where(ALLOCATABLE).select(
        "business_date", "order_id", "source_included_tax_milli", "allocated_included_tax_milli", (c("allocated_included_tax_milli") - c("source_included_tax_milli")).alias("delta_milli"),
        "item_count", "allocation_denominator_milli", c("order_status").alias("status"), c("destination_raw").alias("destination"),
    )


def rounding_debug(chain: Chain) -> DataFrame:
    d = c("delta_milli")
    one = rounding_orders(chain).agg(total(c("source_included_tax_milli")).alias("s"), total(c("allocated_included_tax_milli")).alias("g"), total(d).alias("d"), number(d != 0).alias("n"), F.coalesce(F.max(F.abs(d)), F.lit(0)).alias("m"), F.coalesce(F.round(F.avg(F.abs(d))), F.lit(0)).alias("v"))
    return rows_of(one, [(k, {"value_milli": c(v)}) for k, v in (("source_order_level_included_tax_milli", "s"), ("allocated_preview_included_tax_milli", "g"), ("rounding_delta_milli", "d"), ("affected_order_count", "n"), ("max_abs_order_delta_milli", "m"), ("avg_abs_order_delta_milli", "v"))])


def top_tax_delta_sample(chain: Chain, n: int = 10) -> DataFrame:
    return rounding_orders(chain).orderBy(F.abs("delta_milli").desc(), "business_date", "order_id").limit(n if n > 0 else 10)


def traced_orders(chain: Chain, n: int = 5) -> DataFrame:
    """The top orders with their rank. The limit comes first, so the unpartitioned window sees n rows."""
    order = Window.orderBy(F.abs("delta_milli").desc(), "business_date", "order_id")
    return top_tax_delta_sample(chain, n).withColumn("trace_rank", F.row_number().over(order))


def pinned(src: Sources, keys: list[tuple]) -> Sources:
    """The rows of some orders (order_id, business_date). Ids and days are literals of plain tests, so they reach the scans: only the
    days' folders are read, and of those only what may hold the ids."""
    ids, days = sorted({k for k, _ in keys}), sorted({d for _, d in keys})

    def only(df: DataFrame, key: str) -> DataFrame:
        pairs = F.lit(False)
        for k, d in keys:
            pairs = pairs | ((c(key) == F.lit(k)) & (c("t_open_date") == F.lit(d)))
        return df.where(c("t_open_date").isin(days) & c(key).isin(ids)).where(pairs)

    return Sources(only(src.orders, "id"), *(only(df, "order_id") for df in src[1:]))


def pinned_chain(chain: Chain, top: DataFrame) -> Chain:
    """The chain over the orders of ``top`` (few rows, made already) alone."""
    few = pinned(chain.src, [(r["order_id"], r["business_date"]) for r in top.select(*D).distinct().collect()])
    return Chain(few, chain.dedup, parts=few.orders.sparkSession.sparkContext.defaultParallelism)


def order_trace(chain: Chain, n: int = 5, place: str | None = None) -> DataFrame:
    """Five sections over the top orders: header, payments, item allocation, allocation summary, join check. Values that a
    section doesn't have are null.

    First the n orders are found and made (n is a parameter). Then the sources are read for those orders alone, and their payments,
    items and flow are written once under ``place`` (else to scratch); the sections read only that."""
    top = few_rows(traced_orders(chain, n).select("trace_rank", *D, "status", "destination"))
    place = place or scratch(top.sparkSession, "trace")
    keep = lambda df, name: staged(df, f"{place}/{name}")
    small = pinned_chain(chain, top)
    small.keep_flow(keep)
    top, key = F.broadcast(top), ["trace_rank", *D]
    dated = lambda df: df.withColumnRenamed("t_open_date", "business_date").join(top.select(*key), D)
    blank = lambda k: F.coalesce(x.trim_ws(c(k)), F.lit(""))
    pays = keep(dated(small.src.payments).select(*key, blank("id").alias("payment_row_id"), blank("name").alias("payment_name"), x.payment_type_id(c("name")).alias("normalized_payment_type_id"), x.safe_milli(c("amount")).alias("payment_amount_milli")), "payments")
    items_ = keep(dated(small.src.items.where(x.has_product(c("product_no")))).select(*key, x.trim_ws(c("product_no")).alias("product_no"), blank("id").alias("id"), blank("product_name").alias("name"), x.safe_milli(c("included_tax")).alias("tax")), "items")
    scope = keep(small.scope().join(top.select(*key), D), "scope")
    grouped = pays.groupBy(*key, "normalized_payment_type_id").agg(F.sum("payment_amount_milli").alias("m"))
    known = (c("m") != 0) & (c("normalized_payment_type_id") != 0)
    paid = grouped.groupBy(*key).agg(
        F.count_if(known).alias("normalized_payment_type_count"), F.max_by("normalized_payment_type_id", F.struct(F.abs("m"), "normalized_payment_type_id")).alias("best"),
        F.when((F.count_if(c("m") > 0) > 0) & (F.count_if(c("m") < 0) > 0), 1).otherwise(0).alias("has_offsetting_payments"), F.count("*").alias("payment_after_order_aggregation_row_count"),
    )
    kinds = c("normalized_payment_type_count")
    paid = few_rows(paid.withColumn("final_payment_type_id", F.when(kinds == 0, 0).when(kinds == 1, c("best")).otherwise(8)).withColumn("is_mixed", (kinds > 1).cast("int")).drop("best"))
    lines = small.enriched.join(top.select(*key), D)
    # one aggregation counts the rows of all kinds
    row = lambda df, kind, product=None: df.select(*key, F.lit(kind).alias("kind"), (F.lit(None).cast("string") if product is None else product).alias("product_no"))
    every = row(items_, "item", c("product_no")).union(row(pays, "payment")).union(row(lines, "line")).union(row(dated(small.src.additions), "addition"))
    of = lambda kind: F.count_if(c("kind") == kind)
    made = every.groupBy(*key).agg(of("item").alias("raw_item_row_count"), F.size(F.collect_set("product_no")).cast("bigint").alias("grouped_item_row_count"), of("payment").alias("raw_payment_row_count"), of("line").alias("final_joined_row_count"), of("addition").alias("raw_addition_row_count"))
    counts = top.join(made, key, "left").join(F.broadcast(paid.select(*key, "payment_after_order_aggregation_row_count")), key, "left")
    counts = counts.withColumns({k: F.coalesce(k, F.lit(0)) for k in (*made.columns[len(key) :], "payment_after_order_aggregation_row_count")})
    counts = few_rows(counts.withColumn("additions_after_order_aggregation_row_count", F.when(c("raw_addition_row_count") > 0, 1).otherwise(0)))
    section = lambda df, k, name, note, row=None: df.withColumns({"section_order": F.lit(k), "section": F.lit(name), "row_order": F.lit(1) if row is None else row, "note": note})
    head = scope.select(*key, c("order_status").alias("status"), c("destination_raw").alias("destination"), c("order_type_id").alias("normalized_order_type_id"), "branch_id",
        *(x.to_milli(c(f"order_{k}")).alias(f"{v}_milli") for k, v in (("total", "total"), ("item_subtotal", "item_subtotal"), ("discount_subtotal", "discount"), ("surcharge_subtotal", "surcharge"), ("included_tax", "included_tax"), ("tax_subtotal", "tax_subtotal"))), "transaction_voided", "void_sale_period")
    by_row = Window.partitionBy(*key).orderBy("payment_row_id", "payment_name", "payment_amount_milli")
    of_order = [F.broadcast(paid), F.broadcast(counts.select(*key, "raw_payment_row_count"))]
    second = pays.join(top, key).join(of_order[0], key, "left").join(of_order[1], key, "left").withColumn("payment_row_count", c("raw_payment_row_count"))
    meta = items_.groupBy(*key, "product_no").agg(
        F.count("*").alias("raw_item_row_count"), F.max("id").alias("one_id"), F.max_by("name", F.struct(F.length("name"), "name")).alias("product_name"), F.sum("tax").alias("raw_item_included_tax_milli")
    ).withColumn("item_id", F.when(c("raw_item_row_count") == 1, c("one_id")).otherwise(F.concat(F.lit("product_group:"), c("product_no")))).drop("one_id")
    share = x.share_of(c("addition_discount_total"), c("item_gross"), c("order_gross_sales")), x.share_of(c("addition_surcharge_total"), c("item_gross"), c("order_gross_sales"))
    net = c("item_gross") - (c("item_discount") + share[0]) + (c("item_surcharge") + share[1])
    ratio = F.when(F.abs("order_net_sales") <= 0.000001, F.lit(0.0)).otherwise(net / F.when(c("order_net_sales") != 0, c("order_net_sales")))
    given = line_allocations(lines, "trace_rank", *ITEM, *ORDER_MONEY)
    third = given.join(meta, [*key, "product_no"], "left").join(top, key).select(
        *key, "status", "destination", c("order_type_id").alias("normalized_order_type_id"), "branch_id", c("payment_type_id").alias("final_payment_type_id"), "item_id", "product_no", "product_name", c("qty_milli").alias("current_qty_milli"),
        x.to_milli(c("item_net")).alias("current_subtotal_milli"), x.to_milli(c("item_discount")).alias("current_discount_milli"), x.to_milli(c("item_surcharge")).alias("current_surcharge_milli"), "raw_item_included_tax_milli",
        x.to_milli(c("order_net_sales")).alias("allocation_denominator_milli"), x.to_milli(share[0]).alias("allocated_discount_milli"), x.to_milli(share[1]).alias("allocated_surcharge_milli"), "raw_item_row_count",
        (F.round(ratio * 1000000) / 1000000).alias("allocation_ratio"), c("included_tax_milli").alias("allocated_included_tax_milli"),
    )
    given, source = c("allocated_included_tax_milli"), c("source_included_tax_milli")
    fourth = scope.join(F.broadcast(counts.drop("status", "destination")), key).join(F.broadcast(paid.drop("payment_after_order_aggregation_row_count")), key, "left").select(
        *key, c("order_status").alias("status"), c("destination_raw").alias("destination"), *(F.coalesce(k, F.lit(0)).alias(k) for k in ("final_payment_type_id", "is_mixed", "has_offsetting_payments", "normalized_payment_type_count")),
        "allocation_denominator_milli", source.alias("source_order_included_tax_milli"), given.alias("sum_allocated_included_tax_milli"), (given - source).alias("delta_milli"), c("source_net_sales_milli").alias("source_order_net_milli"),
        c("allocated_net_sales_milli").alias("sum_allocated_net_milli"), (c("allocated_net_sales_milli") - c("source_net_sales_milli")).alias("net_delta_milli"),
        "raw_item_row_count", "grouped_item_row_count", "raw_payment_row_count", "payment_after_order_aggregation_row_count", "final_joined_row_count", "raw_addition_row_count", "additions_after_order_aggregation_row_count",
        c("raw_item_row_count").alias("item_line_count"), c("grouped_item_row_count").alias("product_group_count"), c("raw_payment_row_count").alias("payment_row_count"),
    )
    mixed = F.concat_ws(", ", F.when(c("is_mixed") == 1, "mixed"), F.when(c("has_offsetting_payments") == 1, "offsetting"))
    merged = F.when(c("raw_item_row_count") > 1, "several items as one product").otherwise("one item")
    amplified = F.when(c("final_joined_row_count") > c("grouped_item_row_count"), "joined rows exceed grouped items").otherwise("no amplification")
    parts = [
        section(head, 1, "order_header", F.lit("newest row of status 1")), section(second, 2, "payment_trace", mixed, F.row_number().over(by_row)),
        section(third, 3, "item_allocation_trace", merged, F.row_number().over(Window.partitionBy(*key).orderBy("product_no"))),
        section(fourth, 4, "allocation_summary", F.lit("order beside its lines")), section(counts, 5, "join_duplication_check", amplified),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def duplicate_order_trace(chain: Chain, n: int = 5) -> DataFrame:
    """Every version of the top orders, newest first. The orders are found first, and then read alone."""
    top = few_rows(traced_orders(chain, n).select("trace_rank", *D, c("status").alias("top_sample_status"), c("destination").alias("top_sample_destination")))
    ranked = o.duplicate_row_rank(pinned_chain(chain, top).base.join(F.broadcast(top), D))
    money = {"total": "total", "item_subtotal": "item_subtotal", "discount_subtotal": "discount_subtotal", "payment_subtotal": "payment_subtotal", "included_tax": "included_tax_subtotal", "tax_subtotal": "tax_subtotal", "item_surcharge_subtotal": "item_surcharge_subtotal", "trans_surcharge_subtotal": "trans_surcharge_subtotal"}
    return ranked.select(
        "trace_rank", c("duplicate_rank").alias("raw_row_rank"), "duplicate_row_count", *D, c("order_status").alias("status"), c("destination_raw").alias("destination"), "branch_id", c("branch_raw").alias("branch"),
        *(x.to_milli(c(f"order_{k}")).alias(f"{v}_milli") for k, v in money.items()),
        "transaction_created", "transaction_submitted", "transaction_voided", "void_sale_period", "created", "modified", "sequence", "sale_period", "shift_number", "top_sample_status", "top_sample_destination",
    )


def duplicate_order_summary(stats: DataFrame) -> DataFrame:
    dup = c("row_count") > 1
    tests = {
        "duplicate_delivery_only_count": c("delivery_row_count") == c("row_count"), "duplicate_status_mismatch_count": c("status_count") > 1, "duplicate_financial_mismatch_count": c("financial_count") > 1,
        "duplicate_included_tax_mismatch_count": c("included_tax_count") > 1, "duplicate_total_mismatch_count": c("total_count") > 1, "duplicate_with_distinct_modified_count": c("modified_count") > 1,
        "duplicate_with_distinct_created_count": c("created_count") > 1, "duplicate_with_distinct_transaction_submitted_count": c("submitted_count") > 1,
        "duplicate_with_any_dedup_sort_signal_count": (c("modified_count") > 1) | (c("created_count") > 1) | (c("submitted_count") > 1),
    }
    one = stats.agg(F.count("*").alias("keys"), number(dup).alias("dups"), total(c("row_count"), dup).alias("rows"), *(number(dup & t).alias(k) for k, t in tests.items()))
    first = [("order_id_open_date_total_count", c("keys")), ("duplicate_order_id_open_date_count", c("dups")), ("duplicate_row_total_count", c("rows")), ("duplicate_extra_row_count", c("rows") - c("dups"))]
    return rows_of(one, [(k, {"value": v}) for k, v in [*first, *((k, c(k)) for k in tests)]])


def status_dedup_candidate_summary(chain: Chain, stats: DataFrame | None = None) -> DataFrame:
    """Sixteen counts over raw rows, candidates and which statuses meet in one key. stats: order_duplicate_stats with presence, if made already."""
    dup = c("row_count") > 1
    stats = o.order_duplicate_stats(chain.src.orders, chain.deal, True) if stats is None else stats
    has = {k: c(f"has_status_{n}") == 1 for k, n in ((1, "1"), (2, "2"), (-1, "minus_1"), (-2, "minus_2"))}
    one = stats.agg(
        total(c("row_count")).alias("raw_order_rows"), F.count("*").alias("raw_order_keys"), number(dup).alias("duplicate_order_keys"), total(c("row_count"), dup).alias("duplicate_raw_rows"),
        *(number(dup & (c(f"{k}_count") > 1)).alias(f"{k}_mismatch_duplicate_keys") for k in ("status", "financial", "included_tax", "total")),
        number(has[1]).alias("sales_candidate_order_keys"), number(has[-2]).alias("void_candidate_order_keys"), number(has[-1]).alias("excluded_status_minus_1_order_keys"), number(has[2]).alias("excluded_status_2_order_keys"),
        number(has[1] & has[2]).alias("orders_with_both_status_1_and_2"), number(has[1] & has[-2]).alias("orders_with_both_status_1_and_minus_2"),
        number(has[2] & ~has[1] & ~has[-1] & ~has[-2]).alias("orders_with_only_status_2"), number(has[-1] & ~has[1] & ~has[2] & ~has[-2]).alias("orders_with_only_status_minus_1"),
    )
    return rows_of(one, [(k, {"value": c(k)}) for k in one.columns])


def deltas(chain: Chain) -> DataFrame:
    """Of each order and day with lines: the tax, net and ex-tax sales that these were given, and by how much their included tax differs most from that of
    an allocatable row (null without one). One run of the chain, whose rows of an order are summed where they stand."""
    if "deltas" in chain.kept:
        return chain.kept["deltas"]
    flags = ["has_invalid_amount", "is_amount_outlier", "is_completed_proxy"]
    source = F.when(F.expr(DONE) & (F.abs("order_net_sales") > 0.000001), x.to_milli(c("order_included_tax")))
    sums = [F.sum(m).alias(m) for m in ("tax_milli", "net_sales_milli", "sales_ex_tax_milli", "included_tax_milli")]
    by_order = chain.given("order_included_tax", "order_net_sales", *flags).groupBy(*D).agg(*sums, F.min(source).alias("least"), F.max(source).alias("most"))
    far = F.greatest(*(F.abs(c("included_tax_milli") - c(k)) for k in ("least", "most")))
    return by_order.withColumn("max_abs_delta_milli", far).drop("included_tax_milli", "least", "most")


def status_dedup_reconciliation_comparison(official: Chain, legacy: Chain) -> DataFrame:
    """Tax, net and ex-tax sales: both previews, the source, and the two deltas."""
    sums = lambda given, tag: given.agg(*(total(c(f"{m}_milli")).alias(f"{m}{tag}") for m in ("tax", "net_sales", "sales_ex_tax")))
    # the source rounds its sums, the previews add rounded lines
    source = official.financials.where(c("item_count") > 0).agg(*(F.coalesce(x.to_milli(x.money_sum(c(v))), F.lit(0)).alias(f"{k}_s") for k, v in (("tax", "order_included_tax"), ("net_sales", "order_net_sales"), ("sales_ex_tax", "order_sales_ex_tax"))))
    one = sums(deltas(legacy), "_l").crossJoin(sums(official.allocations, "_o")).crossJoin(source)
    metrics = []
    for m in ("tax", "net_sales", "sales_ex_tax"):
        a, b, s = c(f"{m}_l"), c(f"{m}_o"), c(f"{m}_s")
        metrics += [(f"{m}_{k}", {"value_milli": v}) for k, v in (("current_preview", a), ("status_dedup_preview", b), ("source_status_1", s), ("current_minus_source", a - s), ("status_dedup_minus_source", b - s))]
    return rows_of(one, metrics)


def order_mapping_summary(chain: Chain) -> DataFrame:
    return chain.kept.get("by_order", chain.orders).groupBy("order_type_id").agg(F.count("*").alias("row_count"), F.countDistinct("destination_raw").alias("raw_destination_count"))


def payment_mapping_summary(chain: Chain) -> DataFrame:
    named = chain.src.payments.select(x.payment_type_id(c("name")).alias("payment_type_id"), F.coalesce(x.trim_ws(c("name")), F.lit("")).alias("raw"))
    return named.groupBy("payment_type_id").agg(F.count("*").alias("row_count"), F.countDistinct("raw").alias("raw_payment_name_count"))


def reconciliation_summary(chain: Chain) -> DataFrame:
    """One row: source sums of orders with items beside the sums of the fact. Where the orders aren't written yet, both come of one run of the chain."""
    source = {"gross": "order_gross_sales", "discount": "order_discount_total", "surcharge": "order_surcharge_total", "net": "order_net_sales", "ex_tax": "order_sales_ex_tax", "included_tax": "order_included_tax", "excluded_tax": "order_excluded_tax", "tax": "order_tax_total", "addition_discount": "addition_discount_total", "addition_surcharge": "addition_surcharge_total", "addition_include_tax": "addition_include_tax_total"}
    with_tax = lambda df: df.withColumn("order_tax_total", c("order_included_tax") + c("order_excluded_tax"))
    if chain.dedup and "by_order" not in chain.kept:
        return _reconciled_once(with_tax(chain.flow), source)
    rows = with_tax(chain.financials)
    left = rows.where(c("item_count") > 0).agg(F.count("*").alias("source_order_count"), *(F.coalesce(x.to_milli(x.money_sum(c(v))), F.lit(0)).alias(f"source_{k}_milli") for k, v in source.items()))
    return left.crossJoin(chain.totals())


def _reconciled_once(flow: DataFrame, source: dict[str, str]) -> DataFrame:
    """The summary of a flow: the first line of each order takes the order's money along to the fact's grain."""
    first = c("product_no") == F.min("product_no").over(Window.partitionBy(*D))
    sold = flow.withColumns({"one_of_order": first, **{k: c(k).cast("double") for k in ITEM}}).where("product_no is not null")
    lines = line_allocations(sold, "one_of_order", *(v for v in dict.fromkeys(source.values()) if v not in ORDER_MONEY), *(v for v in ORDER_MONEY))
    once = [F.sum(F.when(c("one_of_order"), x.money(c(v)))).alias(f"sum_{k}") for k, v in source.items()]
    grain = lines.groupBy(*GRAIN[1:]).agg(*once, F.count_if("one_of_order").alias("orders"), *(F.sum(m).cast("bigint").alias(m) for m in MEASURES))
    return grain.agg(
        F.coalesce(F.sum("orders"), F.lit(0)).alias("source_order_count"), *(F.coalesce(x.to_milli(F.sum(f"sum_{k}").cast("double")), F.lit(0)).alias(f"source_{k}_milli") for k in source),
        F.count("*").alias("preview_group_count"), *(total(c(m)).alias(f"preview_{m}") for m in MEASURES),
    )


def status_excluded_summary(chain: Chain) -> DataFrame:
    """Per excluded status: keys, raw rows, sums, and its destinations with their numbers, most frequent first."""
    base = chain.excluded().withColumn("label", x.destination_label(c("destination_raw")))
    raw = chain.base.where(c("order_status").isin(-1, 2)).groupBy("order_status").agg(F.count("*").alias("raw_rows"))
    labels = base.groupBy("order_status", "label").count()
    text = labels.groupBy("order_status").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct((-c("count")).alias("n"), "label"))), lambda s: F.concat(s["label"], F.lit(":"), (-s["n"]).cast("string"))), ", ").alias("destination_distribution"))
    sums = base.groupBy("order_status").agg(
        F.count("*").alias("order_keys"), x.to_milli(x.money_sum(c("order_total"))).alias("total_milli"), total(x.to_milli(c("order_payment_subtotal"))).alias("payment_subtotal_milli"),
        x.to_milli(x.money_sum(c("order_included_tax"))).alias("included_tax_milli"), number(c("transaction_voided").isNotNull()).alias("voided_count"), number(c("transaction_submitted").isNull()).alias("submitted_null_count"),
    )
    return sums.join(raw, "order_status", "left").join(text, "order_status", "left").withColumnRenamed("order_status", "status")


def top_delta_before_after(official: Chain, legacy: Chain, n: int = 5) -> DataFrame:
    """The top orders by the legacy rule beside what both rules make of them. They are found first, and then both chains run over them
    alone."""
    top = deltas(legacy).where("max_abs_delta_milli is not null").select(*D, c("max_abs_delta_milli").alias("current_max_abs_delta_milli"))
    top = few_rows(top.orderBy(F.desc("current_max_abs_delta_milli"), "business_date", "order_id").limit(n))
    official, legacy = pinned_chain(official, top), pinned_chain(legacy, top)
    top = F.broadcast(top)
    raw = legacy.base.join(top.select(*D), D).groupBy(*D).agg(F.count("*").alias("raw_order_row_count"), F.array_join(F.array_sort(F.collect_set(c("order_status").cast("string"))), ",").alias("raw_status_list"))
    before = legacy.scope().join(top.select(*D), D).groupBy(*D).agg(F.max("allocated_included_tax_milli").alias("current_included"), F.max("allocated_net_sales_milli").alias("current_net"))
    after = official.scope().join(top.select(*D), D).select(*D, c("order_status").alias("selected_sales_status"), x.to_milli(c("order_payment_subtotal")).alias("selected_sales_payment_subtotal_milli"), "source_included_tax_milli", "allocated_included_tax_milli", "source_net_sales_milli", "allocated_net_sales_milli")
    zero = lambda k: F.coalesce(k, F.lit(0))
    return top.join(raw, D, "left").join(before, D, "left").join(after, D, "left").select(
        *D, zero("raw_order_row_count").alias("raw_order_row_count"), F.coalesce("raw_status_list", F.lit("")).alias("raw_status_list"), "selected_sales_status", zero("selected_sales_payment_subtotal_milli").alias("selected_sales_payment_subtotal_milli"),
        zero("source_included_tax_milli").alias("source_status_1_included_tax_milli"), zero("current_included").alias("current_allocated_included_tax_milli"), zero("allocated_included_tax_milli").alias("status_dedup_allocated_included_tax_milli"),
        (zero("current_included") - zero("source_included_tax_milli")).alias("current_delta_milli"), (zero("allocated_included_tax_milli") - zero("source_included_tax_milli")).alias("status_dedup_delta_milli"),
        (zero("current_net") - zero("source_net_sales_milli")).alias("current_net_delta_milli"), (zero("allocated_net_sales_milli") - zero("source_net_sales_milli")).alias("status_dedup_net_delta_milli"), "current_max_abs_delta_milli",
    )


def source_counts(chain: Chain) -> DataFrame:
    out = None
    for name, df in zip(("orders", "order_items", "order_additions", "order_payments"), chain.src, strict=True):
        one = df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("source_table"), "row_count")
        out = one if out is None else out.union(one)
    return out
