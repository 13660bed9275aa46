"""Orders: cleaning, the latest version by status, duplicates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions import exprs as x
from ..schemas import D

AMOUNTS = ["total", "item_subtotal", "discount_subtotal", "surcharge_subtotal", "included_tax_subtotal"]


def orders_base(orders: DataFrame) -> DataFrame:
    """One row for each version of an order, with clean keys, flags and amounts. Nulls have defaults, no row is dropped."""
    raw = [F.col(c) for c in AMOUNTS]
    return orders.select(
        F.col("id").alias("order_id"),
        F.col("t_open_date").alias("business_date"),
        x.hour_of_day(F.col("s_hour"), F.col("transaction_created")).alias("hour_of_day"),
        x.default_if_blank(F.col("branch_id"), "UNKNOWN_BRANCH").alias("branch_id"),
        x.default_if_blank(F.col("branch"), "UNKNOWN_BRANCH_NAME").alias("branch_name"),
        F.coalesce(x.trim_ws(F.col("branch")), F.lit("")).alias("branch_raw"),
        F.coalesce(x.trim_ws(F.col("destination")), F.lit("")).alias("destination_raw"),
        x.order_type_id(F.col("destination")).alias("order_type_id"),
        F.coalesce("status", F.lit(-1)).alias("order_status"),
        "transaction_created", "transaction_submitted", "transaction_voided", "created", "modified",
        "sequence", "void_sale_period", "sale_period", "shift_number",
        x.finite_or_zero(F.col("total")).alias("order_total"),
        x.finite_or_zero(F.col("item_subtotal")).alias("order_item_subtotal"),
        x.positive_or_zero(F.col("discount_subtotal")).alias("order_discount_subtotal"),
        x.positive_or_zero(F.col("surcharge_subtotal")).alias("order_surcharge_subtotal"),
        x.finite_or_zero(F.col("included_tax_subtotal")).alias("order_included_tax"),
        F.lit(0.0).alias("order_excluded_tax"),
        x.finite_or_zero(F.col("tax_subtotal")).alias("order_tax_subtotal"),
        x.finite_or_zero(F.col("payment_subtotal")).alias("order_payment_subtotal"),
        x.finite_or_zero(F.col("item_surcharge_subtotal")).alias("order_item_surcharge_subtotal"),
        x.finite_or_zero(F.col("trans_surcharge_subtotal")).alias("order_trans_surcharge_subtotal"),
        x.has_invalid_amount(*raw).alias("has_invalid_amount"),
        x.is_amount_outlier(*raw).alias("is_amount_outlier"),
        F.when(F.coalesce("status", F.lit(-1)) == 1, 1).otherwise(0).alias("is_status_completed"),
        F.when(F.col("transaction_voided").isNull(), 0).otherwise(1).alias("is_voided"),
        F.when((F.coalesce("status", F.lit(-1)) == 1) & F.col("transaction_voided").isNull(), 1).otherwise(0).alias("is_completed_proxy"),
    )


#: Newest first; the sequence settles what the rule leaves open.
NEWEST = [F.desc_nulls_last, ("transaction_submitted", "modified", "transaction_created", "order_payment_subtotal", "order_total", "sequence")]


def newest_first(*more: str) -> WindowSpec:
    """The versions of each order and day (and ``more``)."""
    down, keys = NEWEST
    return Window.partitionBy(*D, *more).orderBy(*(down(k) for k in keys))


def orders_status_latest(base: DataFrame) -> DataFrame:
    """The newest version of each order, day and status."""
    return base.withColumn("rank", F.row_number().over(newest_first("order_status"))).where("rank = 1").drop("rank")


def with_status(base: DataFrame, *statuses: int) -> DataFrame:
    """The newest versions of some statuses; the filter comes first, as status is a key of the ranking. Of one status, the rows are
    dealt by order and day alone, as in all that follows."""
    wanted = base.where(F.col("order_status").isin(*statuses))
    if len(statuses) > 1:
        return orders_status_latest(wanted)
    return wanted.withColumn("rank", F.row_number().over(newest_first())).where("rank = 1").drop("rank")


def sales_candidates(base: DataFrame) -> DataFrame:
    return with_status(base, 1)


def void_candidates(base: DataFrame) -> DataFrame:
    return with_status(base, -2)


def excluded_candidates(base: DataFrame) -> DataFrame:
    return with_status(base, -1, 2)


def order_status_presence(base: DataFrame) -> DataFrame:
    """Per order and day: which statuses it has."""
    return base.groupBy(*D).agg(*_presence(F.col("order_status")))


def _presence(status: Column) -> list[Column]:
    names = {1: "has_status_1", 2: "has_status_2", -1: "has_status_minus_1", -2: "has_status_minus_2"}
    return [F.max(F.when(status == k, 1).otherwise(0)).alias(v) for k, v in names.items()]


def order_duplicate_stats(orders: DataFrame, deal: Callable[[DataFrame], DataFrame], presence: bool = False) -> DataFrame:
    """Per order and day: rows and numbers of different values, and with ``presence`` which statuses it has. Few rows share a key, so the distinct
    counts are sizes of sets; these are made where the rows of a key meet, so that plain columns are dealt and not texts and sets."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    money = ["total", "item_subtotal", "discount_subtotal", "surcharge_subtotal", "included_tax_subtotal", "tax_subtotal", "payment_subtotal", "item_surcharge_subtotal"]
    sets = {
        "status_count": F.col("status"), "total_count": F.col("total"), "included_tax_count": F.col("included_tax_subtotal"),
        "financial_count": F.struct(*money), "modified_count": text("modified"), "created_count": text("created"), "submitted_count": text("transaction_submitted"),
    }
    rows = deal(orders.select(
        F.col("id").alias("order_id"), F.col("t_open_date").alias("business_date"), F.coalesce(x.trim_ws(F.col("destination")) == "外送", F.lit(False)).alias("delivery"), F.coalesce("status", F.lit(-1)).alias("status"),
        *(x.safe_milli(F.col(k)).alias(k) for k in money), "modified", "created", "transaction_submitted",
    ))
    return rows.groupBy(*D).agg(
        F.count("*").alias("row_count"),
        F.count_if("delivery").alias("delivery_row_count"),
        *(F.size(F.collect_set(v)).cast("bigint").alias(k) for k, v in sets.items()),
        *(_presence(F.col("status")) if presence else ()),
    )


def duplicate_row_rank(base: DataFrame) -> DataFrame:
    """All rows with their rank and number in their order and day."""
    newest = Window.partitionBy(*D).orderBy(*(F.desc_nulls_last(c) for c in ("transaction_submitted", "modified", "created", "transaction_created", "sequence")))
    return base.withColumn("duplicate_rank", F.row_number().over(newest)).withColumn("duplicate_row_count", F.count("*").over(Window.partitionBy(*D)))
