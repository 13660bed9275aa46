"""From orders, items, additions and payments to allocated lines and the hourly fact.

Every join and order-level group has the keys (order_id, business_date), so one run over many days equals as many
one-day runs. The flow over the newest sales reads and shuffles each source once, by those keys: an order's totals are sums over
its lines in place, not a join with a summary. Money is summed as decimals and divided as doubles.
"""

from __future__ import annotations

import copy
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as x
from ..schemas import D, GRAIN, MEASURES
from ..sources.readers import Sources, parts_for
from .orders import excluded_candidates, orders_base, sales_candidates

LINE = [*D, "hour_of_day", "branch_id", "product_no", "order_type_id"]


NAMES = ["product_name", "cate_no", "cate_name"]


def clean_variant() -> list[Column]:
    """An item's names, as the product dimension has them."""
    return [x.default_if_blank(F.col("product_name"), "UNKNOWN_PRODUCT_NAME").alias("product_name"), x.null_if_blank(F.col("cate_no")).alias("cate_no"), x.null_if_blank(F.col("cate_name")).alias("cate_name")]


def clean_items(items: DataFrame, *more: Column) -> DataFrame:
    """Items with a product number: keys, quantity in thousandths, exact money, and columns ``more``."""
    return items.where(x.has_product(F.col("product_no"))).select(
        "order_id", F.col("t_open_date").alias("business_date"), x.default_if_blank(F.col("product_no"), "UNKNOWN_PRODUCT").alias("product_no"),
        x.qty_milli(F.col("current_qty")).alias("qty"),
        x.money(x.finite_or_zero(F.col("current_subtotal"))).alias("net"), x.money(x.positive_or_zero(F.col("current_discount"))).alias("discount"),
        x.money(x.positive_or_zero(F.col("current_surcharge"))).alias("surcharge"), *more,
    )


SUMMED = {"qty_milli": "qty", "item_net": "net", "item_discount": "discount", "item_surcharge": "surcharge"}


def _line_sums() -> list[Column]:
    return [F.sum(v).alias(k) for k, v in SUMMED.items()]


def _gross() -> Column:
    return F.col("item_net") + F.col("item_discount") - F.col("item_surcharge")


def item_lines(orders: DataFrame, items: DataFrame, deal: Deal = lambda df: df) -> DataFrame:
    """Items of the orders by product; items without a product number are left out. ``orders`` may repeat a key."""
    joined = orders.select(*D, "hour_of_day", "branch_id", "order_type_id").join(deal(clean_items(items)), D)
    return joined.groupBy(*LINE).agg(*_line_sums()).withColumn("item_gross", _gross())


def order_item_totals(lines: DataFrame) -> DataFrame:
    return lines.groupBy(*D).agg(F.count("*").alias("item_count"), *(F.sum(f"item_{c}").alias(f"sum_{c}") for c in ("gross", "discount", "surcharge", "net")))


def order_additions_totals(additions: DataFrame, deal: Deal = lambda df: df) -> DataFrame:
    total = lambda c: F.sum(x.money(x.positive_or_zero(F.col(c))))
    return deal(additions.withColumnRenamed("t_open_date", "business_date")).groupBy(*D).agg(
        total("current_discount").alias("addition_discount"), total("current_surcharge").alias("addition_surcharge"), total("include_tax").alias("addition_include_tax")
    )


#: Deals rows by order and day.
Deal = Callable[[DataFrame], DataFrame]


def by_order(df: DataFrame) -> DataFrame:
    return df.repartition(*D)


def payment_groups(payments: DataFrame, deal: Deal = by_order) -> DataFrame:
    """Amounts by order and type. Dealt by order only (an order has few payments), so what follows by order needs no other shuffle."""
    named = payments.select("order_id", F.col("t_open_date").alias("business_date"), x.payment_type_id(F.col("name")).alias("payment_type_id"), x.finite_or_zero(F.col("amount")).alias("amount"))
    return deal(named).groupBy(*D, "payment_type_id").agg(x.money_sum(F.col("amount")).alias("payment_amount"))


def payment_summary(payments: DataFrame, deal: Deal = by_order) -> DataFrame:
    """The payment type of each order: 0 without a known one that counts, itself if one, else 8. Of one, the type of the
    largest amount of all groups is taken (ties: the larger type)."""
    real = F.count_if((F.abs("payment_amount") > 0.0001) & (F.col("payment_type_id") != 0))
    return payment_groups(payments, deal).groupBy(*D).agg(real.alias("n"), F.max_by("payment_type_id", F.struct(F.abs("payment_amount").alias("a"), "payment_type_id")).alias("best")).select(
        *D, F.when(F.col("n") == 0, 0).when(F.col("n") == 1, F.col("best")).otherwise(8).alias("payment_type_id")
    )


TOTALS = ["sum_gross", "sum_discount", "sum_surcharge", "sum_net"]


def financial_columns(joined: DataFrame, *keep: str | Column) -> DataFrame:
    """``keep`` and the money of an order, from the totals of its items and additions (0 where it has none)."""
    double = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    exact = lambda c: F.coalesce(F.col(c), F.lit(0).cast("decimal(18,6)"))
    return joined.select(
        *keep, F.coalesce("item_count", F.lit(0)).alias("item_count"),
        double("sum_gross").alias("order_gross_sales"), double("sum_net").alias("order_item_net_sales"),
        double("addition_discount").alias("addition_discount_total"), double("addition_surcharge").alias("addition_surcharge_total"), double("addition_include_tax").alias("addition_include_tax_total"),
        (exact("sum_discount") + exact("addition_discount")).cast("double").alias("order_discount_total"),
        (exact("sum_surcharge") + exact("addition_surcharge")).cast("double").alias("order_surcharge_total"),
        (exact("sum_gross") - exact("sum_discount") - exact("addition_discount") + exact("sum_surcharge") + exact("addition_surcharge")).cast("double").alias("order_net_sales"),
    ).withColumn("order_sales_ex_tax", F.col("order_net_sales") - (F.col("order_included_tax") + F.col("order_excluded_tax")))


def order_financials(orders: DataFrame, lines: DataFrame, additions: DataFrame, deal: Deal = lambda df: df) -> DataFrame:
    """One row for each row of ``orders``, with the totals of its items and additions. ``orders`` may repeat a key."""
    joined = orders.join(order_item_totals(lines), D, "left").join(order_additions_totals(additions, deal), D, "left")
    return financial_columns(joined, *orders.columns)


def order_flow(orders: DataFrame, items: DataFrame, additions: DataFrame, payments: DataFrame, deal: Deal = by_order, variants: bool = False) -> DataFrame:
    """A row for each line of ``orders`` (one row a key), or one without product for an order that has none: the order's columns and
    money, its payment type, and the line's sums as item_... What a step doesn't use is pruned from the sources. With ``variants``
    there is a row for each item with its names; the first of a line (one_of_line) has the line's sums, the others none."""
    others = [k for k in orders.columns if k not in LINE]
    # an order has one row, so its lines are summed before they meet it, and what meets stays sorted for the sums over an order
    named = []
    if variants:
        named = [*NAMES, "one_of_line"]
        of_line = Window.partitionBy(*D, "product_no").orderBy("product_no")
        whole = of_line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        every = deal(clean_items(items, *clean_variant())).withColumns({"one_of_line": F.row_number().over(of_line) == 1, **{k: F.sum(v).over(whole) for k, v in SUMMED.items()}})
        sums = every.select(*D, "product_no", *named, *(F.when(F.col("one_of_line"), F.col(k)).alias(k) for k in SUMMED)).withColumn("item_gross", _gross())
    else:
        sums = deal(clean_items(items)).groupBy(*D, "product_no").agg(*_line_sums()).withColumn("item_gross", _gross())
    lines = orders.join(sums, D, "left")
    of_order = Window.partitionBy(*D)
    sums = {f"sum_{k}": F.sum(f"item_{k}").over(of_order) for k in ("gross", "discount", "surcharge", "net")}
    counted = F.when(F.col("one_of_line"), F.col("product_no")) if variants else F.col("product_no")
    lines = lines.withColumns({"item_count": F.count(counted).over(of_order), **sums})
    joined = lines.join(order_additions_totals(additions, deal), D, "left").join(payment_summary(payments, deal), D, "left").withColumn("payment_type_id", F.coalesce("payment_type_id", F.lit(0)))
    return financial_columns(joined, *LINE, *others, "payment_type_id", "qty_milli", *ITEM, *named)


ITEM = ["item_gross", "item_net", "item_discount", "item_surcharge"]
ORDER_MONEY = ["order_included_tax", "order_excluded_tax", "order_gross_sales", "order_net_sales", "addition_discount_total", "addition_surcharge_total"]


def line_enriched(lines: DataFrame, financials: DataFrame, payments: DataFrame, deal: Deal = by_order) -> DataFrame:
    """Lines with the money of their orders; ``financials`` may repeat a key, which repeats its lines."""
    return (
        lines.withColumns({k: F.col(k).cast("double") for k in ITEM})
        .join(financials.select(*D, *ORDER_MONEY), D)
        .join(payment_summary(payments, deal), D, "left")
        .withColumn("payment_type_id", F.coalesce("payment_type_id", F.lit(0)))
    )


def line_allocations(enriched: DataFrame, *keep: str) -> DataFrame:
    """Each line's measures in thousandths, with the columns ``keep``. Rounded by line; what follows is whole-number addition."""
    c = F.col
    discount = c("item_discount") + x.share_of(c("addition_discount_total"), c("item_gross"), c("order_gross_sales"))
    surcharge = c("item_surcharge") + x.share_of(c("addition_surcharge_total"), c("item_gross"), c("order_gross_sales"))
    parts = enriched.select(
        *LINE, "payment_type_id", *keep, "qty_milli", x.to_milli(c("item_gross")).alias("gross_sales_milli"), x.to_milli(discount).alias("discount_milli"), x.to_milli(surcharge).alias("surcharge_milli"),
        *(x.to_milli(x.share_of(c(f"order_{k}_tax"), c("item_gross") - discount + surcharge, c("order_net_sales"))).alias(f"{k}_tax_milli") for k in ("included", "excluded")),
    )
    return parts.withColumns(made_of())


#: Measures that the others are made of.
BASIC = ["qty_milli", "gross_sales_milli", "discount_milli", "surcharge_milli", "included_tax_milli", "excluded_tax_milli"]


def made_of(of: str = "") -> dict[str, Column]:
    """The other measures, which are sums and differences of the basic ones; of allocated_..., say, if ``of`` stands before their names."""
    c = lambda k: F.col(f"{of}{k}_milli")
    net, tax = c("gross_sales") - c("discount") + c("surcharge"), c("included_tax") + c("excluded_tax")
    return {f"{of}net_sales_milli": net, f"{of}tax_milli": tax, f"{of}sales_ex_tax_milli": net - tax}


def repeated_flow(orders: DataFrame, items: DataFrame, additions: DataFrame, payments: DataFrame, deal: Deal = by_order, *keep: str) -> DataFrame:
    """A row for each line and row of its order, where rows of one key repeat each other's lines: what ``line_enriched`` makes of
    ``item_lines`` and ``order_financials``, with the columns ``keep`` of the order's row. Each source is dealt once: the rows of a key, of which
    there are few, meet its items as an array. Orders without lines have no row."""
    place = [k for k in LINE if k not in (*D, "product_no")]
    tax = ["order_included_tax", "order_excluded_tax"]
    of = list(dict.fromkeys((*tax, *keep)))
    at = lambda r: F.struct(*(r[k].alias(k) for k in place))
    every = deal(orders.select(*D, *place, *of)).groupBy(*D).agg(F.collect_list(F.struct(*place, *of)).alias("every"))
    sums = deal(clean_items(items)).groupBy(*D, "product_no").agg(*_line_sums())
    lines = every.join(sums, D).withColumn("at", F.explode(F.array_distinct(F.transform("every", at))))
    # rows of one place repeat its lines
    times = F.size(F.filter("every", lambda r: at(r).eqNullSafe(F.col("at"))))
    lines = lines.withColumns({k: (F.col(k) * times).cast(sums.schema[k].dataType) for k in SUMMED}).withColumn("item_gross", _gross())
    of_order = Window.partitionBy(*D)
    lines = lines.withColumns({"item_count": F.count("*").over(of_order), **{f"sum_{k}": F.sum(f"item_{k}").over(of_order) for k in ("gross", "discount", "surcharge", "net")}})
    joined = lines.join(order_additions_totals(additions, deal), D, "left").join(payment_summary(payments, deal), D, "left").withColumn("payment_type_id", F.coalesce("payment_type_id", F.lit(0)))
    names = [k for k in joined.columns if k not in ("every", "at")]
    rows = joined.select(*names, *(F.col(f"at.{k}").alias(k) for k in place), F.explode("every").alias("row")).select(*names, *place, *(F.col(f"row.{k}").alias(k) for k in of))
    return financial_columns(rows, *LINE, *of, "payment_type_id", "qty_milli", *(F.col(k).cast("double").alias(k) for k in ITEM))


def order_allocation_summary(allocations: DataFrame) -> DataFrame:
    return allocations.groupBy(*D).agg(*(F.sum(m).alias(m) for m in MEASURES), F.count("*").alias("allocation_row_count"))


class Chain:
    """The steps over one set of sources, each built once. dedup: over the newest sales; else over all rows of orders, where rows of
    one key repeat each other's lines. dealt: the sources are bucketed by order (``readers.bucketed``). Else each source is dealt by order into as many ``parts`` as its files ask for, or
    as given."""

    def __init__(self, src: Sources, dedup: bool = True, dealt: bool = False, parts: int | None = None):
        self.src, self.dedup = src, dedup
        self.parts = 0 if dealt else parts or parts_for(src)
        if self.parts and not dedup:  # where two dealt sides meet directly, Spark raises their parts to its own number, and would deal others again
            self.parts = max(self.parts, int(src.orders.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        self.kept: dict[str, DataFrame] = {}
        self.base = orders_base(src.orders)
        self.orders = sales_candidates(self.deal(self.base)) if dedup else self.base
        if dedup:
            self.flow = order_flow(self.orders, src.items, src.additions, src.payments, self.deal)
            self._after_flow()
        else:
            orders = self.deal(self.base)
            self.lines = item_lines(orders, src.items, self.deal)
            self.financials = order_financials(orders, self.lines, src.additions, self.deal)
            self.enriched = self._repeated().select(*LINE, "payment_type_id", "qty_milli", *ITEM, *ORDER_MONEY)
            self.allocations = line_allocations(self.enriched)
            self.summary = order_allocation_summary(self.allocations)

    def deal(self, df: DataFrame) -> DataFrame:
        """Rows dealt by order and day, as all steps by order need them."""
        return df.repartition(self.parts, *D) if self.parts else df

    def _repeated(self, *keep: str) -> DataFrame:
        return repeated_flow(self.base, self.src.items, self.src.additions, self.src.payments, self.deal, *keep)

    def given(self, *keep: str) -> DataFrame:
        """The allocated lines, each with the columns ``keep`` of its order's row."""
        if not self.dedup:
            named = [k for k in keep if k in self.base.columns]
            return line_allocations(self._repeated(*named), *keep)
        return line_allocations(self.flow.where("product_no is not null").withColumns({k: F.col(k).cast("double") for k in ITEM}), *keep)

    def excluded(self) -> DataFrame:
        """The newest version of each order of an excluded status."""
        return self.kept["excluded"] if "excluded" in self.kept else excluded_candidates(self.base)

    def _after_flow(self) -> None:
        sold = self.flow.where("product_no is not null")
        self.lines = sold.select(*LINE, "qty_milli", *ITEM)
        self.enriched = sold.select(*LINE, "payment_type_id", "qty_milli", *(F.col(k).cast("double").alias(k) for k in ITEM), *ORDER_MONEY)
        self.allocations = line_allocations(self.enriched)
        self.summary = order_allocation_summary(self.allocations)
        self.financials = self._by_order().select(*self._order_columns())

    def keep_flow(self, write: Callable[[DataFrame, str], DataFrame]) -> None:
        """Has the flow written once (``write`` gives it back), so that all that follows reads it."""
        self.flow = write(self.flow, "flow")
        self._after_flow()

    def _order_columns(self) -> list[str]:
        money = [k for k in self.flow.columns if k not in (*LINE, *ITEM, "payment_type_id", "qty_milli")]
        return [*D, *(k for k in LINE if k not in (*D, "product_no")), *money]

    def _by_order(self) -> DataFrame:
        """The flow by order: its columns, and what its lines were given."""
        if "by_order" in self.kept:
            return self.kept["by_order"]
        keep = [k for k in self._order_columns() if k not in LINE]
        lines = line_allocations(self.flow.withColumns({k: F.col(k).cast("double") for k in ITEM}), *keep)
        once = [F.first(k).alias(k) for k in self._order_columns() if k not in D]
        given = [F.sum(m).alias(f"allocated_{m}") for m in MEASURES]
        return lines.groupBy(*D).agg(*once, *given, F.when(F.count("product_no") > 0, 1).otherwise(0).alias("appears_in_preview_allocation"))

    def keep_lines(self, write: Callable[[DataFrame, str], DataFrame]) -> None:
        """Has the allocated lines written once (``write`` gives them back)."""
        self.allocations = write(self.allocations, "lines")
        self.summary = order_allocation_summary(self.allocations)

    def written_once(self, write: Callable[[DataFrame, str], DataFrame]) -> Chain:
        """This chain with its lines written once (``write`` gives them back), for a job that needs more than the fact: over the newest sales, the orders
        and the names of the items sold are read from the written lines too. This chain itself doesn't change."""
        run = copy.copy(self)
        run.kept = {}
        if not self.dedup:
            run.keep_lines(write)
            return run
        flow = order_flow(self.orders, self.src.items, self.src.additions, self.src.payments, self.deal, variants=True)
        first = F.col("product_no").eqNullSafe(F.min("product_no").over(Window.partitionBy(*D))) & F.coalesce("one_of_line", F.lit(True))
        flow = flow.withColumns({"one_of_order": first, **{k: F.col(k).cast("double") for k in ITEM}})
        lines = write(line_allocations(flow, "order_status", "one_of_order", "one_of_line", *NAMES), "lines")
        sold = lines.where("one_of_line")
        run.orders = lines.where("one_of_order").select(*D, "order_status")
        run.allocations = sold.select(*LINE, "payment_type_id", *MEASURES)
        run.summary = order_allocation_summary(run.allocations)
        run.kept["variants"] = lines.where("product_no is not null").select("business_date", "product_no", *NAMES)
        return run

    def keep(self, write: Callable[[DataFrame, str], DataFrame], columns: list[str] | None = None, fact: bool = True) -> None:
        """Has scope and fact written once (``write`` gives them back), so that many reports share them. The chain over the newest sales runs once: it
        leaves its lines, of which one of each order has the order's own columns too; of these only ``columns``, if given. Without ``fact`` that
        isn't written: what is asked of it is made of the lines."""
        if self.dedup:
            kept = [k for k in self._order_columns() if k in LINE or columns is None or k in columns]
            columns = [k for k in self.financials.columns if k in kept]
            keep = [k for k in kept if k not in LINE]
            lines = line_allocations(self.flow.withColumns({k: F.col(k).cast("double") for k in ITEM}), *keep)
            over = Window.partitionBy(*D)
            given = {f"allocated_{m}": F.sum(m).over(over) for m in BASIC}
            seen = {"appears_in_preview_allocation": F.when(F.count("product_no").over(over) > 0, 1).otherwise(0), "one_of_order": F.col("product_no").eqNullSafe(F.min("product_no").over(over))}
            lines = lines.withColumns(given | seen)
            once = [*keep, *given, "appears_in_preview_allocation"]
            lines = write(lines.select(*LINE, "payment_type_id", *BASIC, "one_of_order", *(F.when(F.col("one_of_order"), F.col(k)).alias(k) for k in once)), "lines")
            self.kept["by_order"] = lines.where("one_of_order").select(*kept, *given, "appears_in_preview_allocation").withColumns(made_of("allocated_"))
            self.allocations = lines.where("product_no is not null").withColumns(made_of()).select(*LINE, "payment_type_id", *MEASURES)
            self.summary = order_allocation_summary(self.allocations)
            self.financials = self.kept["by_order"].select(*columns)
        self.kept["scope"] = self.scope() if self.dedup else write(self.scope(), "scope")
        if fact:
            self.kept["fact"] = write(self.fact(), "fact")
        if not self.dedup:
            self.financials = self.kept["scope"].select(*self.financials.columns)

    def scope(self) -> DataFrame:
        """One row for each order row: its source totals beside what was allocated."""
        if "scope" in self.kept:
            return self.kept["scope"]
        c = F.col
        source = {"gross_sales": "order_gross_sales", "discount": "order_discount_total", "surcharge": "order_surcharge_total", "net_sales": "order_net_sales", "included_tax": "order_included_tax", "sales_ex_tax": "order_sales_ex_tax"}
        if self.dedup:
            joined = self._by_order()
        else:
            given = self.summary.select(*D, *(c(m).alias(f"allocated_{m}") for m in MEASURES), F.lit(1).alias("appears_in_preview_allocation"))
            joined = self.financials.join(given, D, "left")
        return joined.select(
            *self.financials.columns,
            F.when(c("item_count") > 0, 1).otherwise(0).alias("has_valid_items"),
            F.when(F.abs("order_net_sales") > 0.000001, 1).otherwise(0).alias("has_tax_allocation_denominator"),
            *(x.to_milli(c(v)).alias(f"source_{k}_milli") for k, v in source.items()),
            x.to_milli(c("addition_include_tax_total")).alias("addition_include_tax_milli"),
            x.to_milli(c("order_net_sales")).alias("allocation_denominator_milli"),
            *(F.coalesce(f"allocated_{m}", F.lit(0)).alias(f"allocated_{m}") for m in MEASURES),
            F.coalesce("appears_in_preview_allocation", F.lit(0)).alias("appears_in_preview_allocation"),
            x.reconciliation_bucket().alias("reconciliation_bucket"),
        )

    def fact(self, owner: int = 1) -> DataFrame:
        if "fact" in self.kept:
            return self.kept["fact"].withColumn("owner_user_id", F.lit(owner).cast("bigint"))
        return hourly_fact(self.allocations, owner)

    def count_groups(self, make: Callable[[DataFrame], DataFrame]) -> None:
        """Has the groups of the fact counted once by day (``make`` gives the few rows back). Groups are told by their keys, so no measure is shuffled."""
        self.kept["groups"] = make(self.allocations.select(*GRAIN[1:]).distinct().groupBy("business_date").agg(F.count("*").alias("groups")))

    def totals(self) -> DataFrame:
        """One row: the number of the fact's groups, and the sums of its measures, which are those of the lines."""
        sums = [F.coalesce(F.sum(m), F.lit(0)).alias(f"preview_{m}") for m in MEASURES]
        if "groups" not in self.kept:
            return self.fact().agg(F.count("*").alias("preview_group_count"), *sums)
        return self.kept["groups"].agg(F.coalesce(F.sum("groups"), F.lit(0)).alias("preview_group_count")).crossJoin(self.allocations.agg(*sums))

    def first_groups(self, n: int) -> DataFrame:
        """The first n rows of the fact by its grain. Where its groups are counted, only the first days that have so many are summed."""
        fact, seen = self.fact(), 0
        for day, groups in sorted(self.kept["groups"].collect()) if "groups" in self.kept else []:
            seen += groups
            if seen >= n:
                fact = fact.where(F.col("business_date") <= F.lit(day))
                break
        return fact.orderBy(*GRAIN[1:]).limit(n)


def hourly_fact(allocations: DataFrame, owner: int = 1) -> DataFrame:
    """The lines summed to the fact's grain."""
    keyed = allocations.withColumn("owner_user_id", F.lit(owner).cast("bigint"))
    short = {k: F.col(k).cast("smallint") for k in ("hour_of_day", "order_type_id", "payment_type_id")}
    return keyed.groupBy(*GRAIN).agg(*(F.sum(m).cast("bigint").alias(m) for m in MEASURES)).withColumns(short)
