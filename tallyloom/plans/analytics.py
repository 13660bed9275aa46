"""Rankings, mixes and trends on the fact and its dimensions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as x
from ..schemas import MEASURES

c = F.col


def sums(fact: DataFrame, *by: str, measures: tuple[str, ...] = ("qty_milli", "net_sales_milli")) -> DataFrame:
    return fact.groupBy(*by).agg(*(F.sum(m).alias(m) for m in measures))


def with_products(fact: DataFrame, products: DataFrame) -> DataFrame:
    return fact.join(products.select("owner_user_id", "product_no", "product_name", "cate_no", "cate_name", "is_active"), ["owner_user_id", "product_no"])


def allowed(allow: tuple[str, ...] = (), deny: tuple[str, ...] = ()) -> Column:
    """Normal products, those always let in, without those always left out."""
    out = x.is_normal_product(c("product_name"))
    out = out | c("product_no").isin(*allow) if allow else out
    return out & ~c("product_no").isin(*deny) if deny else out


def product_summary(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Quantity and net sales of each product of the dimension, by owner; no product is left out."""
    return sums(with_products(fact, products), "owner_user_id", "product_no", "product_name")


def product_summary_top(fact: DataFrame, products: DataFrame, n: int = 5) -> DataFrame:
    return product_summary(fact, products).orderBy(F.desc_nulls_last("net_sales_milli"), "product_no", "owner_user_id").limit(n)


def product_leaderboard(fact: DataFrame, products: DataFrame, n: int = 5, allow: tuple[str, ...] = (), deny: tuple[str, ...] = ()) -> DataFrame:
    named = with_products(fact, products).where(c("is_active") & allowed(allow, deny))
    return sums(named, "owner_user_id", "product_no", "product_name").orderBy(F.desc("net_sales_milli"), F.desc("qty_milli"), "product_no").limit(n)


def excluded_products_audit(fact: DataFrame, products: DataFrame, allow: tuple[str, ...] = (), deny: tuple[str, ...] = ()) -> DataFrame:
    return sums(with_products(fact, products).where(~(c("is_active") & allowed(allow, deny))), "owner_user_id", "product_no", "product_name")


def top(fact: DataFrame, key: str, measure: str, n: int = 5) -> DataFrame:
    """The n keys of largest sums of a measure (ties: smaller key), with all measures."""
    return sums(fact, key, measures=tuple(MEASURES)).orderBy(F.desc_nulls_last(measure), key).limit(n)


def top_branches(fact: DataFrame, branches: DataFrame, measure: str, n: int = 5) -> DataFrame:
    """The branches of largest sums of a measure, with their names."""
    return top(fact, "branch_id", measure, n).join(branches.select("branch_id", "branch_name"), "branch_id", "left")


def with_code(by: DataFrame, key: str) -> DataFrame:
    """Sums by type with the type's code."""
    name = {"order_type_id": x.order_type_code, "payment_type_id": x.payment_type_code}[key]
    return by.withColumn("code", name(c(key)))


def mix(fact: DataFrame, key: str) -> DataFrame:
    """Sums by key with their share of the net sales of all."""
    by = sums(fact, key)
    whole = F.sum("net_sales_milli").over(Window.partitionBy())  # over one row for each key
    return by.withColumn("net_share", F.when(whole != 0, c("net_sales_milli").cast("double") / whole.cast("double")))


def share_of_sales(fact: DataFrame, key: str) -> DataFrame:
    by = sums(fact, "owner_user_id", key, measures=("net_sales_milli",))
    whole = by.groupBy("owner_user_id").agg(F.sum("net_sales_milli").alias("whole"))
    return by.join(whole, "owner_user_id").select("owner_user_id", key, "net_sales_milli", F.when(c("whole") != 0, c("net_sales_milli").cast("double") / c("whole").cast("double")).alias("share"))


#: The sums that reports want, by report; and those of which the largest are ranked, by which measures.
SETS = {
    "products": ("product_no",), "branches": ("branch_id",), "hours": ("hour_of_day",), "branch_hours": ("branch_id", "hour_of_day"), "product_hours": ("product_no", "hour_of_day"),
    "order_types": ("order_type_id",), "payment_types": ("payment_type_id",), "days": ("business_date",), "product_branches": ("product_no", "branch_id"),
}
RANKED = {"products": ("qty_milli", "gross_sales_milli", "net_sales_milli", "sales_ex_tax_milli"), "branches": ("net_sales_milli", "qty_milli", "tax_milli", "discount_milli", "surcharge_milli")}


def all_sums(fact: DataFrame) -> DataFrame:
    """owner_user_id, report, key_1, key_2 and all measures, for each of ``SETS`` and the whole (report ``all``): one reading of the fact, by
    grouping sets, summed before it is shuffled."""
    keys = ["owner_user_id", "business_date", "hour_of_day", "branch_id", "product_no", "order_type_id", "payment_type_id"]
    of = {"all": (), **SETS}
    grouped = fact.groupingSets([[c("owner_user_id"), *(c(k) for k in own)] for own in of.values()], *keys)
    made = grouped.agg(F.grouping_id(*keys).alias("g"), *(F.sum(m).alias(m) for m in MEASURES))
    number = {sum(0 if k in ("owner_user_id", *own) else 1 << (len(keys) - 1 - i) for i, k in enumerate(keys)): name for name, own in of.items()}
    text = lambda n: F.coalesce(*(F.when(c("g") == g, c(of[name][n]).cast("string")) for g, name in number.items() if len(of[name]) > n))
    report = F.coalesce(*(F.when(c("g") == g, name) for g, name in number.items()))
    return made.select("owner_user_id", report.alias("report"), text(0).alias("key_1"), text(1).alias("key_2"), *MEASURES)


def in_one_pass(fact: DataFrame, write: Callable[[DataFrame], DataFrame], n: int = 5) -> DataFrame:
    """All mixes, shares, trends and rankings at once: each sum of ``all_sums`` with its share of the owner's net sales (measure ``all``), and
    the n largest of each measure in ``RANKED`` with their rank. The fact is read once; ``write`` keeps the sums. The limit stands
    in the ranking, so tasks send n rows of each report and measure."""
    every = write(all_sums(fact))
    whole = every.where("report = 'all'").select("owner_user_id", c("net_sales_milli").alias("whole"))
    rows = every.where("report <> 'all'").join(whole, "owner_user_id")
    rows = rows.withColumn("net_share", F.when(c("whole") != 0, c("net_sales_milli").cast("double") / c("whole").cast("double")))
    values = F.coalesce(*(F.when(c("report") == r, F.array(*(F.struct(F.lit(m).alias("measure"), c(m).alias("value")) for m in ms))) for r, ms in RANKED.items()))
    ranked = rows.withColumn("by", F.explode(values)).withColumn("measure", c("by.measure"))
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("owner_user_id", "report", "measure").orderBy(F.desc("by.value"), "key_1"))).where(c("rank") <= n)
    columns = ["owner_user_id", "report", "measure", "rank", "key_1", "key_2", "qty_milli", "net_sales_milli", "net_share"]
    return rows.withColumns({"measure": F.lit("all"), "rank": F.lit(None).cast("int")}).select(*columns).union(ranked.select(*columns))
