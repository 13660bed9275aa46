"""Column helpers of the sales jobs. All are built-in functions, so they stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")
#: Largest amount that fits thousandths in a bigint, and the default outlier limit.
MILLI_LIMIT, OUTLIER_LIMIT = 9223372036854775.0, 100000.0

# Rules for the order type, first match wins; names of the types.
ORDER_TYPE_RULES = [("掃碼|qr", 8), ("快一點自取", 6), ("快一點外送", 7), ("熊貓|foodpanda", 2), ("ubereats|uber eats", 5), ("外送", 3), ("自取", 4), ("來店|內用|店內", 1)]
ORDER_TYPES = {0: "unknown", 1: "in_store", 2: "foodpanda", 3: "delivery", 4: "pickup", 5: "ubereats", 6: "quick_pickup", 7: "quick_delivery", 8: "qr_order", 9: "other"}
PAYMENT_TYPES = {0: "unknown_payment", 1: "cash", 2: "card", 3: "e_wallet", 4: "platform_payment", 5: "coupon", 8: "mixed", 9: "other"}
STATUSES = {1: "normal_sales", -2: "void", -1: "cancelled_like", 2: "other_excluded"}
#: First match wins; cards come before the wallets.
PAYMENT_TYPE_RULES = [("^undefined_pay$", 0), ("^cash$", 1), ("card", 2), ("^(linepay|easycard|uupay)$", 3), ("foodpanda|uber eats|ubereats", 4), ("coupon|voucher|gift|禮券|折抵", 5)]
#: Why an order is or isn't allocated, in the order of the tests.
BUCKETS = ["invalid_non_finite_amount", "amount_outlier_over_threshold", "status_not_completed_or_voided", "no_valid_items", "zero_tax_allocation_denominator", "allocatable"]
SPECIAL_PRODUCT = "幣|券|折抵|折扣|點數|贈|服務費|運費|調整|測試"


def trim_ws(c: Column) -> Column:
    """Trims any white space, not only spaces."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def null_if_blank(c: Column) -> Column:
    return F.nullif(trim_ws(c), F.lit(""))


def default_if_blank(c: Column, default: str) -> Column:
    return F.coalesce(null_if_blank(c), F.lit(default))


def has_product(c: Column) -> Column:
    return F.coalesce(trim_ws(c), F.lit("")) != ""


def finite_or_zero(c: Column) -> Column:
    """As double; null, NaN and infinities are 0 (NaN sorts above infinity, so one test does)."""
    d = c.cast("double")
    return F.when(F.abs(d) < INF, d).otherwise(F.lit(0.0))


def positive_or_zero(c: Column) -> Column:
    return F.abs(finite_or_zero(c))


def safe_milli(c: Column) -> Column:
    """Thousandths as bigint; what wouldn't fit is 0."""
    d = finite_or_zero(c)
    return F.round(F.when(F.abs(d) <= MILLI_LIMIT, d).otherwise(F.lit(0.0)) * 1000).cast("bigint")


def to_milli(c: Column) -> Column:
    return F.round(c * 1000).cast("bigint")


def qty_milli(c: Column) -> Column:
    return (F.coalesce(c.try_cast("decimal(20,3)"), F.lit(0).cast("decimal(20,3)")) * 1000).cast("bigint")


def money(c: Column) -> Column:
    """Exact summand: a sum of these doesn't depend on the order of its rows."""
    return c.cast("decimal(18,6)")


def money_sum(c: Column) -> Column:
    return F.sum(money(c)).cast("double")


def hour_of_day(s_hour: Column, ts: Column) -> Column:
    return F.greatest(F.least(F.coalesce(null_if_blank(s_hour).try_cast("int"), F.hour(ts), F.lit(0)), F.lit(23)), F.lit(0))


def first_match(name: Column, rules: list[tuple[str, int]]) -> Column:
    """The number of the first rule that the trimmed name in small letters matches; 0 for a blank one, 9 for none."""
    n = F.lower(F.coalesce(trim_ws(name), F.lit("")))
    out = F.when(n == "", 0)
    for pattern, number in rules:
        out = out.when(n.rlike(pattern), number)
    return out.otherwise(9)


def order_type_id(destination: Column) -> Column:
    return first_match(destination, ORDER_TYPE_RULES)


def payment_type_id(name: Column) -> Column:
    return first_match(name, PAYMENT_TYPE_RULES)


def _code(c: Column, names: dict[int, str], other: str) -> Column:
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for k, v in names.items():
        out = out.when(c == k, v)
    return out.otherwise(other)


def order_type_code(c: Column) -> Column:
    return _code(c, ORDER_TYPES, "other")


def payment_type_code(c: Column) -> Column:
    return _code(c, PAYMENT_TYPES, "other")


def has_invalid_amount(*amounts: Column) -> Column:
    out = F.lit(False)
    for c in amounts:
        out = out | (c.isNotNull() & ~(F.abs(c.cast("double")) < INF))
    return F.when(out, 1).otherwise(0)


def is_amount_outlier(*amounts: Column, limit: float = OUTLIER_LIMIT) -> Column:
    return F.when(F.greatest(*(positive_or_zero(c) for c in amounts)) > limit, 1).otherwise(0)


def item_gross(subtotal: Column, discount: Column, surcharge: Column) -> Column:
    return finite_or_zero(subtotal) + positive_or_zero(discount) - positive_or_zero(surcharge)


def share_of(total: Column, part: Column, whole: Column) -> Column:
    """total * (part / whole); 0 where whole is 0."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(total * (part / F.when(whole != 0, whole)))


def reconciliation_bucket() -> Column:
    tests = [F.col("has_invalid_amount") == 1, F.col("is_amount_outlier") == 1, F.col("is_completed_proxy") == 0, F.col("item_count") <= 0, F.abs("order_net_sales") <= 0.000001]
    return F.coalesce(*(F.when(t, b) for t, b in zip(tests, BUCKETS, strict=False)), F.lit(BUCKETS[-1]))


def financial_signature(*amounts: Column) -> Column:
    return F.concat_ws("|", *(safe_milli(c).cast("string") for c in amounts))


def normalize_name(c: Column) -> Column:
    return F.regexp_replace(F.lower(trim_ws(c)), r"(?U)\s+", " ")


def is_normal_product(name: Column) -> Column:
    return ~name.rlike(SPECIAL_PRODUCT) & ~F.lower(name).like("%test%")


def destination_label(c: Column) -> Column:
    return F.when(F.coalesce(trim_ws(c), F.lit("")) == "", "(blank)").otherwise(trim_ws(c))
