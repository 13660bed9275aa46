"""The same chain as DuckDB SQL text, for checking results: ``sql(select)`` puts the steps before a last SELECT."""

from __future__ import annotations

from ..functions import exprs as x
from ..schemas import MEASURES
from ..sources.pos_adapter import CTES

FINITE = "CASE WHEN abs({c}) < cast('Infinity' AS double) THEN cast({c} AS double) ELSE cast(0 AS double) END"
AMOUNTS = ["total", "item_subtotal", "discount_subtotal", "surcharge_subtotal", "included_tax_subtotal"]


def fin(c: str) -> str:
    return f"({FINITE.format(c=c)})"


def pos(c: str) -> str:
    return f"abs({fin(c)})"


def dec(e: str) -> str:
    return f"cast({e} AS decimal(18,6))"


def blank(c: str, default: str) -> str:
    return f"coalesce(nullif(trim({c}), ''), '{default}')"


def milli(e: str) -> str:
    return f"cast(round(({e}) * 1000) AS bigint)"


def names(c: str, of: dict[int, str]) -> str:
    """The text of each code."""
    return "CASE " + c + " " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in of.items()) + " END"


def first_match(c: str, blank_: int, rules: list[tuple[str, int]], other: int) -> str:
    """The number of the first of ``rules`` (pattern, number) that a name in small letters matches."""
    text = f"lower(trim(coalesce({c}, '')))"
    return f"CASE WHEN {text} = '' THEN {blank_} " + " ".join(f"WHEN regexp_matches({text}, '{p}') THEN {n}" for p, n in rules) + f" ELSE {other} END"


PAYMENT, DESTINATION = first_match("name", 0, x.PAYMENT_TYPE_RULES, 9), first_match("destination", 0, x.ORDER_TYPE_RULES, 9)

# Fixed rule: the hour as written, else of the order's time, else 0; kept within 0 and 23.
HOUR = "greatest(least(coalesce(try_cast(nullif(trim(s_hour), '') AS integer), hour(transaction_created), 0), 23), 0)"

CLEAN = {  # the columns of an order version
    "order_id": "id",
    "business_date": "t_open_date",
    "hour_of_day": HOUR,
    "branch_id": blank("branch_id", "UNKNOWN_BRANCH"),
    "branch_name": blank("branch", "UNKNOWN_BRANCH_NAME"),
    "branch_raw": "coalesce(trim(branch), '')",
    "destination_raw": "coalesce(trim(destination), '')",
    "order_type_id": DESTINATION,
    "order_status": "coalesce(status, -1)",
    **{k: k for k in ("transaction_created", "transaction_submitted", "transaction_voided", "created", "modified", "sequence", "void_sale_period", "sale_period", "shift_number")},
    **{f"order_{k}": fin(v) for k, v in {"total": "total", "item_subtotal": "item_subtotal", "included_tax": "included_tax_subtotal", "tax_subtotal": "tax_subtotal", "payment_subtotal": "payment_subtotal"}.items()},
    **{f"order_{k}": pos(k) for k in ("discount_subtotal", "surcharge_subtotal", "item_surcharge_subtotal", "trans_surcharge_subtotal")},
    "has_invalid_amount": f"cast(list_bool_or([NOT coalesce(abs(v) < cast('Infinity' AS double), true) FOR v IN [{', '.join(AMOUNTS)}]]) AS integer)",
    "is_amount_outlier": f"cast(list_max([{', '.join(pos(k) for k in AMOUNTS)}]) > 100000 AS integer)",
    "is_voided": "cast(transaction_voided IS NOT NULL AS integer)",
    "is_completed_proxy": "cast(coalesce(status, -1) = 1 AND transaction_voided IS NULL AS integer)",
}
_BASE = f"""ob AS (SELECT {", ".join(f"{v} AS {k}" for k, v in CLEAN.items())} FROM pos_orders),
latest AS (SELECT * FROM ob QUALIFY row_number() OVER (PARTITION BY order_id, business_date, order_status ORDER BY transaction_submitted DESC NULLS LAST, modified DESC NULLS LAST,
 transaction_created DESC NULLS LAST, order_payment_subtotal DESC NULLS LAST, order_total DESC NULLS LAST, sequence DESC NULLS LAST) = 1),
adds AS (SELECT order_id, t_open_date AS business_date, sum({dec(pos("current_discount"))}) AS ad, sum({dec(pos("current_surcharge"))}) AS asur, sum({dec(pos("include_tax"))}) AS atax FROM pos_additions GROUP BY 1, 2),
pay AS (SELECT order_id, t_open_date AS business_date, {PAYMENT} AS ptype, cast(sum({dec(fin("amount"))}) AS double) AS amount FROM pos_payments GROUP BY 1, 2, 3),
paid AS (SELECT order_id, business_date, CASE count(*) FILTER (abs(amount) > 0.0001 AND ptype <> 0) WHEN 0 THEN 0 WHEN 1 THEN (list(ptype ORDER BY abs(amount) DESC, ptype DESC))[1] ELSE 8 END AS payment_type_id FROM pay GROUP BY 1, 2)"""


_tests = ["has_invalid_amount = 1", "is_amount_outlier = 1", "is_completed_proxy = 0", "item_count <= 0", "abs(order_net_sales) <= 0.000001"]
BUCKET = "coalesce(" + ", ".join(f"CASE WHEN {t} THEN '{b}' END" for t, b in zip(_tests, x.BUCKETS, strict=False)) + f", '{x.BUCKETS[-1]}')"


def chain(tag: str, orders: str) -> str:
    """The steps after the choice of orders; names end in ``tag``."""
    disc = "item_discount + CASE WHEN order_gross_sales = 0 THEN cast(0 AS double) ELSE addition_discount_total * (item_gross / order_gross_sales) END"
    sur = "item_surcharge + CASE WHEN order_gross_sales = 0 THEN cast(0 AS double) ELSE addition_surcharge_total * (item_gross / order_gross_sales) END"
    sums = ", ".join(f"cast(sum({m}) AS bigint) AS {m}" for m in MEASURES)
    return f""",
od{tag} AS ({orders}),
il0{tag} AS (SELECT o.order_id, o.business_date, o.hour_of_day, o.branch_id, trim(i.product_no) AS product_no, o.order_type_id,
 sum(cast(cast(i.current_qty AS decimal(20,3)) * 1000 AS bigint)) AS qty_milli, sum({dec(fin("i.current_subtotal"))}) AS net, sum({dec(pos("i.current_discount"))}) AS disc, sum({dec(pos("i.current_surcharge"))}) AS sur
 FROM od{tag} o JOIN pos_items i ON i.order_id = o.order_id AND i.t_open_date = o.business_date WHERE trim(coalesce(i.product_no, '')) <> '' GROUP BY 1, 2, 3, 4, 5, 6),
oit{tag} AS (SELECT order_id, business_date, count(*) AS n, sum(net + disc - sur) AS g, sum(disc) AS d, sum(sur) AS s FROM il0{tag} GROUP BY 1, 2),
fi0{tag} AS (SELECT o.*, coalesce(t.n, 0) AS item_count, coalesce(t.g, 0) AS g, coalesce(t.d, 0) AS d, coalesce(t.s, 0) AS s, coalesce(a.ad, 0) AS ad, coalesce(a.asur, 0) AS asur, coalesce(a.atax, 0) AS atax
 FROM od{tag} o LEFT JOIN oit{tag} t USING (order_id, business_date) LEFT JOIN adds a USING (order_id, business_date)),
fi{tag} AS (SELECT *, cast(g AS double) AS order_gross_sales, cast(ad AS double) AS addition_discount_total, cast(asur AS double) AS addition_surcharge_total, cast(atax AS double) AS addition_include_tax_total,
 cast(d + ad AS double) AS order_discount_total, cast(s + asur AS double) AS order_surcharge_total, cast(g - d - ad + s + asur AS double) AS order_net_sales FROM fi0{tag}),
en{tag} AS (SELECT l.order_id, l.business_date, l.hour_of_day, l.branch_id, l.product_no, l.order_type_id, coalesce(p.payment_type_id, 0) AS payment_type_id, l.qty_milli,
 cast(l.net + l.disc - l.sur AS double) AS item_gross, cast(l.net AS double) AS item_net, cast(l.disc AS double) AS item_discount, cast(l.sur AS double) AS item_surcharge,
 f.order_included_tax, f.order_gross_sales, f.order_net_sales, f.addition_discount_total, f.addition_surcharge_total
 FROM il0{tag} l JOIN fi{tag} f USING (order_id, business_date) LEFT JOIN paid p USING (order_id, business_date)),
al0{tag} AS (SELECT order_id, business_date, hour_of_day, branch_id, product_no, order_type_id, payment_type_id, qty_milli, {milli("item_gross")} AS gross_sales_milli,
 {milli(disc)} AS discount_milli, {milli(sur)} AS surcharge_milli,
 {milli(f"CASE WHEN order_net_sales = 0 THEN cast(0 AS double) ELSE order_included_tax * ((item_gross - ({disc}) + ({sur})) / order_net_sales) END")} AS included_tax_milli, cast(0 AS bigint) AS excluded_tax_milli FROM en{tag}),
al{tag} AS (SELECT *, gross_sales_milli - discount_milli + surcharge_milli AS net_sales_milli, included_tax_milli + excluded_tax_milli AS tax_milli,
 gross_sales_milli - discount_milli + surcharge_milli - included_tax_milli - excluded_tax_milli AS sales_ex_tax_milli FROM al0{tag}),
su{tag} AS (SELECT order_id, business_date, {sums}, count(*) AS allocation_row_count FROM al{tag} GROUP BY 1, 2),
sc{tag} AS (SELECT f.*, CASE WHEN f.item_count > 0 THEN 1 ELSE 0 END AS has_valid_items, CASE WHEN abs(f.order_net_sales) > 0.000001 THEN 1 ELSE 0 END AS has_den,
 {milli("f.order_gross_sales")} AS source_gross_sales_milli, {milli("f.order_discount_total")} AS source_discount_milli, {milli("f.order_surcharge_total")} AS source_surcharge_milli,
 {milli("f.order_net_sales")} AS source_net_sales_milli, {milli("f.order_included_tax")} AS source_included_tax_milli, {milli("f.order_net_sales - f.order_included_tax")} AS source_sales_ex_tax_milli,
 {milli("f.addition_include_tax_total")} AS addition_include_tax_milli, {milli("f.order_net_sales")} AS allocation_denominator_milli,
 {", ".join(f"coalesce(u.{m}, 0) AS allocated_{m}" for m in MEASURES)}, CASE WHEN u.order_id IS NULL THEN 0 ELSE 1 END AS appears_in_preview_allocation,
 {BUCKET} AS reconciliation_bucket
 FROM fi{tag} f LEFT JOIN su{tag} u USING (order_id, business_date)),
fact{tag} AS (SELECT cast(1 AS bigint) AS owner_user_id, business_date, cast(hour_of_day AS smallint) AS hour_of_day, branch_id, product_no, cast(order_type_id AS smallint) AS order_type_id, cast(payment_type_id AS smallint) AS payment_type_id, {sums}
 FROM al{tag} GROUP BY ALL)"""


OFFICIAL = chain("", "SELECT * FROM latest WHERE order_status = 1")
LEGACY = chain("_leg", "SELECT * FROM ob")


def sql(select: str, more: str = "", legacy: bool = False) -> str:
    """The query text: sources, steps, ``more`` steps (each ``name AS (...)``), the last SELECT."""
    return f"WITH {CTES},\n{_BASE}{OFFICIAL}{LEGACY if legacy else ''}{', ' + more if more else ''}\n{select}"
