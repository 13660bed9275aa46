"""The point-of-sale sources made from the tables orders and lineitem: plain SQL that Spark and DuckDB both read."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .readers import Sources

POS_ORDERS = """
SELECT cast(o_orderkey AS string) AS id,
  cast(o_orderkey*10+v AS string) AS sequence,
  CASE WHEN v=2 THEN -2 WHEN o_orderkey%13=0 THEN 2 WHEN o_orderkey%17=0 THEN -1 WHEN o_orderkey%19=0 THEN NULL ELSE 1 END AS status,
  CASE o_orderkey%12 WHEN 0 THEN '來店' WHEN 1 THEN '內用' WHEN 2 THEN 'FOODPANDA' WHEN 3 THEN '外送' WHEN 4 THEN '自取' WHEN 5 THEN 'Uber Eats' WHEN 6 THEN '快一點自取' WHEN 7 THEN '快一點外送' WHEN 8 THEN '掃碼點單' WHEN 9 THEN ' ' WHEN 10 THEN NULL ELSE 'misc' END AS destination,
  CASE WHEN o_orderkey%43=0 THEN ' ' ELSE 'B' || cast(o_custkey%25 AS string) END AS branch_id,
  CASE WHEN o_orderkey%47=0 THEN NULL ELSE 'Branch ' || cast(o_custkey%25 AS string) || CASE WHEN o_orderkey%10=0 THEN ' x' ELSE '' END END AS branch,
  CASE WHEN o_orderkey%29=0 THEN 'x' WHEN o_orderkey%31=0 THEN '99' WHEN o_orderkey%37=0 THEN '' ELSE cast(o_orderkey%24 AS string) END AS s_hour,
  o_orderdate + interval '1' hour * cast(o_orderkey%24 AS int) AS transaction_created,
  CASE WHEN o_orderkey%23=0 THEN NULL ELSE o_orderdate + interval '1' hour * cast(o_orderkey%24 AS int) + interval '1' minute * v END AS transaction_submitted,
  CASE WHEN o_orderkey%53=0 THEN o_orderdate + interval '1' hour * 23 ELSE NULL END AS transaction_voided,
  o_orderdate AS created,
  o_orderdate + interval '1' day * v AS modified,
  CASE WHEN v=2 THEN cast(cast(o_orderdate AS date) AS string) ELSE NULL END AS void_sale_period,
  cast(o_orderdate AS date) AS sale_period,
  cast(o_orderkey%3 AS int) AS shift_number,
  CASE WHEN o_orderkey%997=0 THEN cast('NaN' AS double) WHEN o_orderkey%1009=0 THEN cast('Infinity' AS double) WHEN o_orderkey%1013=0 THEN NULL ELSE o_totalprice + v END AS total,
  o_totalprice AS item_subtotal,
  cast(0 AS double) - cast(o_orderkey%50 AS double) AS discount_subtotal,
  cast(o_custkey%7 AS double) AS surcharge_subtotal,
  cast(o_custkey%7 AS double) AS item_surcharge_subtotal,
  cast(0 AS double) AS trans_surcharge_subtotal,
  CASE WHEN v=0 THEN o_totalprice ELSE o_totalprice + 1 END AS payment_subtotal,
  cast(floor(o_totalprice*(5 + v*(o_orderkey%2))+0.5) AS double)/cast(100 AS double) AS included_tax_subtotal,
  cast(floor(o_totalprice*5+0.5) AS double)/cast(100 AS double) AS tax_subtotal,
  cast(o_orderdate AS date) AS t_open_date
 FROM orders CROSS JOIN (VALUES (0),(1),(2)) AS ver(v)
 WHERE v=0 OR (v=1 AND o_orderkey%5=0) OR (v=2 AND o_orderkey%11=0)
"""
POS_ITEMS = """
SELECT cast(l_orderkey*10+l_linenumber AS string) AS id,
  cast(l_orderkey AS string) AS order_id,
  CASE WHEN (l_orderkey+l_linenumber)%41=0 THEN ' ' ELSE 'P' || cast(l_partkey%200 AS string) END AS product_no,
  CASE WHEN l_partkey%200=7 THEN '雲林幣' WHEN l_partkey%200=8 THEN '折抵券' WHEN l_partkey%200=9 THEN 'Test item' WHEN l_orderkey%59=0 THEN NULL ELSE 'Item ' || cast(l_partkey%200 AS string) || CASE WHEN l_orderkey%9=0 AND l_partkey%4=0 THEN '  New' ELSE '' END END AS product_name,
  CASE WHEN l_partkey%20=0 THEN ' ' ELSE 'C' || cast(l_partkey%200%10 AS string) END AS cate_no,
  CASE WHEN l_partkey%20=0 THEN NULL ELSE 'Cate ' || cast(l_partkey%200%10 AS string) END AS cate_name,
  l_quantity AS current_qty,
  cast(floor(l_extendedprice*(1-l_discount)*100+0.5) AS double)/cast(100 AS double) AS current_subtotal,
  cast(0 AS double) - cast(floor(l_extendedprice*l_discount*100+0.5) AS double)/cast(100 AS double) AS current_discount,
  CASE WHEN l_linenumber=3 THEN cast(floor(l_tax*100+0.5) AS double) ELSE cast(0 AS double) END AS current_surcharge,
  cast(floor(l_extendedprice*l_tax*100+0.5) AS double)/cast(100 AS double) AS included_tax,
  cast(o_orderdate AS date) AS t_open_date
 FROM lineitem JOIN orders ON o_orderkey=l_orderkey
"""
POS_ADDITIONS = """
SELECT cast(o_orderkey*10+k AS string) AS id, cast(o_orderkey AS string) AS order_id,
  CASE WHEN k=0 THEN cast(0 AS double) - cast(o_orderkey%50 AS double) ELSE NULL END AS current_discount,
  CASE WHEN k=1 THEN cast(o_custkey%7 AS double) ELSE cast(0 AS double) END AS current_surcharge,
  cast(k AS double) AS include_tax,
  cast(o_orderdate AS date) AS t_open_date
 FROM orders CROSS JOIN (VALUES (0),(1)) AS ad(k) WHERE o_orderkey%3=0 AND (k=0 OR o_orderkey%2=0)
"""
POS_PAYMENTS = """
SELECT cast(o_orderkey*10+k AS string) AS id, cast(o_orderkey AS string) AS order_id,
  CASE (o_orderkey+k)%11 WHEN 0 THEN 'CASH' WHEN 1 THEN 'credit_card' WHEN 2 THEN ' LinePay ' WHEN 3 THEN 'foodpanda' WHEN 4 THEN '禮券' WHEN 5 THEN 'undefined_pay' WHEN 6 THEN NULL WHEN 7 THEN 'other' WHEN 8 THEN 'easycard' WHEN 9 THEN 'gift card' ELSE 'uupay' END AS name,
  CASE WHEN k=2 THEN -cast(10+o_orderkey%5 AS double) ELSE cast(100*(k+1)+o_orderkey%7 AS double) END AS amount,
  cast(o_orderdate AS date) AS t_open_date
 FROM orders CROSS JOIN (VALUES (0),(1),(2)) AS pk(k)
 WHERE k=0 OR (k=1 AND o_orderkey%4=0) OR (k=2 AND o_orderkey%16=0)
"""

CTES = f"pos_orders AS ({POS_ORDERS}), pos_items AS ({POS_ITEMS}), pos_additions AS ({POS_ADDITIONS}), pos_payments AS ({POS_PAYMENTS})"


def pos_sources(spark: SparkSession, sf_dir: str) -> Sources:
    tables = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("orders", "lineitem")}
    made = []
    for sql in (POS_ORDERS, POS_ITEMS, POS_ADDITIONS, POS_PAYMENTS):
        for name in tables:
            sql = sql.replace(f"FROM {name}", f"FROM {{{name}}}").replace(f"JOIN {name} ", f"JOIN {{{name}}} ")
        made.append(spark.sql(sql, **{k: v for k, v in tables.items() if f"{{{k}}}" in sql}))
    return Sources(*made)
