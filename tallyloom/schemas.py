"""Declared schemas of the sources (as the exports have them) and of the tables they make."""

from __future__ import annotations

# The columns of the exported tables, in the order of their files.
ORDERS = """
id string, sequence string, items_count int, total float, change float, tax_subtotal float, surcharge_subtotal float, discount_subtotal float,
payment_subtotal float, rounding_prices string, precision_prices string, rounding_taxes string, precision_taxes string, status int, service_clerk
string, service_clerk_displayname string, proceeds_clerk string, proceeds_clerk_displayname string, member string, member_displayname string,
member_email string, member_cellphone string, invoice_type string, invoice_title string, invoice_no string, invoice_count int, destination string,
table_no int, check_no int, no_of_customers int, terminal_no string, transaction_created timestamp_ntz, transaction_submitted timestamp_ntz, created
timestamp_ntz, modified timestamp_ntz, included_tax_subtotal float, item_subtotal float, sale_period date, shift_number int, branch_id string, branch
string, transaction_voided timestamp_ntz, promotion_subtotal float, void_clerk string, void_clerk_displayname string, void_sale_period string,
void_shift_number int, revalue_subtotal float, qty_subtotal int, inherited_order_id string, inherited_desc string, item_surcharge_subtotal float,
trans_surcharge_subtotal float, item_discount_subtotal float, trans_discount_subtotal float, service_charge_subtotal float,
included_service_charge_subtotal float, s_day string, s_month string, s_year string, s_hour string, tr_date date
"""
ITEMS = """
id string, order_id string, cate_no string, included_tax float, cate_name string, product_no string, product_barcode string, product_name string,
current_qty float, current_price float, current_subtotal float, tax_name string, tax_rate float, tax_type string, current_tax float, discount_name
string, discount_rate float, discount_type string, current_discount float, surcharge_name string, surcharge_rate float, surcharge_type string,
current_surcharge float, condiments string, current_condiment float, memo string, created int, modified int, destination string, parent_no string,
weight float, sale_unit string, seat_no string, parent_index string, has_setitems boolean, stock_maintained boolean, current_service_charge float,
included_service_charge float, price_level int, service_clerk string, service_clerk_displayname string, service_status int, service_status_time1 int,
service_status_time2 int, service_status_time3 int, service_status_time4 int, service_status_time5 int, item_sequence int, item_sequence_barcode
string, org_order_sequence_no string, service_charge_name string, service_charge_rate float, service_charge_type string, terminal_no string
"""
ADDITIONS = """
id string, order_id string, tax_name string, tax_rate float, tax_type string, current_tax float, discount_name string, discount_rate float,
discount_type string, current_discount float, surcharge_name string, surcharge_rate float, surcharge_type string, current_surcharge float,
has_discount boolean, has_surcharge boolean, created int, modified int, include_tax float, terminal_no string
"""
PAYMENTS = """
id string, order_id string, order_items_count int, order_total float, name string, amount float, memo1 string, memo2 string, created int, modified
int, origin_amount float, service_clerk string, proceeds_clerk string, service_clerk_displayname string, proceeds_clerk_displayname string, change
float, sale_period int, shift_number int, terminal_no string, is_groupable boolean
"""
CONDIMENTS = """
id string, order_id string, item_id string, name string, price float, created int, modified int, condiment_id string, condiment_group_id string,
current_qty int, current_subtotal float, condiment_group_name string, terminal_no string
"""
ITEM_TAXES = """
id string, order_id string, order_item_id string, promotion_id string, tax_no string, tax_name string, tax_type string, tax_rate float, tax_rate_type
string, tax_threshold float, tax_subtotal float, included_tax_subtotal float, item_count int, taxable_amount float, created int, modified int,
order_addition_id string, terminal_no string
"""
PROMOTIONS = """
id string, order_id string, promotion_id string, name string, code string, alt_name1 string, alt_name2 string, trigger string, trigger_name string,
trigger_level string, type string, type_name string, type_level string, matched_amount int, matched_items_qty int, matched_items_subtotal float,
discount_subtotal float, tax_name string, current_tax float, included_tax float, created int, modified int, terminal_no string
"""
ANNOTATIONS = """
id string, type string, text string, created int, modified int, order_id string, terminal_no string
"""
DAY = "t_open_date date"
SOURCES = {
    "orders": ORDERS, "order_items": ITEMS, "order_additions": ADDITIONS, "order_payments": PAYMENTS,
    "order_item_condiments": CONDIMENTS, "order_item_taxes": ITEM_TAXES, "order_promotions": PROMOTIONS, "order_annotations": ANNOTATIONS,
}

GRAIN = ["owner_user_id", "business_date", "hour_of_day", "branch_id", "product_no", "order_type_id", "payment_type_id"]
MEASURES = ["qty_milli", "gross_sales_milli", "discount_milli", "surcharge_milli", "net_sales_milli", "sales_ex_tax_milli", "included_tax_milli", "excluded_tax_milli", "tax_milli"]
#: Names that the fact must not have.
FORBIDDEN = "raw_payment_name raw_payment_memo1 item_count void_milli refund_milli order_count completed_order_count void_order_count refund_order_count cancelled_order_count tr_date t_open_date void_sale_period order_num".split()
D = ["order_id", "business_date"]
