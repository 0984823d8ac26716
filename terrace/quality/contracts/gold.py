"""Checks on the histories, dimensions, fact and mart. Fixed values."""

from ..suite import (
    accepted,
    between,
    contract,
    holds,
    key,
    matches,
    no_overlap,
    not_null,
    related,
    together,
    unique,
)
from .staging import CUSTOMER_TYPES, ORDER_STATUSES

REAL = "is_unknown = false"

GOLD = {
    "snap_product": contract(not_null("product_bk"), key("scd_id")),
    "snap_employee": contract(not_null("employee_bk"), key("scd_id")),
    "snap_salesterritory": contract(not_null("sales_territory_bk"), key("scd_id")),
    "dim_customer": contract(
        key("customer_sk"),
        key("customer_bk"),
        not_null("account_number", where=REAL),
        unique("account_number", where=REAL),
        accepted("customer_type", *CUSTOMER_TYPES),
        not_null("customer_name", "is_unknown"),
        holds("customer_bk is not null or is_unknown = true"),
    ),
    "dim_product": contract(
        key("product_sk"),
        not_null("product_bk", "valid_from", "is_current", "is_unknown"),
        not_null("product_name", "product_number", where=REAL),
        # A number is unique among current versions only: a second version repeats it.
        unique("product_number", where="is_unknown = false and is_current"),
        accepted("product_status", "Active", "Inactive", "Discontinued", where=REAL),
        between("list_price", "standard_cost", low=0, where=REAL),
        no_overlap("product_bk"),
    ),
    "dim_employee": contract(
        key("employee_sk"),
        not_null("employee_bk", "valid_from", "is_current", "is_unknown"),
        not_null("login_id", "job_title", "hire_date", where=REAL),
        no_overlap("employee_bk"),
    ),
    "dim_salesterritory": contract(
        key("sales_territory_sk"),
        not_null("sales_territory_bk", "valid_from", "is_current", "territory_name", "is_unknown"),
        not_null("country_region_code", "territory_group", where=REAL),
        no_overlap("sales_territory_bk"),
    ),
    "dim_date": contract(
        key("date_sk"),
        unique("full_date"),
        not_null("full_date", where="date_sk <> -1"),
        between("year_number", low=1990, high=2030, where=REAL),
        between("month_number", low=1, high=12, where=REAL),
        between("day_of_month", low=1, high=31, where=REAL),
        between("quarter_number", low=1, high=4, where=REAL),
        between("day_of_week", low=1, high=7, where=REAL),
        not_null("is_weekend", where=REAL),
        between("fiscal_quarter", low=1, high=4, where=REAL),
        not_null("is_unknown"),
    ),
    "dim_special_offer": contract(
        key("special_offer_sk"),
        not_null("special_offer_bk", "eligible_product_count", "is_active", "is_unknown"),
        not_null("offer_description", "offer_type", "offer_category", where=REAL),
        between("eligible_product_count", low=0),
        between("discount_pct", low=0, high=1),
        accepted("discount_tier", "No Discount", "Low (<5%)", "Medium (5-15%)", "High (15-30%)", "Deep (30%+)"),
    ),
    "dim_sales_order_junk": contract(
        key("sales_order_junk_sk"),
        not_null("order_status", "is_unknown"),
        accepted("order_status", *ORDER_STATUSES),
        not_null("revision_number", where=REAL),
        between("revision_number", low=0, where=REAL),
        together("order_status", "is_online_order", "revision_number", "ship_method_name", "card_type"),
    ),
    "fct_sales_detail": contract(
        key("sales_order_line_sk"),
        not_null("sales_order_bk", "sales_order_detail_bk", "sales_order_line_bk", "order_date",
                 "order_date_sk", "customer_sk", "product_sk", "employee_sk", "sales_territory_sk",
                 "special_offer_sk", "sales_order_junk_sk", "order_qty", "unit_price", "unit_price_discount",
                 "line_total", "discount_amount", "allocated_freight", "allocated_tax",
                 "line_total_with_overhead", "updated_at"),
        matches("sales_order_line_bk", r"^\d+-\d+$"),
        holds(">= '1990-01-01' and order_date <= '2030-12-31'", "order_date", where="order_date is not null"),
        related("order_date_sk", "dim_date.date_sk"),
        related("ship_date_sk", "dim_date.date_sk", where="ship_date_sk <> -1"),
        related("due_date_sk", "dim_date.date_sk", where="due_date_sk <> -1"),
        related("customer_sk", "dim_customer.customer_sk"),
        related("product_sk", "dim_product.product_sk"),
        related("employee_sk", "dim_employee.employee_sk"),
        related("sales_territory_sk", "dim_salesterritory.sales_territory_sk"),
        related("special_offer_sk", "dim_special_offer.special_offer_sk"),
        related("sales_order_junk_sk", "dim_sales_order_junk.sales_order_junk_sk"),
        between("order_qty", low=1),
        between("unit_price", "line_total", "discount_amount", "allocated_freight", "allocated_tax",
                "line_total_with_overhead", low=0),
        between("unit_price_discount", low=0, high=1),
        holds(">= line_total", "line_total_with_overhead"),
        together("sales_order_bk", "sales_order_detail_bk"),
    ),
    "mart_sales_summary": contract(
        not_null("year_number", "quarter_number", "month_number", "month_name", "sales_territory_bk",
                 "territory_name", "country_region_code", "territory_group", "product_category_bk",
                 "product_subcategory_bk", "category_name", "subcategory_name", "order_count", "line_count",
                 "units_sold", "gross_revenue", "discount_amount", "net_revenue", "freight_allocated",
                 "tax_allocated", "total_cost", "gross_profit"),
        between("quarter_number", low=1, high=4),
        between("month_number", low=1, high=12),
        between("order_count", "line_count", "units_sold", low=1),
        between("gross_revenue", "discount_amount", "net_revenue", "freight_allocated", "tax_allocated",
                "total_cost", low=0),
        together("year_number", "quarter_number", "month_number", "sales_territory_bk", "territory_name",
                 "country_region_code", "territory_group", "product_category_bk", "category_name",
                 "product_subcategory_bk", "subcategory_name", "employee_bk"),
        holds("net_revenue <= gross_revenue"),
        holds("discount_amount >= 0 AND discount_amount = gross_revenue - net_revenue"),
        holds("gross_profit = net_revenue - total_cost"),
    ),
}
