"""Checks on the intermediate models. Fixed values."""

from ..suite import accepted, between, contract, holds, key, not_null, related, together, unique
from .staging import ORDER_STATUSES


def _amounts(*columns: str):
    """Non-negative where present."""
    return [c for column in columns for c in between(column, low=0, where=f"{column} is not null")]


INTERMEDIATE = {
    "int_customer_addresses": contract(
        key("customer_bk"),
        related("customer_bk", "stg_customer.customer_bk"),
        related("address_bk", "stg_address.address_bk"),
    ),
    "int_product_enriched": contract(
        key("product_bk"),
        related("product_bk", "stg_product.product_bk"),
        not_null("product_name", "product_number", "subcategory_name", "category_name", "sell_start_at",
                 "product_status", "modified_at"),
        unique("product_number"),
        between("standard_cost", "list_price", "days_to_manufacture", low=0),
        accepted("product_status", "Active", "Inactive", "Discontinued"),
        holds("discontinued_at is null or product_status = 'Discontinued'"),
        holds("sell_end_at IS NULL OR sell_end_at >= sell_start_at"),
        holds("standard_cost <= list_price or list_price = 0"),
    ),
    "int_employee_details": contract(
        key("employee_bk"),
        related("employee_bk", "stg_employee.employee_bk"),
        not_null("login_id", "job_title", "hire_date", "modified_at"),
        _amounts("organization_level", "vacation_hours", "sick_leave_hours", "pay_rate"),
        holds("birth_date IS NULL OR hire_date > birth_date"),
    ),
    "int_territory_current": contract(
        key("sales_territory_bk"),
        related("sales_territory_bk", "stg_sales_territory.sales_territory_bk"),
        not_null("territory_name", "country_region_code", "territory_group", "modified_at"),
        _amounts("sales_ytd", "sales_last_year", "cost_ytd", "cost_last_year"),
        related("current_sales_person_bk", "stg_sales_person.sales_person_bk"),
    ),
    "int_sales_order_flag_combinations": contract(
        not_null("order_status", "is_online_order", "revision_number", "ship_method_name", "card_type"),
        accepted("order_status", *ORDER_STATUSES),
        between("revision_number", low=0),
        together("order_status", "is_online_order", "revision_number", "ship_method_name", "card_type"),
    ),
    "int_sales_order_line_enriched": contract(
        key("sales_order_line_bk"),
        not_null("sales_order_bk", "sales_order_detail_bk", "product_bk", "special_offer_bk", "order_qty",
                 "unit_price", "unit_price_discount", "line_total", "order_date", "order_status",
                 "is_online_order", "revision_number", "customer_bk", "ship_method_name", "card_type",
                 "header_sub_total", "header_tax_amount", "header_freight", "header_total_due",
                 "allocated_freight", "allocated_tax", "modified_at"),
        related("sales_order_bk", "stg_sales_order_header.sales_order_bk"),
        related("product_bk", "stg_product.product_bk"),
        related("special_offer_bk", "stg_special_offer.special_offer_bk"),
        related("customer_bk", "stg_customer.customer_bk"),
        related("sales_person_bk", "stg_sales_person.sales_person_bk"),
        related("sales_territory_bk", "stg_sales_territory.sales_territory_bk"),
        between("order_qty", low=1),
        between("unit_price", "line_total", "revision_number", "header_sub_total", "header_tax_amount",
                "header_freight", "header_total_due", "allocated_freight", "allocated_tax", low=0),
        between("unit_price_discount", low=0, high=1),
        holds("due_date IS NULL OR due_date >= order_date"),
        holds("ship_date IS NULL OR ship_date >= order_date"),
    ),
}
