"""Joins, best-row choices and allocations between staging and the dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import UNKNOWN_LABEL, lifecycle_status
from ..operators.allocation import allocate
from ..operators.dimensions import flag_combinations
from ..operators.latest import best_per_key, current_assignment, dedupe_latest
from ..operators.shape import Level, flatten_hierarchy, lookup_chain, prefix_columns

UNASSIGNED = "Unassigned"
NO_CARD = "No Card"

FLAG_DEFAULTS = {
    "order_status": UNKNOWN_LABEL,
    "is_online_order": False,
    "revision_number": 0,
    "ship_method_name": UNKNOWN_LABEL,
    "card_type": NO_CARD,
}


def customer_addresses(
    customer: DataFrame,
    person: DataFrame,
    business_entity: DataFrame,
    business_entity_address: DataFrame,
    address: DataFrame,
    state_province: DataFrame,
) -> DataFrame:
    """One best address per customer: lowest address type, then latest change.

    The path runs through the person, so a customer that is only a store keeps
    a row without an address. Addresses are ranked per business entity before
    any customer is joined: the ranking keeps one row per entity in each map
    task, and every join of the chain then meets a unique key.
    """
    candidates = business_entity_address.select("business_entity_bk", "address_bk", "address_type_id").join(
        address.select(
            "address_bk",
            "address_line_1",
            "address_line_2",
            "city",
            "state_province_bk",
            "postal_code",
            F.col("address_bk").alias("_found_address"),
            F.col("modified_at").alias("_address_modified"),
        ),
        "address_bk",
        "left",
    )
    best_of_entity = best_per_key(
        candidates,
        ["business_entity_bk"],
        [
            F.col("address_type_id").asc(),
            F.col("_address_modified").desc_nulls_last(),
            F.col("address_bk").asc(),
        ],
    ).select(
        F.col("business_entity_bk").alias("_linked"),
        F.col("_found_address").alias("address_bk"),
        "address_line_1",
        "address_line_2",
        "city",
        "state_province_bk",
        "postal_code",
    )
    states = state_province.select(
        "state_province_bk", "state_province_code", "state_province_name", "country_region_code"
    )
    best = lookup_chain(
        customer.select("customer_bk", "person_bk"),
        [
            (person.select(F.col("person_bk").alias("_person")), "_person", "person_bk"),
            (business_entity.select(F.col("business_entity_bk").alias("_entity")), "_entity", "_person"),
            (best_of_entity, "_linked", "_entity"),
            (states, "state_province_bk", "state_province_bk"),
        ],
    )
    return best.select(
        "customer_bk",
        "address_bk",
        "address_line_1",
        "address_line_2",
        "city",
        "state_province_code",
        "state_province_name",
        "country_region_code",
        "postal_code",
    )


def employee_details(
    employee: DataFrame, person: DataFrame, pay_history: DataFrame, department_history: DataFrame
) -> DataFrame:
    """Employee with person names, latest pay rate and latest open department."""
    pay = dedupe_latest(
        pay_history.select("employee_bk", "rate_change_at", "pay_rate", "pay_frequency"),
        ["employee_bk"],
        "rate_change_at",
    ).drop("rate_change_at")
    department = current_assignment(
        department_history, ["employee_bk"], "end_date", "start_date", ["department_bk", "shift_bk"]
    ).select("employee_bk", "department_bk")
    names = person.select(
        F.col("person_bk").alias("employee_bk"), "first_name", "middle_name", "last_name", "full_name"
    )
    joined = lookup_chain(
        employee, [(t, "employee_bk", "employee_bk") for t in (names, pay, department)]
    )
    return joined.select(
        "employee_bk",
        "first_name",
        "middle_name",
        "last_name",
        "full_name",
        "login_id",
        "national_id_number",
        "job_title",
        "organization_node",
        "organization_level",
        "birth_date",
        "marital_status",
        "gender",
        "hire_date",
        "is_salaried",
        "is_active_employee",
        "vacation_hours",
        "sick_leave_hours",
        "pay_rate",
        "pay_frequency",
        "department_bk",
        "modified_at",
    )


def product_enriched(product: DataFrame, subcategory: DataFrame, category: DataFrame, as_of) -> DataFrame:
    """Product with its subcategory and category names and its lifecycle status."""
    flat = flatten_hierarchy(
        product,
        [
            Level(
                subcategory,
                "product_subcategory_bk",
                "product_subcategory_bk",
                {"subcategory_name": UNASSIGNED},
                ["product_category_bk"],
            ),
            Level(category, "product_category_bk", "product_category_bk", {"category_name": UNASSIGNED}),
        ],
    )
    return flat.select(
        "product_bk",
        "product_name",
        "product_number",
        "is_make",
        "is_finished_good",
        "color",
        "product_line",
        "product_class",
        "product_style",
        "size",
        "size_uom_code",
        "weight",
        "weight_uom_code",
        "standard_cost",
        "list_price",
        "days_to_manufacture",
        "product_subcategory_bk",
        "subcategory_name",
        "product_category_bk",
        "category_name",
        "sell_start_at",
        "sell_end_at",
        "discontinued_at",
        lifecycle_status("discontinued_at", "sell_end_at", as_of).alias("product_status"),
        "modified_at",
    )


def territory_current(territory: DataFrame, territory_history: DataFrame) -> DataFrame:
    """Territory with the sales person of its most recent open assignment."""
    current = current_assignment(
        territory_history, ["sales_territory_bk"], "end_at", "start_at", ["sales_person_bk"]
    ).select("sales_territory_bk", F.col("sales_person_bk").alias("current_sales_person_bk"))
    return territory.join(current, "sales_territory_bk", "left").select(
        "sales_territory_bk",
        "territory_name",
        "country_region_code",
        "territory_group",
        "sales_ytd",
        "sales_last_year",
        "cost_ytd",
        "cost_last_year",
        "current_sales_person_bk",
        "modified_at",
    )


def _with_descriptors(header: DataFrame, ship_method: DataFrame, credit_card: DataFrame | None) -> DataFrame:
    hops = [(ship_method.select("ship_method_bk", "ship_method_name"), "ship_method_bk", "ship_method_bk")]
    if credit_card is not None:
        hops.append((credit_card.select("credit_card_bk", "card_type"), "credit_card_bk", "credit_card_bk"))
    return lookup_chain(header, hops)


def order_flag_combinations(header: DataFrame, ship_method: DataFrame, credit_card: DataFrame | None) -> DataFrame:
    """Distinct status, channel, revision, ship method and card type of all orders; without ``credit_card`` the headers have the last."""
    return flag_combinations(_with_descriptors(header, ship_method, credit_card), FLAG_DEFAULTS)


def described_headers(
    header: DataFrame, ship_method: DataFrame, credit_card: DataFrame | None, keys: Sequence[str] = ()
) -> DataFrame:
    """Order headers with ship method and card type; ``keys`` are further columns to carry along (see ``sales.keyed_headers``).

    Headers that have their ``card_type`` already come without ``credit_card``.
    """
    return _with_descriptors(
        header.select(
            "sales_order_bk",
            "order_date",
            "due_date",
            "ship_date",
            "order_status",
            "is_online_order",
            "revision_number",
            "customer_bk",
            "sales_person_bk",
            "sales_territory_bk",
            "ship_method_bk",
            "credit_card_bk",
            "currency_rate_bk",
            "sub_total",
            "tax_amount",
            "freight",
            "total_due",
            *([] if credit_card is not None else ["card_type"]),
            *keys,
        ),
        ship_method,
        credit_card,
    ).fillna({"ship_method_name": UNKNOWN_LABEL, "card_type": NO_CARD})


def order_lines_enriched(
    detail: DataFrame,
    header: DataFrame,
    ship_method: DataFrame,
    credit_card: DataFrame,
    hot_orders: Sequence = (),
) -> DataFrame:
    """Order lines with header attributes and their share of freight and tax; ``hot_orders`` are split (see ``allocate``)."""
    return lines_of_headers(detail, described_headers(header, ship_method, credit_card), hot_orders)


def lines_of_headers(
    detail: DataFrame, described: DataFrame, hot_orders: Sequence = (), keys: Sequence[str] = ()
) -> DataFrame:
    """``order_lines_enriched`` with headers that are described already.

    ``keys`` are further columns of the headers or the lines to carry along.
    """
    priced = prefix_columns(described, "header_", ["sub_total", "tax_amount", "freight", "total_due"])
    lines = allocate(
        detail,
        priced,
        "sales_order_bk",
        "line_total",
        {"allocated_freight": "header_freight", "allocated_tax": "header_tax_amount"},
        "sales_order_detail_bk",
        hot_orders,
    )
    return lines.select(
        "sales_order_line_bk",
        "sales_order_bk",
        "sales_order_detail_bk",
        "product_bk",
        "special_offer_bk",
        "order_qty",
        "unit_price",
        "unit_price_discount",
        "line_total",
        "order_date",
        "due_date",
        "ship_date",
        "order_status",
        "is_online_order",
        "revision_number",
        "customer_bk",
        "sales_person_bk",
        "sales_territory_bk",
        "ship_method_bk",
        "ship_method_name",
        "credit_card_bk",
        "card_type",
        "currency_rate_bk",
        "header_sub_total",
        "header_tax_amount",
        "header_freight",
        "header_total_due",
        "allocated_freight",
        "allocated_tax",
        "modified_at",
        *keys,
    )
