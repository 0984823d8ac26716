"""The seven dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (
    UNKNOWN_KEY,
    UNKNOWN_LABEL,
    UNKNOWN_SK,
    active_between,
    surrogate_key,
    tier,
)
from ..operators.dimensions import (
    date_dimension,
    junk_dimension,
    unknown_version,
    with_bridge_count,
    with_unknown_member,
)
from ..operators.history import scd2_dimension
from ..operators.shape import lookup_chain
from .history import EMPLOYEE, PRODUCT, TERRITORY

# --- fixed values ------------------------------------------------------------------

FISCAL_START_MONTH = 7

NO_DISCOUNT = "No Discount"
DISCOUNT_STEPS = (("0.05", "Low (<5%)"), ("0.15", "Medium (5-15%)"), ("0.30", "High (15-30%)"))
TOP_DISCOUNT = "Deep (30%+)"

PRODUCT_LABELS = (
    "product_name", "product_number", "color", "product_line", "product_class", "product_style",
    "size", "subcategory_name", "category_name", "product_status",
)

# --- end of fixed values -----------------------------------------------------------


def discount_tier(rate) -> Column:
    return tier(rate, NO_DISCOUNT, DISCOUNT_STEPS, TOP_DISCOUNT)


def key_view(df: DataFrame, sk: str, key: str) -> DataFrame:
    """Only the keys of a current-state dimension, as a fact lookup reads them."""
    keys = df.select(surrogate_key(key).alias(sk), key)
    return with_unknown_member(keys, {sk: UNKNOWN_SK, key: UNKNOWN_KEY})


def dim_customer(customer: DataFrame, person: DataFrame, store: DataFrame, addresses: DataFrame) -> DataFrame:
    """Current state of each customer with person, store and best address."""
    persons = person.select(
        "person_bk",
        F.col("title").alias("person_title"),
        F.col("first_name").alias("person_first_name"),
        F.col("middle_name").alias("person_middle_name"),
        F.col("last_name").alias("person_last_name"),
        F.col("suffix").alias("person_suffix"),
        F.col("full_name").alias("person_full_name"),
        "person_type",
        "email_promotion_flag",
    )
    stores = store.select("store_bk", "store_name", F.col("sales_person_bk").alias("store_sales_person_bk"))
    located = addresses.select(
        "customer_bk",
        *[
            F.col(c).alias(f"current_{c}")
            for c in (
                "address_line_1", "address_line_2", "city", "state_province_code",
                "state_province_name", "country_region_code", "postal_code",
            )
        ],
    )
    joined = lookup_chain(
        customer,
        [(persons, "person_bk", "person_bk"), (stores, "store_bk", "store_bk"),
         (located, "customer_bk", "customer_bk")],
    )
    described = joined.select(
        surrogate_key("customer_bk").alias("customer_sk"),
        "customer_bk",
        "account_number",
        "customer_type",
        "person_bk",
        *[c for c in persons.columns if c != "person_bk"],
        "store_bk",
        "store_name",
        "store_sales_person_bk",
        F.coalesce("store_name", "person_full_name").alias("customer_name"),
        *[c for c in located.columns if c != "customer_bk"],
        "row_guid",
        "modified_at",
        F.lit(False).alias("is_unknown"),
    )
    return with_unknown_member(
        described,
        {
            "customer_sk": UNKNOWN_SK,
            "customer_bk": UNKNOWN_KEY,
            "customer_type": UNKNOWN_LABEL,
            "customer_name": UNKNOWN_LABEL,
            "is_unknown": True,
        },
    )


def dim_product(history: DataFrame) -> DataFrame:
    versions = scd2_dimension(history, "product_sk", PRODUCT.columns)
    return with_unknown_member(
        versions,
        unknown_version("product_sk", "product_bk", PRODUCT_LABELS, standard_cost="0", list_price="0"),
    )


def dim_employee(history: DataFrame) -> DataFrame:
    """Employee versions; the national id stays in the history only."""
    columns = [c for c in EMPLOYEE.columns if c != "national_id_number"]
    versions = scd2_dimension(history, "employee_sk", columns)
    return with_unknown_member(versions, unknown_version("employee_sk", "employee_bk", ["full_name"]))


def dim_salesterritory(history: DataFrame) -> DataFrame:
    versions = scd2_dimension(history, "sales_territory_sk", TERRITORY.columns)
    labels = ["territory_name", "country_region_code", "territory_group"]
    return with_unknown_member(versions, unknown_version("sales_territory_sk", "sales_territory_bk", labels))


def dim_date(header: DataFrame) -> DataFrame:
    return date_dimension(header, ["order_date", "ship_date", "due_date"], FISCAL_START_MONTH)


def dim_special_offer(offer: DataFrame, offer_product: DataFrame, as_of) -> DataFrame:
    counted = with_bridge_count(offer, offer_product, "special_offer_bk", "eligible_product_count")
    described = counted.select(
        surrogate_key("special_offer_bk").alias("special_offer_sk"),
        "special_offer_bk",
        "offer_description",
        "offer_type",
        "offer_category",
        "discount_pct",
        discount_tier("discount_pct").alias("discount_tier"),
        "start_at",
        "end_at",
        "min_qty",
        "max_qty",
        active_between("start_at", "end_at", as_of).alias("is_active"),
        "eligible_product_count",
        F.lit(False).alias("is_unknown"),
    )
    return with_unknown_member(
        described,
        {
            "special_offer_sk": UNKNOWN_SK,
            "special_offer_bk": UNKNOWN_KEY,
            "offer_description": UNKNOWN_LABEL,
            "discount_pct": "0",
            "discount_tier": NO_DISCOUNT,
            "is_active": False,
            "eligible_product_count": 0,
            "is_unknown": True,
        },
    )


def dim_sales_order_junk(combinations: DataFrame) -> DataFrame:
    return junk_dimension(
        combinations,
        "sales_order_junk_sk",
        {"order_status": UNKNOWN_LABEL, "ship_method_name": UNKNOWN_LABEL, "card_type": UNKNOWN_LABEL},
    )
