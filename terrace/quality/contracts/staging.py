"""Checks on the staging tables. Fixed values."""

from ..suite import accepted, between, contract, holds, key, matches, not_null, related, together, unique

ORDER_STATUSES = ("In process", "Approved", "Backordered", "Rejected", "Shipped", "Cancelled", "Unknown")
CUSTOMER_TYPES = ("Individual", "Store", "StoreContact", "Unknown")

STAGING = {
    "stg_business_entity_address": contract(
        not_null("business_entity_bk", "address_bk", "address_type_id", "row_guid", "modified_at"),
        unique("row_guid"),
        related("address_bk", "stg_address.address_bk"),
        together("business_entity_bk", "address_bk", "address_type_id"),
    ),
    "stg_person": contract(
        key("person_bk"),
        not_null("person_type", "first_name", "last_name", "full_name", "row_guid", "modified_at"),
        unique("row_guid"),
    ),
    "stg_address": contract(
        key("address_bk"),
        not_null("address_line_1", "city", "state_province_bk", "postal_code", "row_guid", "modified_at"),
        unique("row_guid"),
        related("state_province_bk", "stg_state_province.state_province_bk"),
    ),
    "stg_state_province": contract(
        key("state_province_bk"),
        not_null("state_province_code", "country_region_code", "state_province_name", "sales_territory_bk",
                 "modified_at"),
        related("sales_territory_bk", "stg_sales_territory.sales_territory_bk"),
    ),
    "stg_store": contract(
        key("store_bk"),
        not_null("store_name", "row_guid", "modified_at"),
        unique("row_guid"),
        related("sales_person_bk", "stg_sales_person.sales_person_bk"),
    ),
    "stg_customer": contract(
        key("customer_bk"),
        related("person_bk", "stg_person.person_bk"),
        related("store_bk", "stg_store.store_bk"),
        related("sales_territory_bk", "stg_sales_territory.sales_territory_bk"),
        key("account_number"),
        matches("account_number", r"^AW[0-9]{8}$"),
        not_null("customer_type"),
        accepted("customer_type", *CUSTOMER_TYPES),
        key("row_guid"),
        not_null("modified_at"),
    ),
    "stg_sales_order_header": contract(
        key("sales_order_bk"),
        key("sales_order_number"),
        matches("sales_order_number", r"^SO[0-9]+$"),
        not_null("order_date", "customer_bk", "order_status", "total_due", "modified_at"),
        related("customer_bk", "stg_customer.customer_bk"),
        accepted("order_status", *ORDER_STATUSES),
        related("ship_method_bk", "stg_ship_method.ship_method_bk"),
        related("credit_card_bk", "stg_credit_card.credit_card_bk"),
        between("total_due", low=0),
        holds("ship_date IS NULL OR ship_date >= order_date"),
        holds("due_date >= order_date"),
    ),
    "stg_sales_order_detail": contract(
        key("sales_order_line_bk"),
        not_null("sales_order_bk", "product_bk", "special_offer_bk", "order_qty", "unit_price",
                 "unit_price_discount", "line_total", "modified_at"),
        related("sales_order_bk", "stg_sales_order_header.sales_order_bk"),
        related("product_bk", "stg_product.product_bk"),
        related("special_offer_bk", "stg_special_offer.special_offer_bk"),
        between("order_qty", low=1),
        between("unit_price", "line_total", low=0),
        between("unit_price_discount", low=0, high=1),
    ),
    "stg_sales_territory": contract(
        key("sales_territory_bk"),
        not_null("territory_name", "country_region_code", "territory_group", "modified_at"),
    ),
    "stg_sales_territory_history": contract(
        not_null("sales_person_bk", "sales_territory_bk", "start_at", "modified_at"),
        related("sales_person_bk", "stg_sales_person.sales_person_bk"),
        related("sales_territory_bk", "stg_sales_territory.sales_territory_bk"),
        together("sales_person_bk", "sales_territory_bk", "start_at"),
    ),
    "stg_sales_person": contract(
        key("sales_person_bk"),
        related("sales_person_bk", "stg_employee.employee_bk"),
        related("sales_territory_bk", "stg_sales_territory.sales_territory_bk"),
        between("commission_pct", low=0, high=1),
        not_null("modified_at"),
    ),
    "stg_special_offer": contract(
        key("special_offer_bk"),
        not_null("offer_description", "discount_pct", "offer_type", "offer_category", "modified_at"),
        between("discount_pct", low=0, high=1),
    ),
    "stg_special_offer_product": contract(
        not_null("special_offer_bk", "product_bk", "modified_at"),
        related("special_offer_bk", "stg_special_offer.special_offer_bk"),
        related("product_bk", "stg_product.product_bk"),
        together("special_offer_bk", "product_bk"),
    ),
    "stg_ship_method": contract(
        key("ship_method_bk"),
        not_null("ship_method_name", "modified_at"),
        between("ship_base_cost", "ship_rate", low=0),
    ),
    "stg_credit_card": contract(
        key("credit_card_bk"),
        not_null("card_type", "card_number_masked", "exp_month", "exp_year", "modified_at"),
        matches("card_number_masked", r"^X+[0-9]{4}$"),
        between("exp_month", low=1, high=12),
    ),
    "stg_product": contract(
        key("product_bk"),
        not_null("product_name"),
        key("product_number"),
        between("list_price", "standard_cost", low=0),
        related("product_subcategory_bk", "stg_product_subcategory.product_subcategory_bk"),
        not_null("modified_at"),
        accepted("product_line", "R", "M", "T", "S", where="product_line is not null"),
        accepted("product_class", "H", "M", "L", where="product_class is not null"),
        accepted("product_style", "W", "M", "U", where="product_style is not null"),
        holds("CAST(standard_cost AS DECIMAL(18,2)) <= CAST(list_price AS DECIMAL(18,2)) OR list_price = 0"),
    ),
    "stg_product_subcategory": contract(
        key("product_subcategory_bk"),
        not_null("product_category_bk", "subcategory_name", "modified_at"),
        related("product_category_bk", "stg_product_category.product_category_bk"),
    ),
    "stg_product_category": contract(
        key("product_category_bk"), key("category_name"), not_null("modified_at")
    ),
    "stg_employee": contract(
        key("employee_bk"), not_null("login_id", "job_title", "hire_date", "modified_at")
    ),
    "stg_employee_pay_history": contract(
        not_null("employee_bk", "rate_change_at", "pay_rate", "pay_frequency", "modified_at"),
        related("employee_bk", "stg_employee.employee_bk"),
        between("pay_rate", low=0),
        together("employee_bk", "rate_change_at"),
    ),
    "stg_employee_dept_history": contract(
        not_null("employee_bk", "department_bk", "shift_bk", "start_date", "modified_at"),
        related("employee_bk", "stg_employee.employee_bk"),
        together("employee_bk", "department_bk", "shift_bk", "start_date"),
    ),
}
