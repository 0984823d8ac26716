"""The 22 landed tables: file layout, dedupe key and staging types.

Each column line reads ``SourceColumn  staged_name  type``. The type defaults
to text; ``-`` lands the column without carrying it into staging, and a line
starting with ``=`` names a column that the staging plan derives.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

TAB = "\t"
PLUS_PIPE = "+|"

# Staging types that stand for a cast or a cleaning rule.
TYPES = {
    "int": "int",
    "money": "decimal(19,4)",
    "rate": "decimal(10,4)",
    "weight": "decimal(8,2)",
    "total": "decimal(38,6)",
    "flag": "boolean",
    "date": "date",
    "timestamp": "timestamp",
}


@dataclass(frozen=True)
class StagedColumn:
    source: str | None
    name: str
    kind: str


@dataclass(frozen=True)
class SourceTable:
    name: str
    domain: str
    staged_as: str
    dedupe_keys: tuple[str, ...]
    layout: str
    separator: str = TAB
    multiline: bool = False

    @cached_property
    def _lines(self) -> list[list[str]]:
        return [line.split() for line in self.layout.strip().splitlines()]

    @cached_property
    def columns(self) -> list[str]:
        """Landed columns in file order."""
        return [parts[0] for parts in self._lines if parts[0] != "="]

    @cached_property
    def staged(self) -> list[StagedColumn]:
        """Staging columns in output order."""
        out = []
        for parts in self._lines:
            source = None if parts[0] == "=" else parts[0]
            if parts[1] == "-":
                continue
            kind = "derived" if source is None else (parts[2] if len(parts) > 2 else "text")
            out.append(StagedColumn(source, parts[1], kind))
        return out


# --- fixed values: names, order and types of the source tables ---------------

_TABLES = [
    SourceTable("Customer", "sales", "stg_customer", ("CustomerID",), """
        CustomerID      customer_bk         int
        PersonID        person_bk           int
        StoreID         store_bk            int
        TerritoryID     sales_territory_bk  int
        AccountNumber   account_number
        =               customer_type
        rowguid         row_guid
        ModifiedDate    modified_at         leading_timestamp
    """),
    SourceTable("SalesOrderHeader", "sales", "stg_sales_order_header", ("SalesOrderID",), """
        SalesOrderID            sales_order_bk        int
        RevisionNumber          revision_number       int
        OrderDate               order_date            timestamp
        DueDate                 due_date              timestamp
        ShipDate                ship_date             timestamp
        Status                  order_status_code     int
        =                       order_status
        OnlineOrderFlag         is_online_order       flag
        SalesOrderNumber        sales_order_number
        PurchaseOrderNumber     purchase_order_number
        AccountNumber           account_number
        CustomerID              customer_bk           int
        SalesPersonID           sales_person_bk       int
        TerritoryID             sales_territory_bk    int
        BillToAddressID         bill_to_address_bk    int
        ShipToAddressID         ship_to_address_bk    int
        ShipMethodID            ship_method_bk        int
        CreditCardID            credit_card_bk        int
        CreditCardApprovalCode  credit_card_approval_code
        CurrencyRateID          currency_rate_bk      int
        SubTotal                sub_total             money
        TaxAmt                  tax_amount            money
        Freight                 freight               money
        TotalDue                total_due             money
        Comment                 comment
        rowguid                 row_guid
        ModifiedDate            modified_at           leading_timestamp
    """),
    SourceTable("SalesOrderDetail", "sales", "stg_sales_order_detail", ("SalesOrderID", "SalesOrderDetailID"), """
        =                      sales_order_line_bk
        SalesOrderID           sales_order_bk           int
        SalesOrderDetailID     sales_order_detail_bk    int
        CarrierTrackingNumber  carrier_tracking_number
        OrderQty               order_qty                int
        ProductID              product_bk               int
        SpecialOfferID         special_offer_bk         int
        UnitPrice              unit_price               money
        UnitPriceDiscount      unit_price_discount      money
        LineTotal              line_total               total
        rowguid                row_guid
        ModifiedDate           modified_at              leading_timestamp
    """),
    SourceTable("SalesTerritory", "sales", "stg_sales_territory", ("TerritoryID",), """
        TerritoryID        sales_territory_bk   int
        Name               territory_name
        CountryRegionCode  country_region_code
        Group              territory_group
        SalesYTD           sales_ytd            money
        SalesLastYear      sales_last_year      money
        CostYTD            cost_ytd             money
        CostLastYear       cost_last_year       money
        rowguid            row_guid
        ModifiedDate       modified_at          leading_timestamp
    """),
    SourceTable("SalesTerritoryHistory", "sales", "stg_sales_territory_history",
                ("BusinessEntityID", "TerritoryID", "StartDate"), """
        BusinessEntityID  sales_person_bk     int
        TerritoryID       sales_territory_bk  int
        StartDate         start_at            timestamp
        EndDate           end_at              timestamp
        rowguid           row_guid
        ModifiedDate      modified_at         leading_timestamp
    """),
    SourceTable("SalesPerson", "sales", "stg_sales_person", ("BusinessEntityID",), """
        BusinessEntityID  sales_person_bk     int
        TerritoryID       sales_territory_bk  int
        SalesQuota        sales_quota         money
        Bonus             bonus               money
        CommissionPct     commission_pct      rate
        SalesYTD          sales_ytd           money
        SalesLastYear     sales_last_year     money
        rowguid           row_guid
        ModifiedDate      modified_at         leading_timestamp
    """),
    SourceTable("SpecialOffer", "sales", "stg_special_offer", ("SpecialOfferID",), """
        SpecialOfferID  special_offer_bk   int
        Description     offer_description
        DiscountPct     discount_pct       rate
        Type            offer_type
        Category        offer_category
        StartDate       start_at           leading_timestamp
        EndDate         end_at             leading_timestamp
        MinQty          min_qty            int
        MaxQty          max_qty            int
        rowguid         row_guid
        ModifiedDate    modified_at        leading_timestamp
    """),
    SourceTable("SpecialOfferProduct", "sales", "stg_special_offer_product", ("SpecialOfferID", "ProductID"), """
        SpecialOfferID  special_offer_bk  int
        ProductID       product_bk        int
        rowguid         row_guid
        ModifiedDate    modified_at       leading_timestamp
    """),
    SourceTable("ShipMethod", "sales", "stg_ship_method", ("ShipMethodID",), """
        ShipMethodID  ship_method_bk    int
        Name          ship_method_name
        ShipBase      ship_base_cost    money
        ShipRate      ship_rate         money
        rowguid       row_guid
        ModifiedDate  modified_at       leading_timestamp
    """),
    SourceTable("CreditCard", "sales", "stg_credit_card", ("CreditCardID",), """
        CreditCardID  credit_card_bk      int
        CardType      card_type
        CardNumber    card_number_masked  masked
        ExpMonth      exp_month           int
        ExpYear       exp_year            int
        ModifiedDate  modified_at         leading_timestamp
    """),
    SourceTable("Employee", "humanresources", "stg_employee", ("BusinessEntityID",), """
        BusinessEntityID   employee_bk         int
        NationalIDNumber   national_id_number
        LoginID            login_id
        OrganizationNode   organization_node
        OrganizationLevel  organization_level  int
        JobTitle           job_title
        BirthDate          birth_date          date
        MaritalStatus      marital_status
        Gender             gender
        HireDate           hire_date           date
        SalariedFlag       is_salaried         flag
        VacationHours      vacation_hours      int
        SickLeaveHours     sick_leave_hours    int
        CurrentFlag        is_active_employee  flag
        rowguid            row_guid
        ModifiedDate       modified_at         leading_timestamp
    """),
    SourceTable("EmployeePayHistory", "humanresources", "stg_employee_pay_history",
                ("BusinessEntityID", "RateChangeDate"), """
        BusinessEntityID  employee_bk     int
        RateChangeDate    rate_change_at  leading_timestamp
        Rate              pay_rate        money
        PayFrequency      pay_frequency   int
        ModifiedDate      modified_at     leading_timestamp
    """),
    SourceTable("EmployeeDepartmentHistory", "humanresources", "stg_employee_dept_history",
                ("BusinessEntityID", "DepartmentID", "ShiftID", "StartDate"), """
        BusinessEntityID  employee_bk    int
        DepartmentID      department_bk  int
        ShiftID           shift_bk       int
        StartDate         start_date     date
        EndDate           end_date       date
        ModifiedDate      modified_at    leading_timestamp
    """),
    SourceTable("BusinessEntity", "person", "stg_business_entity", ("BusinessEntityID",), """
        BusinessEntityID  business_entity_bk  int
        rowguid           row_guid
        ModifiedDate      modified_at         leading_timestamp
    """, PLUS_PIPE, True),
    SourceTable("BusinessEntityAddress", "person", "stg_business_entity_address",
                ("BusinessEntityID", "AddressID", "AddressTypeID"), """
        BusinessEntityID  business_entity_bk  int
        AddressID         address_bk          int
        AddressTypeID     address_type_id     int
        rowguid           row_guid
        ModifiedDate      modified_at         leading_timestamp
    """, PLUS_PIPE, True),
    SourceTable("Person", "person", "stg_person", ("BusinessEntityID",), """
        BusinessEntityID       person_bk              int
        PersonType             person_type
        NameStyle              is_eastern_name_style  flag
        Title                  title
        FirstName              first_name
        MiddleName             middle_name
        LastName               last_name
        Suffix                 suffix
        =                      full_name
        EmailPromotion         email_promotion_flag   int
        AdditionalContactInfo  -
        Demographics           -
        rowguid                row_guid
        ModifiedDate           modified_at            leading_timestamp
    """, PLUS_PIPE, True),
    SourceTable("Address", "person", "stg_address", ("AddressID",), """
        AddressID        address_bk            int
        AddressLine1     address_line_1
        AddressLine2     address_line_2
        City             city
        StateProvinceID  state_province_bk     int
        PostalCode       postal_code
        SpatialLocation  spatial_location_raw
        rowguid          row_guid
        ModifiedDate     modified_at           leading_timestamp
    """),
    SourceTable("StateProvince", "person", "stg_state_province", ("StateProvinceID",), """
        StateProvinceID          state_province_bk       int
        StateProvinceCode        state_province_code
        CountryRegionCode        country_region_code
        IsOnlyStateProvinceFlag  is_only_state_province  flag
        Name                     state_province_name
        TerritoryID              sales_territory_bk      int
        rowguid                  -
        ModifiedDate             modified_at             leading_timestamp
    """),
    SourceTable("Product", "production", "stg_product", ("ProductID",), """
        ProductID              product_bk              int
        Name                   product_name
        ProductNumber          product_number
        MakeFlag               is_make                 flag
        FinishedGoodsFlag      is_finished_good        flag
        Color                  color
        SafetyStockLevel       safety_stock_level      int
        ReorderPoint           reorder_point           int
        StandardCost           standard_cost           money
        ListPrice              list_price              money
        Size                   size
        SizeUnitMeasureCode    size_uom_code
        WeightUnitMeasureCode  weight_uom_code
        Weight                 weight                  weight
        DaysToManufacture      days_to_manufacture     int
        ProductLine            product_line            trimmed
        Class                  product_class           trimmed
        Style                  product_style           trimmed
        ProductSubcategoryID   product_subcategory_bk  int
        ProductModelID         product_model_bk        int
        SellStartDate          sell_start_at           timestamp
        SellEndDate            sell_end_at             timestamp
        DiscontinuedDate       discontinued_at         timestamp
        rowguid                row_guid
        ModifiedDate           modified_at             leading_timestamp
    """),
    SourceTable("ProductSubcategory", "production", "stg_product_subcategory", ("ProductSubcategoryID",), """
        ProductSubcategoryID  product_subcategory_bk  int
        ProductCategoryID     product_category_bk     int
        Name                  subcategory_name
        rowguid               row_guid
        ModifiedDate          modified_at             leading_timestamp
    """),
    SourceTable("ProductCategory", "production", "stg_product_category", ("ProductCategoryID",), """
        ProductCategoryID  product_category_bk  int
        Name               category_name
        rowguid            row_guid
        ModifiedDate       modified_at          leading_timestamp
    """),
    SourceTable("Store", "sales", "stg_store", ("BusinessEntityID",), """
        BusinessEntityID  store_bk         int
        Name              store_name
        SalesPersonID     sales_person_bk  int
        Demographics      -
        rowguid           row_guid
        ModifiedDate      modified_at      leading_timestamp
    """, PLUS_PIPE),
]

# Load-time service levels in hours: (warn, error).
FRESHNESS_HOURS = {"sales": (24, 48), "person": (24, 48)}
FRESHNESS_HOURS_BY_TABLE = {"StateProvince": (7 * 24, 30 * 24)}

# --- end of fixed values ------------------------------------------------------

SOURCES: dict[str, SourceTable] = {t.name: t for t in _TABLES}


def freshness_hours(table: str) -> tuple[int, int] | None:
    """Service level of a table: its own, else its domain's, else none."""
    return FRESHNESS_HOURS_BY_TABLE.get(table) or FRESHNESS_HOURS.get(SOURCES[table].domain)
