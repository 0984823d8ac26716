"""Checks on the landed text tables. Fixed values."""

from ..suite import accepted, contract, key, not_null, related, together

LANDED = {
    "Customer": contract(
        key("CustomerID"),
        related("PersonID", "Person.BusinessEntityID"),
        related("StoreID", "Store.BusinessEntityID"),
        related("TerritoryID", "SalesTerritory.TerritoryID"),
    ),
    "SalesOrderHeader": contract(
        key("SalesOrderID"),
        accepted("Status", 1, 2, 3, 4, 5, 6),
        accepted("OnlineOrderFlag", 0, 1),
        related("CustomerID", "Customer.CustomerID"),
        related("SalesPersonID", "SalesPerson.BusinessEntityID"),
        related("TerritoryID", "SalesTerritory.TerritoryID"),
        related("ShipMethodID", "ShipMethod.ShipMethodID"),
    ),
    "SalesOrderDetail": contract(
        not_null("SalesOrderID", "SalesOrderDetailID"),
        related("SalesOrderID", "SalesOrderHeader.SalesOrderID"),
        related("ProductID", "Product.ProductID"),
        related("SpecialOfferID", "SpecialOffer.SpecialOfferID"),
        together("SalesOrderID", "SalesOrderDetailID"),
    ),
    "SalesTerritory": contract(key("TerritoryID")),
    "SalesTerritoryHistory": contract(
        not_null("BusinessEntityID", "TerritoryID", "StartDate"),
        related("BusinessEntityID", "SalesPerson.BusinessEntityID"),
        related("TerritoryID", "SalesTerritory.TerritoryID"),
    ),
    "SalesPerson": contract(
        key("BusinessEntityID"),
        related("BusinessEntityID", "Employee.BusinessEntityID"),
        related("TerritoryID", "SalesTerritory.TerritoryID"),
    ),
    "SpecialOffer": contract(key("SpecialOfferID")),
    "SpecialOfferProduct": contract(
        not_null("SpecialOfferID", "ProductID"),
        related("SpecialOfferID", "SpecialOffer.SpecialOfferID"),
        related("ProductID", "Product.ProductID"),
        together("SpecialOfferID", "ProductID"),
    ),
    "ShipMethod": contract(key("ShipMethodID")),
    "CreditCard": contract(key("CreditCardID")),
    "Store": contract(
        key("BusinessEntityID"),
        related("BusinessEntityID", "BusinessEntity.BusinessEntityID"),
        related("SalesPersonID", "SalesPerson.BusinessEntityID"),
    ),
    "Employee": contract(
        key("BusinessEntityID"),
        related("BusinessEntityID", "BusinessEntity.BusinessEntityID"),
        accepted("MaritalStatus", "M", "S"),
        accepted("Gender", "M", "F"),
        accepted("SalariedFlag", 0, 1),
        accepted("CurrentFlag", 0, 1),
    ),
    "EmployeePayHistory": contract(
        not_null("BusinessEntityID", "RateChangeDate"),
        related("BusinessEntityID", "Employee.BusinessEntityID"),
        accepted("PayFrequency", 1, 2),
    ),
    "EmployeeDepartmentHistory": contract(
        not_null("BusinessEntityID", "DepartmentID", "ShiftID", "StartDate"),
        related("BusinessEntityID", "Employee.BusinessEntityID"),
    ),
    "BusinessEntity": contract(key("BusinessEntityID"), not_null("ModifiedDate")),
    "Person": contract(
        key("BusinessEntityID"),
        related("BusinessEntityID", "BusinessEntity.BusinessEntityID"),
        not_null("PersonType", "FirstName", "LastName", "EmailPromotion", "ModifiedDate"),
        accepted("PersonType", "SC", "IN", "SP", "EM", "VC", "GC"),
        accepted("NameStyle", 0, 1),
        accepted("EmailPromotion", 0, 1, 2),
    ),
    "Address": contract(
        key("AddressID"),
        not_null("AddressLine1", "City", "StateProvinceID", "PostalCode", "ModifiedDate"),
        related("StateProvinceID", "StateProvince.StateProvinceID"),
    ),
    "StateProvince": contract(
        key("StateProvinceID"),
        not_null("StateProvinceCode", "CountryRegionCode", "IsOnlyStateProvinceFlag", "Name", "TerritoryID",
                 "ModifiedDate"),
        accepted("IsOnlyStateProvinceFlag", 0, 1),
        related("TerritoryID", "SalesTerritory.TerritoryID"),
    ),
    "BusinessEntityAddress": contract(
        not_null("BusinessEntityID", "AddressID", "AddressTypeID", "ModifiedDate"),
        related("BusinessEntityID", "BusinessEntity.BusinessEntityID"),
        related("AddressID", "Address.AddressID"),
        accepted("AddressTypeID", 1, 2, 3, 4, 5, 6),
    ),
    "Product": contract(
        key("ProductID"),
        not_null("ProductNumber"),
        accepted("MakeFlag", 0, 1),
        accepted("FinishedGoodsFlag", 0, 1),
        related("ProductSubcategoryID", "ProductSubcategory.ProductSubcategoryID"),
    ),
    "ProductSubcategory": contract(
        key("ProductSubcategoryID"),
        not_null("ProductCategoryID"),
        related("ProductCategoryID", "ProductCategory.ProductCategoryID"),
    ),
    "ProductCategory": contract(key("ProductCategoryID")),
}
