"""A small landed warehouse: every table, written the way the extracts look."""

from terrace.sources.registry import SOURCES

STAMP = "2013-07-31 00:00:00.000000000"


def person(key, kind="IN", **kw):
    return {"BusinessEntityID": key, "PersonType": kind, "NameStyle": 0, "FirstName": f"First{key}",
            "LastName": f"Last{key}", "EmailPromotion": 0, "rowguid": f"P{key}", **kw}


def order(key, date, **kw):
    return {"SalesOrderID": key, "RevisionNumber": 8, "OrderDate": f"{date} 00:00:00",
            "DueDate": f"{date} 12:00:00", "ShipDate": f"{date} 06:00:00", "Status": 5, "OnlineOrderFlag": 0,
            "SalesOrderNumber": f"SO{key}", "CustomerID": 1, "SalesPersonID": 274, "TerritoryID": 1,
            "ShipMethodID": 5, "CreditCardID": 11, "SubTotal": "100.0000", "TaxAmt": "8.0000",
            "Freight": "2.5000", "TotalDue": "110.5000", "rowguid": f"H{key}", **kw}


def line(key, detail, total, **kw):
    return {"SalesOrderID": key, "SalesOrderDetailID": detail, "OrderQty": 1, "ProductID": 707,
            "SpecialOfferID": 1, "UnitPrice": f"{total}", "UnitPriceDiscount": "0.0000",
            "LineTotal": f"{total}", "rowguid": f"D{detail}", **kw}


def product(key, **kw):
    return {"ProductID": key, "Name": f"Product {key}", "ProductNumber": f"PN-{key}", "MakeFlag": 1,
            "FinishedGoodsFlag": 1, "Color": "Red", "SafetyStockLevel": 4, "ReorderPoint": 3,
            "StandardCost": "4.0000", "ListPrice": "9.0000", "DaysToManufacture": 0, "ProductLine": "R ",
            "Class": "H ", "Style": "U ", "ProductSubcategoryID": 31, "SellStartDate": "2011-05-31 00:00:00",
            "rowguid": f"R{key}", **kw}


def base_tables():
    return {
        "Customer": [
            {"CustomerID": 1, "PersonID": 101, "TerritoryID": 1, "AccountNumber": "AW00000001", "rowguid": "C1"},
            {"CustomerID": 2, "StoreID": 201, "TerritoryID": 1, "AccountNumber": "AW00000002", "rowguid": "C2"},
            {"CustomerID": 3, "PersonID": 102, "StoreID": 201, "TerritoryID": 2, "AccountNumber": "AW00000003",
             "rowguid": "C3"},
            {"CustomerID": 4, "AccountNumber": "AW00000004", "rowguid": "C4"},
        ],
        "SalesOrderHeader": [
            order(1, "2011-05-31"),
            order(2, "2012-07-12", SalesPersonID=None, OnlineOrderFlag=1, CreditCardID=None, CustomerID=3,
                  ShipDate=None, DueDate="2014-07-12 00:00:00"),
            order(3, "2012-07-20", RevisionNumber=None, SubTotal="0.0000"),
            # the same order landed twice: the later change wins
            order(1, "2011-05-31", Status=1, ModifiedDate="2011-01-01 00:00:00"),
            order(4, "2012-08-01"),
        ],
        "SalesOrderDetail": [
            line(1, 1, "10.000000"),
            line(1, 2, "20.000000"),
            line(1, 3, "70.000000"),
            line(2, 4, "50.000000", ProductID=708, OrderQty=2, UnitPrice="27.5000", SpecialOfferID=2,
                 UnitPriceDiscount="0.1000"),
            line(3, 5, "0.000000", UnitPrice="5.0000", UnitPriceDiscount="1.0000"),
            line(99, 6, "5.000000"),
        ],
        "SalesTerritory": [
            {"TerritoryID": 1, "Name": "Northwest", "CountryRegionCode": "US", "Group": "North America",
             "SalesYTD": "7.5", "SalesLastYear": "3", "CostYTD": "0", "CostLastYear": "0", "rowguid": "T1"},
            {"TerritoryID": 2, "Name": "Germany", "CountryRegionCode": "DE", "Group": "Europe",
             "SalesYTD": "1", "SalesLastYear": "1", "CostYTD": "0", "CostLastYear": "0", "rowguid": "T2"},
        ],
        "SalesTerritoryHistory": [
            {"BusinessEntityID": 274, "TerritoryID": 1, "StartDate": "2011-05-31 00:00:00", "rowguid": "TH1"},
            {"BusinessEntityID": 275, "TerritoryID": 1, "StartDate": "2012-05-31 00:00:00", "rowguid": "TH2"},
            {"BusinessEntityID": 275, "TerritoryID": 2, "StartDate": "2011-05-31 00:00:00",
             "EndDate": "2012-05-30 00:00:00", "rowguid": "TH3"},
        ],
        "SalesPerson": [
            {"BusinessEntityID": 274, "TerritoryID": 1, "Bonus": "0", "CommissionPct": "0.012", "SalesYTD": "5",
             "SalesLastYear": "0", "rowguid": "SP1"},
            {"BusinessEntityID": 275, "TerritoryID": 1, "Bonus": "0", "CommissionPct": "0.01", "SalesYTD": "5",
             "SalesLastYear": "0", "rowguid": "SP2"},
        ],
        "SpecialOffer": [
            {"SpecialOfferID": 1, "Description": "None", "DiscountPct": "0.0000", "Type": "No Discount",
             "Category": "No Discount", "StartDate": STAMP, "EndDate": "2014-11-30 00:00:00.0", "MinQty": 0,
             "rowguid": "O1"},
            {"SpecialOfferID": 2, "Description": "Volume", "DiscountPct": "0.1000", "Type": "Volume",
             "Category": "Reseller", "StartDate": "2011-05-31 00:00:00", "EndDate": "2012-05-30 00:00:00",
             "MinQty": 2, "MaxQty": 9, "rowguid": "O2"},
        ],
        "SpecialOfferProduct": [
            {"SpecialOfferID": 1, "ProductID": 707, "rowguid": "OP1"},
            {"SpecialOfferID": 1, "ProductID": 708, "rowguid": "OP2"},
        ],
        "ShipMethod": [{"ShipMethodID": 5, "Name": "CARGO", "ShipBase": "8.99", "ShipRate": "1.49", "rowguid": "S5"}],
        "CreditCard": [
            {"CreditCardID": 11, "CardType": "Vista", "CardNumber": "11112222333344", "ExpMonth": 11, "ExpYear": 2026},
        ],
        "Employee": [
            {"BusinessEntityID": key, "NationalIDNumber": f"N{key}", "LoginID": f"login{key}",
             "OrganizationNode": "/1/", "OrganizationLevel": 1, "JobTitle": "Sales Representative",
             "BirthDate": "1980-01-01", "MaritalStatus": "S", "Gender": "F", "HireDate": "2011-01-04",
             "SalariedFlag": 1, "VacationHours": 14, "SickLeaveHours": 27, "CurrentFlag": 1, "rowguid": f"E{key}"}
            for key in (274, 275)
        ],
        "EmployeePayHistory": [
            {"BusinessEntityID": 274, "RateChangeDate": "2011-01-04 00:00:00.0", "Rate": "20.5", "PayFrequency": 2},
            {"BusinessEntityID": 274, "RateChangeDate": "2013-01-04 00:00:00.0", "Rate": "23.0769",
             "PayFrequency": 2},
        ],
        "EmployeeDepartmentHistory": [
            {"BusinessEntityID": 274, "DepartmentID": 3, "ShiftID": 1, "StartDate": "2011-01-04"},
            {"BusinessEntityID": 274, "DepartmentID": 4, "ShiftID": 1, "StartDate": "2010-01-04"},
            {"BusinessEntityID": 275, "DepartmentID": 3, "ShiftID": 1, "StartDate": "2011-01-04",
             "EndDate": "2012-01-01"},
        ],
        "BusinessEntity": [{"BusinessEntityID": key, "rowguid": f"B{key}"} for key in (101, 102, 201, 274, 275)],
        "BusinessEntityAddress": [
            {"BusinessEntityID": 101, "AddressID": 1, "AddressTypeID": 1, "rowguid": "BA1"},
            {"BusinessEntityID": 101, "AddressID": 2, "AddressTypeID": 2, "rowguid": "BA2"},
            {"BusinessEntityID": 102, "AddressID": 1, "AddressTypeID": 2, "rowguid": "BA3"},
            {"BusinessEntityID": 102, "AddressID": 2, "AddressTypeID": 2, "rowguid": "BA4"},
        ],
        "Person": [
            person(101, MiddleName="B", Suffix="Jr."),
            person(102, "SC", Demographics="<x>two\nlines</x>"),
            person(274, "SP"),
            person(275, "SP"),
        ],
        "Address": [
            {"AddressID": 1, "AddressLine1": "1 Main", "City": "Bothell", "StateProvinceID": 79,
             "PostalCode": "98011", "rowguid": "A1"},
            {"AddressID": 2, "AddressLine1": "2 Side", "City": "Berlin", "StateProvinceID": 80,
             "PostalCode": "10115", "rowguid": "A2", "ModifiedDate": "2014-01-01 00:00:00.0"},
        ],
        "StateProvince": [
            {"StateProvinceID": 79, "StateProvinceCode": "WA", "CountryRegionCode": "US",
             "IsOnlyStateProvinceFlag": 0, "Name": "Washington", "TerritoryID": 1, "rowguid": "SP79"},
            {"StateProvinceID": 80, "StateProvinceCode": "BE", "CountryRegionCode": "DE",
             "IsOnlyStateProvinceFlag": 0, "Name": "Berlin", "TerritoryID": 2, "rowguid": "SP80"},
        ],
        "Product": [
            product(707),
            product(708, ProductSubcategoryID=None, SellEndDate="2012-05-29 00:00:00"),
            product(709, DiscontinuedDate="2013-01-01 00:00:00", ProductLine=None),
        ],
        "ProductSubcategory": [{"ProductSubcategoryID": 31, "ProductCategoryID": 4, "Name": "Helmets",
                                "rowguid": "PS31"}],
        "ProductCategory": [{"ProductCategoryID": 4, "Name": "Accessories", "rowguid": "PC4"}],
        "Store": [{"BusinessEntityID": 201, "Name": "Corner Shop", "SalesPersonID": 274, "rowguid": "ST201"}],
    }


def write_landing(folder, tables):
    """One file per table, in column order, without a header."""
    for name, spec in SOURCES.items():
        out = []
        for row in tables[name]:
            full = {"ModifiedDate": STAMP, **row}
            stray = set(full) - set(spec.columns)
            assert not stray, (name, stray)
            values = ["" if full.get(c) is None else str(full[c]) for c in spec.columns]
            if spec.multiline:
                values = [f'"{v}"' if "\n" in v else v for v in values]
            out.append(spec.separator.join(values))
        (folder / f"{name}.csv").write_text("\n".join(out) + "\n", encoding="utf-8")
    return str(folder)
