"""Wholesale, raw to clean: 13 loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bodega.functions.amounts import line_amounts, money, split_by_flag
from bodega.functions.dates import NEVER_LOADED, moment
from bodega.functions.text import clean_email, clean_postal_code, clean_text, substitute
from bodega.operators.joins import q
from bodega.plans.entity import MAIN, CleanLoad, Sources, arrange, nothing

# Text for a missing attribute, renamed payment method, offset of supplier transactions.
NOT_AVAILABLE = "N/A"
RENAMED = ("CHECK", "CHEQUE")
SUPPLIER_OFFSET = 1_000_000

KEPT = "ValidFrom, ValidTo"


def _or_na(c: str) -> Column:
    return F.coalesce(clean_text(c), F.lit(NOT_AVAILABLE))


def _day_or_never(c: str) -> Column:
    return F.coalesce(q(c).cast("timestamp_ntz"), moment(NEVER_LOADED)).cast("date")


def _rounded(c: str, places: int, kind: str) -> Column:
    return F.round(q(c), places).cast(kind)


def _people(s: Sources) -> DataFrame:
    return s("Application.People").select(q("PersonID").alias("PrimaryContactPersonID"), q("FullName").alias("Contact"))


def city(s: Sources) -> DataFrame:
    states = s("Application.StateProvinces", "StateProvinceID, StateProvinceName, SalesTerritory, CountryID")
    countries = s("Application.Countries", "CountryID, CountryName, Continent, Region, Subregion")
    rows = s.fresh("Application.Cities", "CityID").join(states, "StateProvinceID").join(countries, "CountryID")
    return arrange(rows, f"""CityID > WWI City ID, CityName > City, StateProvinceName > State Province, CountryName > Country,
        Continent, SalesTerritory, Region, Subregion, Location, = Latest Recorded Population, {KEPT}""",
        {"Latest Recorded Population": F.coalesce(q("LatestRecordedPopulation"), F.lit(0).cast("bigint"))})


def customer(s: Sources) -> DataFrame:
    payer = s("Sales.Customers").select(q("CustomerID").alias("BillToCustomerID"), q("CustomerName").alias("Payer"))
    rows = (
        s.fresh("Sales.Customers", "CustomerID")
        .join(payer, "BillToCustomerID", "left")
        .join(s("Sales.CustomerCategories", "CustomerCategoryID, CustomerCategoryName"), "CustomerCategoryID", "left")
        .join(s("Sales.BuyingGroups", "BuyingGroupID, BuyingGroupName"), "BuyingGroupID", "left")
        .join(_people(s), "PrimaryContactPersonID", "left")
    )
    return arrange(rows, f"""CustomerID > WWI Customer ID, CustomerName > Customer, Payer > Bill To Customer,
        CustomerCategoryName > Category, = Buying Group, Contact > Primary Contact, = Postal Code, {KEPT}""",
        {"Buying Group": _or_na("BuyingGroupName"), "Postal Code": clean_postal_code("PostalPostalCode")})


def employee(s: Sources) -> DataFrame:
    staff = s.fresh("Application.People", "PersonID").filter(q("IsEmployee"))
    return arrange(staff, f"PersonID > WWI Employee ID, FullName > Employee, = Preferred Name, IsSalesperson, Photo, {KEPT}",
                   {"Preferred Name": clean_email("PreferredName")})


def payment_method(s: Sources) -> DataFrame:
    return arrange(s.fresh("Application.PaymentMethods", "PaymentMethodID"),
                   f"PaymentMethodID > WWI Payment Method ID, = Payment Method, {KEPT}",
                   {"Payment Method": substitute("PaymentMethodName", *RENAMED)})


def stock_item(s: Sources) -> DataFrame:
    def package(role: str) -> DataFrame:
        return s("Warehouse.PackageTypes").select(q("PackageTypeID").alias(f"{role}PackageID"), q("PackageTypeName").alias(f"{role}Package"))

    rows = (
        s.fresh("Warehouse.StockItems", "StockItemID")
        .join(s("Warehouse.Colors", "ColorID, ColorName"), "ColorID", "left")
        .join(package("Outer"), "OuterPackageID", "left")
        .join(package("Unit"), "UnitPackageID", "left")
    )
    return arrange(rows, f"""StockItemID > WWI Stock Item ID, StockItemName > Stock Item, = Color,
        OuterPackage > Selling Package, UnitPackage > Buying Package, = Brand, = Size, LeadTimeDays, QuantityPerOuter,
        IsChillerStock, = Barcode, = Tax Rate, = Unit Price, = Recommended Retail Price, = Typical Weight Per Unit, Photo,
        {KEPT}""", {
        "Color": _or_na("ColorName"), "Brand": _or_na("Brand"), "Size": _or_na("Size"), "Barcode": q("Barcode"),
        "Tax Rate": _rounded("TaxRate", 3, "decimal(18,3)"), "Unit Price": _rounded("UnitPrice", 2, "decimal(18,2)"),
        "Recommended Retail Price": _rounded("RecommendedRetailPrice", 2, "decimal(18,2)"),
        "Typical Weight Per Unit": _rounded("TypicalWeightPerUnit", 3, "decimal(18,3)"),
    })


def supplier(s: Sources) -> DataFrame:
    rows = (
        s.fresh("Purchasing.Suppliers", "SupplierID")
        .join(s("Purchasing.SupplierCategories", "SupplierCategoryID, SupplierCategoryName"), "SupplierCategoryID", "left")
        .join(_people(s), "PrimaryContactPersonID", "left")
    )
    return arrange(rows, f"""SupplierID > WWI Supplier ID, SupplierName > Supplier, SupplierCategoryName > Category,
        Contact > Primary Contact, = Supplier Reference, PaymentDays, = Postal Code, {KEPT}""",
        {"Supplier Reference": q("SupplierReference"), "Postal Code": clean_postal_code("PostalPostalCode")})


def transaction_type(s: Sources) -> DataFrame:
    return arrange(s.fresh("Application.TransactionTypes", "TransactionTypeID"),
                   f"TransactionTypeID > WWI Transaction Type ID, TransactionTypeName > Transaction Type, {KEPT}")


def stock_holding(s: Sources) -> DataFrame:
    return arrange(s("Warehouse.StockItemHoldings"), """StockItemID > WWI Stock Item ID, QuantityOnHand, BinLocation,
        LastStocktakeQuantity, = Last Cost Price, ReorderLevel, TargetStockLevel""",
        {"Last Cost Price": _rounded("LastCostPrice", 2, "decimal(18,2)")})


def movement(s: Sources) -> DataFrame:
    return arrange(s.fresh("Warehouse.StockItemTransactions", "TransactionOccurredWhen"), """= Date Key,
        StockItemID > WWI Stock Item ID, CustomerID > WWI Customer ID, SupplierID > WWI Supplier ID,
        TransactionTypeID > WWI Transaction Type ID, StockItemTransactionID > WWI Stock Item Transaction ID,
        InvoiceID > WWI Invoice ID, PurchaseOrderID > WWI Purchase Order ID, Quantity""",
        {"Date Key": q("TransactionOccurredWhen").cast("date")})


def order(s: Sources) -> DataFrame:
    header = s.fresh("Sales.Orders", "OrderDate")
    rows = header.join(s("Sales.OrderLines"), "OrderID").join(s("Warehouse.PackageTypes", "PackageTypeID, PackageTypeName"), "PackageTypeID")
    return arrange(rows, """CustomerID > WWI Customer ID, StockItemID > WWI Stock Item ID, SalespersonPersonID > WWI Salesperson ID,
        PickedByPersonID > WWI Picker ID, OrderID > WWI Order ID, BackorderOrderID > WWI Backorder ID, = Order Date Key,
        = Picked Date Key, Description, PackageTypeName > Package, Quantity, = Unit Price, = Tax Rate, = Total Excluding Tax,
        = Tax Amount, = Total Including Tax""", {
        "Order Date Key": q("OrderDate").cast("date"), "Picked Date Key": _day_or_never("PickingCompletedWhen"),
        "Unit Price": _rounded("UnitPrice", 2, "decimal(18,2)"), "Tax Rate": _rounded("TaxRate", 2, "decimal(18,3)"),
        **line_amounts("Quantity", "UnitPrice", "TaxRate"),
    })


def purchase(s: Sources) -> DataFrame:
    rows = (
        s.fresh("Purchasing.PurchaseOrders", "OrderDate")
        .join(s("Purchasing.PurchaseOrderLines"), "PurchaseOrderID")
        .join(s("Warehouse.StockItems", "StockItemID, QuantityPerOuter"), "StockItemID")
        .join(s("Warehouse.PackageTypes", "PackageTypeID, PackageTypeName"), "PackageTypeID")
    )
    return arrange(rows, """= Date Key, SupplierID > WWI Supplier ID, StockItemID > WWI Stock Item ID,
        PurchaseOrderID > WWI Purchase Order ID, OrderedOuters, = Ordered Quantity, ReceivedOuters,
        PackageTypeName > Package, IsOrderFinalized""", {
        "Date Key": q("OrderDate").cast("date"), "Ordered Quantity": q("OrderedOuters") * q("QuantityPerOuter"),
    })


def sale(s: Sources, corrected: bool = False) -> DataFrame:
    """Invoice lines. The net total repeats the line profit, as the warehouse has always shown it; with
    `corrected` it is the extended price without tax."""
    rows = (
        s.fresh("Sales.Invoices", "InvoiceDate")
        .join(s("Sales.InvoiceLines"), "InvoiceID")
        .join(s("Warehouse.StockItems", "StockItemID, IsChillerStock"), "StockItemID")
        .join(s("Warehouse.PackageTypes", "PackageTypeID, PackageTypeName"), "PackageTypeID")
    )
    gross, profit, tax = (_rounded(c, 2, "decimal(18,2)") for c in ("ExtendedPrice", "LineProfit", "TaxAmount"))
    dry, chilled = split_by_flag(gross, "IsChillerStock")
    return arrange(rows, """CustomerID > WWI Customer ID, BillToCustomerID > WWI Bill To Customer ID,
        StockItemID > WWI Stock Item ID, SalespersonPersonID > WWI Salesperson ID, = Invoice Date Key, = Delivery Date Key,
        InvoiceID > WWI Invoice ID, Description, PackageTypeName > Package, Quantity, = Unit Price, = Tax Rate,
        = Total Excluding Tax, = Tax Amount, = Profit, = Total Including Tax, = Total Dry Items, = Total Chiller Items""", {
        "Invoice Date Key": q("InvoiceDate").cast("date"), "Delivery Date Key": _day_or_never("ConfirmedDeliveryTime"),
        "Unit Price": _rounded("UnitPrice", 2, "decimal(18,2)"), "Tax Rate": _rounded("TaxRate", 2, "decimal(18,3)"),
        "Total Excluding Tax": money(gross - tax) if corrected else profit, "Tax Amount": tax, "Profit": profit,
        "Total Including Tax": gross, "Total Dry Items": dry, "Total Chiller Items": chilled,
    })


def transaction(s: Sources) -> DataFrame:
    """Customer and supplier transactions, each cut at its own watermark."""
    def side(table: str, part: str, layout: str, given: dict[str, Column]) -> DataFrame:
        amount, tax = q("TransactionAmount"), q("TaxAmount")
        return arrange(s.fresh(table, "TransactionDate", part), f"""= Date Key, {layout}, TransactionTypeID > WWI Transaction Type ID,
            PaymentMethodID > WWI Payment Method ID, = Total Excluding Tax, = Tax Amount, = Total Including Tax,
            = Outstanding Balance, IsFinalized""", {
            "Date Key": q("TransactionDate").cast("date"), "Total Excluding Tax": money(F.round(amount, 2)),
            "Tax Amount": money(F.round(tax, 2)), "Total Including Tax": money(F.round(amount + tax, 2)),
            "Outstanding Balance": money(F.round(q("OutstandingBalance"), 2)), **given,
        })

    customers = side("Sales.CustomerTransactions", "customer", """CustomerID > WWI Customer ID, = WWI Bill To Customer ID,
        CustomerTransactionID > WWI Customer Transaction ID, InvoiceID > WWI Invoice ID""", {"WWI Bill To Customer ID": nothing("int")})
    suppliers = side("Purchasing.SupplierTransactions", "supplier", """SupplierID > WWI Supplier ID,
        = WWI Supplier Transaction ID, PurchaseOrderID > WWI Purchase Order ID""",
        {"WWI Supplier Transaction ID": q("SupplierTransactionID") + F.lit(SUPPLIER_OFFSET)})
    return customers.unionByName(suppliers, allowMissingColumns=True)


def _dated(target: str, build, table: str, column: str, ident: str) -> CleanLoad:
    return CleanLoad(target, build, ident, by="control", control_dates={MAIN: (table, column)}, validity=False)


LOADS = {
    load.target: load
    for load in (
        CleanLoad("City_Staging", city, "WWI City ID", validity=False),
        CleanLoad("Customer_Staging", customer, "WWI Customer ID", validity=False),
        CleanLoad("Employee_Staging", employee, "WWI Employee ID", validity=False),
        CleanLoad("PaymentMethod_Staging", payment_method, "WWI Payment Method ID", validity=False),
        CleanLoad("StockItem_Staging", stock_item, "WWI Stock Item ID", validity=False),
        CleanLoad("Supplier_Staging", supplier, "WWI Supplier ID", validity=False),
        CleanLoad("TransactionType_Staging", transaction_type, "WWI Transaction Type ID", validity=False),
        CleanLoad("StockHolding_Staging", stock_holding, by="none", validity=False),
        _dated("Movement_Staging", movement, "Warehouse.StockItemTransactions", "TransactionOccurredWhen", "WWI Stock Item Transaction ID"),
        _dated("Order_Staging", order, "Sales.Orders", "OrderDate", "WWI Order ID"),
        _dated("Purchase_Staging", purchase, "Purchasing.PurchaseOrders", "OrderDate", "WWI Purchase Order ID"),
        _dated("Sale_Staging", sale, "Sales.Invoices", "InvoiceDate", "WWI Invoice ID"),
        CleanLoad("Transaction_Staging", transaction, by="control", validity=False, control_dates={
            "customer": ("Sales.CustomerTransactions", "TransactionDate"),
            "supplier": ("Purchasing.SupplierTransactions", "TransactionDate"),
        }),
    )
}
