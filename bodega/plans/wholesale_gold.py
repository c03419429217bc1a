"""Wholesale, clean to star schema: 7 dimensions and 6 facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bodega.plans.entity import nothing
from bodega.plans.star import Dimension, FactLoad, Star, fact_rows

CUSTOMER, ITEM, EMPLOYEE, SUPPLIER = "Dimension.Customer", "Dimension.Stock Item", "Dimension.Employee", "Dimension.Supplier"
KIND, METHOD = "Dimension.Transaction Type", "Dimension.Payment Method"

DIMENSIONS = {
    d.target: d
    for d in (
        Dimension("Dimension.City", "City_Staging", "City Key", ("WWI City ID",)),
        Dimension(CUSTOMER, "Customer_Staging", "Customer Key", ("WWI Customer ID",), {"Category": None, "Buying Group": ""}),
        Dimension(EMPLOYEE, "Employee_Staging", "Employee Key", ("WWI Employee ID",)),
        Dimension(METHOD, "PaymentMethod_Staging", "Payment Method Key", ("WWI Payment Method ID",)),
        Dimension(ITEM, "StockItem_Staging", "Stock Item Key", ("WWI Stock Item ID",), {"Unit Price": 0, "Recommended Retail Price": 0}),
        Dimension(SUPPLIER, "Supplier_Staging", "Supplier Key", ("WWI Supplier ID",), {"Category": None}),
        Dimension(KIND, "TransactionType_Staging", "Transaction Type Key", ("WWI Transaction Type ID",)),
    )
}

# How each surrogate key is found: fact key -> (dimension, staging id, dimension id, dimension key).
ROLES: dict[str, tuple[str, str, str, str]] = {
    "Customer Key": (CUSTOMER, "WWI Customer ID", "WWI Customer ID", "Customer Key"),
    "Bill To Customer Key": (CUSTOMER, "WWI Bill To Customer ID", "WWI Customer ID", "Customer Key"),
    "Stock Item Key": (ITEM, "WWI Stock Item ID", "WWI Stock Item ID", "Stock Item Key"),
    "Supplier Key": (SUPPLIER, "WWI Supplier ID", "WWI Supplier ID", "Supplier Key"),
    "Salesperson Key": (EMPLOYEE, "WWI Salesperson ID", "WWI Employee ID", "Employee Key"),
    "Picker Key": (EMPLOYEE, "WWI Picker ID", "WWI Employee ID", "Employee Key"),
    "Transaction Type Key": (KIND, "WWI Transaction Type ID", "WWI Transaction Type ID", "Transaction Type Key"),
    "Payment Method Key": (METHOD, "WWI Payment Method ID", "WWI Payment Method ID", "Payment Method Key"),
}


def _keys(g: Star, rows: DataFrame, *roles: str) -> DataFrame:
    for role in roles:
        dimension, own, business, key = ROLES[role]
        rows = g.key(rows, dimension, (own, business), {role: key})
    return rows


def stock_holding(g: Star) -> DataFrame:
    return fact_rows(_keys(g, g.all("StockHolding_Staging"), "Stock Item Key"), """Stock Item Key, Quantity On Hand, Bin Location,
        Last Stocktake Quantity, Last Cost Price, Reorder Level, Target Stock Level""")


def movement(g: Star) -> DataFrame:
    rows = g.fresh("Movement_Staging", "WWI Stock Item Transaction ID")
    return fact_rows(_keys(g, rows, "Stock Item Key", "Customer Key", "Supplier Key", "Transaction Type Key"), """Date Key,
        Stock Item Key, Customer Key, Supplier Key, Transaction Type Key, WWI Stock Item Transaction ID, WWI Invoice ID,
        WWI Purchase Order ID, Quantity""")


def order(g: Star) -> DataFrame:
    rows = _keys(g, g.fresh("Order_Staging", "WWI Order ID"), "Customer Key", "Stock Item Key", "Salesperson Key", "Picker Key")
    return fact_rows(rows, """= City Key, Customer Key, Stock Item Key, Order Date Key, Picked Date Key, Salesperson Key, Picker Key,
        WWI Order ID, WWI Backorder ID, Description, Package, Quantity, Unit Price, Tax Rate, Total Excluding Tax, Tax Amount,
        Total Including Tax""", {"City Key": F.lit(0)})


def purchase(g: Star) -> DataFrame:
    rows = _keys(g, g.fresh("Purchase_Staging", "WWI Purchase Order ID"), "Supplier Key", "Stock Item Key")
    return fact_rows(rows, """Date Key, Supplier Key, Stock Item Key, WWI Purchase Order ID, Ordered Outers, Ordered Quantity,
        Received Outers, Package, Is Order Finalized""")


def sale(g: Star) -> DataFrame:
    rows = _keys(g, g.fresh("Sale_Staging", "WWI Invoice ID"), "Customer Key", "Bill To Customer Key", "Stock Item Key", "Salesperson Key")
    return fact_rows(rows, """= City Key, Customer Key, Bill To Customer Key, Stock Item Key, Invoice Date Key, Delivery Date Key,
        Salesperson Key, WWI Invoice ID, Description, Package, Quantity, Unit Price, Tax Rate, Total Excluding Tax, Tax Amount,
        Profit, Total Including Tax, Total Dry Items, Total Chiller Items""", {"City Key": F.lit(0)})


def transaction(g: Star) -> DataFrame:
    rows = _keys(g, g.all("Transaction_Staging"), "Customer Key", "Supplier Key", "Transaction Type Key", "Payment Method Key")
    return fact_rows(rows, """Date Key, Customer Key, = Bill To Customer Key, Supplier Key, Transaction Type Key, Payment Method Key,
        WWI Customer Transaction ID, WWI Supplier Transaction ID, WWI Invoice ID, WWI Purchase Order ID,
        = Supplier Invoice Number, Total Excluding Tax, Tax Amount, Total Including Tax, Outstanding Balance, Is Finalized""",
        {"Bill To Customer Key": F.lit(0), "Supplier Invoice Number": nothing("string")})


FACTS = {
    f.target: f
    for f in (
        FactLoad("Fact.Stock Holding", "Stock Holding Key", stock_holding, by="all", order=("WWI Stock Item ID", "Bin Location"),
                 needs=(ITEM,)),
        FactLoad("Fact.Movement", "Movement Key", movement, "WWI Stock Item Transaction ID", needs=(ITEM, CUSTOMER, SUPPLIER, KIND)),
        FactLoad("Fact.Order", "Order Key", order, "WWI Order ID",
                 order=("WWI Order ID", "WWI Stock Item ID", "Description", "Quantity", "Unit Price"), needs=(CUSTOMER, ITEM, EMPLOYEE)),
        FactLoad("Fact.Purchase", "Purchase Key", purchase, "WWI Purchase Order ID",
                 order=("WWI Purchase Order ID", "WWI Stock Item ID", "Ordered Outers", "Received Outers"), needs=(SUPPLIER, ITEM)),
        FactLoad("Fact.Sale", "Sale Key", sale, "WWI Invoice ID",
                 order=("WWI Invoice ID", "WWI Stock Item ID", "Description", "Quantity", "Total Including Tax"), needs=(CUSTOMER, ITEM, EMPLOYEE)),
        FactLoad("Fact.Transaction", "Transaction Key", transaction, by="once",
                 order=("WWI Customer Transaction ID", "WWI Supplier Transaction ID", "Date Key", "Total Including Tax"),
                 needs=(CUSTOMER, SUPPLIER, KIND, METHOD)),
    )
}
