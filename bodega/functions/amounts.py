"""Money columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bodega.functions.base import as_col


def money(c: Column | str) -> Column:
    return as_col(c).cast("decimal(18,2)")


def line_amounts(quantity: Column | str, unit_price: Column | str, tax_rate: Column | str) -> dict[str, Column]:
    """Net, tax and gross of a line; `tax_rate` is in percent. Each is rounded on its own."""
    net = as_col(quantity) * as_col(unit_price)
    tax = net * as_col(tax_rate) / F.lit(100)
    return {
        "Total Excluding Tax": money(F.round(net, 2)),
        "Tax Amount": money(F.round(tax, 2)),
        "Total Including Tax": money(F.round(net + tax, 2)),
    }


def split_by_flag(amount: Column | str, flag: Column | str) -> tuple[Column, Column]:
    """The amount twice: zeroed where the flag is not 0, and zeroed where it is not 1."""
    value, on = as_col(amount), as_col(flag).cast("int")
    zero = F.lit(0).cast("decimal(18,2)")
    return F.when(on == 0, value).otherwise(zero), F.when(on == 1, value).otherwise(zero)
