"""Sets of rows derived for fact tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bodega.functions.amounts import money
from bodega.functions.dates import date_key
from bodega.operators.joins import q


def daily_balance(moves: DataFrame, account: str, day: str, amount: str, balance: str, ident: str | None = None) -> DataFrame:
    """Per account and day: lowest, highest and mean balance, count, money in and money out.

    Opening and closing repeat the lowest and highest balance. With `ident` they are the balances of
    the first and last movement of the day instead.
    """
    moved = q(amount)
    opening, closing = F.min(q(balance)), F.max(q(balance))
    if ident is not None:
        opening, closing = F.min_by(q(balance), q(ident)), F.max_by(q(balance), q(ident))
    zero = F.lit(0).cast("decimal(18,2)")
    return moves.groupBy(q(account), q(day)).agg(
        opening.alias("Saldo Apertura"),
        closing.alias("Saldo Cierre"),
        F.min(q(balance)).alias("Saldo Minimo"),
        F.max(q(balance)).alias("Saldo Maximo"),
        money(F.round(F.avg(q(balance)), 2)).alias("Saldo Promedio"),
        F.count(F.lit(1)).alias("Numero Movimientos"),
        money(F.sum(F.when(moved > 0, moved).otherwise(zero))).alias("Importe Total Entradas"),
        money(F.sum(F.when(moved < 0, F.abs(moved)).otherwise(zero))).alias("Importe Total Salidas"),
    )


def snapshot_key(run_ts: datetime | str) -> Column:
    return date_key(F.lit(str(run_ts)).cast("timestamp_ntz"))
