"""Repeatable table samples: a stated share of the rows, chosen row by row by a stable hash."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIGITS = 8


def _bound(share: float) -> str:
    """The first hash, in hexadecimal, that is not in the sample."""
    return format(int(share * 16**DIGITS), f"0{DIGITS}x")


def sample_rows(df: DataFrame, keys: Sequence[str], share: float = 1.0) -> DataFrame:
    """About `share` of the rows; a row is chosen by its `keys` alone. 1 is the whole table."""
    if share >= 1:
        return df
    text = F.concat_ws("|", *[F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("")) for k in keys])
    return df.filter(F.substring(F.md5(text.cast("binary")), 1, DIGITS) < _bound(share))


def sample_sql(keys: Sequence[str], share: float) -> str:
    """The same choice as an SQL condition."""
    text = " || '|' || ".join(f"coalesce(cast(\"{k}\" as varchar), '')" for k in keys)
    return f"substr(md5({text}), 1, {DIGITS}) < '{_bound(share)}'"
