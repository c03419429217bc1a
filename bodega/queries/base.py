"""Shared parts of the registered queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bodega.sources.relations import table

RUN_TS = "2024-06-30 00:00:00"
RUN_DAY = "2024-06-30"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


class Tables:
    """The given tables as attributes, opened once when asked for (opening reads a footer)."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        self.__dict__[name] = table(self.spark, self.folder, name)
        return self.__dict__[name]

    def sql(self, text: str) -> DataFrame:
        """Text with {table} references."""
        return self.spark.sql(text, **{n: getattr(self, n) for n in TABLES if "{" + n + "}" in text})


@dataclass(frozen=True)
class Query:
    run: Callable[[Tables], DataFrame]
    oracle: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, oracle: str | None = None, floats: tuple[str, ...] = ()):
    """Register a query; the oracle text is what another SQL engine runs on the same tables.

    `floats` are whole-number columns with NULLs, shown as doubles on both sides because data frames
    disagree on how to hold a missing integer.
    """
    def add(fn: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        if not floats:
            REGISTRY[name] = Query(fn, oracle)
            return fn
        shown = ", ".join(f'cast("{c}" as double) as "{c}"' for c in floats)
        REGISTRY[name] = Query(
            lambda t: fn(t).withColumns({c: F.col(f"`{c}`").cast("double") for c in floats}),
            oracle and f"select * replace ({shown}) from ({oracle})",
        )
        return fn
    return add


def plain(df: DataFrame) -> DataFrame:
    """Columns as long, double and text only, so that results of two engines compare exactly."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.BinaryType):
            continue
        if isinstance(f.dataType, T.BooleanType):
            c = c.cast("int").cast("bigint")
        elif isinstance(f.dataType, T.IntegralType):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        out.append(c.alias(f.name))
    return df.select(*out)
