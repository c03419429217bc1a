"""Declared constraints checked on data: one row per rule with rows tested and rows in breach."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bodega.operators.joins import q


def _report(rule: str, target: str, counted: DataFrame) -> DataFrame:
    return counted.select(
        F.lit(rule).alias("regla"), F.lit(target).alias("objeto"),
        F.col("filas").cast("bigint").alias("filas"),
        F.coalesce(F.col("incumplen"), F.lit(0)).cast("bigint").alias("incumplen"),
    )


def not_null(df: DataFrame, column: str, target: str | None = None) -> DataFrame:
    return _report("NOT NULL", target or column, df.agg(
        F.count(F.lit(1)).alias("filas"), F.count_if(q(column).isNull()).alias("incumplen")))


def unique(df: DataFrame, columns: Sequence[str], target: str | None = None) -> DataFrame:
    """Rows beyond the first of each key. Counts are combined before the shuffle, so a key holding a
    large share of the rows costs one record per task."""
    groups = df.groupBy(*[q(c) for c in columns]).agg(F.count(F.lit(1)).alias("_n"))
    return _report("UNIQUE", target or ", ".join(columns), groups.agg(
        F.sum("_n").alias("filas"), F.sum(F.col("_n") - 1).alias("incumplen")))


def duplicated(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*[q(c) for c in columns]).agg(F.count(F.lit(1)).alias("veces")).filter(F.col("veces") > 1)


def foreign_key(child: DataFrame, column: str, parent: DataFrame, parent_column: str, target: str | None = None) -> DataFrame:
    """Child rows whose non-NULL value is missing in the parent. Values are counted first, so the join
    sees each child value once however often it repeats."""
    values = child.groupBy(q(column).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    present = parent.select(q(parent_column).alias("_v")).distinct().withColumn("_ok", F.lit(True))
    joined = values.join(present, "_v", "left")
    orphan = F.col("_v").isNotNull() & F.col("_ok").isNull()
    return _report("FOREIGN KEY", target or column, joined.agg(
        F.sum("_n").alias("filas"), F.sum(F.when(orphan, F.col("_n"))).alias("incumplen")))


def check(df: DataFrame, test: Column, target: str) -> DataFrame:
    """Rows where the test is false; an unknown result (NULL) passes, as a CHECK constraint does."""
    return _report("CHECK", target, df.agg(
        F.count(F.lit(1)).alias("filas"), F.count_if(~F.coalesce(test, F.lit(True))).alias("incumplen")))


def among(column: str, values: Sequence[str]) -> Column:
    """Value-list test that ignores case, as the declared lists are mixed-case and clean data upper-case."""
    return F.upper(q(column)).isin(*[v.upper() for v in values])


def exactly_one_of(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a + b, [q(c).isNotNull().cast("int") for c in columns]) == 1


def audit(reports: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def wrong_date_order(df: DataFrame, earlier: str, later: str) -> DataFrame:
    """Rows whose later date lies before the earlier one."""
    return df.filter(q(later) < q(earlier))


def document_mismatches(people: DataFrame, documents: DataFrame, key: str, number: str) -> DataFrame:
    """Identity documents whose number differs from the owner's, or is shared by several documents."""
    shared = duplicated(documents.filter(q(number).isNotNull()), [number]).select(q(number).alias("_shared"), F.lit(1).alias("_many"))
    owner = people.select(q(key).alias("_owner"), q(number).alias("_owned"))
    return (
        documents.join(owner, q(key) == F.col("_owner"), "left")
        .join(shared, q(number) == F.col("_shared"), "left")
        .withColumn("distinto", F.coalesce((q(number) != F.col("_owned")).cast("int"), F.lit(0)))
        .withColumn("repetido", F.coalesce(F.col("_many"), F.lit(0)))
        .filter((F.col("distinto") == 1) | (F.col("repetido") == 1))
        .select(*documents.columns, "distinto", "repetido")
    )
