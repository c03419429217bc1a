"""Inline rows, seeding and plain scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def inline_rows(spark: SparkSession, schema: str, rows: Sequence[tuple]) -> DataFrame:
    """A lookup relation written in the code (a local relation: no job, broadcast by its size)."""
    return spark.createDataFrame(list(rows), schema)


def missing_rows(seed: DataFrame, target: DataFrame, key: str | list[str]) -> DataFrame:
    """Seed rows whose key the target does not hold yet; appending them twice adds nothing."""
    return seed.join(target, key, "left_anti")
