"""Header and line tables stored side by side: bucketed and sorted by the header's id, so that joining them needs no shuffle."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

Reader = Callable[[str], DataFrame]
#: A fixed number for all tables that are joined with each other; a bucket should fit a task at the size the tables will have.
BUCKETS = 32


def store_bucketed(df: DataFrame, table: str, key: str, path: str, buckets: int = BUCKETS) -> None:
    """Store `df` as catalog table `table` under `path`: one shuffle now, none in any later join or group by `key`."""
    # A task per bucket, so that each bucket is one sorted file.
    df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)


def colocated(spark: SparkSession, read: Reader, keys: Mapping[str, str], name_of: Callable[[str], str], folder: str,
              buckets: int = BUCKETS) -> Reader:
    """A reader for which the tables of `keys` (table to id column) are stored in buckets under catalog names given by `name_of`.

    A table is stored when it is first read, and read from there from then on.
    """
    def reader(table: str) -> DataFrame:
        if table not in keys:
            return read(table)
        name = name_of(table)
        if not spark.catalog.tableExists(name):
            store_bucketed(read(table), name, keys[table], f"{folder}/{name}", buckets)
        return spark.table(name)

    return reader
