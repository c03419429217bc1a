"""Shared parts of the training-data operators: tables, scratch space, numbering."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

#: The characters that contracts here call white space: space, tab to carriage return.
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Only a session that runs in one process (a laptop, a test) may leave it unset; it gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = tempfile.mkdtemp(prefix="bodega-shared-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch(spark: SparkSession, what: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"


def settle(df: DataFrame, what: str) -> DataFrame:
    """Write `df` as Parquet to the shared folder and read it: lineage ends there, on all executors alike."""
    path = scratch(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def number_within(rows: DataFrame, keys: list[str], order: list[str], out: str) -> DataFrame:
    """Gapless numbers from 0 within each value of `keys`, as column `out`.

    `rows` must be settled and have a column ``part`` that no single task outgrows (the task which wrote the row).
    A key's rows are numbered within (key, part), so a hot key is spread over all parts; only one count per part
    meets in one place.
    """
    inner = Window.partitionBy(*keys, "part").orderBy(*order)
    before = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy(*keys, "part").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("part").alias("_part"), "_start")
    )
    same = F.col("part") == F.col("_part")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return (
        rows.withColumn("_i", F.row_number().over(inner) - 1)
        .join(starts, same)
        .withColumn(out, (F.col("_i") + F.col("_start")).cast("long"))
        .drop("_i", "_start", "_part", *[f"_k{i}" for i in range(len(keys))])
    )
