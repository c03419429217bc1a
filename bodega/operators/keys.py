"""Surrogate keys: unique and repeatable, numbered by many tasks at once.

Rows of a stored table are numbered where they lie, by their file and their place in it, from a reserved range of keys
(`reserve`, `place_keys`). Rows that are not stored are numbered inside hash buckets (`number_rows`).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from bodega.operators.joins import q
from bodega.sources.store import FILE, ROW, TRIES, Conflict, Store

# Primes, so that ids in regular steps still spread evenly.
BUCKETS = 1_021
FACT_BUCKETS = 16_381
#: Files whose starts are broadcast (a few hundred bytes each); beyond that they are joined as Spark sees fit.
BROADCAST_FILES = 50_000


def number_rows(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    start: int = 0,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Add `key` = start+1 .. start+n.

    A window without partitions would send every row to one task. Rows are numbered inside hash
    buckets of their ordering columns instead, and each bucket starts where the sizes of the lower
    buckets end. Only the bucket sizes (at most `buckets` rows) pass through one task. `order` must
    identify a row; the result depends on the rows and `buckets`, not on the layout of the cluster.
    The bucket of a single integer column is that number modulo `buckets`, else a hash.
    """
    columns = [q(c) for c in order]
    plain = len(order) == 1 and isinstance(df.schema[order[0]].dataType, IntegralType)
    spread = F.pmod(columns[0] if plain else F.xxhash64(*columns), F.lit(buckets))
    rows = df.withColumn("_bucket", F.coalesce(spread, F.lit(0)).cast("int"))
    lower = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select(F.col("_bucket").alias("_of"), F.coalesce(F.sum("_size").over(lower), F.lit(0)).alias("_start"))
    )
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy(*columns))
    return (
        rows.withColumn("_inside", inside)
        .join(F.broadcast(starts), F.col("_bucket") == F.col("_of"))
        .withColumn(key, (F.lit(start) + F.col("_start") + F.col("_inside")).cast("bigint"))
        .drop("_bucket", "_inside", "_of", "_start")
    )


def next_start(dim: DataFrame, key: str) -> int:
    """Largest key given out so far (0 is the unknown member)."""
    return dim.agg(F.coalesce(F.max(q(key)), F.lit(0))).first()[0]


RESERVED = "ReservaClaves"
RESERVED_SCHEMA = "TablaDestino string, Desde bigint, Hasta bigint, FechaReserva timestamp_ntz"


def reserve(store: Store, table: str, n: int, now: datetime, loaded: Callable[[], int] = lambda: 0) -> int:
    """Reserve n keys of `table` in the control table and return the key before the first: keys are it + 1 .. it + n.

    A reservation counts if no other was published meanwhile, else it is made anew: ranges never overlap. `loaded` gives
    the largest key of a table that has none reserved.
    """
    for _ in range(TRIES):
        version = store.version(RESERVED)
        start = version.notes.get(table) if version else None
        start = loaded() if start is None else start
        if not n:
            return start
        row = store.spark.createDataFrame([(table, start + 1, start + n, now)], RESERVED_SCHEMA)
        try:
            store.append(RESERVED, row, notes={table: start + n}, expect=version.number if version else 0)
            return start
        except Conflict:
            continue
    raise Conflict(f"no keys of {table!r} could be reserved")


def place_keys(rows: DataFrame, key: str, reserving: Callable[[int], int]) -> DataFrame:
    """Add `key` to rows read with their positions, and leave the positions out.

    A key is the start of the row's file plus the row's number in it, so nothing is shuffled to number rows: files are
    counted from their footers, and their starts (a row per file) are joined. Rows filtered out later leave their keys unused.
    """
    files = sorted((r[0], r[1]) for r in rows.groupBy(FILE).count().collect())
    start = reserving(sum(n for _, n in files))
    starts = []
    for name, n in files:
        starts.append((name, start))
        start += n
    given = rows.sparkSession.createDataFrame(starts, "_of string, _start bigint")
    placed = rows.join(F.broadcast(given) if len(files) <= BROADCAST_FILES else given, F.col(FILE) == F.col("_of"), "left")
    return placed.withColumn(key, F.col("_start") + F.col(ROW) + 1).drop(FILE, ROW, "_of", "_start")
