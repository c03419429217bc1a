"""Watermarks: which source rows are new to a target."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bodega.functions.dates import moment
from bodega.sources.store import Store, Watch


def high_water(target: DataFrame | None, column: str) -> Any:
    """Largest loaded value, None for a target never loaded. One column, one row to the driver."""
    return None if target is None else target.agg(F.max(F.col(f"`{column}`"))).first()[0]


def newer(source: DataFrame, column: str | Column, watermark: Any) -> DataFrame:
    """Rows above the watermark. The literal reaches the parquet scan; None means everything."""
    if watermark is None:
        return source
    col = F.col(f"`{column}`") if isinstance(column, str) else column
    return source.filter(col > (moment(watermark) if isinstance(watermark, datetime) else F.lit(watermark)))


@dataclass(frozen=True)
class IdRange:
    """Where a sub-type lives inside a merged id space: shifted by `offset`, below `limit`."""

    name: str
    offset: int = 0
    limit: int | None = None

    def watch(self, column: str) -> Watch:
        """What a store records of this range of a column."""
        return Watch(column, self.offset or -1, self.limit)

    def holds(self, ident: Column) -> Column:
        inside = ident > F.lit(self.offset) if self.offset else ident >= F.lit(0)
        return inside & (ident <= F.lit(self.limit)) if self.limit is not None else inside


def id_ranges(**offsets: int) -> dict[str, IdRange]:
    """Ranges from ascending offsets: each ends where the next begins."""
    names = list(offsets)
    limits = [offsets[n] for n in names[1:]] + [None]
    return {n: IdRange(n, offsets[n], limit) for n, limit in zip(names, limits)}


def range_high_water(target: DataFrame | None, column: str, ranges: dict[str, IdRange]) -> dict[str, Any]:
    """One watermark per sub-type, in source ids, from a single pass over the id column."""
    if target is None:
        return dict.fromkeys(ranges)
    ident = F.col(f"`{column}`")
    found = target.agg(
        *[F.max(F.when(r.holds(ident), ident - F.lit(r.offset))).alias(n) for n, r in ranges.items()]
    ).first()
    return found.asDict()


def newer_in_ranges(rows: DataFrame, column: str, ranges: dict[str, IdRange], marks: dict[str, Any]) -> DataFrame:
    """Rows of a merged id space above the watermark of their own sub-type."""
    ident = F.col(f"`{column}`")
    tests = []
    for name, r in ranges.items():
        mark = marks.get(name)
        tests.append(r.holds(ident) if mark is None else r.holds(ident) & (ident > F.lit(mark + r.offset)))
    return rows.filter(reduce(lambda a, b: a | b, tests))


def union_subtypes(parts: dict[str, DataFrame], ident: str, ranges: dict[str, IdRange]) -> DataFrame:
    """Sub-type tables with disjoint ids; columns a sub-type lacks become typed NULLs."""
    shifted = [
        df.withColumn(ident, (F.col(f"`{ident}`") + F.lit(ranges[name].offset)).cast(df.schema[ident].dataType))
        for name, df in parts.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), shifted)


def latest_of(*values: Any) -> Any:
    """Largest of several maxima, ignoring sources without rows."""
    known = [v for v in values if v is not None]
    return max(known) if known else None


def watches(column: str, ranges: dict[str, IdRange]) -> list[Watch]:
    """What a store should record of a watermark column, with each write."""
    if not column:
        return []
    return [r.watch(column) for r in ranges.values()] if ranges else [Watch(column)]


def stored_mark(store: Store, table: str, column: str) -> Any:
    """Largest loaded value, None for a table never loaded: from the extremes recorded with its writes, not from its rows."""
    return store.extremes(table, [Watch(column)])[column][1]


def stored_range_marks(store: Store, table: str, column: str, ranges: dict[str, IdRange]) -> dict[str, Any]:
    """One watermark per sub-type, in source ids, from the extremes recorded with the table's writes."""
    found = store.extremes(table, watches(column, ranges))
    largest = {n: found[r.watch(column).name][1] for n, r in ranges.items()}
    return {n: None if largest[n] is None else largest[n] - r.offset for n, r in ranges.items()}
