"""Dimension maintenance: versioned (type 2) and insert-only."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bodega.functions.dates import moment, open_end
from bodega.operators.joins import differs, latest_per_key, q
from bodega.operators.keys import BUCKETS, next_start, number_rows

VALID_FROM, VALID_TO, LINEAGE = "Valid From", "Valid To", "Lineage Key"

Settle = Callable[[DataFrame], DataFrame]


def lazily(df: DataFrame) -> DataFrame:
    """Leave a frame as it is; a load passes `cut_lineage` instead where a frame is used several times."""
    return df


def open_versions(dim: DataFrame) -> DataFrame:
    return dim.filter(q(VALID_TO) == open_end())


def as_of(dim: DataFrame, when: datetime | str) -> DataFrame:
    """Versions in force at a moment: from inclusive, to exclusive."""
    t = moment(when)
    return dim.filter((q(VALID_FROM) <= t) & (t < q(VALID_TO)))


def newest(staging: DataFrame, business: Sequence[str], latest_by: Sequence[str] = ()) -> DataFrame:
    return latest_per_key(staging, business, [q(c).desc_nulls_last() for c in latest_by])


def _versioned(rows: DataFrame, run_ts: datetime | str) -> DataFrame:
    return rows.withColumns({VALID_FROM: moment(run_ts), VALID_TO: open_end(), LINEAGE: F.lit(1)})


def first_versions(staging: DataFrame, key: str, business: Sequence[str], run_ts: datetime | str,
                   buckets: int = BUCKETS) -> DataFrame:
    """A new dimension: every staging row is an open version."""
    return number_rows(_versioned(staging, run_ts), key, business, 0, buckets)


def changes(dim: DataFrame, staging: DataFrame, business: Sequence[str], tracked: Mapping[str, object],
            null_safe: bool = False) -> DataFrame:
    """Staging rows that are new or changed, with `_changed` telling which (False = new key).

    One left join against the tracked columns of the open versions.
    """
    known = open_versions(dim).select(
        *[q(b).alias(f"_b{i}") for i, b in enumerate(business)],
        *[q(t).alias(f"_t{i}") for i, t in enumerate(tracked)],
        F.lit(True).alias("_known"),
    )
    match = reduce(lambda a, b: a & b, [q(b) == F.col(f"_b{i}") for i, b in enumerate(business)])
    old = {t: F.col(f"_t{i}") for i, t in enumerate(tracked)}
    new = {t: q(t) for t in tracked}
    is_new = F.col("_known").isNull()
    changed = differs(old, new, tracked, null_safe) if tracked else F.lit(False)
    joined = staging.join(known, match, "left")
    return (
        joined.withColumn("_changed", ~is_new & changed)
        .filter(is_new | F.col("_changed"))
        .select(*[q(c) for c in staging.columns], "_changed")
    )


def merge_versions(
    dim: DataFrame,
    staging: DataFrame,
    key: str,
    business: Sequence[str],
    tracked: Mapping[str, object],
    run_ts: datetime | str,
    null_safe: bool = False,
    start: int | None = None,
    buckets: int = BUCKETS,
    settle: Settle = lazily,
    gone: DataFrame | None = None,
) -> DataFrame:
    """The whole dimension after a type 2 merge: untouched rows, closed versions, new versions.

    `staging` holds one row per business key (see `newest`); `tracked` maps each watched column to
    the value its NULL compares as, or None. Columns outside `tracked` never trigger a version.
    Close and insert share `run_ts`, so the two intervals touch exactly. The business keys of `gone` are closed without a
    successor. The new and changed rows are
    used three times; `settle` may materialise them.
    """
    attributes = [c for c in dim.columns if c not in (key, VALID_FROM, VALID_TO, LINEAGE)]
    pending = settle(changes(dim, staging.select(*[q(c) for c in attributes]), business, tracked, null_safe))
    closing = pending.filter(F.col("_changed")).select(
        *[q(b).alias(f"_b{i}") for i, b in enumerate(business)], F.lit(True).alias("_closes")
    )
    if gone is not None:
        closing = closing.unionByName(gone.select(*[q(b).alias(f"_b{i}") for i, b in enumerate(business)], F.lit(True).alias("_closes")))
    match = reduce(lambda a, b: a & b, [q(b) == F.col(f"_b{i}") for i, b in enumerate(business)])
    closes = F.col("_closes").isNotNull() & (q(VALID_TO) == open_end())
    kept = (
        dim.join(closing, match, "left")
        .withColumn(VALID_TO, F.when(closes, moment(run_ts)).otherwise(q(VALID_TO)))
        .select(*[q(c) for c in dim.columns])
    )
    first = next_start(dim, key) if start is None else start
    added = number_rows(_versioned(pending.drop("_changed"), run_ts), key, business, first, buckets)
    return kept.unionByName(added.select(*[q(c) for c in dim.columns]))


def missing_members(
    dim: DataFrame,
    staging: DataFrame,
    key: str,
    business: Sequence[str],
    run_ts: datetime | str,
    against_open: bool = True,
    start: int | None = None,
    buckets: int = BUCKETS,
    settle: Settle = lazily,
) -> DataFrame:
    """Rows to append to an insert-only dimension: keys without an open version, or (with
    `against_open=False`) without any row. Nothing is ever closed."""
    known = open_versions(dim) if against_open else dim
    fresh = settle(staging.join(known.select(*[q(b) for b in business]), list(business), "left_anti"))
    first = next_start(dim, key) if start is None else start
    stamped = _versioned(fresh, run_ts)
    return number_rows(stamped, key, business, first, buckets).select(*[q(c) for c in dim.columns])
