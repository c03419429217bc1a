"""Lookup joins. Sides are never force-broadcast: Catalyst and AQE choose by measured size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from math import ceil
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def q(name: str) -> Column:
    """Column by exact name (names here contain blanks)."""
    return F.col(f"`{name}`")


def latest_per_key(df: DataFrame, key: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """One row per key. The rank filter is applied before the shuffle too, so a hot key is cut to one
    row per map task instead of travelling whole to one reducer."""
    tie = F.xxhash64(*[q(c) for c in df.columns])
    rank = F.row_number().over(Window.partitionBy(*[q(k) for k in key]).orderBy(*newest_first, tie))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def key_per_value(dim: DataFrame, value: str | Sequence[str], keys: Sequence[str]) -> DataFrame:
    """A lookup made single-valued: the row with the smallest first key per value (partial aggregation)."""
    values = [value] if isinstance(value, str) else list(value)
    known = dim.filter(reduce(lambda a, b: a & b, [q(v).isNotNull() for v in values]))
    if len(keys) == 1:
        return known.groupBy(*[q(v) for v in values]).agg(F.min(q(keys[0])).alias(keys[0]))
    return (
        known.groupBy(*[q(v) for v in values])
        .agg(F.min(F.struct(*[q(k) for k in keys])).alias("_picked"))
        .select(*[q(v) for v in values], *[F.col("_picked").getField(k).alias(k) for k in keys])
    )


#: Values of a column that are looked at as candidates for splitting, and the tasks that a column's rows should be dealt to.
CANDIDATES = 64
TASKS = 200


def hot_values(rows: DataFrame, columns: Sequence[str], tasks: int = TASKS, candidates: int = CANDIDATES) -> dict[str, dict[Any, int]]:
    """Per column the values that hold more than one task's share of the rows, and how many shares they hold.

    One pass keeps a summary of the most frequent values of all columns (at most `candidates` each come to the driver). It may
    overstate a count a little, never miss a value that holds a share.
    """
    tops = [F.expr(f"approx_top_k(`{c}`, {candidates}, {max(10_000, 64 * candidates)})").alias(str(i)) for i, c in enumerate(columns)]
    found = rows.agg(F.count(F.lit(1)).alias("n"), *tops).first()
    share = max(1, found["n"] / tasks)
    return {c: {x["item"]: ceil(x["count"] / share) for x in found[str(i)] or () if x["item"] is not None and x["count"] > share}
            for i, c in enumerate(columns)}


def resolve(
    facts: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str],
    unknown: int | None = 0,
    single: bool = True,
    spread: int = 1,
    identity: Sequence[str] = (),
    hot: Mapping[Any, int] | None = None,
) -> DataFrame:
    """Left lookup of surrogate keys: `on` maps fact column to dimension column, `take` maps the new
    column to the dimension key. A miss gives `unknown` (None leaves NULL).

    `single` collapses the dimension to one row per looked-up value first, so rows never multiply.

    Facts without a value match nothing, yet a shuffle would send them all to one task: they are dealt
    out by a salt instead, a hash of the columns in `identity` (else of the first column), so that a scan below
    stays pruned. AQE splits a hot value at run time. `hot` (see `hot_values`) does it by plan for a lookup by one column: the
    rows of such a value are dealt to as many salts as it holds shares, and its dimension row alone is copied to each;
    `spread` > 1 does it for all values, at the price of that many copies of the dimension.
    """
    sources = list(dict.fromkeys(take.values()))
    if single:
        dim = key_per_value(dim, list(on.values()), sources)
    names = {c: f"_look_{i}" for i, c in enumerate(list(on.values()) + [s for s in sources if s not in on.values()])}
    shares = {v: n for v, n in (hot or {}).items() if n > 1} if len(on) == 1 and spread == 1 else {}

    def copies_of(value: Column) -> Column:
        many = F.lit(spread)
        for v, n in shares.items():
            many = F.when(value == F.lit(v), n).otherwise(many)
        return many

    looked_up = q(next(iter(on.values())))
    copies = F.explode(F.sequence(F.lit(0), copies_of(looked_up) - 1))  # exploded, so the salt stays a join key
    side = dim.select(*[q(c).alias(a) for c, a in names.items()], copies.alias("_copy"))
    empty = reduce(lambda a, b: a | b, [q(f).isNull() for f in on])
    row = F.xxhash64(*[q(c) for c in identity or facts.columns[:1]])
    dealt = F.pmod(row, copies_of(q(next(iter(on))))) if spread > 1 or shares else F.lit(0)
    # Beyond all copies, so that rows without a value meet none.
    salt = F.when(empty, F.pmod(row, F.lit(1 << 16)) + max(spread, *shares.values(), 1)).otherwise(dealt)
    condition = reduce(lambda a, b: a & b, [q(f) == F.col(names[d]) for f, d in on.items()])
    joined = facts.withColumn("_salt", salt.cast("int")).join(side, condition & (F.col("_salt") == F.col("_copy")), "left")
    found = {
        out: F.col(names[src]) if unknown is None else F.coalesce(F.col(names[src]), F.lit(unknown))
        for out, src in take.items()
    }
    return joined.withColumns(found).drop(*names.values(), "_salt", "_copy")


def bridge(first: DataFrame, dim: DataFrame, on: Mapping[str, str], by: str, key: str) -> DataFrame:
    """Two-hop lookup table: value `by` of `first` -> smallest `key` of the dimension rows it reaches."""
    (left, right), = on.items()
    hop = key_per_value(dim, right, [key]).select(q(right).alias("_hop"), q(key).alias("_key"))
    return (
        first.select(q(by).alias(by), q(left).alias("_left"))
        .join(hop, F.col("_left") == F.col("_hop"), "inner")
        .groupBy(q(by))
        .agg(F.min("_key").alias(key))
    )


def detail_measures(detail: DataFrame, by: str, measures: Mapping[str, Column]) -> DataFrame:
    """One row per owner with its aggregated detail (partial aggregation before the shuffle)."""
    return detail.groupBy(q(by)).agg(*[m.alias(n) for n, m in measures.items()])


def pairs_in_use(uses: DataFrame, left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """Left and right rows that some row of `uses` brings together, once each: distinct keys, then two equi-joins."""
    met = uses.select(q(left_key), q(right_key)).distinct()
    return met.join(left, left_key).join(right, right_key).select(*[q(c) for c in (*left.columns, *right.columns)])


def differs(old: Mapping[str, Column], new: Mapping[str, Column], defaults: Mapping[str, object],
            null_safe: bool = False) -> Column:
    """True when a tracked column changed.

    A column with a default compares NULL as that default. A column without one follows SQL: a NULL
    side is not a change, unless `null_safe` asks for it.
    """
    tests = []
    for name in new:
        a, b, default = old[name], new[name], defaults.get(name)
        if default is not None:
            tests.append(F.coalesce(a, F.lit(default)) != F.coalesce(b, F.lit(default)))
        elif null_safe:
            tests.append(~a.eqNullSafe(b))
        else:
            tests.append(F.coalesce(a != b, F.lit(False)))
    return reduce(lambda a, b: a | b, tests)
