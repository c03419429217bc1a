"""Clean layer to star schema: how dimensions and facts are declared and run."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bodega.functions.dates import date_key, moment, open_end
from bodega.operators.control import ControlTables, LayerResult, run_layer
from bodega.operators.incremental import (
    IdRange, high_water, newer, newer_in_ranges, range_high_water, stored_mark, stored_range_marks, watches,
)
from bodega.operators.joins import hot_values, q, resolve
from bodega.operators.keys import FACT_BUCKETS, next_start, number_rows, place_keys, reserve
from bodega.operators.scd import (
    LINEAGE, VALID_FROM, VALID_TO, Settle, first_versions, lazily, merge_versions, missing_members, newest, open_versions,
)
from bodega.plans.entity import MAIN, arrange, as_is, same_name
from bodega.session import cut_lineage
from bodega.sources.store import Conflict, Part, Store, Version, Watch

Reader = Callable[[str], DataFrame]
VALIDITY = (VALID_FROM, VALID_TO, LINEAGE)


@dataclass(frozen=True)
class Lookup:
    """A surrogate key taken from another dimension while a dimension is loaded."""

    column: str
    dimension: str
    on: tuple[str, str]
    key: str


@dataclass(frozen=True)
class Dimension:
    """`tracked` maps watched columns to the value their NULL compares as (None: NULL is no change).
    Without tracked columns the dimension is insert-only. `ends`: its staging ends members that vanish (see `load_changes`)."""

    target: str
    staging: str
    key: str
    business: tuple[str, ...]
    tracked: Mapping[str, object] = field(default_factory=dict)
    drop: tuple[str, ...] = ()
    add: Mapping[str, str] = field(default_factory=dict)
    lookup: Lookup | None = None
    versioned: bool = True
    against_open: bool = True
    ends: bool = False

    def attributes(self, staging: DataFrame, dims: Reader, single: bool = False) -> DataFrame:
        """One row per business key with the columns the dimension keeps; `single`: the staging has no more."""
        latest_by = [c for c in (VALID_FROM, "ValidFrom") if c in staging.columns]
        rows = staging if single else newest(staging, self.business, latest_by)
        if self.lookup is not None:
            (own, other) = self.lookup.on
            rows = resolve(rows, open_versions(dims(self.lookup.dimension)), {own: other}, {self.lookup.column: self.lookup.key})
        rows = rows.withColumns({n: F.lit(None).cast(t) for n, t in self.add.items()})
        left_out = set(self.drop) | set(VALIDITY) | {"ValidFrom", "ValidTo"}
        return rows.select(*[q(c) for c in rows.columns if c not in left_out])

    def shape(self, df: DataFrame) -> DataFrame:
        columns = [self.key] + [c for c in df.columns if c not in (self.key, *VALIDITY)]
        return df.select(*[q(c) for c in columns + list(VALIDITY if self.versioned else (LINEAGE,))])

    def first(self, staging: DataFrame, dims: Reader, run_ts: datetime, settle: Settle = lazily) -> DataFrame:
        return self.shape(first_versions(settle(self.attributes(staging, dims)), self.key, self.business, run_ts))

    def merged(self, dim: DataFrame, staging: DataFrame, dims: Reader, run_ts: datetime, settle: Settle = lazily,
               start: int | None = None, ends: bool = False) -> DataFrame:
        """With `ends`, a member whose newest staging row is over (its validity ends by now) is closed without a successor."""
        gone = None
        if ends and VALID_TO in staging.columns:
            last = settle(newest(staging, self.business, [VALID_FROM]))
            over = q(VALID_TO) <= moment(run_ts)
            gone, staging = last.filter(over).select(*[q(b) for b in self.business]), last.filter(~over)
        rows = self.attributes(staging, dims, gone is not None)
        return self.shape(merge_versions(dim, rows, self.key, self.business, self.tracked, run_ts, start=start, settle=settle, gone=gone))

    def additions(self, dim: DataFrame, staging: DataFrame, dims: Reader, run_ts: datetime, settle: Settle = lazily,
                  start: int | None = None) -> DataFrame:
        rows, against_open = self.attributes(staging, dims), self.against_open and self.versioned
        return missing_members(dim, rows, self.key, self.business, run_ts, against_open, start=start, settle=settle)


#: Hidden partition of a stored type 2 dimension: whether a version is open.
OPEN = "_open"
LAST_KEY = "last_key"


def marked_keys(rows: DataFrame, own: str, others: Sequence[str]) -> DataFrame:
    """Rows whose schema says, for the dictionary, which column is the key and which are keys of other tables."""
    for name, mark in [(own, "pk"), *[(c, "fk") for c in others]]:
        if name in rows.columns:
            rows = rows.withMetadata(name, {**rows.schema[name].metadata, mark: 1})
    return rows


def split(versions: DataFrame) -> DataFrame:
    """Versions with the partition they are stored in."""
    return versions.withColumn(OPEN, q(VALID_TO) == open_end())


def is_open(part: Part) -> bool:
    """Parts of a table that is not split count as open."""
    return part.values.get(OPEN, "true") == "true"


def stored_open(gold: Store, target: str) -> DataFrame:
    """The open versions of a stored dimension; closed ones are not read where they are stored apart."""
    dim = gold.read(target, [p for p in gold.version(target).parts if is_open(p)])
    return open_versions(dim)


def load_dimension(d: Dimension, silver: Reader, gold: Store, run_ts: datetime) -> int:
    """Bring one dimension up to date; rows added are returned.

    The rows to add are counted, numbered and written; they are materialised once, in the cluster's checkpoint folder, so
    that the staging is read and compared only once. Open and closed versions of a tracked dimension are stored apart: a merge
    reads and writes the open ones, and adds those that it closes to the closed ones, which stay where they are.
    """
    staging, version = silver(d.staging), gold.version(d.target)
    apart = (OPEN,) if d.tracked else ()

    def marked(rows: DataFrame) -> DataFrame:
        return marked_keys(rows, d.key, [d.lookup.column] if d.lookup else [])

    if version is None:
        rows = marked(d.first(staging, gold.read, run_ts, cut_lineage))
        return gold.replace(d.target, split(rows) if apart else rows, apart, notes=lambda n: {LAST_KEY: n})
    start = version.notes.get(LAST_KEY)
    start = next_start(gold.read(d.target), d.key) if start is None else start
    if not d.tracked:
        rows = d.additions(gold.read(d.target), staging, gold.read, run_ts, cut_lineage, start)
        return gold.append(d.target, rows, notes=lambda n: {LAST_KEY: start + n})
    parts = [p for p in version.parts if is_open(p)]
    dim = gold.read(d.target, parts)
    before = dim.count()
    merged = marked(d.merged(dim, staging, gold.read, run_ts, cut_lineage, start, ends=d.ends))
    if version.partition_by != apart:  # stored whole by an earlier release, or by hand
        return gold.replace(d.target, split(merged), apart, notes=lambda n: {LAST_KEY: start + n - before}) - before
    own = {p.path for p in parts}
    return gold.swap(d.target, split(merged), lambda p: p.path in own, apart, notes=lambda n: {LAST_KEY: start + n - before},
                     expect=version.number) - before


FACT_KEY = "_fact_key"
#: Rows from which a dimension's lookups are looked at for hot values first.
LARGE_DIMENSION = 200_000


@dataclass
class Star:
    """What a fact load reads: staging cut at the watermark, dimensions, the run moment.

    With an `order` the staging rows get their surrogate key before any lookup (lookups never multiply rows). Rows of a
    stored staging (`silver` is a Store) are numbered where they lie, from keys that `reserving` reserves; parts that hold
    nothing above the marks are not opened. Other rows are numbered by their `order`.
    """

    silver: Reader | Store
    dims: Reader | Store
    run_ts: datetime
    marks: dict[str, Any] = field(default_factory=dict)
    ranges: dict[str, IdRange] = field(default_factory=dict)
    order: tuple[str, ...] = ()
    start: int = 0
    reserving: Callable[[int], int] | None = None
    rows_by: tuple[str, ...] = ()
    base: DataFrame | None = None

    def staging(self, table: str) -> DataFrame:
        """A staging table read beside the one the fact is made of."""
        return self.silver.read(table) if isinstance(self.silver, Store) else self.silver(table)

    def _keyed(self, table: str, marks: dict[Watch, Any] | None = None) -> DataFrame:
        if not isinstance(self.silver, Store):
            df = self.silver(table)
            return number_rows(df, FACT_KEY, self.order, self.start, FACT_BUCKETS) if self.order and marks is None else df
        parts = self.silver.newer_parts(table, marks or {})
        self.base = self.silver.read(table, parts)
        if not self.order:
            return self.silver.read(table, parts)
        return place_keys(self.silver.read(table, parts, positions=True), FACT_KEY, self.reserving or (lambda n: self.start))

    def all(self, table: str) -> DataFrame:
        return self._keyed(table)

    def fresh(self, table: str, ident: str) -> DataFrame:
        if self.ranges:
            marks = {r.watch(ident): None if self.marks.get(n) is None else self.marks[n] + r.offset for n, r in self.ranges.items()}
        else:
            marks = {Watch(ident): self.marks.get(MAIN)}
        df = self._keyed(table, marks)
        df = newer_in_ranges(df, ident, self.ranges, self.marks) if self.ranges else newer(df, ident, self.marks.get(MAIN))
        stored = isinstance(self.silver, Store)
        return df if stored or not self.order else number_rows(df, FACT_KEY, self.order, self.start, FACT_BUCKETS)

    def members(self, dimension: str) -> DataFrame:
        return self.dims.read(dimension) if isinstance(self.dims, Store) else self.dims(dimension)

    def current(self, dimension: str) -> DataFrame:
        return stored_open(self.dims, dimension) if isinstance(self.dims, Store) else open_versions(self.dims(dimension))

    def identity(self, facts: DataFrame) -> tuple[str, ...]:
        """The columns that tell the fact's rows apart: rows without a value to look up are dealt out by them."""
        return (FACT_KEY,) if FACT_KEY in facts.columns else tuple(c for c in self.order or self.rows_by if c in facts.columns)

    def key(self, facts: DataFrame, dimension: str, on: tuple[str, str], take: Mapping[str, str], versioned: bool = True) -> DataFrame:
        """Surrogate keys of the current version, 0 when there is none."""
        side = self.current(dimension) if versioned else self.members(dimension)
        return resolve(facts, side, {on[0]: on[1]}, take, identity=self.identity(facts), hot=self.hot(dimension, on[0]))

    def hot(self, dimension: str, column: str) -> dict[Any, int]:
        """The staging's values to split among tasks, where both sides are stored and the dimension is too large to be sent around."""
        if self.base is None or column not in self.base.columns or not isinstance(self.dims, Store) or self.dims.rows(dimension) < LARGE_DIMENSION:
            return {}
        return hot_values(self.base, [column])[column]


@dataclass(frozen=True)
class FactLoad:
    """`by` is ``id`` (per range when ids were merged), ``day`` (a date whose key is the watermark),
    ``all`` (full refresh) or ``once`` (only into an empty fact). `order` names the staging columns that
    identify a row, for its surrogate key; `needs` the dimensions it looks up."""

    target: str
    key: str
    build: Callable[[Star], DataFrame]
    ident: str = ""
    by: str = "id"
    ranges: dict[str, IdRange] = field(default_factory=dict)
    order: tuple[str, ...] = ()
    needs: tuple[str, ...] = ()

    @property
    def identity(self) -> tuple[str, ...]:
        return self.order or (self.ident,)

    def marks(self, fact: DataFrame | None) -> dict[str, Any]:
        """The watermarks from a fact's rows."""
        if self.by in ("all", "once"):
            return {}
        if self.ranges:
            return range_high_water(fact, self.ident, self.ranges)
        return {MAIN: self._day(high_water(fact, self.ident))}

    def stored_marks(self, gold: Store) -> dict[str, Any]:
        """The watermarks from what was recorded with the writes of a stored fact; its rows are not read."""
        if self.by in ("all", "once"):
            return {}
        if self.ranges:
            return stored_range_marks(gold, self.target, self.ident, self.ranges)
        return {MAIN: self._day(stored_mark(gold, self.target, self.ident))}

    def _day(self, mark: Any) -> Any:
        if self.by != "day" or mark is None:
            return mark
        return datetime.strptime(str(mark), "%Y%m%d").date() if mark else None


def load_fact(f: FactLoad, silver: Reader | Store, gold: Store, run_ts: datetime, keys: bool = True, dims: Reader | None = None) -> int:
    """Load one fact; rows written are returned. With `keys` each new row gets a surrogate key.

    Marks come from what was recorded with the fact's writes and keys from reserved ranges: the fact itself is not read. A
    load of kind ``once`` is published only if nobody has filled the fact meanwhile.
    """
    version: Version | None = gold.version(f.target)
    if f.by == "once" and not gold.is_empty(f.target):
        return 0
    order = f.identity if keys else ()
    watch = [*([Watch(f.key)] if keys else []), *(watches(f.ident, f.ranges) if f.by in ("id", "day") else [])]

    def loaded() -> int:
        return stored_mark(gold, f.target, f.key) or 0

    # A full refresh starts at 1 again.
    reserving = (lambda n: 0) if f.by == "all" else (lambda n: reserve(gold, f.target, n, run_ts, loaded))
    star = Star(silver, dims or gold, run_ts, f.stored_marks(gold), f.ranges, order, 0, reserving, f.identity)
    if keys and not isinstance(silver, Store) and f.by != "all":
        star.start = loaded()
    rows = f.build(star).withColumn(LINEAGE, F.lit(1)).withColumnRenamed(FACT_KEY, f.key)
    rows = marked_keys(rows, f.key, [c for c in rows.columns if c.endswith(" Key") and c not in (f.key, LINEAGE)])
    if f.by == "all":
        return gold.replace(f.target, rows, watch=watch)
    if f.by != "once":
        return gold.append(f.target, rows, watch=watch)
    try:
        return gold.append(f.target, rows, watch=watch, expect=version.number if version else 0)
    except Conflict:
        return 0


def fact_rows(df: DataFrame, layout: str, given: Mapping[str, Column] | None = None) -> DataFrame:
    own = f"{FACT_KEY}, " if FACT_KEY in df.columns else ""
    return arrange(df, own + layout, given, rename=same_name, treat=as_is)


def day_keys(**columns: str) -> dict[str, Column]:
    """Integer date keys: Fecha_Pago_Key="Fecha Pago" gives column "Fecha Pago Key"."""
    return {name.replace("_", " "): date_key(f"`{c}`") for name, c in columns.items()}


def run_star_layer(dimensions: Mapping[str, Dimension], facts: Mapping[str, FactLoad], silver: Reader | Store, gold: Store,
                   run_ts: datetime, only: str | None = None, parallel: int = 1, keys: bool = True) -> LayerResult:
    """Dimensions and facts side by side, each as soon as what it looks up has been loaded.

    A load is held back if one that it looks up has failed: a fact without its dimension would keep the unknown key for good.
    """
    read = silver.read if isinstance(silver, Store) else silver
    loads: dict[str, Callable[[], int]] = {n: (lambda d=d: load_dimension(d, read, gold, run_ts)) for n, d in dimensions.items()}
    loads |= {n: (lambda f=f: load_fact(f, silver, gold, run_ts, keys)) for n, f in facts.items()}
    needs = {n: {d.lookup.dimension} for n, d in dimensions.items() if d.lookup} | {n: set(f.needs) for n, f in facts.items()}
    return run_layer(loads, ControlTables(gold), run_ts, only, parallel, control_rows_for=lambda n: False, needs=needs)
