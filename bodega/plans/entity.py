"""How an entity load is declared and run: sources, watermark, column rules, sink."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bodega.functions.dates import moment, open_end
from bodega.functions.text import clean_email, clean_phone, clean_text
from bodega.operators.control import ControlTables, LayerResult, run_layer
from bodega.operators.incremental import IdRange, newer, stored_mark, stored_range_marks, watches
from bodega.operators.joins import latest_per_key, q
from bodega.operators.snapshot import VANISHED, difference, digests
from bodega.session import cut_lineage
from bodega.sources.store import Store

MAIN = "main"
Reader = Callable[[str], DataFrame]


def spaced(name: str) -> str:
    """Warehouse name of a raw column: FechaCierre -> Fecha Cierre, TAEAplicado -> TAE Aplicado."""
    return re.sub(r"(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", " ", name)


def by_rule(df: DataFrame, name: str) -> Column:
    """The standard treatment of a column: e-mails lower-cased, phones trimmed, other text upper-cased."""
    column = q(name)
    if not isinstance(df.schema[name].dataType, T.StringType):
        return column
    if "Email" in name:
        return clean_email(column)
    return clean_phone(column) if "Telefono" in name else clean_text(column)


def arrange(df: DataFrame, layout: str, given: Mapping[str, Column] | None = None, rename: Callable[[str], str] = spaced,
            treat: Callable[[DataFrame, str], Column] = by_rule) -> DataFrame:
    """Project to a layout of comma-separated entries.

    ``Source`` keeps a column under its warehouse name, ``Source > Target`` names it, ``= Target``
    takes the expression `given` for it. Kept columns get the standard treatment.
    """
    out = []
    for entry in (e.strip() for e in layout.split(",")):
        if entry.startswith("="):
            name = entry[1:].strip()
            out.append(given[name].alias(name))
        elif ">" in entry:
            source, name = (x.strip() for x in entry.split(">"))
            out.append(treat(df, source).alias(name))
        else:
            out.append(treat(df, entry).alias(rename(entry)))
    return df.select(*out)


def as_is(df: DataFrame, name: str) -> Column:
    return q(name)


def same_name(name: str) -> str:
    return name


def nothing(kind: str) -> Column:
    """A typed NULL."""
    return F.lit(None).cast(kind)


@dataclass
class Sources:
    """What a load reads: raw tables, and raw tables cut at the watermark of their part."""

    read: Reader
    run_ts: datetime
    marks: dict[str, Any] = field(default_factory=dict)
    ranges: dict[str, IdRange] = field(default_factory=dict)
    single_lookups: bool = False
    observed: dict[str, Observation] | None = None

    def __call__(self, table: str, columns: str | None = None) -> DataFrame:
        df = self.read(table)
        return df if columns is None else df.select(*[q(c.strip()) for c in columns.split(",")])

    def fresh(self, table: str, ident: str, part: str = MAIN) -> DataFrame:
        rows = newer(self.read(table), ident, self.marks.get(part))
        if self.observed is None:
            return rows
        self.observed[part] = Observation()
        return rows.observe(self.observed[part], F.max(q(ident)).alias("mark"))

    def seen(self) -> dict[str, Any]:
        """Per part the largest `ident` that the load has read, known once its rows are written."""
        return {p: o.get.get("mark") for p, o in (self.observed or {}).items()}

    def offset(self, part: str) -> int:
        return self.ranges[part].offset

    def attribute(self, table: str, key: str, columns: str, newest_by: str) -> DataFrame:
        """A side table joined on `key`. It may hold several rows per key, which multiply the rows of
        the load; with `single_lookups` only the newest is used."""
        df = self.read(table).filter(q(key).isNotNull())
        if self.single_lookups:
            df = latest_per_key(df, [key], [q(newest_by).desc_nulls_last()])
        return df.select(*[q(c.strip()) for c in f"{key},{columns}".split(",")])

    def validity(self) -> dict[str, Column]:
        return {"Valid From": moment(self.run_ts), "Valid To": open_end(), "Lineage Key": F.lit(1)}


@dataclass(frozen=True)
class CleanLoad:
    """Raw to clean layer.

    `by` is the watermark: ``id`` (largest target id, per range when the load merges sub-types),
    ``date`` (largest target date), ``control`` (date in the control table, advanced to the largest
    source date of each part) or ``none`` (full snapshot).
    """

    target: str
    build: Callable[[Sources], DataFrame]
    ident: str = ""
    by: str = "id"
    ranges: dict[str, IdRange] = field(default_factory=dict)
    control_dates: dict[str, tuple[str, str]] = field(default_factory=dict)
    validity: bool = True

    def control_name(self, part: str) -> str:
        return self.target if part == MAIN else f"{self.target}/{part}"

    def rows(self, sources: Sources) -> DataFrame:
        df = self.build(sources)
        return df.withColumns(sources.validity()) if self.validity else df


def clean_marks(load: CleanLoad, store: Store, control: ControlTables | None) -> dict[str, Any]:
    """The watermarks of a load, from the control table or from what was recorded with the target's writes."""
    if load.by == "control":
        return {p: control.watermark(load.control_name(p)) for p in load.control_dates}
    if load.by == "none":
        return {}
    if load.ranges:
        return stored_range_marks(store, load.target, load.ident, load.ranges)
    return {MAIN: stored_mark(store, load.target, load.ident)}


def load_clean(load: CleanLoad, read: Reader, store: Store, run_ts: datetime, control: ControlTables | None = None,
               single_lookups: bool = False, marks: dict[str, dict[str, Any]] | None = None, sort_by: Sequence[str] = ()) -> int:
    """Run one load and return the rows written (counted by the write itself).

    With `sort_by` the rows are written in that order, over all files: later loads then skip the row groups below their mark, and
    keys given by place follow the order.

    A load by control date then moves the mark of each part to the largest date of the rows it has read, so that rows
    arriving meanwhile belong to the next run. A header counts as read when its lines come later.
    """
    by_control = load.by == "control"
    sources = Sources(read, run_ts, clean_marks(load, store, control), load.ranges, single_lookups, {} if by_control else None)
    rows, watch = load.rows(sources), watches(load.ident, load.ranges)
    if sort_by:
        rows = rows.orderBy(*[q(c) for c in sort_by])
    written = (store.replace if load.by == "none" else store.append)(load.target, rows, watch=watch)
    if not by_control:
        return written
    if marks is not None and written:
        marks[load.target] = sources.seen()
    return written


def digests_of(target: str) -> str:
    """The table with the row digests of a staging's last snapshot."""
    return f"{target}_Huellas"


def load_changes(load: CleanLoad, read: Reader, store: Store, run_ts: datetime, key: Sequence[str] = (), single_lookups: bool = False) -> int:
    """Stage what has changed in the whole source since the last run; rows written are returned.

    New and changed rows are staged as they are now. A row that is gone from the source is staged once more as it was, with a
    validity that ends now, which closes its dimension member (`Dimension.ends`). The staging needs validity columns, and `key` (else
    the load's id) must be unique. The rows are staged before their digests: a run that ends in between is repeated with
    the same outcome, as a dimension takes the newest row of a member.
    """
    key, known = list(key) or [load.ident], digests_of(load.target)
    rows = cut_lineage(load.rows(Sources(read, run_ts, {}, load.ranges, single_lookups)))
    own = ["Valid From", "Valid To"]
    if not store.exists(known):
        written = store.append(load.target, rows, watch=watches(load.ident, load.ranges))
        store.replace(known, digests(rows, key, own))
        return written
    states = cut_lineage(difference(rows, store.read(known), key, own))
    fresh = rows.join(states.filter(F.col("_state") != VANISHED), key, "left_semi")
    gone = states.filter(F.col("_state") == VANISHED).select(*[q(k) for k in key])
    last = latest_per_key(store.read(load.target).join(gone, key, "left_semi"), key, [q("Valid From").desc_nulls_last()])
    ended = last.withColumns({"Valid From": moment(run_ts), "Valid To": moment(run_ts)})
    written = store.append(load.target, fresh.unionByName(ended.select(*[q(c) for c in fresh.columns])), watch=watches(load.ident, load.ranges))
    store.replace(known, digests(rows, key, own))
    return written


def run_clean_layer(loads: Mapping[str, CleanLoad], read: Reader, store: Store, run_ts: datetime, only: str | None = None,
                    parallel: int = 1, single_lookups: bool = False, sort_by: Mapping[str, Sequence[str]] | None = None) -> LayerResult:
    """All loads of a clean layer (or `only` one), with control and log rows. `sort_by`: see `load_clean`."""
    control, marks = ControlTables(store), {}

    def job(load: CleanLoad) -> Callable[[], int]:
        return lambda: load_clean(load, read, store, run_ts, control, single_lookups, marks, (sort_by or {}).get(load.target, ()))

    def done(name: str) -> bool:
        return loads[name].by != "control"

    result = run_layer({n: job(x) for n, x in loads.items()}, control, run_ts, only, parallel, control_rows_for=done)
    moved = {loads[n].control_name(p): mark for n, parts in marks.items() for p, mark in parts.items() if mark is not None}
    if moved:
        control.advance_all(moved, run_ts)
    return result
