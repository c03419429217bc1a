"""Control table, run log and the layer runner."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta
from functools import reduce
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType

from bodega.functions.dates import NEVER_LOADED, moment
from bodega.sources.store import Part, Store

CONTROL = "ControlCarga"
RUN_LOG = "LogEjecucion"

CONTROL_SCHEMA = StructType([
    StructField("TablaStagingDestino", StringType(), False),
    StructField("UltimaFechaProcesada", TimestampNTZType()),
    StructField("Estado", StringType(), False),
    StructField("FechaUltimaEjecucion", TimestampNTZType()),
])
RUN_LOG_SCHEMA = StructType([
    StructField("NombreProceso", StringType(), False),
    StructField("TablaDestino", StringType(), False),
    StructField("RegistrosCargados", LongType(), False),
    StructField("DuracionSegundos", IntegerType(), False),
    StructField("Estado", StringType(), False),
    StructField("MensajeError", StringType()),
    StructField("FechaEjecucion", TimestampNTZType(), False),
])


def upsert(table: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """The table with `rows` replacing those of equal key and added where there are none."""
    return table.join(rows, key, "left_anti").select(*table.columns).unionByName(rows.select(*table.columns))


def control_rows(marks: DataFrame, run_ts: datetime | str) -> DataFrame:
    """Control rows from (TablaStagingDestino, UltimaFechaProcesada); a missing date becomes `run_ts`."""
    return marks.select(
        "TablaStagingDestino",
        F.coalesce(F.col("UltimaFechaProcesada").cast("timestamp_ntz"), moment(run_ts)).alias("UltimaFechaProcesada"),
        F.lit("OK").alias("Estado"),
        moment(run_ts).alias("FechaUltimaEjecucion"),
    )


def last_processed(control: DataFrame, table: str) -> DataFrame:
    """One row: the control date of `table`, or the never-loaded date when it has none."""
    return control.filter(F.col("TablaStagingDestino") == table).agg(
        F.coalesce(F.max("UltimaFechaProcesada"), moment(NEVER_LOADED)).alias("UltimaFechaProcesada")
    )


def purge(log: DataFrame, run_ts: datetime | str, days: int = 90, column: str = "FechaEjecucion") -> DataFrame:
    """The log without rows older than `days`."""
    return log.filter(~(F.col(column) < moment(run_ts) - F.make_dt_interval(days=F.lit(days))))


def newest_runs(log: DataFrame, n: int = 10) -> DataFrame:
    """The status report's last runs (top-k per task, then merged)."""
    return log.orderBy(F.col("FechaEjecucion").desc(), "NombreProceso", "TablaDestino").limit(n)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its count, sorted by name. Counting reads no data columns."""
    counts = [df.agg(F.count(F.lit(1)).alias("Filas")).select(F.lit(n).alias("Tabla"), "Filas") for n, df in tables.items()]
    return reduce(DataFrame.unionByName, counts).orderBy("Tabla")


#: Hidden partition of the stored run log: the day of a row.
DAY = "_day"


def log_rows(store: Store, rows: DataFrame, table: str = RUN_LOG, column: str = "FechaEjecucion") -> int:
    """Append to a log that is stored by day."""
    return store.append(table, rows.withColumn(DAY, F.col(column).cast("date")), partition_by=(DAY,))


def purge_partitions(store: Store, table: str, run_ts: datetime, days: int = 90, column: str = "FechaEjecucion") -> int:
    """Purge a log stored by day: whole days before the limit are dropped, and only the day of the limit is written anew.

    Returns the rows written, which are those kept of that day.
    """
    version, limit = store.version(table), run_ts - timedelta(days=days)
    if version is None:
        return 0

    def day(part: Part) -> date | None:
        return date.fromisoformat(part.values[DAY]) if part.values[DAY] else None

    last = [p for p in version.parts if day(p) == limit.date()]
    gone = {p.path for p in version.parts if day(p) and day(p) <= limit.date()}
    if not gone:
        return 0
    kept = purge(store.read(table, last, hidden=True), run_ts, days, column) if last else None
    if kept is None:
        store.drop(table, lambda p: p.path in gone)
        return 0
    return store.swap(table, kept, lambda p: p.path in gone, (DAY,))


@dataclass
class ControlTables:
    """Control table and run log kept in a store."""

    store: Store

    @property
    def spark(self) -> SparkSession:
        return self.store.spark

    def control(self) -> DataFrame:
        return self.store.read_or_empty(CONTROL, CONTROL_SCHEMA)

    def log(self) -> DataFrame:
        return self.store.read_or_empty(RUN_LOG, RUN_LOG_SCHEMA)

    def watermark(self, table: str) -> datetime:
        return last_processed(self.control(), table).first()[0]

    def advance(self, table: str, mark: datetime | None, run_ts: datetime) -> None:
        self.advance_all({table: mark}, run_ts)

    def advance_all(self, moved: Mapping[str, datetime | None], run_ts: datetime) -> None:
        """Move the marks of some tables in one write."""
        marks = self.spark.createDataFrame(list(moved.items()), "TablaStagingDestino string, UltimaFechaProcesada timestamp_ntz")
        self.store.replace(CONTROL, upsert(self.control(), control_rows(marks, run_ts), "TablaStagingDestino"))

    def record(self, process: str, table: str, rows: int, seconds: int, error: str | None, run_ts: datetime) -> None:
        state = "Exitoso" if error is None else "Error"
        row = [(process, table, rows, seconds, state, error, run_ts)]
        log_rows(self.store, self.spark.createDataFrame(row, RUN_LOG_SCHEMA))

    def purge_log(self, run_ts: datetime, days: int = 90) -> int:
        return purge_partitions(self.store, RUN_LOG, run_ts, days)

    def status(self, tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        return {
            "control": self.control().orderBy("TablaStagingDestino"),
            "runs": newest_runs(self.log()),
            "rows": row_counts(tables),
        }


@dataclass
class LayerResult:
    ok: int = 0
    errors: int = 0
    rows: dict[str, int] = field(default_factory=dict)
    messages: dict[str, str] = field(default_factory=dict)


def run_layer(
    loads: Mapping[str, Callable[[], int]],
    control: ControlTables,
    run_ts: datetime,
    only: str | None = None,
    parallel: int = 1,
    marks: Mapping[str, Callable[[], datetime | None]] | None = None,
    control_rows_for: Callable[[str], bool] = lambda name: True,
    needs: Mapping[str, set[str]] | None = None,
) -> LayerResult:
    """Run the loads of a layer; a failing load is logged and the others go on.

    Each load writes its table and returns the rows written. `only` runs a single table. `needs` names the loads that one
    must follow (of those that run): it is held back, and logged as an error, if one of them failed or was held back. Loads that
    are ready run in up to `parallel` threads of the same session: Spark schedules their jobs side by side. Log and
    control rows are written by this thread, one at a time.
    """

    def attempt(name: str) -> tuple[str, int, int, str | None]:
        started = time.monotonic()
        try:
            rows, error = loads[name](), None
        except Exception as exc:  # noqa: BLE001 - isolation is the point
            rows, error = 0, str(exc)
        return name, rows, int(time.monotonic() - started), error

    result, moved = LayerResult(), {}

    def settle(name: str, rows: int, seconds: int, error: str | None) -> None:
        control.record(f"load {name}", name, rows, seconds, error, run_ts)
        if error is None:
            result.ok += 1
            result.rows[name] = rows
            mark = (marks or {}).get(name)
            if control_rows_for(name) and (mark is None or rows > 0):
                moved[name] = mark() if mark else None
        else:
            result.errors += 1
            result.messages[name] = error

    names = [n for n in loads if only is None or n == only]
    place = {n: i for i, n in enumerate(names)}
    before = {n: [x for x in (needs or {}).get(n, ()) if x in place] for n in names}
    graph: TopologicalSorter = TopologicalSorter(before)
    graph.prepare()
    ready: list[str] = []
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        running: dict = {}
        while graph.is_active():
            ready = sorted([*ready, *graph.get_ready()], key=place.__getitem__)
            while ready and len(running) < max(1, parallel):
                name = ready.pop(0)
                failed = sorted(x for x in before[name] if x in result.messages)
                if failed:
                    settle(name, 0, 0, f"held back: {', '.join(failed)} failed")
                    graph.done(name)
                    ready = sorted([*ready, *graph.get_ready()], key=place.__getitem__)
                else:
                    running[pool.submit(attempt, name)] = name
            if not running:
                continue
            for future in wait(running, return_when=FIRST_COMPLETED).done:
                settle(*future.result())
                graph.done(running.pop(future))
    if moved:
        control.advance_all(moved, run_ts)
    return result
