"""A profiling run over a catalog: open the run log, profile what is due, log failures, close, keep three dates."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bodega.operators.catalog import CatalogEntry, in_scope
from bodega.operators.quality import Sweep, TableName, close_run, merge_states, profile_state, sweep
from bodega.sources.store import Store

RESULTS, RUNS, ERRORS = "DQ_Resultados", "RegistroCargas", "DQ_LOG"
PROCEDURE = "perfil_columnas"

RUN_COLUMNS = (
    "FechaEjecucion timestamp_ntz, FechaFinEjecucion timestamp_ntz, Paquete string, Procedimiento string, NomFichero string, "
    "NomTablaDestino string, Nuevos int, Actualizados int, Eliminados int, DuracionSeg int, DuracionMin int, Correcto boolean"
)
ERROR_COLUMNS = (
    "Fecha timestamp_ntz, Paquete string, Procedimiento string, BaseDatos string, SchemaName string, Tabla string, "
    "Columna string, MensajeError string"
)


#: Partition of the results: the date of a run.
RUN_DATE = "fecha_ejecucion"
KEPT_RUNS = 3
#: Hidden partition of a kept profile state: the part of the table that it is of.
PART = "_part"


def drop_old_runs(store: Store, kept: int = KEPT_RUNS) -> None:
    """Keep the newest run dates: older ones' partitions are dropped, the others stay where they are."""
    version = store.version(RESULTS)
    if version is None:
        return
    dates = sorted({p.values[RUN_DATE] for p in version.parts if p.values[RUN_DATE]}, reverse=True)
    store.drop(RESULTS, lambda p: p.values[RUN_DATE] in dates[kept:])


def refresh_state(tables: Store, table: str, states: Store) -> DataFrame:
    """The merged profile state of a stored table, kept per part: parts that are new since the last call alone are read, and
    the states of parts that the table no longer has are dropped."""
    version, kept = tables.version(table), f"{table}_Estado"
    current = {p.path: p for p in version.parts}
    states.drop(kept, lambda p: p.values[PART] not in current)
    known = {p.values[PART] for p in states.version(kept).parts} if states.exists(kept) else set()
    for path, part in current.items():
        if path not in known:
            state = profile_state(tables.read(table, [part])).withColumn(PART, F.lit(path))
            states.append(kept, state, partition_by=(PART,))
    return merge_states(states.read(kept))


@dataclass
class QualityRun:
    store: Store
    package: str = "DQ_Analisis"
    clock: Callable[[], datetime] = datetime.now

    def results(self) -> DataFrame:
        return self.store.read(RESULTS)

    def _done(self, day: str) -> set[TableName]:
        """Tables that have a result for the day (one row per table comes to the driver)."""
        if not self.store.exists(RESULTS):
            return set()
        today = self.results().filter(F.col("fecha_ejecucion") == F.lit(day).cast("date"))
        return {TableName(*r) for r in today.select("base_datos", "schema_name", "tabla").distinct().collect()}

    def _append(self, table: str, columns: str, row: tuple) -> None:
        self.store.append(table, self.store.spark.createDataFrame([row], columns))

    def run(self, entries: Iterable[CatalogEntry], now: datetime | None = None) -> Sweep:
        start = now or self.clock()
        day, written = str(start.date()), 0
        self._append(RUNS, RUN_COLUMNS, (start, None, self.package, PROCEDURE, "", RESULTS, None, None, None, None, None, None))

        def save(name: TableName, result: DataFrame) -> None:
            nonlocal written
            written += self.store.append(RESULTS, result, partition_by=(RUN_DATE,))

        tables = {TableName(e.database, e.schema, e.table): e.data for e in entries if in_scope(e)}
        ok = False
        try:
            out = sweep(tables, day, save, self._done(day))
            for name, column, message in out.failures:
                self._append(ERRORS, ERROR_COLUMNS, (start, self.package, PROCEDURE, name.database, name.schema, name.table, column, message))
            ok = True
        finally:
            closed = close_run(self.store.read(RUNS), self.package, PROCEDURE, written, self.clock() if now is None else now, ok)
            self.store.replace(RUNS, closed)
        drop_old_runs(self.store)
        return out
