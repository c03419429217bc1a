"""Column profile: counts, scores, value patterns and the inferred logical type, one row per column.

Columns of one storage type are unpivoted together to (column, value) in their own type and counted
per distinct value, so a repeated value is collapsed before the shuffle and a hot value never travels
more than once per map task. Patterns are then tested once per distinct value and weighted by its
count. Every column is read once: there is one scan per storage type, pruned to its columns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bodega.functions import identifiers as ident
from bodega.functions.dates import borders_crossed, moment

# Minimum declared length at which a pattern is tried.
NEEDS_LENGTH = {"email": 6, "dni": 9, "cp": 5, "telefono": 9, "iban": 24}

PATTERNS = ("numerico", "fecha", "email", "dni", "cp", "telefono", "iban", "booleano")

NOT_EVALUABLE = (T.BinaryType, T.ArrayType, T.MapType, T.StructType, T.VariantType, T.TimeType)
UNBOUNDED = -1


@dataclass(frozen=True)
class TableName:
    database: str
    schema: str
    table: str

    def __str__(self) -> str:
        return f"{self.database}.{self.schema}.{self.table}"


def value_class(field: T.StructField) -> str:
    """none, number, day or text."""
    if isinstance(field.dataType, NOT_EVALUABLE) or field.metadata.get("max_length") == UNBOUNDED:
        return "none"
    if isinstance(field.dataType, (T.NumericType, T.BooleanType)):
        return "number"
    if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "day"
    return "text"


def storage(field: T.StructField) -> str:
    """The type a column is counted in; columns of one storage type share a scan."""
    kind = field.dataType
    if value_class(field) == "none":
        return "none"
    if isinstance(kind, (T.BooleanType, T.IntegralType)):
        return "bigint"
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return "double"
    if isinstance(kind, T.DecimalType):
        return f"decimal({18 if kind.precision <= 18 else 38},{kind.scale})"
    if value_class(field) == "day":
        return kind.simpleString()
    return "string"


def tests_of(kind: str) -> dict[str, Column]:
    """The pattern tests of a storage type over the column _value."""
    v = F.col("_value")
    if kind == "none":
        return {}
    if kind == "string":
        return {
            "number": ident.looks_numeric(v),
            "day": ident.in_calendar(ident.text_to_date(v)),
            "yes_no": ident.yes_no_among(v, ident.YES_NO_TEXTS),
            "yes_no_bit": ident.yes_no_among(v, ident.YES_NO_TEXTS_AND_BITS),
            "no_category": ident.yes_no_among(v, ident.NOT_A_CATEGORY),
            "email": ident.looks_email(v),
            "dni": ident.looks_dni(v),
            "dni_strict": ident.strict_dni(v),
            "dni_valid": ident.valid_dni(v),
            "cp": ident.looks_postal_code(v),
            "telefono": ident.looks_phone(v),
            "iban": ident.looks_iban(v),
            "iban_valid": ident.looks_iban(v) & ident.valid_iban(v),
        }
    if kind in ("date", "timestamp", "timestamp_ntz"):
        return {"day": ident.in_calendar(v.cast("date"))}
    # A decimal with places never reads "0" or "1".
    bit = F.lit(False) if kind.startswith("decimal") and not kind.endswith(",0)") else v.isin(0, 1)
    return {"number": v.try_cast("decimal(18,4)").isNotNull(), "bit": bit}


TESTS = ("number", "day", "bit", "yes_no", "yes_no_bit", "no_category", "email", "dni", "dni_strict", "dni_valid",
         "cp", "telefono", "iban", "iban_valid")


def _flags(tests: Mapping[str, Column]) -> Column:
    """All tests of a value as one integer, so that it is tested once and summed many times."""
    bits = [F.when(test, 1 << TESTS.index(name)).otherwise(0) for name, test in tests.items()]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def value_counts(df: DataFrame, kind: str) -> DataFrame:
    """(column position, value, count, flags) of the columns stored as `kind`, a row per distinct value."""
    columns = {str(i): f for i, f in enumerate(df.schema.fields) if storage(f) == kind}
    cells = df.select(*[F.col(f"`{f.name}`").cast("int").cast(kind).alias(p) if isinstance(f.dataType, T.BooleanType)
                        else F.col(f"`{f.name}`").cast(kind).alias(p) for p, f in columns.items()])
    flags = _flags(tests_of(kind))
    if kind == "string":
        # An array of structs: the tests' shared parts do not compile over an unpivot.
        cells = cells.select(F.inline(F.array(*[F.struct(F.lit(p).alias("_position"), F.col(p).alias("_value")) for p in columns])))
        # Texts are tested whole before the shuffle and counted under their SHA-256, so that none is carried.
        digest = F.unhex(F.sha2(F.col("_value"), 256))
        counted = cells.select("_position", digest.alias("_value"), flags.alias("_flags")).groupBy("_position", "_value", "_flags")
        return counted.agg(F.count(F.lit(1)).alias("_count")).select("_position", "_value", "_count", "_flags")
    cells = cells.unpivot([], list(columns), "_position", "_value")
    counted = cells.groupBy(*cells.columns).agg(F.count(F.lit(1)).alias("_count"))
    return counted.select("_position", "_value", "_count", flags.alias("_flags"))


STATE = "columna string, valor binary, marcas int, veces bigint"


def profile_state(df: DataFrame) -> DataFrame:
    """What a profile is made of, in a form that can be kept and added up: per column and distinct value (by digest; NULL is none)
    the outcome of the tests and the number of rows. Columns that are not evaluated have one row."""
    names = F.element_at(F.create_map(*[F.lit(x) for i, f in enumerate(df.schema.fields) for x in (str(i), f.name)]), F.col("_position"))
    parts = []
    for kind in dict.fromkeys(storage(f) for f in df.schema.fields):
        if kind == "none":
            own = F.array(*[F.lit(f.name) for f in df.schema.fields if storage(f) == kind])
            parts.append(df.agg(F.count(F.lit(1)).alias("veces")).select(
                F.explode(own).alias("columna"), F.lit(None).cast("binary").alias("valor"), F.lit(None).cast("int").alias("marcas"), "veces"))
            continue
        shown = F.col("_value") + F.lit(0.0) if kind == "double" else F.col("_value")  # one zero
        value = F.col("_value") if kind == "string" else F.unhex(F.sha2(shown.cast("string"), 256))
        parts.append(value_counts(df, kind).select(names.alias("columna"), value.alias("valor"), F.col("_flags").alias("marcas"),
                                                   F.col("_count").alias("veces")))
    return reduce(DataFrame.unionByName, parts)


def merge_states(states: DataFrame) -> DataFrame:
    """The state of all rows from the states of parts of them."""
    return states.groupBy("columna", "valor", "marcas").agg(F.sum("veces").alias("veces"))


def counts_of_state(state: DataFrame, fields: Sequence[T.StructField]) -> DataFrame:
    """The counts that `column_counts` takes from rows, from a merged state."""
    n, none = F.col("veces"), F.lit(None).cast("bigint")
    place = F.create_map(*[F.lit(x) for i, f in enumerate(fields) for x in (f.name, str(i))])
    kinds = F.create_map(*[F.lit(x) for f in fields for x in (f.name, storage(f))])

    def weighted(test: str) -> Column:
        return F.sum(F.when(F.col("marcas").bitwiseAND(F.lit(1 << TESTS.index(test))) != 0, n)).alias(f"_{test}")

    summed = state.groupBy("columna").agg(
        F.sum(n).alias("filas"), F.coalesce(F.sum(F.when(F.col("valor").isNull(), n)), F.lit(0)).alias("_nulls"),
        F.count("valor").alias("_distinct"), *[weighted(t) for t in TESTS])
    evaluated = F.element_at(kinds, F.col("columna")) != "none"
    tried = {t: [k for k in {storage(f) for f in fields} if t in tests_of(k)] for t in TESTS}
    return summed.select(
        F.element_at(place, F.col("columna")).alias("_position"), "filas", F.when(evaluated, F.col("_nulls")).otherwise(0).alias("_nulls"), "_distinct",
        *[F.when(F.element_at(kinds, F.col("columna")).isin(tried[t]), F.col(f"_{t}")).otherwise(none).alias(f"_{t}") if tried[t]
          else none.alias(f"_{t}") for t in TESTS])


def _kind_counts(df: DataFrame, kind: str) -> DataFrame:
    n, none = F.col("_count"), F.lit(None).cast("bigint")
    if kind == "none":
        positions = [F.lit(str(i)) for i, f in enumerate(df.schema.fields) if storage(f) == kind]
        zero = F.lit(0).cast("bigint")
        return df.agg(F.count(F.lit(1)).alias("filas")).select(
            F.explode(F.array(*positions)).alias("_position"), "filas", zero.alias("_nulls"), zero.alias("_distinct"),
            *[none.alias(f"_{t}") for t in TESTS])
    tried = tests_of(kind)

    def weighted(test: str) -> Column:
        return F.sum(F.when(F.col("_flags").bitwiseAND(F.lit(1 << TESTS.index(test))) != 0, n)).alias(f"_{test}")

    counted = value_counts(df, kind).groupBy("_position").agg(
        F.sum(n).alias("filas"),
        F.coalesce(F.sum(F.when(F.col("_value").isNull(), n)), F.lit(0)).alias("_nulls"),
        F.count("_value").alias("_distinct"),
        *[weighted(t) for t in tried],
    )
    return counted.select("_position", "filas", "_nulls", "_distinct", *[F.col(f"_{t}") if t in tried else none.alias(f"_{t}") for t in TESTS])


def column_counts(df: DataFrame) -> DataFrame:
    """Per column position: rows, NULLs, distinct values and the weighted count of every test."""
    kinds = list(dict.fromkeys(storage(f) for f in df.schema.fields))
    return reduce(DataFrame.unionByName, [_kind_counts(df, k) for k in kinds])


def _percent(part: Column, whole: Column) -> Column:
    big = "decimal(20,0)"
    return (F.lit(100).cast(big) * part.cast(big) / F.nullif(whole, F.lit(0)).cast(big)).cast("decimal(5,2)")


def profile(df: DataFrame, name: TableName, run_date: date | str, state: DataFrame | None = None) -> DataFrame:
    """The quality result of every column of `df`; with a merged `state` its rows are not read, only its columns count."""
    fields = df.schema.fields

    def per_column(of: Callable[[T.StructField], object]) -> Column:
        pairs = [x for i, f in enumerate(fields) for x in (F.lit(str(i)), F.lit(of(f)))]
        return F.element_at(F.create_map(*pairs), F.col("_position"))

    rows, nulls, distinct = F.col("filas"), F.col("_nulls"), F.col("_distinct")
    kind, length = F.col("_kind"), F.col("_length")
    none, number, text = kind == "none", kind == "number", kind == "text"
    not_null = rows - nulls
    base = (column_counts(df) if state is None else counts_of_state(state, fields)).select(
        "*",
        per_column(lambda f: f.name).alias("columna"),
        per_column(value_class).alias("_kind"),
        per_column(lambda f: int(f.metadata.get("max_length", 1 << 30))).alias("_length"),
    )

    def tried(pattern: str) -> Column:
        return text & (length >= F.lit(NEEDS_LENGTH[pattern]))

    few = distinct.between(2, 3)
    hits = {
        "numerico": F.when(number | text, F.col("_number")),
        "fecha": F.when((kind == "day") | text, F.col("_day")),
        **{p: F.when(tried(p), F.col(f"_{p}")) for p in NEEDS_LENGTH},
    }
    yes_no = F.col("_yes_no_bit")
    shares = {p: _percent(h, rows) for p, h in hits.items()}
    hits["booleano"] = (
        F.when(number & few, F.col("_bit"))
        .when(text & (distinct == 1), F.when(F.col("_yes_no") > 0, 1).otherwise(0))
        .when(text & few, F.when(yes_no == not_null, 1).otherwise(0))
        .when(text, F.lit(0))
    )
    shares["booleano"] = (
        F.when(number & few, _percent(F.col("_bit"), rows))
        .when(text & (distinct == 1), F.when(F.col("_yes_no") > 0, F.lit(100).cast("decimal(5,2)")))
        .when(text & few, _percent(yes_no, rows))
    )
    category = text & F.col("_no_category").isNull() & distinct.between(2, 15) & (not_null > distinct)
    big = "decimal(20,0)"
    lost = F.lit(60).cast(big) * nulls.cast(big) + F.lit(40).cast(big) * (rows - distinct).cast(big)

    def measured(value: Column, kind_: str) -> Column:
        return F.when(none, F.lit(0)).otherwise(value).cast(kind_)

    measures = base.select(
        "columna", "_kind", "filas",
        measured(nulls, "bigint").alias("nulos"),
        measured(not_null - distinct, "bigint").alias("duplicados"),
        measured(_percent(nulls, rows), "decimal(5,2)").alias("porc_nulos"),
        measured(_percent(not_null - distinct, rows), "decimal(5,2)").alias("porc_duplicados"),
        measured(_percent(not_null, rows), "decimal(5,2)").alias("completitud"),
        measured((F.lit(100).cast(big) * rows.cast(big) - lost) / rows.cast(big), "decimal(5,2)").alias("scoring"),
        *[
            (F.when(none, F.lit(0)).otherwise(hits[p]) if p in ("numerico", "booleano") else hits[p])
            .cast("bigint").alias(f"posibles_{p}")
            for p in PATTERNS
        ],
        *[
            (F.when(none, F.lit(0)).otherwise(shares[p]) if p in ("numerico", "booleano") else shares[p])
            .cast("decimal(5,2)").alias(f"porc_{p}")
            for p in PATTERNS
        ],
        F.when(text, distinct).cast("int").alias("num_distintos"),
        F.when(text, category).alias("es_categorica"),
        _percent(F.coalesce(F.col("_dni_valid"), F.lit(0)), F.col("_dni_strict")).alias("_dni_ok"),
        _percent(F.coalesce(F.col("_iban_valid"), F.lit(0)), F.col("_iban")).alias("_iban_ok"),
    )
    return infer_logical_type(measures).select(
        F.lit(name.database).alias("base_datos"),
        F.lit(name.schema).alias("schema_name"),
        F.lit(name.table).alias("tabla"),
        *[c for c in RESULT_COLUMNS if c not in ("base_datos", "schema_name", "tabla", "fecha_ejecucion")],
        F.lit(str(run_date)).cast("date").alias("fecha_ejecucion"),
    )


RESULT_COLUMNS = (
    "base_datos", "schema_name", "tabla", "columna", "filas", "nulos", "duplicados",
    "porc_nulos", "porc_duplicados", "completitud", "scoring",
    *(f"posibles_{p}" for p in PATTERNS), *(f"porc_{p}" for p in PATTERNS),
    "tipo_logico", "porc_coincidencia", "fecha_ejecucion", "num_distintos", "es_categorica", "porc_conformidad",
)


def infer_logical_type(measures: DataFrame) -> DataFrame:
    """The decision list: close matches first, then exact ones, in a fixed order."""
    best = F.coalesce(
        F.greatest(
            *[F.col(f"porc_{p}") for p in PATTERNS],
            F.when(F.col("es_categorica"), F.lit(100)).otherwise(F.lit(0)).cast("decimal(5,2)"),
        ),
        F.lit(0).cast("decimal(5,2)"),
    )
    df = measures.withColumn("_best", F.when(F.col("_kind") == "none", F.lit(0).cast("decimal(5,2)")).otherwise(best))
    top = F.col("_best")
    decision = F.when(F.col("_kind") == "none", F.lit("NO EVALUABLE"))
    for pattern, label in (("email", "EMAIL"), ("dni", "DNI"), ("cp", "CP"), ("telefono", "TELEFONO"), ("iban", "IBAN")):
        decision = decision.when(F.col(f"porc_{pattern}") >= top * F.lit("0.95").cast("decimal(3,2)"), F.lit(label))
    decision = (
        decision.when(F.col("porc_booleano") == top, F.lit("BOOLEANO"))
        .when(F.col("porc_fecha") == top, F.lit("FECHA"))
        .when(F.col("es_categorica"), F.lit("CATEGORICA"))
        .when(F.col("porc_numerico") == top, F.lit("NUMERICO"))
        .when(top <= 0, F.lit("SIN INFORMAR"))
        .otherwise(F.lit("SIN_INFORMAR"))
    )
    iban, dni = F.col("porc_iban"), F.col("porc_dni")
    zero = F.lit(0).cast("decimal(5,2)")
    conformity = F.when((F.coalesce(iban, zero) >= F.coalesce(dni, zero)) & (iban >= 80), F.col("_iban_ok")).when(
        dni >= 80, F.col("_dni_ok")
    )
    return df.withColumns(
        {"tipo_logico": decision, "porc_coincidencia": F.when(top <= 0, zero).otherwise(top), "porc_conformidad": conformity}
    )


@dataclass
class Sweep:
    """What a profiling run produced: results, failed columns and the closed run-log row."""

    results: list[DataFrame]
    failures: list[tuple[TableName, str, str]]
    skipped: list[TableName]


def not_done_today(tables: DataFrame, results: DataFrame, run_date: date | str) -> DataFrame:
    """Catalog tables with rows that have no result for the run date."""
    done = results.filter(F.col("fecha_ejecucion") == F.lit(str(run_date)).cast("date")).select(
        "base_datos", "schema_name", F.col("tabla").alias("table_name")
    )
    return tables.filter(F.col("row_count") > 0).join(done.distinct(), ["base_datos", "schema_name", "table_name"], "left_anti")


def sweep(
    tables: Mapping[TableName, DataFrame],
    run_date: date | str,
    save: Callable[[TableName, DataFrame], None],
    done: Iterable[TableName] = (),
) -> Sweep:
    """Profile whole tables one by one and hand each result to `save`.

    Tables already done and empty tables are skipped. When a table's job fails, its columns are tried
    one at a time so that only the failing ones are lost and reported; a table that cannot be opened at all is
    reported without a column.
    """
    out = Sweep([], [], [])
    finished = set(done)
    for name, df in tables.items():
        if name in finished:
            out.skipped.append(name)
            continue
        try:
            if df.isEmpty():
                out.skipped.append(name)
                continue
            result = profile(df, name, run_date)
            save(name, result)
            out.results.append(result)
        except Exception as failed:  # noqa: BLE001 - retried per column below
            try:
                fields = df.schema.fields
            except Exception:  # noqa: BLE001 - the table itself is gone
                out.failures.append((name, "", str(failed)))
                continue
            for field in fields:
                try:
                    result = profile(df.select(F.col(f"`{field.name}`")), name, run_date)
                    save(name, result)
                    out.results.append(result)
                except Exception as exc:  # noqa: BLE001 - a failing column must not stop the sweep
                    out.failures.append((name, field.name, str(exc)))
    return out


def keep_newest_runs(results: DataFrame, runs: int = 3) -> DataFrame:
    """Results of the newest run dates; the dates are found by a top-k over distinct dates."""
    newest = results.select("fecha_ejecucion").distinct().orderBy(F.col("fecha_ejecucion").desc()).limit(runs)
    return results.join(newest, "fecha_ejecucion", "left_semi").select(*results.columns)


def close_run(log: DataFrame, package: str, procedure: str, rows: int, finished: datetime | str, ok: bool) -> DataFrame:
    """The run log with the open rows of one procedure closed: end, rows, seconds, minutes, outcome."""
    mine = (F.col("Paquete") == package) & (F.col("Procedimiento") == procedure) & F.col("FechaFinEjecucion").isNull()
    end, start = moment(finished), F.col("FechaEjecucion")

    def closed(value: Column, column: str) -> Column:
        return F.when(mine, value).otherwise(F.col(column))

    return log.select(
        *[
            {
                "FechaFinEjecucion": closed(end, "FechaFinEjecucion"),
                "Nuevos": closed(F.lit(rows if ok else None).cast("int"), "Nuevos"),
                "Actualizados": closed(F.lit(0 if ok else None).cast("int"), "Actualizados"),
                "Eliminados": closed(F.lit(0 if ok else None).cast("int"), "Eliminados"),
                "DuracionSeg": closed(borders_crossed("SECOND", start, end).cast("int"), "DuracionSeg"),
                "DuracionMin": closed(borders_crossed("MINUTE", start, end).cast("int"), "DuracionMin"),
                "Correcto": closed(F.lit(ok), "Correcto"),
            }.get(c, F.col(c)).alias(c)
            for c in log.columns
        ]
    )
