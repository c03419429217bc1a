"""Data dictionary: tables, columns and their descriptions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bodega.operators.name_rules import RAW_DESCRIPTIONS, WAREHOUSE_DESCRIPTIONS, text_column
from bodega.sources.store import Store


@dataclass(frozen=True)
class CatalogEntry:
    """One table as the dictionary sees it. Key and length facts live in the field metadata:
    ``pk``, ``fk``, ``max_length``, ``sql_type``, ``comment``. `rows` is the number of rows where it is known without a count."""

    layer: str
    database: str
    schema: str
    table: str
    data: DataFrame
    description: str | None = None
    created: datetime | None = None
    modified: datetime | None = None
    rows: int | None = None


# What each layer shows.
SILVER_SCHEMA = "Integration"
GOLD_SCHEMAS = ("Dimension", "Fact")
SYSTEM_SCHEMAS = ("sys", "INFORMATION_SCHEMA")


def in_scope(entry: CatalogEntry) -> bool:
    """Archive tables are hidden; Silver shows staging tables only, Gold its two schemas only."""
    if "archive" in entry.table.lower():
        return False
    if entry.layer == "Silver":
        return entry.schema == SILVER_SCHEMA and entry.table.endswith("_Staging")
    if entry.layer == "Gold":
        return entry.schema in GOLD_SCHEMAS
    return entry.schema not in SYSTEM_SCHEMAS


def table_catalog(entries: Iterable[CatalogEntry]) -> DataFrame:
    """One row per table in scope with its row and column counts. A known count is shown as it is; others are counted from
    the files' footers, without reading a column."""
    def counted(e: CatalogEntry) -> DataFrame:
        if e.rows is not None:
            return e.data.sparkSession.createDataFrame([(e.rows,)], "row_count bigint")
        return e.data.agg(F.count(F.lit(1)).alias("row_count"))

    rows = [
        counted(e).select(
            F.lit(e.layer).alias("capa"), F.lit(e.database).alias("base_datos"), F.lit(e.schema).alias("schema_name"),
            F.lit(e.table).alias("table_name"),
            F.lit(None if e.created is None else str(e.created)).cast("timestamp_ntz").alias("create_date"),
            F.lit(None if e.modified is None else str(e.modified)).cast("timestamp_ntz").alias("modify_date"),
            F.lit(e.description).cast("string").alias("table_description"),
            "row_count", F.lit(len(e.data.columns)).alias("column_count"),
        )
        for e in entries if in_scope(e)
    ]
    return reduce(DataFrame.unionByName, rows)


COLUMN_CATALOG = (
    "capa string, base_datos string, schema_name string, table_name string, column_name string, data_type string, "
    "max_length int, precision int, scale int, is_nullable boolean, es_pk int, es_fk int, "
    "DescripcionCampo string, OrdenCampo int"
)


def _type_facts(field: T.StructField) -> tuple[str, int | None, int | None, int | None]:
    kind = field.dataType
    name = field.metadata.get("sql_type", kind.typeName())
    if isinstance(kind, T.DecimalType):
        return name, field.metadata.get("max_length"), kind.precision, kind.scale
    return name, field.metadata.get("max_length"), None, None


def column_catalog(spark: SparkSession, entries: Iterable[CatalogEntry]) -> DataFrame:
    """One row per column in scope, from schemas already on the driver (no data is read)."""
    rows = []
    for e in entries:
        if not in_scope(e):
            continue
        for i, f in enumerate(e.data.schema.fields, 1):
            name, length, precision, scale = _type_facts(f)
            rows.append((
                e.layer, e.database, e.schema, e.table, f.name, name, length, precision, scale, f.nullable,
                int(bool(f.metadata.get("pk"))), int(bool(f.metadata.get("fk"))), f.metadata.get("comment"), i,
            ))
    return spark.createDataFrame(rows, COLUMN_CATALOG)


def stored_tables(store: Store, layer: str, database: str, names: Mapping[str, tuple[str, str]]) -> list[CatalogEntry]:
    """Entries for tables of a store, with the row counts and types that its versions name; `names` maps a stored table to
    (schema, table). Tables not written yet are left out."""
    return [CatalogEntry(layer, database, schema, table, store.read(name), rows=store.rows(name))
            for name, (schema, table) in names.items() if store.exists(name)]


def session_tables(spark: SparkSession, layer_of: dict[str, tuple[str, str, str]]) -> list[CatalogEntry]:
    """Entries for the tables registered in the session catalog; `layer_of` maps a catalog database to
    (layer, database, schema)."""
    entries = []
    for database, (layer, name, schema) in layer_of.items():
        for t in spark.catalog.listTables(database):
            data = spark.table(f"`{database}`.`{t.name}`")
            entries.append(CatalogEntry(layer, name, schema, t.name, data, t.description))
    return entries


def describe_raw_columns(table: str = "table_name", column: str = "column_name", data_type: str = "data_type") -> Column:
    """Description of a Bronze column by its name."""
    return text_column(RAW_DESCRIPTIONS, F.col(column), F.col(data_type), F.col(table))


def describe_warehouse_columns(column: str = "column_name", data_type: str = "data_type") -> Column:
    """Description of a Silver or Gold column by its name."""
    return text_column(WAREHOUSE_DESCRIPTIONS, F.col(column), F.col(data_type))


def set_descriptions(descriptions: DataFrame, updates: DataFrame, known: DataFrame) -> DataFrame:
    """Descriptions keyed by (schema_name, table_name): updated when present, added when not, and
    ignored for tables the catalog does not know."""
    keys = ["schema_name", "table_name"]
    valid = updates.join(known.select(*keys).distinct(), keys, "left_semi")
    return descriptions.join(valid, keys, "left_anti").unionByName(valid)
