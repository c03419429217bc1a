"""Column lineage: proposed mappings, their validation against the catalog, and reachability."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bodega.operators.name_rules import CLEAN_LABELS, CLEAN_RULES, STAR_LABELS, STAR_RULES, text_column

MAPPING_COLUMNS = (
    "BDOrigen", "EsquemaOrigen", "NombreObjetoOrigen", "NombreCampoOrigen", "NombreCampoOrigenEnVentanaOB",
    "Transformacion", "BDDestino", "EsquemaDestino", "TablaDestino", "NombreCampoDestino", "TipoCampoDestino",
    "OrdenCamposTablaDestino",
)
MAPPING_SCHEMA = ", ".join(f"{c} {'int' if c.startswith('Orden') else 'string'}" for c in MAPPING_COLUMNS)
TARGET = ("BDDestino", "EsquemaDestino", "TablaDestino", "NombreCampoDestino")
SOURCE = ("BDOrigen", "EsquemaOrigen", "NombreObjetoOrigen", "NombreCampoOrigen")

# Columns of the warehouse that carry no source field.
TECHNICAL = ("Valid From", "Valid To", "Lineage Key")


def _declared_type(name: Column, length: Column) -> Column:
    return F.when(name.contains("char"), F.concat(name, F.lit("("), length.cast("string"), F.lit(")"))).otherwise(name)


def _not_listed(gaps: Mapping[str, Sequence[str]]) -> Column:
    """Not one of the table/column pairs left out on purpose."""
    tests = [(F.col("table_name") == t) & F.col("column_name").isin(*cols) for t, cols in gaps.items()]
    return ~reduce(lambda a, b: a | b, tests) if tests else F.lit(True)


def propose_clean_layer(columns: DataFrame, sources: DataFrame, gaps: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Silver <- Bronze: every staging column mapped to its main source table under its own name.

    `sources` has (staging, database, schema, table). Surrogate staging keys, technical columns and
    the `gaps` are left out.
    """
    c, ty = F.col("column_name"), F.col("data_type")
    wanted = columns.filter(F.col("schema_name") == "Integration").filter(
        ~c.like("%Staging Key") & ~c.isin(*TECHNICAL) & _not_listed(gaps or {})
    )
    return wanted.join(sources, F.col("table_name") == F.col("staging"), "inner").select(
        F.col("database").alias("BDOrigen"), F.col("schema").alias("EsquemaOrigen"),
        F.col("table").alias("NombreObjetoOrigen"), c.alias("NombreCampoOrigen"),
        text_column(CLEAN_LABELS, c, ty).alias("NombreCampoOrigenEnVentanaOB"), text_column(CLEAN_RULES, c, ty).alias("Transformacion"),
        F.col("base_datos").alias("BDDestino"), F.col("schema_name").alias("EsquemaDestino"),
        F.col("table_name").alias("TablaDestino"), c.alias("NombreCampoDestino"),
        _declared_type(ty, F.col("max_length")).alias("TipoCampoDestino"),
        F.col("OrdenCampo").alias("OrdenCamposTablaDestino"),
    )


def propose_star_layer(columns: DataFrame, gaps: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Gold <- Silver: each column mapped to the staging table named after its own table."""
    c, ty = F.col("column_name"), F.col("data_type")
    own_key = c.rlike("[ _]Key$") & (F.col("OrdenCampo") == 1)
    wanted = columns.filter(F.col("schema_name").isin("Dimension", "Fact")).filter(
        ~F.col("table_name").like("%Archive%") & (c != "Lineage Key") & ~own_key & _not_listed(gaps or {})
    )
    return wanted.select(
        F.col("base_datos").alias("BDOrigen"), F.lit("Integration").alias("EsquemaOrigen"),
        F.concat("table_name", F.lit("_Staging")).alias("NombreObjetoOrigen"), c.alias("NombreCampoOrigen"),
        text_column(STAR_LABELS, c, ty).alias("NombreCampoOrigenEnVentanaOB"), text_column(STAR_RULES, c, ty).alias("Transformacion"),
        F.col("base_datos").alias("BDDestino"), F.col("schema_name").alias("EsquemaDestino"),
        F.col("table_name").alias("TablaDestino"), c.alias("NombreCampoDestino"),
        _declared_type(ty, F.col("max_length")).alias("TipoCampoDestino"),
        F.col("OrdenCampo").alias("OrdenCamposTablaDestino"),
    )


def manual_rows(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """Hand-written mappings (secondary sources, or invalid ones that prove the diagnostics)."""
    return spark.createDataFrame(list(rows), MAPPING_SCHEMA)


def one_mapping_per_target(mapping: DataFrame) -> DataFrame:
    """The canonical mapping per target field: lowest field order, then source table name.

    The rank limit is applied on each map task before the shuffle, so a target field with very many
    candidates is never gathered whole.
    """
    order = [F.col("OrdenCamposTablaDestino"), F.col("NombreObjetoOrigen"), F.col("NombreCampoOrigen")]
    rank = F.row_number().over(Window.partitionBy(*TARGET).orderBy(*order))
    return mapping.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def _folded(c: str, case_insensitive: bool) -> Column:
    return F.lower(F.rtrim(F.col(c))) if case_insensitive else F.col(c)


def enrich(mapping: DataFrame, columns: DataFrame, tables: DataFrame, case_insensitive: bool = True) -> DataFrame:
    """Mappings with type, length and layer of both ends and six diagnostic flags."""
    field_keys = ("base_datos", "schema_name", "table_name", "column_name")

    def attach(df: DataFrame, side: DataFrame, ends: Sequence[str], take: Mapping[str, str], mark: str) -> DataFrame:
        keys = field_keys[: len(ends)]
        lookup = side.select(
            *[_folded(k, case_insensitive).alias(f"_k{i}") for i, k in enumerate(keys)],
            *[F.col(src).alias(out) for out, src in take.items()], F.lit(1).alias(mark),
        )
        condition = [_folded(e, case_insensitive) == F.col(f"_k{i}") for i, e in enumerate(ends)]
        return df.join(lookup, reduce(lambda a, b: a & b, condition), "left").drop(*[f"_k{i}" for i in range(len(keys))])

    df = attach(mapping, columns, SOURCE, {"tipo_origen": "data_type", "longitud_origen": "max_length"}, "_sc")
    df = attach(df, tables, SOURCE[:3], {"capa_origen": "capa"}, "_st")
    df = attach(df, columns, TARGET, {"tipo_destino": "data_type", "longitud_destino": "max_length"}, "_tc")
    df = attach(df, tables, TARGET[:3], {"capa_destino": "capa"}, "_tt")

    def missing(mark: str) -> Column:
        return F.col(mark).isNull().cast("int")

    def empty(name: str) -> Column:
        return (F.coalesce(F.rtrim(F.col(name)), F.lit("")) == "").cast("int")

    return df.select(
        *mapping.columns, "tipo_origen", "longitud_origen", "capa_origen", "tipo_destino", "longitud_destino", "capa_destino",
        missing("_sc").alias("campo_origen_inexistente"), missing("_tc").alias("campo_destino_inexistente"),
        missing("_st").alias("tabla_origen_inexistente"), missing("_tt").alias("tabla_destino_inexistente"),
        empty("NombreCampoOrigen").alias("origen_vacio"), empty("NombreCampoDestino").alias("destino_vacio"),
    )


def mapping_checks(enriched: DataFrame) -> DataFrame:
    """Per target schema: mapped fields, target fields that do not exist, fields mapped more than once."""
    per_field = enriched.groupBy(*TARGET).agg(
        F.count(F.lit(1)).alias("_n"), F.sum("campo_destino_inexistente").alias("_missing")
    )
    return per_field.groupBy("EsquemaDestino").agg(
        F.sum("_n").alias("campos"), F.sum("_missing").alias("campos_no_existentes"),
        F.count_if(F.col("_n") > 1).alias("duplicados"),
    )


def closure(lower: DataFrame, upper: DataFrame) -> DataFrame:
    """Fields of the first layer with every field of the third they reach.

    `lower` maps layer 1 to 2 and `upper` maps 2 to 3; the hop is an equi-join on the middle field.
    Give it mappings with one source per target (`one_mapping_per_target`), and there is at most one
    row per target field. Both sides are reduced to distinct field pairs first. Follow it upstream or
    downstream by filtering either end.
    """
    down = lower.select(*[F.col(c).alias(f"desde_{c}") for c in SOURCE], *[F.col(c).alias(f"_m{i}") for i, c in enumerate(TARGET)]).distinct()
    up = upper.select(*[F.col(c).alias(f"_m{i}") for i, c in enumerate(SOURCE)], *[F.col(c).alias(f"hasta_{c}") for c in TARGET]).distinct()
    middle = [f"_m{i}" for i in range(4)]
    return down.join(up, middle, "inner").select(
        *[f"desde_{c}" for c in SOURCE], *[F.col(m).alias(f"via_{c}") for m, c in zip(middle, TARGET)],
        *[f"hasta_{c}" for c in TARGET],
    )


def orphan_tables(tables: DataFrame, mapping: DataFrame) -> DataFrame:
    """Empty catalog tables that no mapping reads or fills."""
    ends = mapping.select(
        F.col("BDOrigen").alias("base_datos"), F.col("EsquemaOrigen").alias("schema_name"), F.col("NombreObjetoOrigen").alias("table_name")
    ).unionByName(mapping.select(
        F.col("BDDestino").alias("base_datos"), F.col("EsquemaDestino").alias("schema_name"), F.col("TablaDestino").alias("table_name")
    )).distinct()
    return tables.filter(F.col("row_count") == 0).join(ends, ["base_datos", "schema_name", "table_name"], "left_anti")
