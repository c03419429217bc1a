"""Texts given to columns by what their names and types look like: rules as data, for two engines.

A rule is (text, name pattern, pattern the name must not have, type pattern); an empty pattern asks for nothing. The first rule
that fits gives the text. In a text, {tabla} and {campo} stand for the table and the column, {resto} for the column
without the word Fecha, lower-case, and {resto_junto} for the same without leading blanks.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Rule = tuple[str, str, str, str]

TEXT_TYPES = "^(n?varchar|n?char|string)$"
BIT_TYPES = "^(bit|boolean)$"
DECIMAL_TYPES = "^(decimal|numeric|money)$"

# Descriptions of Bronze columns.
RAW_DESCRIPTIONS: Sequence[Rule] = (
    ("Identificador único de {tabla} (clave de negocio).", "ID$", "Tipo", ""),
    ("Fecha de {resto}.", "^Fecha", "", ""),
    ("Importe monetario en euros.", "Importe|Saldo", "", ""),
    ("Correo electrónico de contacto.", "Email", "", ""),
    ("Número de teléfono de contacto.", "Telefono", "", ""),
    ("Denominación o nombre.", "Nombre|RazonSocial", "", ""),
    ("Estado o situación actual.", "Estado", "", ""),
    ("Indicador booleano (Sí/No).", "", "", BIT_TYPES),
    ("Campo {campo} del sistema origen.", "", "", ""),
)

# Descriptions of Silver and Gold columns. A key ends in Key after a blank or underscore.
WAREHOUSE_DESCRIPTIONS: Sequence[Rule] = (
    ("Clave de fecha (Date Key).", "Date.*[ _]Key$", "", ""),
    ("Clave de fecha entera (YYYYMMDD).", "Fecha.*[ _]Key$", "", ""),
    ("Clave de linaje: identifica el proceso ETL que cargó el registro.", "^Lineage Key$", "", ""),
    ("Clave surrogada (identificador interno del almacén). Lookup a dimensión; 0 = miembro desconocido.", "[ _]Key$", "", ""),
    ("SCD2: inicio de vigencia de esta versión del registro.", "^Valid From$", "", ""),
    ("SCD2: fin de vigencia (9999-12-31 = versión actual).", "^Valid To$", "", ""),
    ("Identificador de negocio heredado del sistema origen.", "^WWI.*ID$", "", ""),
    ("Fecha de {resto_junto}.", "^Fecha", "", ""),
    ("Importe monetario en euros.", "Importe|Saldo", "", ""),
    ("Edad calculada del cliente (campo derivado).", "^Edad$", "", ""),
    ("Correo electrónico.", "Email", "", ""),
    ("Denominación o nombre.", "Nombre", "", ""),
    ("Estado o situación.", "Estado", "", ""),
    ("Indicador booleano (Sí/No).", "", "", BIT_TYPES),
    ("Atributo {campo}.", "", "", ""),
)

# What the terminal calls a Silver column, and how it comes from Bronze.
CLEAN_LABELS: Sequence[Rule] = (
    ("Importe en euros mostrado en terminal", "Importe|Saldo", "", ""),
    ("Fecha operación (dd/mm/aaaa)", "Fecha", "", ""),
    ("Denominación cliente en pantalla", "Nombre|Cliente", "", ""),
    ("Código IBAN cuenta", "Cuenta", "", ""),
    ("Situación del contrato", "Estado", "", ""),
    ("Campo {campo} del terminal", "", "", ""),
)
CLEAN_RULES: Sequence[Rule] = (
    ("Campo calculado: DATEDIFF(YEAR, Fecha Nacimiento, hoy)", "^Edad$", "", ""),
    ("Normalización: LOWER(TRIM(origen))", "Email", "", ""),
    ("Estandarización: UPPER(TRIM(origen)) + desnormalización vía JOIN", "", "", TEXT_TYPES),
    ("Redondeo a 2 decimales: ROUND(origen,2)", "", "", DECIMAL_TYPES),
    ("Conversión a indicador binario (0/1)", "", "", BIT_TYPES),
    ("Copia directa de fecha", "", "", "date|timestamp"),
    ("Copia directa desde origen", "", "", ""),
)

# What the terminal calls a Gold column, and how it comes from Silver.
STAR_LABELS: Sequence[Rule] = (
    ("Identificador interno (no visible en terminal)", "Key$", "", ""),
    ("Importe en euros", "Importe|Saldo", "", ""),
    ("Fecha (dd/mm/aaaa)", "Fecha", "", ""),
    ("Campo {campo}", "", "", ""),
)
STAR_RULES: Sequence[Rule] = (
    ("Lookup clave surrogada en dimensión (0 si no encuentra)", "Key$", "Date|Fecha|Lineage", ""),
    ("Conversión Date Key entero YYYYMMDD", "Fecha.*Key", "", ""),
    ("SCD Tipo 2: vigencia histórica", "^Valid (From|To)$", "", ""),
    ("Calculado: COUNT cuotas PENDIENTE", "^Cuotas Pendientes$", "", ""),
    ("Calculado: COUNT cuotas IMPAGADA", "^Cuotas Impagadas$", "", ""),
    ("Calculado: MAX días retraso", "^Dias Retraso Maximo$", "", ""),
    ("Copia directa desde Silver", "", "", ""),
)


def _pieces(text: str) -> list[str]:
    return [p for p in re.split(r"(\{\w+\})", text) if p]


def text_column(rules: Sequence[Rule], column: Column, data_type: Column, table: Column | None = None) -> Column:
    """The text of the first rule that fits, as a column."""
    rest = F.lower(F.replace(column, F.lit("Fecha"), F.lit("")))
    parts = {"{tabla}": table, "{campo}": column, "{resto}": rest, "{resto_junto}": F.ltrim(rest)}
    out = []
    for text, name, without, kind in rules:
        test = F.lit(True)
        if name:
            test = test & column.rlike(name)
        if without:
            test = test & ~column.rlike(without)
        if kind:
            test = test & data_type.rlike(kind)
        out.append(F.when(test, F.concat(*[parts[p] if p in parts else F.lit(p) for p in _pieces(text)])))
    return F.coalesce(*out)


def text_sql(rules: Sequence[Rule], column: str, data_type: str, table: str = "''") -> str:
    """The same as the text of an SQL expression."""
    rest = f"lower(replace({column}, 'Fecha', ''))"
    parts = {"{tabla}": table, "{campo}": column, "{resto}": rest, "{resto_junto}": f"ltrim({rest})"}
    cases = []
    for text, name, without, kind in rules:
        tests = ["true"]
        if name:
            tests.append(f"regexp_matches({column}, '{name}')")
        if without:
            tests.append(f"not regexp_matches({column}, '{without}')")
        if kind:
            tests.append(f"regexp_matches({data_type}, '{kind}')")
        value = " || ".join(parts.get(p, f"'{p}'") for p in _pieces(text))
        cases.append(f"when {' and '.join(tests)} then {value}")
    return f"case {' '.join(cases)} end"
