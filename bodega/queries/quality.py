"""Column profiles of the given tables and of a derived table of people with known defects, constraint
audits and run bookkeeping."""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bodega.functions.identifiers import DNI_LETTERS
from bodega.operators import audit
from bodega.operators.catalog import CatalogEntry
from bodega.operators.quality import (
    NEEDS_LENGTH, PATTERNS, TableName, close_run, keep_newest_runs, not_done_today, profile,
)
from bodega.operators.sampling import sample_rows, sample_sql
from bodega.plans.quality_run import ERRORS, RESULTS, RUN_DATE, RUNS, QualityRun, drop_old_runs, refresh_state
from bodega.queries.base import RUN_DAY, RUN_TS, Tables, plain, query
from bodega.queries.raw import C, dni, email, iban, phone, postal
from bodega.session import shared_folder
from bodega.sources.store import Store

PEOPLE = f"""select c_custkey as id, {dni(C)} as documento, {email(C)} as email, {phone(C)} as telefono, {postal(C)} as cp, {iban(C)} as cuenta,
    case when c_acctbal >= 0 then 'si' else 'No ' end as activo, case when c_custkey % 10 = 0 then null else c_mktsegment end as segmento,
    cast(c_custkey % 2 as int) as marca, c_acctbal > 0 as positivo, cast(c_acctbal as decimal(18,2)) as saldo, c_acctbal as saldo_doble,
    date '2000-01-01' + cast(c_custkey % 3000 as int) as alta, case when c_custkey % 7 = 0 then '20240131' else '2024-02-' || lpad(cast(c_custkey % 40 as string), 2, '0') end as fecha_texto,
    case when c_custkey % 3 = 0 then ' 12.5 ' when c_custkey % 3 = 1 then '1e3' else cast(c_custkey as string) end as numero_texto,
    'S' as constante, cast(null as string) as vacio, lower({dni(C)}) as documento_minuscula, c_name || repeat(' x', 200) as largo from {{customer}}"""


def people(t: Tables) -> DataFrame:
    return t.sql(PEOPLE)


PEOPLE_COLUMNS = {
    "id": "number", "documento": "text", "email": "text", "telefono": "text", "cp": "text", "cuenta": "text", "activo": "text", "segmento": "text",
    "marca": "number", "positivo": "number", "saldo": "number", "saldo_doble": "number", "alta": "day", "fecha_texto": "text", "numero_texto": "text",
    "constante": "text", "vacio": "text", "documento_minuscula": "text", "largo": "text",
}
N, T, D, X = "number", "text", "day", "none"
GIVEN = {
    "region": {"r_regionkey": N, "r_name": T},
    "nation": {"n_nationkey": N, "n_name": T, "n_regionkey": N},
    "customer": {"c_custkey": N, "c_name": T, "c_nationkey": N, "c_acctbal": N, "c_mktsegment": T},
    "supplier": {"s_suppkey": N, "s_name": T, "s_nationkey": N, "s_acctbal": N},
    "part": {"p_partkey": N, "p_name": T, "p_brand": T, "p_type": T, "p_size": N, "p_retailprice": N},
    "orders": {"o_orderkey": N, "o_custkey": N, "o_orderstatus": T, "o_totalprice": N, "o_orderdate": D, "o_orderpriority": T},
    "lineitem": {"l_orderkey": N, "l_partkey": N, "l_suppkey": N, "l_linenumber": N, "l_quantity": N, "l_extendedprice": N, "l_discount": N, "l_tax": N,
                 "l_returnflag": T, "l_linestatus": T, "l_shipdate": D},
    "events": {"event_id": N, "ts": D, "user_id": N, "event_type": T, "value": N, "props": T},
    "documents": {"doc_id": N, "text": T, "lang": T, "source": T, "n_chars": N},
    "embeddings": {"vec_id": N, "embedding": X, "label": N},
    "pages": {"page_id": N, "url": T, "html": T},
    "benchmark": {"item_id": N, "text": T},
    "labels": {"doc_id": N, "quality": N, "toxic": N},
    "conversations": {"conv_id": N, "turn": N, "role": T, "text": T},
}

# --- the same profile as plain SQL, one scan per column ----------------------------------------------

_YES = "('SI','NO','S','N','Y','TRUE','FALSE')"
_YES_BIT = "('0','1','SI','NO','S','N','Y','TRUE','FALSE')"
_CATEGORY_STOP = "('0','1','S','N','Y','TRUE','FALSE')"
_LETTER = f"substr('{DNI_LETTERS}', " + "cast(try_cast(left(trim({c}), 8) as bigint) % 23 as integer) + 1, 1)"
_STRICT = "regexp_matches(trim({c}), '^[0-9]{{8}}[A-Z]$')"
_IBAN = "(length(rtrim({c})) = 24 and regexp_matches({c}, '^ES[0-9]{{2}}'))"
_TEXT_TESTS = {
    "numerico": r"(regexp_matches({c}, '^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)\s*$') and try_cast(trim({c}) as decimal(18,4)) is not null)",
    "fecha": r"""(case when regexp_matches({c}, '^\s*[0-9]{{4}}\s*$') then make_date(try_cast(trim({c}) as integer), 1, 1)
        when regexp_matches({c}, '^\s*[0-9]{{8}}\s*$') then try_cast(substr(trim({c}), 1, 4) || '-' || substr(trim({c}), 5, 2) || '-' || substr(trim({c}), 7, 2) as date)
        when regexp_matches({c}, '^\s*[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}([ T].*)?\s*$') then try_cast(left(trim({c}), 10) as date) end between date '1900-01-01' and date '2100-12-31')""",
    "email": "(length(rtrim({c})) between 6 and 254 and contains({c}, '@') and contains({c}, '.'))",
    "dni": "regexp_matches({c}, '^[0-9]{{8}}[A-Za-z]$')",
    "cp": "regexp_matches({c}, '^[0-5][0-9]{{4}}$')",
    "telefono": "regexp_matches({c}, '^[6-9][0-9]{{8}}$')",
    "iban": _IBAN,
    "si": "upper(trim({c})) in " + _YES,
    "sibit": "upper(trim({c})) in " + _YES_BIT,
    "nocat": "upper(trim({c})) in " + _CATEGORY_STOP,
    "estricto": _STRICT,
    "dniok": f"({_STRICT} and {_LETTER} = right(trim({{c}}), 1))",
    "ibanok": f"({_IBAN} and regexp_matches({{c}}, '^ES[0-9]{{{{22}}}}$') and try_cast({{c}}[5:24] || '1428' || {{c}}[3:4] as hugeint) % 97 = 1)",
}
_TESTS = {
    "text": _TEXT_TESTS,
    "number": {"numerico": "abs(cast({c} as double)) < 1e14", "cero_uno": "cast({c} as double) in (0, 1)"},
    "day": {"fecha": "cast({c} as date) between date '1900-01-01' and date '2100-12-31'"},
    "none": {},
}


def _pct(x: str, n: str = "n") -> str:
    """Hundredths of a percent, rounded half up in integers."""
    return f"((20000 * ({x}) + {n}) // (2 * {n}))"


def column_oracle(relation: str, table: str, column: str, kind: str) -> str:
    ref = f'"{column}"'
    sums = "".join(f", cast(sum(case when {test.format(c=ref)} then 1 end) as bigint) as {name}" for name, test in _TESTS[kind].items())
    distinct = "0" if kind == "none" else f"count(distinct {ref})"
    base = f"select count(*) as n, count(*) filter ({ref} is null) as z, {distinct} as d{sums} from {relation}"
    none, null = "null::bigint", "null::bigint"
    hits, shares = {p: null for p in PATTERNS}, {p: null for p in PATTERNS}
    cat = "null::boolean"
    if kind == "text":
        for p in ("numerico", "fecha", *NEEDS_LENGTH):
            hits[p], shares[p] = p, _pct(p)
        hits["booleano"] = "case when d = 1 then (case when si > 0 then 1 else 0 end) when d between 2 and 3 then (case when sibit = n - z then 1 else 0 end) else 0 end"
        shares["booleano"] = f"case when d = 1 then (case when si > 0 then 10000 end) when d between 2 and 3 then {_pct('sibit')} end"
        cat = "(nocat is null and d between 2 and 15 and n - z > d)"
    elif kind == "number":
        hits["numerico"], shares["numerico"] = "numerico", _pct("numerico")
        hits["booleano"], shares["booleano"] = "case when d between 2 and 3 then cero_uno end", f"case when d between 2 and 3 then {_pct('cero_uno')} end"
    elif kind == "day":
        hits["fecha"], shares["fecha"] = "fecha", _pct("fecha")
    else:
        hits.update(numerico="0", booleano="0")
        shares.update(numerico="0", booleano="0")
    ok = {"dniok": _pct("coalesce(dniok, 0)", "nullif(estricto, 0)"), "ibanok": _pct("coalesce(ibanok, 0)", "nullif(iban, 0)")} if kind == "text" else {"dniok": none, "ibanok": none}
    evaluable = kind != "none"

    def if_evaluable(expr: str) -> str:
        return expr if evaluable else "0"

    inner = f"""select n, {if_evaluable('z')} as nulos, {if_evaluable('n - d - z')} as dup, {if_evaluable(_pct('z'))} as pn, {if_evaluable(_pct('n - d - z'))} as pd, {if_evaluable(_pct('n - z'))} as co,
        {if_evaluable('((200 * (100 * n - 60 * z - 40 * (n - d)) + n) // (2 * n))')} as sc, {', '.join(f'{h} as h_{p}' for p, h in hits.items())}, {', '.join(f'{s} as s_{p}' for p, s in shares.items())},
        {'d' if kind == 'text' else null} as nd, {cat} as cat, {ok['dniok']} as dok, {ok['ibanok']} as iok from ({base})"""
    best = "0" if kind == "none" else f"coalesce(greatest({', '.join(f's_{p}' for p in PATTERNS)}, case when cat then 10000 else 0 end), 0)"
    close = " ".join(f"when 100 * s_{p} >= 95 * m then '{label}'" for p, label in (("email", "EMAIL"), ("dni", "DNI"), ("cp", "CP"), ("telefono", "TELEFONO"), ("iban", "IBAN")))
    kind_of = "'NO EVALUABLE'" if kind == "none" else f"""case {close} when s_booleano = m then 'BOOLEANO' when s_fecha = m then 'FECHA' when cat then 'CATEGORICA'
        when s_numerico = m then 'NUMERICO' when m <= 0 then 'SIN INFORMAR' else 'SIN_INFORMAR' end"""
    conform = "case when coalesce(s_iban, 0) >= coalesce(s_dni, 0) and s_iban >= 8000 then iok when s_dni >= 8000 then dok end"
    return f"""select 'origen' as base_datos, 'dado' as schema_name, '{table}' as tabla, '{column}' as columna, n as filas, nulos, dup as duplicados, pn / 100.0 as porc_nulos, pd / 100.0 as porc_duplicados,
        co / 100.0 as completitud, sc / 100.0 as scoring, {', '.join(f'h_{p} as posibles_{p}' for p in PATTERNS)}, {', '.join(f's_{p} / 100.0 as porc_{p}' for p in PATTERNS)}, {kind_of} as tipo_logico,
        m / 100.0 as porc_coincidencia, '{RUN_DAY}' as fecha_ejecucion, nd as num_distintos, cast(cat as integer) as es_categorica, {conform} / 100.0 as porc_conformidad
        from (select *, {best} as m from ({inner}))"""


def profile_oracle(relation: str, table: str, columns: dict[str, str], only: str = "*") -> str:
    parts = [f"({column_oracle(relation, table, c, k)})" for c, k in columns.items()]
    return f"select {only} from ({' union all '.join(parts)})"


def _profiled(df: DataFrame, table: str) -> DataFrame:
    return plain(profile(df, TableName("origen", "dado", table), RUN_DAY))


COUNTS = (*(f"posibles_{p}" for p in PATTERNS), "num_distintos", "es_categorica")
for _table, _columns in GIVEN.items():
    query(f"dq_profile_{_table}", profile_oracle(_table, _table, _columns), COUNTS)(lambda t, n=_table: _profiled(getattr(t, n), n))

_PEOPLE_SQL = "(" + PEOPLE.replace("{", "").replace("}", "") + ")"
query("dq_profile_people", profile_oracle(_PEOPLE_SQL, "personas", PEOPLE_COLUMNS), COUNTS)(lambda t: _profiled(people(t), "personas"))


def _focus(name: str, columns: tuple[str, ...], shown: tuple[str, ...]):
    """Some measures of some columns of the people."""
    shown = ("columna", *shown)
    kinds = {c: PEOPLE_COLUMNS[c] for c in columns}
    query(name, profile_oracle(_PEOPLE_SQL, "personas", kinds, ", ".join(shown)), tuple(c for c in shown if c in COUNTS))(
        lambda t: _profiled(people(t).select(*columns), "personas").select(*shown))


_focus("dq_measures", ("id", "segmento", "vacio", "saldo"), ("filas", "nulos", "duplicados", "porc_nulos", "porc_duplicados", "completitud", "scoring"))
_focus("dq_numeric", ("id", "saldo", "saldo_doble", "numero_texto", "segmento"), ("posibles_numerico", "porc_numerico"))
_focus("dq_boolean", ("marca", "positivo", "activo", "constante", "segmento"), ("posibles_booleano", "porc_booleano"))
_focus("dq_date", ("alta", "fecha_texto", "segmento"), ("posibles_fecha", "porc_fecha"))
_focus("dq_categorical", ("segmento", "activo", "documento", "constante"), ("num_distintos", "es_categorica"))
_focus("dq_email", ("email", "documento"), ("posibles_email", "porc_email"))
_focus("dq_dni", ("documento", "documento_minuscula", "telefono"), ("posibles_dni", "porc_dni"))
_focus("dq_dni_conformity", ("documento", "documento_minuscula"), ("porc_dni", "porc_conformidad"))
_focus("dq_postal", ("cp", "telefono"), ("posibles_cp", "porc_cp"))
_focus("dq_phone", ("telefono", "documento"), ("posibles_telefono", "porc_telefono"))
_focus("dq_iban", ("cuenta", "documento"), ("posibles_iban", "porc_iban"))
_focus("dq_iban_conformity", ("cuenta",), ("porc_iban", "porc_conformidad"))
_focus("dq_logical_type", tuple(PEOPLE_COLUMNS), ("tipo_logico", "porc_coincidencia", "porc_conformidad"))


LINE_KEY = ("l_orderkey", "l_linenumber")


@query("dq_sampled_profile", profile_oracle(f"(select * from lineitem where {sample_sql(LINE_KEY, 0.25)})", "lineitem", GIVEN["lineitem"]))
def dq_sampled_profile(t: Tables) -> DataFrame:
    """The profile of a stated share of a table."""
    return plain(profile(sample_rows(t.lineitem, LINE_KEY, 0.25), TableName("origen", "dado", "lineitem"), RUN_DAY))


# --- audits ------------------------------------------------------------------------------------------

@query("dq_constraint_unique", """select 'UNIQUE' as regla, 'orders' as objeto, count(*) as filas, count(*) - count(distinct o_orderkey) as incumplen from orders
    union all select 'UNIQUE', 'lineitem', cast(sum(n) as bigint), cast(sum(n - 1) as bigint) from (select count(*) as n from lineitem group by l_orderkey, l_linenumber)""")
def dq_constraint_unique(t: Tables) -> DataFrame:
    return plain(audit.audit([audit.unique(t.orders, ["o_orderkey"], "orders"), audit.unique(t.lineitem, ["l_orderkey", "l_linenumber"], "lineitem")]))


@query("dq_constraint_fk", """select 'FOREIGN KEY' as regla, 'lineitem.l_orderkey' as objeto, count(*) as filas, count(*) filter (l_orderkey not in (select o_orderkey from orders where o_orderstatus = 'F')) as incumplen from lineitem
    union all select 'FOREIGN KEY', 'orders.o_custkey', count(*), count(*) filter (o_custkey not in (select c_custkey from customer)) from orders""")
def dq_constraint_fk(t: Tables) -> DataFrame:
    finished = t.orders.filter(F.col("o_orderstatus") == "F")
    return plain(audit.audit([audit.foreign_key(t.lineitem, "l_orderkey", finished, "o_orderkey", "lineitem.l_orderkey"),
                              audit.foreign_key(t.orders, "o_custkey", t.customer, "c_custkey", "orders.o_custkey")]))


@query("dq_constraint_null_check", f"""with p as {_PEOPLE_SQL} select 'NOT NULL' as regla, 'segmento' as objeto, count(*) as filas, count(*) filter (segmento is null) as incumplen from p
    union all select 'CHECK', 'segmento en lista', count(*), count(*) filter (segmento is not null and segmento not in ('BUILDING', 'MACHINERY')) from p
    union all select 'CHECK', 'saldo en rango', count(*), count(*) filter (not (saldo between 0 and 5000)) from p
    union all select 'CHECK', 'uno de dos', count(*), count(*) filter (segmento is null) from p""")
def dq_constraint_null_check(t: Tables) -> DataFrame:
    p = people(t)
    return plain(audit.audit([
        audit.not_null(p, "segmento"), audit.check(p, audit.among("segmento", ["Building", "Machinery"]), "segmento en lista"),
        audit.check(p, F.col("saldo").between(0, 5000), "saldo en rango"), audit.check(p, audit.exactly_one_of(["segmento", "vacio"]), "uno de dos")]))


@query("dq_date_order", "select c_custkey from customer where c_custkey % 120 = 0 and date '2012-06-01' < date '2013-01-01' + cast(c_custkey % 3650 as integer)")
def dq_date_order(t: Tables) -> DataFrame:
    rows = t.sql("""select c_custkey, date '2013-01-01' + cast(c_custkey % 3650 as int) as alta, case when c_custkey % 120 = 0 then date '2012-06-01' end as baja from {customer}""")
    return plain(audit.wrong_date_order(rows, "alta", "baja").select("c_custkey"))


_DOCUMENTS = f"select {C} as PersonaID, case when ({C}) % 50 = 0 then {dni('c_custkey')} else {dni(C)} end as Numero from {{customer}}"


@query("dq_document_mismatch", f"""with d as ({_DOCUMENTS.replace('{', '').replace('}', '')}), rep as (select Numero from d group by Numero having count(*) > 1)
    select d.PersonaID, d.Numero, cast(d.Numero <> o.n as integer) as distinto, cast(rep.Numero is not null as integer) as repetido
    from d left join (select {C} as id, {dni(C)} as n from customer) o on o.id = d.PersonaID left join rep on rep.Numero = d.Numero where d.Numero <> o.n or rep.Numero is not null""")
def dq_document_mismatch(t: Tables) -> DataFrame:
    owners = t.sql(f"select {C} as PersonaID, {dni(C)} as Numero from {{customer}}")
    return plain(audit.document_mismatches(owners, t.sql(_DOCUMENTS), "PersonaID", "Numero"))


# --- bookkeeping -------------------------------------------------------------------------------------

@query("dq_retention", """select event_id, strftime(ts, '%Y-%m-%d') as fecha_ejecucion from events where cast(ts as date) > (select max(cast(ts as date)) - 3 from events)""")
def dq_retention(t: Tables) -> DataFrame:
    return plain(keep_newest_runs(t.events.select("event_id", F.col("ts").cast("date").alias("fecha_ejecucion"))))


@query("dq_pending_tables", """select 'b' as base_datos, 's' as schema_name, cast(c_custkey as varchar) as table_name, n as row_count from customer
    join (select o_custkey, count(*) as n, max(cast(o_orderdate as date)) as ultimo from orders group by 1) on o_custkey = c_custkey where ultimo <> (select max(cast(o_orderdate as date)) from orders)""")
def dq_pending_tables(t: Tables) -> DataFrame:
    counts = t.orders.groupBy(F.col("o_custkey").cast("string").alias("table_name")).agg(F.count(F.lit(1)).alias("row_count"))
    catalog = t.customer.select(F.lit("b").alias("base_datos"), F.lit("s").alias("schema_name"), F.col("c_custkey").cast("string").alias("table_name")).join(
        counts, "table_name", "left").na.fill(0, ["row_count"])
    results = t.orders.select(F.lit("b").alias("base_datos"), F.lit("s").alias("schema_name"), F.col("o_custkey").cast("string").alias("tabla"),
                              F.col("o_orderdate").cast("date").alias("fecha_ejecucion"))
    today = results.agg(F.max("fecha_ejecucion")).first()[0]
    return plain(not_done_today(catalog, results, today).select("base_datos", "schema_name", "table_name", "row_count"))


@query("dq_close_run", """select event_id, event_type as "Paquete", case when event_type = 'error' and user_id % 2 = 0 then 20 end as "Nuevos",
    case when event_type = 'error' and user_id % 2 = 0 then date_diff('second', ts, timestamp '2024-06-30 00:00:00') end as "DuracionSeg",
    case when event_type = 'error' and user_id % 2 = 0 then date_diff('minute', ts, timestamp '2024-06-30 00:00:00') end as "DuracionMin",
    case when event_type = 'error' and user_id % 2 = 0 then 1 end as "Correcto" from events""", ("Nuevos", "DuracionSeg", "DuracionMin", "Correcto"))
def dq_close_run(t: Tables) -> DataFrame:
    log = t.events.select(
        "event_id", F.col("event_type").alias("Paquete"), F.lit("perfil").alias("Procedimiento"), F.col("ts").alias("FechaEjecucion"),
        F.when(F.col("user_id") % 2 == 1, F.col("ts")).alias("FechaFinEjecucion"), *[F.lit(None).cast("int").alias(c) for c in ("Nuevos", "Actualizados", "Eliminados", "DuracionSeg", "DuracionMin")],
        F.lit(None).cast("boolean").alias("Correcto"))
    return plain(close_run(log, "error", "perfil", 20, RUN_TS, True).select("event_id", "Paquete", "Nuevos", "DuracionSeg", "DuracionMin", "Correcto"))




@query("dq_state_merged", profile_oracle("lineitem", "lineitem", GIVEN["lineitem"]), COUNTS)
def dq_state_merged(t: Tables) -> DataFrame:
    """A profile from kept states: of the first half of a stored table, then of the part that was appended, added up."""
    root = f"{shared_folder(t.spark)}/perfil-{uuid4().hex}"
    tables, states = Store(t.spark, f"{root}/tablas"), Store(t.spark, f"{root}/estados")
    early = F.col("l_shipdate") < F.lit("1995-06-17").cast("timestamp_ntz")
    for rows in (t.lineitem.filter(early), t.lineitem.filter(~early | early.isNull())):
        tables.append("lineitem", rows)
        state = refresh_state(tables, "lineitem", states)
    return plain(profile(tables.read("lineitem"), TableName("origen", "dado", "lineitem"), RUN_DAY, state))


@query("dq_failed_column", """select 'resultado' as parte, 'nation' as tabla, 'n_nationkey' as columna, (select count(*) from nation) as filas
    union all select 'resultado', 'nation', 'n_name', (select count(*) from nation) union all select 'resultado', 'region', 'r_name', (select count(*) from region)
    union all select 'error', 'nation', 'roto', null union all select 'corrida', 'DQ_Resultados', 'true', 3""", ("filas",))
def dq_failed_column(t: Tables) -> DataFrame:
    """A profiling run over a catalog with a column that cannot be read: its error is logged, all else has results, the run is closed."""
    store = Store(t.spark, f"{shared_folder(t.spark)}/corrida-{uuid4().hex}")
    broken = t.nation.select("n_nationkey", "n_name", F.raise_error(F.concat(F.lit("roto "), "n_name")).cast("int").alias("roto"))
    found = [CatalogEntry("Bronze", "origen", "dado", "nation", broken), CatalogEntry("Bronze", "origen", "dado", "region", t.region.select("r_name"))]
    run = QualityRun(store)
    run.run(found, datetime(2024, 6, 30))
    none = F.lit(None).cast("bigint")
    parts = [
        run.results().select(F.lit("resultado").alias("parte"), "tabla", "columna", F.col("filas").cast("bigint").alias("filas")),
        store.read(ERRORS).select(F.lit("error").alias("parte"), F.col("Tabla").alias("tabla"), F.col("Columna").alias("columna"), none.alias("filas")),
        store.read(RUNS).select(F.lit("corrida").alias("parte"), F.col("NomTablaDestino").alias("tabla"), F.col("Correcto").cast("string").alias("columna"),
                                F.col("Nuevos").cast("bigint").alias("filas")),
    ]
    return plain(reduce(DataFrame.unionByName, parts))


@query("dq_dropped_runs", """select distinct event_id, strftime(cast(ts as date), '%Y-%m-%d') as fecha_ejecucion from events where cast(ts as date) > (select max(cast(ts as date)) - 3 from events)""")
def dq_dropped_runs(t: Tables) -> DataFrame:
    """Results stored by run date: the partitions of old dates are dropped, the newest three stay where they are."""
    store = Store(t.spark, f"{shared_folder(t.spark)}/retencion-{uuid4().hex}")
    store.append(RESULTS, t.events.select("event_id", F.col("ts").cast("date").alias(RUN_DATE)), partition_by=(RUN_DATE,))
    drop_old_runs(store)
    return plain(store.read(RESULTS))
