"""Incremental loads, control tables, versioned dimensions, surrogate keys and fact lookups."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bodega.functions.amounts import money
from bodega.functions.dates import moment
from bodega.operators.control import control_rows, last_processed, log_rows, purge, purge_partitions, upsert
from bodega.operators.facts import daily_balance, snapshot_key
from bodega.operators.incremental import (
    high_water, id_ranges, latest_of, newer, newer_in_ranges, stored_mark, stored_range_marks, union_subtypes, watches,
)
from bodega.operators.joins import hot_values, resolve
from bodega.operators.keys import FACT_BUCKETS, number_rows
from bodega.operators.scd import as_of, changes, first_versions, merge_versions, missing_members, newest, open_versions
from bodega.queries.base import RUN_TS, Tables, plain, query
from bodega.session import shared_folder
from bodega.sources.store import Store, Watch

DAY_ONE, DAY_TWO, BETWEEN = "2024-01-01 00:00:00", RUN_TS, "2024-03-01 00:00:00"
BIG = 10**12


def numbered(tag: int, df: DataFrame) -> DataFrame:
    return df.withColumn("lote", F.lit(tag))


# --- watermarks --------------------------------------------------------------------------------------

@query("incremental_id", """select event_id, case when event_id <= (select max(event_id) // 2 from events) then 1 else 2 end as lote from events""")
def incremental_id(t: Tables) -> DataFrame:
    source = t.events.select("event_id")
    half = source.agg(F.floor(F.max("event_id") / 2)).first()[0]
    return plain(two_loads(t, "event_id", source.filter(F.col("event_id") <= half), source))


def two_loads(t: Tables, column: str, *sources: DataFrame, make: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Loads into a stored table that does not exist before: each appends what is above the mark recorded by the ones before."""
    store = Store(t.spark, f"{shared_folder(t.spark)}/marks-{uuid4().hex}")
    for tag, rows in enumerate(sources, 1):
        store.append("cargas", numbered(tag, make(newer(rows, column, stored_mark(store, "cargas", column)))), watch=[Watch(column)])
    return store.read("cargas")


@query("incremental_first_load", "select o_orderkey, o_custkey, case when o_orderkey <= (select max(o_orderkey) // 2 from orders) then 1 else 2 end as lote from orders")
def incremental_first_load(t: Tables) -> DataFrame:
    source = t.orders.select("o_orderkey", "o_custkey")
    half = source.agg(F.floor(F.max("o_orderkey") / 2)).first()[0]
    return plain(two_loads(t, "o_orderkey", source.filter(F.col("o_orderkey") <= half), source))


@query("incremental_ranges", f"""select id, case when id <= {BIG} then (case when id <= (select max(c_custkey) // 2 from customer) then 1 else 2 end)
    else (case when id <= {BIG} + (select max(s_suppkey) // 2 from supplier) then 1 else 2 end) end as lote
    from (select c_custkey + 1 as id from customer union all select s_suppkey + 1 + {BIG} from supplier)""")
def incremental_ranges(t: Tables) -> DataFrame:
    ranges = id_ranges(person=0, company=BIG)
    people, firms = t.customer.select((F.col("c_custkey") + 1).alias("id")), t.supplier.select((F.col("s_suppkey") + 1).alias("id"))
    half = {n: df.agg(F.floor((F.max("id") - 1) / 2)).first()[0] for n, df in {"person": people, "company": firms}.items()}
    first = union_subtypes({"person": people.filter(F.col("id") <= half["person"]), "company": firms.filter(F.col("id") <= half["company"])}, "id", ranges)
    store = Store(t.spark, f"{shared_folder(t.spark)}/marks-{uuid4().hex}")
    for tag, rows in enumerate((first, union_subtypes({"person": people, "company": firms}, "id", ranges)), 1):
        rows = newer_in_ranges(rows, "id", ranges, stored_range_marks(store, "cargas", "id", ranges))
        store.append("cargas", numbered(tag, rows), watch=watches("id", ranges))
    return plain(store.read("cargas"))


@query("incremental_target_date", """select user_id, strftime(cast(ts as date), '%Y-%m-%d') as dia, count(*) as n,
    case when cast(ts as date) <= date '2024-01-15' then 1 else 2 end as lote from events group by user_id, cast(ts as date)""")
def incremental_target_date(t: Tables) -> DataFrame:
    moves = t.events.select("user_id", F.col("ts").cast("date").alias("dia"))

    def daily(df: DataFrame) -> DataFrame:
        return df.groupBy("user_id", "dia").agg(F.count(F.lit(1)).alias("n"))

    return plain(two_loads(t, "dia", moves.filter(F.col("dia") <= F.lit("2024-01-15").cast("date")), moves, make=daily))


@query("incremental_control", """select o_orderkey from orders where o_orderdate > (select min(l_shipdate) + interval 700 day from lineitem where l_returnflag = 'R')""")
def incremental_control(t: Tables) -> DataFrame:
    control = t.lineitem.groupBy(F.col("l_returnflag").alias("TablaStagingDestino")).agg(
        (F.min("l_shipdate") + F.expr("interval 700 days")).alias("UltimaFechaProcesada"))
    mark = last_processed(control, "R").first()[0]
    return plain(newer(t.orders, "o_orderdate", mark).select("o_orderkey"))


@query("control_advance", """select "TablaStagingDestino", strftime("UltimaFechaProcesada", '%Y-%m-%d %H:%M:%S') as "UltimaFechaProcesada", 'OK' as "Estado",
    strftime(ejec, '%Y-%m-%d %H:%M:%S') as "FechaUltimaEjecucion" from (
    select 'orders/' || o_orderstatus as "TablaStagingDestino", max(o_orderdate) as "UltimaFechaProcesada", timestamp '2024-06-30' as ejec from orders group by o_orderstatus
    union all select 'lines/' || l_returnflag, timestamp '2024-01-01', timestamp '2024-01-01' from lineitem group by l_returnflag)""")
def control_advance(t: Tables) -> DataFrame:
    old_orders = t.orders.select(F.concat(F.lit("orders/"), "o_orderstatus").alias("TablaStagingDestino")).distinct()
    old_lines = t.lineitem.select(F.concat(F.lit("lines/"), "l_returnflag").alias("TablaStagingDestino")).distinct()
    none = F.lit(None).cast("timestamp_ntz")
    control = control_rows(old_orders.unionByName(old_lines).withColumn("UltimaFechaProcesada", none), DAY_ONE)
    marks = t.orders.groupBy(F.concat(F.lit("orders/"), "o_orderstatus").alias("TablaStagingDestino")).agg(F.max("o_orderdate").alias("UltimaFechaProcesada"))
    return plain(upsert(control, control_rows(marks, DAY_TWO), "TablaStagingDestino"))


@query("latest_of_sources", """select strftime(greatest((select max(o_orderdate) from orders), (select max(l_shipdate) from lineitem), (select max(ts) from events)),
    '%Y-%m-%d %H:%M:%S') as ultima, (select count(*) from orders) as n""")
def latest_of_sources(t: Tables) -> DataFrame:
    mark = latest_of(high_water(t.orders, "o_orderdate"), high_water(t.lineitem, "l_shipdate"), high_water(t.events, "ts"))
    return plain(t.orders.agg(F.count(F.lit(1)).alias("n")).select(moment(mark).alias("ultima"), "n"))


@query("purge_log", "select event_id from events where not (ts < timestamp '2024-04-10' - interval 90 day)")
def purge_log(t: Tables) -> DataFrame:
    return plain(purge(t.events, "2024-04-10 00:00:00", 90, "ts").select("event_id"))


@query("snapshot_refresh", """select p_partkey as articulo, upper(trim(' l-' || p_name)) as hueco, cast(cast(p_retailprice as decimal(18,2)) as double) as coste from part""")
def snapshot_refresh(t: Tables) -> DataFrame:
    """A stored snapshot of the day before is replaced whole by today's."""
    store = Store(t.spark, f"{shared_folder(t.spark)}/snapshot-{uuid4().hex}")
    today = t.part.select(F.col("p_partkey").alias("articulo"), F.upper(F.trim(F.concat(F.lit(" l-"), "p_name"))).alias("hueco"),
                          money("p_retailprice").alias("coste"))
    store.replace("existencias", today.withColumn("coste", money(F.lit(0))))
    store.replace("existencias", today)
    return plain(store.read("existencias"))


# --- dimensions --------------------------------------------------------------------------------------

def day_one_staging(t: Tables) -> DataFrame:
    return t.customer.select((F.col("c_custkey") + 1).alias("WWI Cliente ID"), F.upper("c_name").alias("Nombre"),
                             F.when(F.col("c_custkey") % 11 != 0, F.col("c_mktsegment")).alias("Segmento"),
                             (F.col("c_acctbal") >= 0).cast("int").alias("Activo"))


def day_two_staging(t: Tables) -> DataFrame:
    moved = (F.col("WWI Cliente ID") - 1) % 7 == 0
    old = day_one_staging(t).withColumn("Segmento", F.when(moved, F.lit("PREMIUM")).otherwise(F.col("Segmento"))).withColumn(
        "Nombre", F.concat("Nombre", F.lit(" SA")))
    new = t.supplier.select((F.col("s_suppkey") + 1 + BIG).alias("WWI Cliente ID"), F.upper("s_name").alias("Nombre"),
                            F.lit(None).cast("string").alias("Segmento"), F.lit(1).alias("Activo"))
    return old.unionByName(new)


TRACKED = {"Segmento": "", "Activo": None}
BUSINESS = ("WWI Cliente ID",)


def dimension_day_one(t: Tables) -> DataFrame:
    return first_versions(day_one_staging(t), "Cliente Key", BUSINESS, DAY_ONE)


def dimension_day_two(t: Tables) -> DataFrame:
    return merge_versions(dimension_day_one(t), day_two_staging(t), "Cliente Key", BUSINESS, TRACKED, DAY_TWO)


ORACLE_DIMENSION = f"""with uno as (select row_number() over (order by (c_custkey + 1) % 1021, c_custkey) as k, c_custkey + 1 as id, upper(c_name) as nombre,
      case when c_custkey % 11 <> 0 then c_mktsegment end as seg, cast(c_acctbal >= 0 as integer) as activo from customer),
    dos as (select id, nombre || ' SA' as nombre, case when (id - 1) % 7 = 0 then 'PREMIUM' else seg end as seg, activo from uno
      union all select s_suppkey + 1 + {BIG}, upper(s_name), null, 1 from supplier),
    nuevas as (select dos.* from dos left join uno on uno.id = dos.id where uno.id is null or coalesce(uno.seg, '') <> coalesce(dos.seg, '')),
    dim as (select k, id, nombre, seg, activo, '2024-01-01 00:00:00' as desde, case when id in (select id from nuevas) then '2024-06-30 00:00:00'
        else '9999-12-31 23:59:59' end as hasta from uno
      union all select (select count(*) from uno) + row_number() over (order by id % 1021, id), id, nombre, seg, activo, '2024-06-30 00:00:00', '9999-12-31 23:59:59' from nuevas)
    select k as "Cliente Key", id as "WWI Cliente ID", nombre as "Nombre", seg as "Segmento", activo as "Activo", desde as "Valid From", hasta as "Valid To",
      1 as "Lineage Key" from dim """


@query("scd2_two_days", ORACLE_DIMENSION)
def scd2_two_days(t: Tables) -> DataFrame:
    return plain(dimension_day_two(t))


@query("scd2_open", ORACLE_DIMENSION + "where hasta = '9999-12-31 23:59:59'")
def scd2_open(t: Tables) -> DataFrame:
    return plain(open_versions(dimension_day_two(t)))


@query("scd2_as_of", ORACLE_DIMENSION + "where desde <= '2024-03-01 00:00:00' and hasta > '2024-03-01 00:00:00'")
def scd2_as_of(t: Tables) -> DataFrame:
    return plain(as_of(dimension_day_two(t), BETWEEN))


@query("scd2_changes", f"""select c_custkey + 1 as "WWI Cliente ID", cast(1 as bigint) as cambia from customer where c_custkey % 7 = 0
      and coalesce(case when c_custkey % 11 <> 0 then c_mktsegment end, '') <> 'PREMIUM'
    union all select s_suppkey + 1 + {BIG}, 0 from supplier""")
def scd2_changes(t: Tables) -> DataFrame:
    pending = changes(dimension_day_one(t), day_two_staging(t), BUSINESS, TRACKED)
    return plain(pending.select("WWI Cliente ID", F.col("_changed").alias("cambia")))


@query("scd2_null_rules", """select c_custkey, cast(a is not null and b is not null and a <> b as integer) as sql_rule, cast(coalesce(a, '') <> coalesce(b, '') as integer) as default_rule,
    cast(a is distinct from b as integer) as null_safe from (select c_custkey, case when c_custkey % 3 <> 0 then c_mktsegment end as a,
    case when c_custkey % 5 = 0 then null when c_custkey % 5 = 1 then '' else c_mktsegment end as b from customer)""")
def scd2_null_rules(t: Tables) -> DataFrame:
    from bodega.operators.joins import differs

    c = t.customer.select("c_custkey", F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).alias("a"),
                          F.when(F.col("c_custkey") % 5 == 1, F.lit("")).when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment")).alias("b"))
    old, new = {"x": F.col("a")}, {"x": F.col("b")}
    return plain(c.select("c_custkey", differs(old, new, {}).alias("sql_rule"), differs(old, new, {"x": ""}).alias("default_rule"),
                          differs(old, new, {}, null_safe=True).alias("null_safe")))


@query("newest_staging_row", """select user_id, event_id, event_type from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) where rn = 1""")
def newest_staging_row(t: Tables) -> DataFrame:
    return plain(newest(t.events, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type"))


@query("dim_insert_only", f"""with uno as (select row_number() over (order by id % 1021, id) as k, id from (select s_suppkey as id from supplier)),
    dos as (select distinct l_suppkey * 2 as id from lineitem)
    select k as "Clave", id, '2024-01-01 00:00:00' as "Valid From", '9999-12-31 23:59:59' as "Valid To", 1 as "Lineage Key" from uno
    union all select (select count(*) from uno) + row_number() over (order by id % 1021, id), id, '2024-06-30 00:00:00', '9999-12-31 23:59:59', 1
    from dos where id not in (select id from uno)""")
def dim_insert_only(t: Tables) -> DataFrame:
    dim = first_versions(t.supplier.select(F.col("s_suppkey").alias("id")), "Clave", ["id"], DAY_ONE)
    seen = t.lineitem.select((F.col("l_suppkey") * 2).alias("id")).distinct()
    return plain(dim.unionByName(missing_members(dim, seen, "Clave", ["id"], DAY_TWO).select(*dim.columns)))


@query("dim_insert_only_by_code", """select 1 as ok, codigo from (select distinct p_brand as codigo from part
    union select distinct 'X' || p_brand from part)""")
def dim_insert_only_by_code(t: Tables) -> DataFrame:
    dim = first_versions(t.part.select(F.col("p_brand").alias("codigo")).distinct(), "Clave", ["codigo"], DAY_ONE)
    both = t.part.select(F.col("p_brand").alias("codigo")).unionByName(t.part.select(F.concat(F.lit("X"), "p_brand").alias("codigo"))).distinct()
    after = dim.unionByName(missing_members(dim, both, "Clave", ["codigo"], DAY_TWO, against_open=False).select(*dim.columns))
    return plain(after.select((F.col("Clave") > 0).alias("ok"), "codigo"))


@query("surrogate_keys", "select count(*) as n, 101 as menor, 100 + count(*) as mayor, count(*) as distintas from lineitem")
def surrogate_keys(t: Tables) -> DataFrame:
    rows = number_rows(t.lineitem, "clave", t.lineitem.columns, 100, FACT_BUCKETS)
    return plain(rows.agg(F.count(F.lit(1)).alias("n"), F.min("clave").alias("menor"), F.max("clave").alias("mayor"),
                          F.count_distinct("clave").alias("distintas")))


# --- facts -------------------------------------------------------------------------------------------

@query("fact_lookup_unknown", """select l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(k, 0) as "Articulo Key", year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) as "Fecha Key",
    20240630 as "Snapshot Key" from lineitem left join (select row_number() over (order by p_partkey % 1021, p_partkey) as k, p_partkey from part where p_size > 25) on p_partkey = l_partkey""")
def fact_lookup_unknown(t: Tables) -> DataFrame:
    from bodega.functions.dates import date_key

    dim = first_versions(t.part.filter(F.col("p_size") > 25).select("p_partkey"), "Articulo Key", ["p_partkey"], DAY_ONE)
    facts = resolve(t.lineitem, open_versions(dim), {"l_partkey": "p_partkey"}, {"Articulo Key": "Articulo Key"})
    return plain(facts.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "Articulo Key", date_key("l_shipdate").alias("Fecha Key"),
                              snapshot_key(RUN_TS).alias("Snapshot Key")))


@query("lookup_hot_key", """select l_orderkey, l_linenumber, s, coalesce(k, 0) as "Proveedor Key" from (
      select l_orderkey, l_linenumber, case when (l_orderkey + l_linenumber) % 3 = 0 then 1 when (l_orderkey + l_linenumber) % 3 = 1 then null else l_suppkey end as s from lineitem)
    left join (select row_number() over (order by s_suppkey % 1021, s_suppkey) as k, s_suppkey from supplier) on s_suppkey = s""", ("s",))
def lookup_hot_key(t: Tables) -> DataFrame:
    """A third of the rows look up one value, a third none: the value's rows are dealt out by their measured share, the others by their identity."""
    dim, facts = hot_lookup(t)
    hot = hot_values(facts, ["s"])["s"]
    rows = resolve(facts, open_versions(dim), {"s": "s_suppkey"}, {"Proveedor Key": "Proveedor Key"}, identity=("l_orderkey", "l_linenumber"), hot=hot)
    return plain(rows)


def hot_lookup(t: Tables) -> tuple[DataFrame, DataFrame]:
    case = F.pmod(F.col("l_orderkey") + F.col("l_linenumber"), F.lit(3))
    value = F.when(case == 0, 1).when(case == 2, F.col("l_suppkey")).cast("bigint")
    return (first_versions(t.supplier.select("s_suppkey"), "Proveedor Key", ["s_suppkey"], DAY_ONE),
            t.lineitem.select("l_orderkey", "l_linenumber", value.alias("s")))


@query("log_purged_by_day", """select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as ts from events where not (ts < timestamp '2024-04-10 12:00:00' - interval 85 day)""")
def log_purged_by_day(t: Tables) -> DataFrame:
    """A log stored by day: whole days are dropped, and only the day of the limit is written anew."""
    store = Store(t.spark, f"{shared_folder(t.spark)}/log-{uuid4().hex}")
    log_rows(store, t.events.select("event_id", "ts"), "registro", "ts")
    purge_partitions(store, "registro", datetime(2024, 4, 10, 12), 85, "ts")
    return plain(store.read("registro"))


@query("append_compacted", "select o_orderkey, o_orderpriority from orders")
def append_compacted(t: Tables) -> DataFrame:
    """Many small appends, put together on the way."""
    store, source = Store(t.spark, f"{shared_folder(t.spark)}/small-{uuid4().hex}"), t.orders.select("o_orderkey", "o_orderpriority")
    for i in range(8):
        store.append("pedidos", source.filter(F.pmod("o_orderkey", F.lit(8)) == i), watch=[Watch("o_orderkey")])
        if i % 3 == 2:
            store.compact("pedidos", 1 << 40)
    return plain(store.read("pedidos"))


def signed_moves(t: Tables) -> DataFrame:
    value = money("value")
    return t.events.select(
        "event_id", "user_id", F.col("ts").cast("date").alias("dia"),
        F.when(F.col("event_type").isin("error", "view"), -value).otherwise(value).alias("importe"),
        (value + F.col("user_id").cast("decimal(10,0)")).cast("decimal(18,2)").alias("saldo"))


ORACLE_MOVES = """(select event_id, user_id, cast(ts as date) as dia, case when event_type in ('error', 'view') then -cast(value as decimal(18,2))
    else cast(value as decimal(18,2)) end as importe, cast(value as decimal(18,2)) + user_id as saldo from events)"""


@query("daily_balance", f"""select user_id, strftime(dia, '%Y-%m-%d') as dia, cast(min(saldo) as double) as minimo, cast(max(saldo) as double) as maximo,
    (((2 * sum(cast(saldo * 100 as bigint)) + count(*)) // (2 * count(*))) / 100.0)::double as medio, count(*) as n,
    cast(sum(case when importe > 0 then importe else 0 end) as double) as entradas, cast(sum(case when importe < 0 then abs(importe) else 0 end) as double) as salidas
    from {ORACLE_MOVES} group by user_id, dia""")
def daily_balance_query(t: Tables) -> DataFrame:
    days = daily_balance(signed_moves(t), "user_id", "dia", "importe", "saldo")
    return plain(days.select("user_id", "dia", F.col("Saldo Apertura").alias("minimo"), F.col("Saldo Cierre").alias("maximo"),
                             F.col("Saldo Promedio").alias("medio"), F.col("Numero Movimientos").alias("n"),
                             F.col("Importe Total Entradas").alias("entradas"), F.col("Importe Total Salidas").alias("salidas")))


@query("daily_balance_first_last", f"""select user_id, strftime(dia, '%Y-%m-%d') as dia, cast(arg_min(saldo, event_id) as double) as apertura,
    cast(arg_max(saldo, event_id) as double) as cierre from {ORACLE_MOVES} group by user_id, dia""")
def daily_balance_first_last(t: Tables) -> DataFrame:
    days = daily_balance(signed_moves(t), "user_id", "dia", "importe", "saldo", ident="event_id")
    return plain(days.select("user_id", "dia", F.col("Saldo Apertura").alias("apertura"), F.col("Saldo Cierre").alias("cierre")))
