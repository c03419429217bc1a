"""Projections, predicates, joins, aggregates, windows, sorts and set operations on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bodega.functions import identifiers as ident
from bodega.functions.amounts import line_amounts, money, split_by_flag
from bodega.functions.dates import age_in_years, borders_crossed, date_key, is_month_end, moment, period
from bodega.functions.text import (
    clean_email, clean_phone, clean_postal_code, clean_text, full_name, like_any, position_of, replace_span, same_text,
    sequence_code, substitute, trimmed_length,
)
from bodega.operators.audit import duplicated
from bodega.operators.control import newest_runs, row_counts, upsert
from bodega.operators.incremental import IdRange, id_ranges, union_subtypes
from bodega.operators.joins import bridge, detail_measures, pairs_in_use, key_per_value, latest_per_key, resolve
from bodega.operators.keys import number_rows
from bodega.operators.risk import GROWTH, LATER_GROWTH, growth_factor
from bodega.queries.base import RUN_TS, TABLES, Tables, plain, query
from bodega.queries.raw import dni, email, iban, phone, postal
from bodega.sources.relations import inline_rows, missing_rows

M = "cast({} as decimal(18,2))".format


# --- projections -------------------------------------------------------------------------------------

@query("project_rename", """select c_custkey as "WWI Cliente ID", c_name as "Nombre Completo", 'PERSONA' as "Tipo Cliente",
    'ESPAÑA' as "Pais", cast(null as varchar) as "Forma Juridica", 1 as "Lineage Key" from customer""")
def project_rename(t: Tables) -> DataFrame:
    return plain(t.customer.select(
        F.col("c_custkey").alias("WWI Cliente ID"), F.col("c_name").alias("Nombre Completo"), F.lit("PERSONA").alias("Tipo Cliente"),
        F.lit("ESPAÑA").alias("Pais"), F.lit(None).cast("string").alias("Forma Juridica"), F.lit(1).alias("Lineage Key")))


@query("clean_denormalise", """select c_custkey as id, upper(trim('  ' || lower(c_name) || ' ')) as nombre,
    lower(trim(' ' || upper(c_name) || '@Mail.ES ')) as email, trim(' 6' || c_custkey || ' ') as telefono,
    upper(trim(n_name)) as nacion, upper(trim(r_name)) as region
    from customer left join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey""")
def clean_denormalise(t: Tables) -> DataFrame:
    c = t.customer.select(
        "c_custkey", "c_nationkey", F.concat(F.lit("  "), F.lower("c_name"), F.lit(" ")).alias("raw_name"),
        F.concat(F.lit(" "), F.upper("c_name"), F.lit("@Mail.ES ")).alias("raw_mail"),
        F.concat(F.lit(" 6"), F.col("c_custkey").cast("string"), F.lit(" ")).alias("raw_phone"))
    joined = c.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return plain(joined.select(
        F.col("c_custkey").alias("id"), clean_text("raw_name").alias("nombre"), clean_email("raw_mail").alias("email"),
        clean_phone("raw_phone").alias("telefono"), clean_text("n_name").alias("nacion"), clean_text("r_name").alias("region")))


@query("full_name_null", """select o_orderkey as id,
    case when o_orderstatus = 'P' then null else o_orderpriority end || ' ' || o_orderstatus ||
    coalesce(' ' || case when o_custkey % 2 = 0 then cast(o_custkey as varchar) end, '') as nombre from orders""")
def full_name_null(t: Tables) -> DataFrame:
    o = t.orders.select(
        "o_orderkey", "o_orderstatus", F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("first"),
        F.when(F.col("o_custkey") % 2 == 0, F.col("o_custkey").cast("string")).alias("third"))
    return plain(o.select(F.col("o_orderkey").alias("id"), full_name("first", "o_orderstatus", "third").alias("nombre")))


@query("postal_code_clean", """select p_partkey as id, left(replace(coalesce(case when p_size % 3 = 0 then null else p_name || ' ' || p_brand end, ''),
    ' ', ''), 10) as codigo from part""")
def postal_code_clean(t: Tables) -> DataFrame:
    raw = F.when(F.col("p_size") % 3 != 0, F.concat("p_name", F.lit(" "), "p_brand"))
    return plain(t.part.select(F.col("p_partkey").alias("id"), clean_postal_code(raw).alias("codigo")))


@query("value_substitution", """select p_partkey as id, replace(upper(trim(' ' || p_name)), 'RING', 'ANILLO') as nombre,
    coalesce(case when p_size > 10 then p_brand end, 'N/A') as marca from part""")
def value_substitution(t: Tables) -> DataFrame:
    return plain(t.part.select(
        F.col("p_partkey").alias("id"), substitute(F.concat(F.lit(" "), "p_name"), "RING", "ANILLO").alias("nombre"),
        F.coalesce(F.when(F.col("p_size") > 10, F.col("p_brand")), F.lit("N/A")).alias("marca")))


@query("line_amounts", f"""select l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(round(q * p, 2) as double) as neto,
    cast(cast(q * p * r * 0.01 as decimal(18,2)) as double) as impuesto, cast(cast(q * p * (1 + r * 0.01) as decimal(18,2)) as double) as bruto
    from (select *, cast(l_quantity as integer) as q, {M('l_extendedprice')} as p, cast(l_tax * 100 as decimal(5,3)) as r from lineitem)""")
def line_amounts_query(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("int").alias("q"),
                             money("l_extendedprice").alias("p"), (F.col("l_tax") * 100).cast("decimal(5,3)").alias("r"))
    parts = line_amounts("q", "p", "r")
    return plain(rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", parts["Total Excluding Tax"].alias("neto"),
                             parts["Tax Amount"].alias("impuesto"), parts["Total Including Tax"].alias("bruto")))


@query("conditional_split", f"""select l_returnflag, cast(sum(case when chilled = 0 then amount else 0 end) as double) as secos,
    cast(sum(case when chilled = 1 then amount else 0 end) as double) as frios
    from (select l_returnflag, {M('l_extendedprice')} as amount, cast(p_size % 4 = 0 as integer) as chilled
          from lineitem join part on l_partkey = p_partkey) group by l_returnflag""")
def conditional_split(t: Tables) -> DataFrame:
    item = t.part.select("p_partkey", (F.col("p_size") % 4 == 0).alias("chilled"))
    dry, chilled = split_by_flag(money("l_extendedprice"), "chilled")
    rows = t.lineitem.join(item, F.col("l_partkey") == F.col("p_partkey")).select("l_returnflag", dry.alias("d"), chilled.alias("c"))
    return plain(rows.groupBy("l_returnflag").agg(F.sum("d").alias("secos"), F.sum("c").alias("frios")))


@query("date_key", """select o_orderkey, coalesce(year(d) * 10000 + month(d) * 100 + day(d), 0) as clave, strftime(d, '%Y-%m') as periodo,
    2024 - year(o_orderdate) as edad, cast(last_day(cast(o_orderdate as date)) = cast(o_orderdate as date) as integer) as fin_mes,
    dayofweek(o_orderdate) + 1 as dia_semana, strftime(cast(o_orderdate as date) + interval 3 month, '%Y-%m-%d') as mas_tres_meses
    from (select *, case when o_orderstatus = 'P' then null else cast(o_orderdate as date) end as d from orders)""")
def date_key_query(t: Tables) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    o = t.orders.withColumn("d", F.when(F.col("o_orderstatus") != "P", day))
    return plain(o.select(
        "o_orderkey", date_key("d").alias("clave"), period("d").alias("periodo"),
        age_in_years("o_orderdate", moment(RUN_TS)).alias("edad"), is_month_end("o_orderdate").alias("fin_mes"),
        F.dayofweek(day).alias("dia_semana"), F.add_months(day, 3).alias("mas_tres_meses")))


@query("borders_crossed", """select event_id, date_diff('second', ts, timestamp '2024-06-30 00:00:00') as segundos,
    date_diff('minute', ts, timestamp '2024-06-30 00:00:00') as minutos, date_diff('year', ts, timestamp '2025-01-01 00:00:00') as anos
    from events""")
def borders(t: Tables) -> DataFrame:
    return plain(t.events.select(
        "event_id", borders_crossed("SECOND", "ts", moment(RUN_TS)).alias("segundos"), borders_crossed("MINUTE", "ts", moment(RUN_TS)).alias("minutos"),
        borders_crossed("YEAR", "ts", moment("2025-01-01 00:00:00")).alias("anos")))


@query("unit_conversion", """select l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(l_quantity as bigint) * p_size as unidades
    from lineitem join part on l_partkey = p_partkey""")
def unit_conversion(t: Tables) -> DataFrame:
    rows = t.lineitem.join(t.part.select("p_partkey", "p_size"), F.col("l_partkey") == F.col("p_partkey"))
    return plain(rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                             (F.col("l_quantity").cast("bigint") * F.col("p_size")).alias("unidades")))


@query("sequence_code", """select s_suppkey, 'SUC-' || right('0000' || cast(row_number() over (order by s_suppkey % 1021, s_suppkey) as varchar), 4) as codigo
    from supplier""")
def sequence_code_query(t: Tables) -> DataFrame:
    numbered = number_rows(t.supplier.select("s_suppkey"), "n", ["s_suppkey"])
    return plain(numbered.select("s_suppkey", sequence_code("SUC-", "n", 4).alias("codigo")))


@query("text_functions", r"""select doc_id, length(rtrim(text)) as largo, position('e' in text) as primera_e,
    'XY' || substr(lang, 2) as cambiado, right(source, 3) as final, left(source, 2) as inicio, replace(lang, 'e', 'E') as letra,
    nullif(lang, 'en') as otra_lengua, ltrim('  ' || lang) as izq, cast(lower(lang) = lower(upper(lang) || '') as integer) as igual from documents""")
def text_functions(t: Tables) -> DataFrame:
    return plain(t.documents.select(
        "doc_id", trimmed_length("text").alias("largo"), position_of("e", "text").alias("primera_e"),
        replace_span("lang", 1, 1, "XY").alias("cambiado"), F.right("source", F.lit(3)).alias("final"),
        F.left("source", F.lit(2)).alias("inicio"), F.replace("lang", F.lit("e"), F.lit("E")).alias("letra"),
        F.nullif(F.col("lang"), F.lit("en")).alias("otra_lengua"), F.ltrim(F.concat(F.lit("  "), "lang")).alias("izq"),
        same_text("lang", F.concat(F.upper("lang"), F.lit("  ")), case_insensitive=True).alias("igual")))


@query("try_conversions", """select event_id, cast(try_cast(case when event_id % 3 = 0 then event_type else cast(cast(value as decimal(18,2)) as varchar) end
    as decimal(18,4)) as double) as numero, strftime(try_cast(case when event_id % 2 = 0 then props else strftime(ts, '%Y-%m-%d') end as date),
    '%Y-%m-%d') as fecha, abs(user_id - 70) as distancia, cast(round(cast(value as decimal(18,2)), 1) as double) as redondo from events""")
def try_conversions(t: Tables) -> DataFrame:
    e = t.events.select(
        "event_id", "user_id", money("value").alias("v"),
        F.when(F.col("event_id") % 3 == 0, F.col("event_type")).otherwise(money("value").cast("string")).alias("n"),
        F.when(F.col("event_id") % 2 == 0, F.col("props")).otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("d"))
    return plain(e.select(
        "event_id", F.when(ident.looks_numeric("n"), F.col("n").try_cast("decimal(18,4)")).alias("numero"),
        ident.text_to_date("d").alias("fecha"), F.abs(F.col("user_id") - 70).alias("distancia"), F.round("v", 1).alias("redondo")))


# --- predicates --------------------------------------------------------------------------------------

@query("filter_in_between", """select o_orderkey from orders where o_orderstatus in ('F', 'O') and o_orderpriority not in ('5-LOW')
    and o_orderdate between timestamp '1996-01-01' and timestamp '1998-12-31' and o_custkey is not null""")
def filter_in_between(t: Tables) -> DataFrame:
    o = t.orders
    return plain(o.filter(
        o.o_orderstatus.isin("F", "O") & ~o.o_orderpriority.isin("5-LOW") & o.o_custkey.isNotNull()
        & o.o_orderdate.between(moment("1996-01-01 00:00:00"), moment("1998-12-31 00:00:00"))).select("o_orderkey"))


@query("filter_like", r"""select page_id, cast(url like '%example%' as integer) as ejemplo, cast(url like '%\_%' escape '\' as integer) as subrayado
    from pages where url not like 'https://m.%'""")
def filter_like(t: Tables) -> DataFrame:
    url = F.col("url")
    return plain(t.pages.filter(~like_any("url", "https://m.%")).select(
        "page_id", url.like("%example%").alias("ejemplo"), url.like(r"%\_%").alias("subrayado")))


@query("filter_classes", f"""select c_custkey, cast(regexp_full_match(d, '[0-9]{{8}}[A-Z]') as integer) as dni,
    cast(regexp_full_match(p, '[0-5][0-9]{{4}}') as integer) as cp, cast(regexp_full_match(f, '[6-9][0-9]{{8}}') as integer) as telefono
    from (select c_custkey, {dni('c_custkey')} as d, {postal('c_custkey')} as p, {phone('c_custkey')} as f from customer)""")
def filter_classes(t: Tables) -> DataFrame:
    c = t.sql(f"select c_custkey, {dni('c_custkey')} as d, {postal('c_custkey')} as p, {phone('c_custkey')} as f from {{customer}}")
    return plain(c.select("c_custkey", ident.looks_dni("d").alias("dni"), ident.looks_postal_code("p").alias("cp"),
                          ident.looks_phone("f").alias("telefono")))


@query("filter_compound_exclusion", """select l_orderkey, l_linenumber, l_partkey, l_suppkey from lineitem
    where not (l_returnflag = 'A' and l_linestatus in ('O', 'F')) and not (l_returnflag = 'R' and l_linestatus in ('F'))""")
def filter_compound_exclusion(t: Tables) -> DataFrame:
    l = t.lineitem
    return plain(l.filter(~((l.l_returnflag == "A") & l.l_linestatus.isin("O", "F")) & ~((l.l_returnflag == "R") & l.l_linestatus.isin("F")))
                 .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))


# --- joins -------------------------------------------------------------------------------------------

@query("lookup_inner", "select p_partkey, l_orderkey, l_linenumber, s_name from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey")
def lookup_inner(t: Tables) -> DataFrame:
    return plain(t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
                 .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select("p_partkey", "l_orderkey", "l_linenumber", "s_name"))


@query("left_join_constant_on", """select c_custkey, count(o_orderkey) as pedidos from customer
    left join orders on c_custkey = o_custkey and o_orderstatus = 'F' group by c_custkey""")
def left_join_constant_on(t: Tables) -> DataFrame:
    finished = t.orders.filter(F.col("o_orderstatus") == "F").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return plain(t.customer.join(finished, F.col("c_custkey") == F.col("o_custkey"), "left")
                 .select("c_custkey", F.coalesce("n", F.lit(0)).alias("pedidos")))


@query("self_join", """select c.c_custkey, b.c_name as pagador from customer c left join customer b on c.c_custkey - c.c_custkey % 10 = b.c_custkey""")
def self_join(t: Tables) -> DataFrame:
    payer = t.customer.select(F.col("c_custkey").alias("payer"), F.col("c_name").alias("pagador"))
    return plain(t.customer.join(payer, F.col("c_custkey") - F.col("c_custkey") % 10 == F.col("payer"), "left").select("c_custkey", "pagador"))


@query("role_playing_dim", """select l_orderkey, l_linenumber, l_partkey, l_suppkey, a.n_name as origen, b.n_name as destino from lineitem
    join supplier on l_suppkey = s_suppkey join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
    left join nation a on s_nationkey = a.n_nationkey left join nation b on c_nationkey = b.n_nationkey""")
def role_playing_dim(t: Tables) -> DataFrame:
    def role(key: str, name: str) -> DataFrame:
        return t.nation.select(F.col("n_nationkey").alias(key), F.col("n_name").alias(name))

    rows = (
        t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(role("s_nationkey", "origen"), "s_nationkey", "left").join(role("c_nationkey", "destino"), "c_nationkey", "left")
    )
    return plain(rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "origen", "destino"))


@query("multi_hop_left", """select o_orderkey, n_name, r_name from orders left join customer on o_custkey = c_custkey
    left join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey""")
def multi_hop_left(t: Tables) -> DataFrame:
    return plain(t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left")
                 .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
                 .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select("o_orderkey", "n_name", "r_name"))


@query("header_line", f"""select o_orderkey, count(*) as lineas, cast(sum({M('l_extendedprice')}) as double) as importe
    from orders join lineitem on o_orderkey = l_orderkey group by o_orderkey""")
def header_line(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", money("l_extendedprice").alias("v"))
    return plain(t.orders.select("o_orderkey").join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
                 .groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("lineas"), F.sum("v").alias("importe")))


@query("composite_left_join", """select p_partkey, coalesce(n, 0) as lineas from part left join (select l_partkey, l_returnflag, l_linestatus, count(*) as n
    from lineitem group by all) on p_partkey = l_partkey and l_returnflag = case when p_size > 25 then 'A' else 'R' end and l_linestatus = 'F'""")
def composite_left_join(t: Tables) -> DataFrame:
    lines = t.lineitem.groupBy("l_partkey", "l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), F.when(F.col("p_size") > 25, "A").otherwise("R").alias("l_returnflag"),
                         F.lit("F").alias("l_linestatus"))
    return plain(part.join(lines, ["l_partkey", "l_returnflag", "l_linestatus"], "left")
                 .select(F.col("l_partkey").alias("p_partkey"), F.coalesce("n", F.lit(0)).alias("lineas")))


@query("anti_new_keys", "select o_orderkey from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey)")
def anti_new_keys(t: Tables) -> DataFrame:
    return plain(missing_rows(t.orders.select(F.col("o_orderkey").alias("l_orderkey")), t.lineitem, "l_orderkey")
                 .select(F.col("l_orderkey").alias("o_orderkey")))


@query("semi_done", "select c_custkey from customer where exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus = 'P')")
def semi_done(t: Tables) -> DataFrame:
    done = t.orders.filter(F.col("o_orderstatus") == "P")
    return plain(t.customer.join(done, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey"))


@query("compound_join", """select o_orderkey, l_linenumber, l_partkey, l_suppkey from orders join lineitem on o_orderkey = l_orderkey
    and strftime(l_shipdate, '%Y-%m') = strftime(o_orderdate, '%Y-%m')""")
def compound_join(t: Tables) -> DataFrame:
    l = t.lineitem.withColumn("m", period("l_shipdate"))
    o = t.orders.withColumn("om", period("o_orderdate"))
    return plain(o.join(l, (F.col("o_orderkey") == F.col("l_orderkey")) & (F.col("m") == F.col("om")))
                 .select("o_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))


USES = """select l_partkey as p_partkey, n_regionkey as r_regionkey from {lineitem} join {orders} on l_orderkey = o_orderkey
    join {customer} on o_custkey = c_custkey join {nation} on c_nationkey = n_nationkey"""


@query("cross_offer", f"""select distinct p_partkey, r_regionkey, p_name, r_name from ({USES.replace('{', '').replace('}', '')}) join part using (p_partkey) join region using (r_regionkey)""")
def cross_offer(t: Tables) -> DataFrame:
    """Every part with each region it is ordered from."""
    return plain(pairs_in_use(t.sql(USES), t.part.select("p_partkey", "p_name"), "p_partkey", t.region.select("r_regionkey", "r_name"), "r_regionkey"))


@query("scalar_lookup", """select l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce((select min(s_suppkey) + 1 from supplier
    where s_nationkey = l_partkey % 30), 0) as clave from lineitem""")
def scalar_lookup(t: Tables) -> DataFrame:
    dim = t.supplier.select((F.col("s_suppkey") + 1).alias("k"), F.col("s_nationkey").cast("bigint").alias("nation"))
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", (F.col("l_partkey") % 30).alias("look"))
    return plain(resolve(rows, dim, {"look": "nation"}, {"clave": "k"}).drop("look"))


@query("lookup_by_name", """select l_orderkey, l_linenumber, l_partkey, l_suppkey, k as clave from lineitem
    join part on l_partkey = p_partkey join (select p_name as pn, min(p_partkey) + 1 as k from part group by p_name) on pn = p_name""")
def lookup_by_name(t: Tables) -> DataFrame:
    named = t.lineitem.join(t.part.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    dim = t.part.select((F.col("p_partkey") + 1).alias("k"), "p_name")
    return plain(resolve(named, dim, {"p_name": "p_name"}, {"clave": "k"}).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "clave"))


@query("fact_two_hop", """select l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(k, 0) as cliente from lineitem left join
    (select o_orderkey, min(c_custkey) + 1 as k from orders join customer on o_custkey = c_custkey group by o_orderkey) on o_orderkey = l_orderkey""")
def fact_two_hop(t: Tables) -> DataFrame:
    dim = t.customer.select((F.col("c_custkey") + 1).alias("k"), "c_custkey")
    hop = bridge(t.orders, dim, {"o_custkey": "c_custkey"}, "o_orderkey", "k")
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return plain(resolve(rows, hop, {"l_orderkey": "o_orderkey"}, {"cliente": "k"}, single=False))


@query("correlated_counts", """select o_orderkey, coalesce((select count(*) from lineitem where l_orderkey = o_orderkey and l_returnflag = 'N'), 0) as pendientes,
    coalesce((select count(*) from lineitem where l_orderkey = o_orderkey and l_returnflag = 'R'), 0) as impagadas,
    coalesce((select max(l_partkey % 90) from lineitem where l_orderkey = o_orderkey), 0) as retraso from orders""")
def correlated_counts(t: Tables) -> DataFrame:
    flag = F.col("l_returnflag")
    plan = detail_measures(t.lineitem, "l_orderkey", {
        "pendientes": F.count_if(flag == "N"), "impagadas": F.count_if(flag == "R"), "retraso": F.max(F.col("l_partkey") % 90)})
    rows = t.orders.select("o_orderkey").join(plan, F.col("o_orderkey") == F.col("l_orderkey"), "left").drop("l_orderkey")
    return plain(rows.na.fill(0, ["pendientes", "impagadas", "retraso"]))


@query("greatest_of", """select c_custkey, coalesce(greatest(case when c_acctbal > 0 then cast(c_acctbal as decimal(18,2)) end::double,
    case when c_custkey % 3 = 0 then c_custkey::double end, case when c_nationkey > 20 then 100.0::double end), 0) as mayor from customer""")
def greatest_of(t: Tables) -> DataFrame:
    bal = money("c_acctbal").cast("double")
    return plain(t.customer.select("c_custkey", F.coalesce(F.greatest(
        F.when(F.col("c_acctbal") > 0, bal), F.when(F.col("c_custkey") % 3 == 0, F.col("c_custkey").cast("double")),
        F.when(F.col("c_nationkey") > 20, F.lit(100.0))), F.lit(0.0)).alias("mayor")))


# --- aggregates --------------------------------------------------------------------------------------

@query("scalar_watermark", """select coalesce(max(l_orderkey), 0) as max_pedido, coalesce(max(case when l_returnflag = 'Z' then l_orderkey end), 0) as vacio,
    strftime(coalesce(max(l_shipdate), timestamp '1900-01-01'), '%Y-%m-%d') as max_fecha, greatest((select max(o_orderkey) from orders), max(l_partkey)) as mayor
    from lineitem""")
def scalar_watermark(t: Tables) -> DataFrame:
    lines = t.lineitem.agg(
        F.coalesce(F.max("l_orderkey"), F.lit(0)).alias("max_pedido"),
        F.coalesce(F.max(F.when(F.col("l_returnflag") == "Z", F.col("l_orderkey"))), F.lit(0)).alias("vacio"),
        F.coalesce(F.max("l_shipdate"), moment("1900-01-01 00:00:00")).cast("date").alias("max_fecha"), F.max("l_partkey").alias("p"))
    both = lines.select("*", F.lit(1).alias("one")).join(t.orders.agg(F.max("o_orderkey").alias("o")).select("o", F.lit(1).alias("one")), "one")
    return plain(both.select("max_pedido", "vacio", "max_fecha", F.greatest("o", "p").alias("mayor")))


@query("watermark_ranges", """select max(case when id <= 1000000000000 then id end) as persona, max(case when id > 1000000000000 then id - 1000000000000 end) as empresa
    from (select c_custkey + 1 as id from customer union all select s_suppkey + 1 + 1000000000000 from supplier)""")
def watermark_ranges(t: Tables) -> DataFrame:
    ranges = id_ranges(persona=0, empresa=10**12)
    parts = {"persona": t.customer.select((F.col("c_custkey") + 1).alias("id")), "empresa": t.supplier.select((F.col("s_suppkey") + 1).alias("id"))}
    merged = union_subtypes(parts, "id", ranges)
    return plain(merged.agg(*[F.max(F.when(r.holds(F.col("id")), F.col("id") - r.offset)).alias(n) for n, r in ranges.items()]))


@query("gated_aggregate", """select case when count(distinct l_linestatus) between 2 and 3 then cast(sum(case when l_linestatus = 'O' then 1 end) as bigint) end as abiertas,
    case when count(distinct l_linenumber) between 2 and 3 then cast(sum(case when l_linenumber = 1 then 1 end) as bigint) end as nada,
    cast(round(100.0 * sum(case when l_returnflag = 'R' then 1 end) / nullif(count(*), 0), 2) as double) as porc from lineitem""", ("abiertas", "nada"))
def gated_aggregate(t: Tables) -> DataFrame:
    share = (F.lit(100).cast("decimal(20,0)") * F.sum(F.when(F.col("l_returnflag") == "R", 1)) / F.nullif(F.count(F.lit(1)), F.lit(0)))
    return plain(t.lineitem.agg(
        F.when(F.count_distinct("l_linestatus").between(2, 3), F.sum(F.when(F.col("l_linestatus") == "O", 1))).alias("abiertas"),
        F.when(F.count_distinct("l_linenumber").between(2, 3), F.sum(F.when(F.col("l_linenumber") == 1, 1))).alias("nada"),
        share.cast("decimal(5,2)").alias("porc")))


@query("dup_check", "select l_orderkey, l_linenumber, count(*) as veces from lineitem group by l_orderkey, l_linenumber having count(*) > 1")
def dup_check(t: Tables) -> DataFrame:
    return plain(duplicated(t.lineitem, ["l_orderkey", "l_linenumber"]))


@query("group_counts", "select o_orderstatus, count(*) as n, count(*) filter (where o_custkey % 3 = 0) as terceros from orders group by o_orderstatus")
def group_counts(t: Tables) -> DataFrame:
    return plain(t.orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_custkey") % 3 == 0).alias("terceros")))


@query("table_row_counts", " union all ".join(f"select '{n}' as \"Tabla\", count(*) as \"Filas\" from {n}" for n in TABLES))
def table_row_counts(t: Tables) -> DataFrame:
    return plain(row_counts({n: getattr(t, n) for n in TABLES}))


@query("distinct_days", "select distinct strftime(ts, '%Y-%m-%d') as dia from events")
def distinct_days(t: Tables) -> DataFrame:
    return plain(t.events.select(F.col("ts").cast("date").alias("dia")).distinct())


# --- windows, sorts, sets ----------------------------------------------------------------------------

@query("row_number_dedupe", """select l_partkey, l_suppkey, l_orderkey, l_linenumber, cast(l_extendedprice as double) as precio from (select *,
    row_number() over (partition by l_partkey order by l_extendedprice desc, l_orderkey desc, l_linenumber desc, l_suppkey desc, l_quantity desc) as rn from lineitem) where rn = 1""")
def row_number_dedupe(t: Tables) -> DataFrame:
    order = [F.col(c).desc() for c in ("l_extendedprice", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")]
    return plain(latest_per_key(t.lineitem, ["l_partkey"], order).select(
        "l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("precio")))


@query("latest_three", """select event_id, strftime(ts, '%Y-%m-%d') as dia from events where cast(ts as date) in
    (select distinct cast(ts as date) from events order by 1 desc limit 3)""")
def latest_three(t: Tables) -> DataFrame:
    days = t.events.select("event_id", F.col("ts").cast("date").alias("dia"))
    newest = days.select("dia").distinct().orderBy(F.col("dia").desc()).limit(3)
    return plain(days.join(newest, "dia", "left_semi").select("event_id", "dia"))


@query("rank_dependent_case", """select s_suppkey, case when rn % 3 = 0 then 'CADA 3' when rn % 4 = 0 then 'CADA 4' else 'RESTO' end as grupo
    from (select s_suppkey, row_number() over (order by s_suppkey % 1021, s_suppkey) as rn from supplier)""")
def rank_dependent_case(t: Tables) -> DataFrame:
    numbered = number_rows(t.supplier.select("s_suppkey"), "rn", ["s_suppkey"])
    return plain(numbered.select("s_suppkey", F.when(F.col("rn") % 3 == 0, "CADA 3").when(F.col("rn") % 4 == 0, "CADA 4").otherwise("RESTO").alias("grupo")))


@query("topk_log", """select strftime(ts, '%Y-%m-%d %H:%M:%S') as "FechaEjecucion", event_type as "NombreProceso", cast(user_id as varchar) as "TablaDestino" from events
    order by ts desc, event_type, cast(user_id as varchar) limit 10""")
def topk_log(t: Tables) -> DataFrame:
    log = t.events.select(F.col("ts").alias("FechaEjecucion"), F.col("event_type").alias("NombreProceso"), F.col("user_id").cast("string").alias("TablaDestino"))
    return plain(newest_runs(log))


@query("ordered_report", "select o_orderpriority, count(*) as n from orders group by o_orderpriority order by o_orderpriority")
def ordered_report(t: Tables) -> DataFrame:
    return plain(t.orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n")).orderBy("o_orderpriority"))


@query("union_all_layers", """select 'cliente' as capa, c_custkey as id, c_name as nombre from customer union all select 'proveedor', s_suppkey, s_name from supplier
    union all select 'articulo', p_partkey, p_name from part""")
def union_all_layers(t: Tables) -> DataFrame:
    def layer(df: DataFrame, tag: str, ident_: str, name: str) -> DataFrame:
        return df.select(F.lit(tag).alias("capa"), F.col(ident_).alias("id"), F.col(name).alias("nombre"))

    return plain(layer(t.customer, "cliente", "c_custkey", "c_name").unionByName(layer(t.supplier, "proveedor", "s_suppkey", "s_name"))
                 .unionByName(layer(t.part, "articulo", "p_partkey", "p_name")))


@query("union_offset", """select c_custkey + 1 as id, 'Persona' as tipo, upper(c_name) as nombre, cast(c_mktsegment as varchar) as segmento from customer
    union all select s_suppkey + 1 + 1000000000000, 'Empresa', upper(s_name), null from supplier""")
def union_offset(t: Tables) -> DataFrame:
    people = t.customer.select((F.col("c_custkey") + 1).alias("id"), F.lit("Persona").alias("tipo"), clean_text("c_name").alias("nombre"),
                               F.col("c_mktsegment").alias("segmento"))
    firms = t.supplier.select((F.col("s_suppkey") + 1).alias("id"), F.lit("Empresa").alias("tipo"), clean_text("s_name").alias("nombre"))
    ranges = {"people": IdRange("people", 0, 10**12), "firms": IdRange("firms", 10**12)}
    return plain(union_subtypes({"people": people, "firms": firms}, "id", ranges))


@query("union_align", f"""select o_orderkey as cliente_tx, null::bigint as proveedor_tx, o_custkey as cliente, null::bigint as proveedor,
    cast({M('o_totalprice')} as double) as importe from orders
    union all select null, l_orderkey * 10 + l_linenumber, null, l_suppkey, cast({M('l_extendedprice')} as double) from lineitem""", ("cliente_tx", "proveedor_tx", "cliente", "proveedor"))
def union_align(t: Tables) -> DataFrame:
    a = t.orders.select(F.col("o_orderkey").alias("cliente_tx"), F.col("o_custkey").alias("cliente"), money("o_totalprice").alias("importe"))
    b = t.lineitem.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("proveedor_tx"), F.col("l_suppkey").alias("proveedor"),
                          money("l_extendedprice").alias("importe"))
    return plain(a.unionByName(b, allowMissingColumns=True))


@query("upsert_control", """select s_suppkey as id, s_name as nombre, 'nuevo' as estado from supplier union all
    select c_custkey, c_name, 'previo' from customer where not exists (select 1 from supplier where s_suppkey = c_custkey)""")
def upsert_control(t: Tables) -> DataFrame:
    old = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("nombre"), F.lit("previo").alias("estado"))
    new = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("nombre"), F.lit("nuevo").alias("estado"))
    return plain(upsert(old, new, "id"))


@query("seed_catalogue", """select seg, c_custkey from (select distinct 'SEG-' || c_mktsegment as seg from customer where c_mktsegment <> 'BUILDING') s
    join customer on seg = 'SEG-' || c_mktsegment union all select 'SEG-BUILDING', c_custkey from customer where c_mktsegment = 'BUILDING'""")
def seed_catalogue(t: Tables) -> DataFrame:
    seed = inline_rows(t.spark, "c_mktsegment string", [("BUILDING",), ("MACHINERY",)])
    held = t.customer.select("c_mktsegment").filter(F.col("c_mktsegment") != "BUILDING").distinct()
    catalogue = held.unionByName(missing_rows(seed, held, "c_mktsegment"))
    return plain(catalogue.join(t.customer, "c_mktsegment").select(F.concat(F.lit("SEG-"), "c_mktsegment").alias("seg"), "c_custkey"))


_GROWTH = "case year(o_orderdate) + 16 " + " ".join(f"when {y} then {g}" for y, g in GROWTH.items()) + f" else {LATER_GROWTH} end"


@query("growth_factor", f"""select year(o_orderdate) + 16 as ano, cast(sum({M('o_totalprice')} * {_GROWTH}) as double) as ajustado from orders group by 1""")
def growth(t: Tables) -> DataFrame:
    shifted = F.add_months(F.col("o_orderdate").cast("date"), 16 * 12)
    rows = t.orders.select(F.year(shifted).alias("ano"), (money("o_totalprice") * growth_factor(shifted)).alias("v"))
    return plain(rows.groupBy("ano").agg(F.sum("v").alias("ajustado")))


@query("iban_check", f"""select c_custkey, cuenta, cast(cuenta[1:2] = 'ES' and (cast(cuenta[5:24] || '1428' || cuenta[3:4] as hugeint) % 97) = 1 as integer) as valido,
    lpad(cast(98 - (cast(cuenta[5:24] || '142800' as hugeint) % 97) as varchar), 2, '0') as control
    from (select c_custkey, {iban('c_custkey + 1')} as cuenta from customer)""")
def iban_check(t: Tables) -> DataFrame:
    c = t.sql(f"select c_custkey, {iban('c_custkey + 1')} as cuenta from {{customer}}")
    return plain(c.select("c_custkey", "cuenta", ident.valid_iban("cuenta").alias("valido"),
                          ident.iban_check_digits(F.substring("cuenta", 5, 20)).alias("control")))


@query("arbitrary_order_codes", """select n_nationkey, 'EMP-' || right('00000' || cast(row_number() over (order by n_nationkey % 1021, n_nationkey) as varchar), 5) as codigo,
    k as primero from nation left join (select s_nationkey, min(s_suppkey) as k from supplier group by 1) on s_nationkey = n_nationkey""", ("primero",))
def arbitrary_order_codes(t: Tables) -> DataFrame:
    first = key_per_value(t.supplier, "s_nationkey", ["s_suppkey"])
    coded = number_rows(t.nation.select("n_nationkey"), "n", ["n_nationkey"])
    return plain(coded.join(first, F.col("n_nationkey") == F.col("s_nationkey"), "left").select(
        "n_nationkey", sequence_code("EMP-", "n", 5).alias("codigo"), F.col("s_suppkey").alias("primero")))
