"""Credit-risk and pricing jobs with orders as loans, parts as products and events as movements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bodega.functions.amounts import money
from bodega.operators import risk
from bodega.queries.base import RUN_DAY, Tables, plain, query
from bodega.queries.raw import LOAN_STATE, O, contract, raw, raw_sql

LOANS = "Credito.Prestamos"
D2 = "cast({} as double)".format


def loans(t: Tables) -> DataFrame:
    return raw(t)(LOANS)


def declared(t: Tables) -> DataFrame:
    """Customers with a negative balance count as already declared."""
    return t.customer.filter(F.col("c_acctbal") < 0).select((F.col("c_custkey") + 1).alias("PersonaID"), F.lit("2024-06").alias("PeriodoDeclaracion"))


_DECLARED = "PersonaID not in (select c_custkey + 1 from customer where c_acctbal < 0)"


@query("risk_month_end", f"""with {raw_sql(LOANS)} select PersonaID as "PersonaID", '{RUN_DAY}' as "FechaDeclaracion", '2024-06' as "PeriodoDeclaracion", {D2('sum(ImportePendiente)')} as "RiesgoDirecto", 0.0::double as "RiesgoIndirecto",
    {D2('sum(ImportePendiente)')} as "RiesgoTotal", {D2("sum(case when EstadoPrestamo = 'Dudoso' then ImportePendiente else 0 end)")} as "RiesgoDudoso", count(*) as "NumeroOperaciones",
    case when bool_or(EstadoPrestamo = 'Dudoso') then 'Dudoso' when bool_or(EstadoPrestamo = 'Vencido') then 'Substandard' else 'Normal' end as "ClasificacionRiesgo"
    from "Credito.Prestamos" where EstadoPrestamo in ('Vigente', 'Dudoso', 'Vencido') and {_DECLARED} group by PersonaID""")
def risk_month_end(t: Tables) -> DataFrame:
    return plain(risk.risk_declarations(loans(t), declared(t), RUN_DAY))


@query("risk_not_month_end", """select count(distinct o_custkey) filter (dia = last_day(dia)) as filas from orders, (select cast(max(o_orderdate) as date) as dia from orders)
    where o_orderkey % 40 <> 0""")
def risk_not_month_end(t: Tables) -> DataFrame:
    """Nothing is declared unless the day, here the last one with an order, is a month's last."""
    day = t.orders.agg(F.max("o_orderdate").cast("date")).first()[0]
    return plain(risk.risk_declarations(loans(t), declared(t).limit(0), str(day)).agg(F.count(F.lit(1)).alias("filas")))


@query("risk_detail", f"""with {raw_sql(LOANS)} select PersonaID as "DeclaracionCIRBEID", PrestamoID % 25 + 1 as "EntidadFinancieraID", NumeroContrato as "NumeroContrato", 'Préstamo Personal' as "TipoOperacion",
    'Financiación' as "NaturalezaOperacion", {D2('ImporteConcedido')} as "ImporteOperacion", {D2('ImportePendiente')} as "SaldoVivo", cast(EstadoPrestamo = 'Dudoso' as integer) as "EsOperacionDudosa"
    from "Credito.Prestamos" where EstadoPrestamo in ('Vigente', 'Dudoso', 'Vencido') and PersonaID in (select c_custkey + 1 from customer) and PersonaID not in (select user_id + 1 from events)""")
def risk_detail(t: Tables) -> DataFrame:
    people = t.customer.select((F.col("c_custkey") + 1).alias("DeclaracionCIRBEID"), (F.col("c_custkey") + 1).alias("PersonaID"), F.lit("2024-06").alias("PeriodoDeclaracion"))
    detailed = t.events.select((F.col("user_id") + 1).alias("DeclaracionCIRBEID")).distinct()
    return plain(risk.declaration_detail(people, loans(t), detailed, "2024-06", 25))


@query("risk_provision", f"""with {raw_sql(LOANS)} select NumeroContrato as "NumeroContrato", '{RUN_DAY}' as "FechaProvision", 'Específica' as "TipoProvision", {D2('cast(ImportePendiente * 0.25 as decimal(18,2))')} as "ImporteProvisionado",
    0.0::double as "ImporteRecuperado", {D2('cast(ImportePendiente * 0.25 as decimal(18,2))')} as "SaldoProvision", 4 as "ClasificacionRiesgoID" from "Credito.Prestamos"
    where EstadoPrestamo = 'Dudoso' and PrestamoID not in (select l_orderkey + 1 from lineitem where l_linenumber = 7)""")
def risk_provision(t: Tables) -> DataFrame:
    booked = t.sql(f"select distinct {contract('pre', 'l_orderkey + 1')} as NumeroContrato, date '{RUN_DAY}' as FechaProvision from {{lineitem}} where l_linenumber = 7")
    return plain(risk.provisions(loans(t), booked, RUN_DAY))


@query("risk_doubtful", f"""with {raw_sql(LOANS)} select NumeroContrato as "NumeroContrato", '{RUN_DAY}' as "FechaDeclaracionDudosa", 'Impago superior a 90 días' as "MotivoDudoso", {D2('ImportePendiente')} as "ImporteDudoso",
    greatest(date_diff('day', FechaPrimerVencimiento, date '{RUN_DAY}'), 90) as "DiasImpago", 4 as "ClasificacionRiesgoID", 'Dudoso' as "EstadoOperacion" from "Credito.Prestamos"
    where EstadoPrestamo = 'Dudoso' and PrestamoID not in (select l_orderkey + 1 from lineitem where l_linenumber = 7)""")
def risk_doubtful(t: Tables) -> DataFrame:
    known = t.sql(f"select distinct {contract('pre', 'l_orderkey + 1')} as NumeroContrato from {{lineitem}} where l_linenumber = 7")
    return plain(risk.doubtful_register(loans(t), known, "FechaPrimerVencimiento", RUN_DAY))


PRODUCTS, SEGMENTS = "Producto.CatalogoProductos", "Cliente.Segmentos"
_OFFERED = "ProductoID not in (select l_partkey + 1 from lineitem where l_quantity = 50)"


def existing_prices(t: Tables) -> DataFrame:
    return t.lineitem.filter(F.col("l_quantity") == 50).select((F.col("l_partkey") + 1).alias("ProductoID"), F.lit(RUN_DAY).cast("date").alias("FechaVigenciaDesde")).distinct()


@query("fee_tariffs", f"""with {raw_sql(PRODUCTS)} select ProductoID as "ProductoID", 'Comisión mantenimiento' as "TipoComision", {D2('coalesce(Comision, 0)')} as "ImporteFijo", 0.0::double as "ImporteMinimo",
    'Saldo medio mensual' as "BaseCalculo", 'Mensual' as "Periodicidad", '{RUN_DAY}' as "FechaVigenciaDesde" from "Producto.CatalogoProductos" where EsComercializable and {_OFFERED}""")
def fee_tariffs(t: Tables) -> DataFrame:
    return plain(risk.fee_tariffs(raw(t)(PRODUCTS), existing_prices(t), RUN_DAY))


# Which customers' segments use which products: lines of their orders.
USES = """select distinct l_partkey + 1 as ProductoID, c_nationkey % 5 + 1 as SegmentoID from {lineitem} join {orders} on l_orderkey = o_orderkey
    join {customer} on o_custkey = c_custkey"""


@query("offer_conditions", f"""with {raw_sql(PRODUCTS, SEGMENTS)} select ProductoID as "ProductoID", SegmentoID as "SegmentoClienteID", 'Condición estándar' as "TipoCondicion",
    {D2('cast(TAE * (1 - NivelRiesgo * 0.05) as decimal(5,3))')} as "TAEOfertado", {D2('cast(TIN * (1 - NivelRiesgo * 0.05) as decimal(5,3))')} as "TINOfertado",
    {D2('coalesce(cast(Comision * (1 - NivelRiesgo * 0.1) as decimal(18,2)), 0)')} as "ComisionApertura", {D2('NivelRiesgo * 2')} as "BonificacionAplicable", '{RUN_DAY}' as "FechaVigenciaDesde"
    from ({USES.replace('{', '').replace('}', '')}) join "Producto.CatalogoProductos" using (ProductoID) join "Cliente.Segmentos" using (SegmentoID) where EsComercializable and not (SegmentoID = 1 and ProductoID in (select l_partkey + 1 from lineitem where l_quantity = 50))""")
def offer_conditions(t: Tables) -> DataFrame:
    existing = existing_prices(t).withColumn("SegmentoClienteID", F.lit(1))
    return plain(risk.offer_conditions(raw(t)(PRODUCTS), raw(t)(SEGMENTS), t.sql(USES), existing, RUN_DAY))


_CLASS = "case o_orderkey % 3 when 0 then 'PRESTAMO' when 1 then 'HIPOTECA' else 'CONSUMO' end"
_PLAN = f"""select {O} as PrestamoID, {contract('pre', O)} as NumeroContrato, {_CLASS} as Clase, cast(o_totalprice as decimal(18,2)) as Principal,
    cast(o_orderkey % 500 + 10 as decimal(18,2)) as ImporteCuota, cast(o_orderdate as date) as FechaFormalizacion, {LOAN_STATE} as EstadoPrestamo from {{orders}}"""


@query("instalment_schedule", f"""with p as ({_PLAN.replace('{', '').replace('}', '')}),
    r as (select *, case Clase when 'CONSUMO' then 6 else 24 end as total, case Clase when 'PRESTAMO' then 3 when 'HIPOTECA' then 6 else 2 end as pagables from p),
    q as (select r.*, n, cast(FechaFormalizacion + to_months(cast(n as integer)) as date) as vence from r, range(1, 25) as g(n) where n <= total),
    s as (select *, n <= pagables and vence <= date '1997-06-30' as pagada, Clase = 'PRESTAMO' and EstadoPrestamo = 'Dudoso' and n = 4 as falla from q)
    select NumeroContrato as "NumeroContrato", n as "NumeroCuota", strftime(vence, '%Y-%m-%d') as "FechaVencimiento", {D2('ImporteCuota')} as "ImporteCuota", {D2('cast(ImporteCuota * 0.85 as decimal(18,2))')} as "ImporteCapital",
    {D2('cast(ImporteCuota * 0.15 as decimal(18,2))')} as "ImporteIntereses", 0.0::double as "ImporteComisiones", {D2('cast(Principal - ImporteCuota * 0.85 * (n - 1) as decimal(18,2))')} as "CapitalPendiente",
    case when pagada then strftime(vence, '%Y-%m-%d') end as "FechaPago", {D2('case when pagada then ImporteCuota end')} as "ImportePagado",
    case when pagada then 'Pagada' when falla then 'Impagada' else 'Pendiente' end as "EstadoCuota",
    case when falla and not pagada then (case when PrestamoID % 20 = 0 then 0 else 30 + PrestamoID % 60 end) else 0 end as "DiasRetraso" from s""")
def instalment_schedule(t: Tables) -> DataFrame:
    return plain(risk.instalment_schedule(t.sql(_PLAN), "1997-06-30"))


@query("monthly_profile", """select user_id as "PersonaID", strftime(ts, '%Y-%m-01') as "Mes", count(*) as "NumeroTransaccionesMes",
    ((2 * sum(cast(cast(value as decimal(18,2)) * 100 as bigint)) + count(*)) // (2 * count(*))) / 100.0 as "ImportePromedioTransaccion", cast(sum(cast(value as decimal(18,2))) as double) as "VolumenMensualOperaciones"
    from events group by 1, 2""")
def monthly_profile(t: Tables) -> DataFrame:
    signed = F.when(F.col("event_type") == "error", -money("value")).otherwise(money("value"))
    moves = t.events.select("user_id", F.col("ts").cast("date").alias("dia"), signed.alias("importe"))
    return plain(risk.monthly_profile(moves, "user_id", "dia", "importe"))


