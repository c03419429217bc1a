"""Credit-risk and pricing batch jobs over loan, movement and product tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bodega.functions.amounts import money
from bodega.functions.dates import period
from bodega.operators.joins import pairs_in_use

# Loan states, what they are declared as, the provision share and its risk class, the
# yearly growth of the business, and the terms of the instalment plans.
DECLARED_STATES = ("Vigente", "Dudoso", "Vencido")
DOUBTFUL = "Dudoso"
DECLARED_CLASS = {"Dudoso": "Dudoso", "Vigente": "Normal"}
OTHER_CLASS = "Substandard"
PROVISION_SHARE = "0.25"
DOUBTFUL_CLASS_ID = 4
GROWTH = {
    2013: "1.00", 2014: "1.12", 2015: "1.21", 2016: "1.26", 2017: "1.30", 2018: "1.35",
    2019: "1.40", 2020: "1.20", 2021: "1.35", 2022: "1.42",
}
LATER_GROWTH = "1.45"
CAPITAL_SHARE, INTEREST_SHARE = "0.85", "0.15"


@dataclass(frozen=True)
class InstalmentTerms:
    """Instalments issued, how many of the first may already be paid, and which one a doubtful loan misses."""

    count: int
    payable: int
    missed: int | None = None


TERMS = {
    "PRESTAMO": InstalmentTerms(24, 3, missed=4),
    "HIPOTECA": InstalmentTerms(24, 6),
    "CONSUMO": InstalmentTerms(6, 2),
}


def _day(value: date | str) -> Column:
    return F.lit(str(value)).cast("date")


def _decimal(text: str) -> Column:
    return F.lit(text).cast("decimal(5,2)")


def growth_factor(day: Column) -> Column:
    year = F.year(day)
    out = F.when(year == 2013, _decimal(GROWTH[2013]))
    for y, factor in GROWTH.items():
        out = out.when(year == y, _decimal(factor))
    return out.otherwise(_decimal(LATER_GROWTH))


def qualifying_loans(loans: DataFrame) -> DataFrame:
    return loans.filter(F.col("EstadoPrestamo").isin(*DECLARED_STATES))


def risk_declarations(loans: DataFrame, declared: DataFrame, day: date | str) -> DataFrame:
    """Month-end declaration, one row per person and period; on another day there is nothing to declare.

    A person's loans are summed (partial aggregation); the class is that of the worst state. People
    already declared for the period are left out.
    """
    today = _day(day)
    amount = F.col("ImportePendiente")
    bad = F.col("EstadoPrestamo") == DOUBTFUL
    severity = F.when(bad, 2).when(F.col("EstadoPrestamo") == "Vigente", 0).otherwise(1)
    per_person = qualifying_loans(loans).filter(today == F.last_day(today)).groupBy("PersonaID").agg(
        money(F.sum(amount)).alias("RiesgoDirecto"),
        money(F.coalesce(F.sum(F.when(bad, amount)), F.lit(0))).alias("RiesgoDudoso"),
        F.count(F.lit(1)).cast("int").alias("NumeroOperaciones"),
        F.max(severity).alias("_worst"),
    )
    known = declared.filter(F.col("PeriodoDeclaracion") == period(today)).select("PersonaID")
    return per_person.join(known, "PersonaID", "left_anti").select(
        "PersonaID", today.alias("FechaDeclaracion"), period(today).alias("PeriodoDeclaracion"),
        "RiesgoDirecto", money(F.lit(0)).alias("RiesgoIndirecto"), F.col("RiesgoDirecto").alias("RiesgoTotal"),
        "RiesgoDudoso", "NumeroOperaciones",
        F.when(F.col("_worst") == 2, DECLARED_CLASS["Dudoso"]).when(F.col("_worst") == 1, OTHER_CLASS)
        .otherwise(DECLARED_CLASS["Vigente"]).alias("ClasificacionRiesgo"),
    )


def declaration_detail(declarations: DataFrame, loans: DataFrame, detailed: DataFrame, reporting: str,
                       institutions: int) -> DataFrame:
    """One row per declared loan of the period whose declaration has no detail yet.

    The reporting institution is picked by contract, evenly over the ids 1..`institutions`.
    """
    pending = declarations.filter(F.col("PeriodoDeclaracion") == reporting).join(detailed, "DeclaracionCIRBEID", "left_anti")
    return qualifying_loans(loans).join(pending.select("DeclaracionCIRBEID", "PersonaID"), "PersonaID", "inner").select(
        "DeclaracionCIRBEID",
        (F.pmod(F.col("PrestamoID"), F.lit(institutions)) + 1).cast("int").alias("EntidadFinancieraID"),
        "NumeroContrato", F.lit("Préstamo Personal").alias("TipoOperacion"), F.lit("Financiación").alias("NaturalezaOperacion"),
        F.col("ImporteConcedido").alias("ImporteOperacion"), F.col("ImportePendiente").alias("SaldoVivo"),
        (F.col("EstadoPrestamo") == DOUBTFUL).alias("EsOperacionDudosa"),
    )


def provisions(loans: DataFrame, booked: DataFrame, day: date | str) -> DataFrame:
    """A quarter of the pending amount of doubtful loans, once per contract and date."""
    share = money(F.round(F.col("ImportePendiente") * _decimal(PROVISION_SHARE), 2))
    known = booked.filter(F.col("FechaProvision") == _day(day)).select("NumeroContrato")
    return loans.filter(F.col("EstadoPrestamo") == DOUBTFUL).join(known, "NumeroContrato", "left_anti").select(
        "NumeroContrato", _day(day).alias("FechaProvision"), F.lit("Específica").alias("TipoProvision"),
        share.alias("ImporteProvisionado"), money(F.lit(0)).alias("ImporteRecuperado"), share.alias("SaldoProvision"),
        F.lit(DOUBTFUL_CLASS_ID).alias("ClasificacionRiesgoID"),
    )


def doubtful_register(loans: DataFrame, registered: DataFrame, first_due: str, day: date | str) -> DataFrame:
    """Doubtful loans not registered yet, with the days since their first due date (90 at least)."""
    days = F.greatest(F.date_diff(_day(day), F.col(first_due)), F.lit(90))
    return loans.filter(F.col("EstadoPrestamo") == DOUBTFUL).join(registered.select("NumeroContrato"), "NumeroContrato", "left_anti").select(
        "NumeroContrato", _day(day).alias("FechaDeclaracionDudosa"), F.lit("Impago superior a 90 días").alias("MotivoDudoso"),
        F.col("ImportePendiente").alias("ImporteDudoso"), days.alias("DiasImpago"),
        F.lit(DOUBTFUL_CLASS_ID).alias("ClasificacionRiesgoID"), F.lit(DOUBTFUL).alias("EstadoOperacion"),
    )


def fee_tariffs(products: DataFrame, existing: DataFrame, day: date | str) -> DataFrame:
    """Monthly fee snapshot of products on sale, once per product and date."""
    known = existing.filter(F.col("FechaVigenciaDesde") == _day(day)).select("ProductoID")
    return products.filter(F.col("EsComercializable")).join(known, "ProductoID", "left_anti").select(
        "ProductoID", F.lit("Comisión mantenimiento").alias("TipoComision"),
        F.coalesce(F.col("Comision"), money(F.lit(0))).alias("ImporteFijo"), money(F.lit(0)).alias("ImporteMinimo"),
        F.lit("Saldo medio mensual").alias("BaseCalculo"), F.lit("Mensual").alias("Periodicidad"),
        _day(day).alias("FechaVigenciaDesde"),
    )


def offer_conditions(products: DataFrame, segments: DataFrame, uses: DataFrame, existing: DataFrame, day: date | str) -> DataFrame:
    """Offer of every product on sale to the segments whose customers use it; rates fall with the segment's risk level.

    `uses` has (ProductoID, SegmentoID), a row or more for each pair that occurs.
    """
    level = F.col("NivelRiesgo")

    def reduced(c: str, step: str, kind: str) -> Column:
        return F.round(F.col(c) * (F.lit(1) - level * _decimal(step)), 3 if kind == "decimal(5,3)" else 2).cast(kind)

    known = existing.filter(F.col("FechaVigenciaDesde") == _day(day)).select("ProductoID", F.col("SegmentoClienteID").alias("SegmentoID"))
    on_sale = products.filter(F.col("EsComercializable")).select("ProductoID", "TAE", "TIN", "Comision")
    pairs = pairs_in_use(uses, on_sale, "ProductoID", segments.select("SegmentoID", "NivelRiesgo"), "SegmentoID")
    return pairs.join(known, ["ProductoID", "SegmentoID"], "left_anti").select(
        "ProductoID", F.col("SegmentoID").alias("SegmentoClienteID"), F.lit("Condición estándar").alias("TipoCondicion"),
        reduced("TAE", "0.05", "decimal(5,3)").alias("TAEOfertado"), reduced("TIN", "0.05", "decimal(5,3)").alias("TINOfertado"),
        F.coalesce(reduced("Comision", "0.10", "decimal(18,2)"), money(F.lit(0))).alias("ComisionApertura"),
        (level * 2).cast("decimal(5,2)").alias("BonificacionAplicable"), _day(day).alias("FechaVigenciaDesde"),
    )


def instalment_schedule(loans: DataFrame, as_of: date | str, terms: Mapping[str, InstalmentTerms] = TERMS) -> DataFrame:
    """Each loan as its instalments.

    `loans` has PrestamoID, NumeroContrato, Clase (a key of `terms`), Principal, ImporteCuota,
    FechaFormalizacion, EstadoPrestamo. The first `payable` instalments due by `as_of` are paid; a
    doubtful loan misses one. Every 20th loan records its miss without delay days (a known defect
    the quality rules must find); the others get 30 to 89 days.
    """
    def per_class(of) -> Column:
        out = F.lit(None).cast("int")
        for name, t in terms.items():
            out = F.when(F.col("Clase") == name, F.lit(of(t)).cast("int")).otherwise(out)
        return out

    n, fee = F.col("NumeroCuota"), F.col("ImporteCuota")
    rows = loans.withColumn("NumeroCuota", F.explode(F.sequence(F.lit(1), per_class(lambda t: t.count))))
    rows = rows.withColumn("FechaVencimiento", F.add_months("FechaFormalizacion", n))
    paid = (n <= per_class(lambda t: t.payable)) & (F.col("FechaVencimiento") <= _day(as_of))
    missed = F.coalesce((F.col("EstadoPrestamo") == DOUBTFUL) & (n == per_class(lambda t: t.missed)), F.lit(False))
    capital = F.lit(CAPITAL_SHARE).cast("decimal(3,2)")
    delay = F.when(F.pmod(F.col("PrestamoID"), F.lit(20)) == 0, 0).otherwise(30 + F.pmod(F.col("PrestamoID"), F.lit(60)))
    return rows.select(
        "NumeroContrato", "NumeroCuota", "FechaVencimiento", "ImporteCuota",
        money(F.round(fee * capital, 2)).alias("ImporteCapital"),
        money(F.round(fee * F.lit(INTEREST_SHARE).cast("decimal(3,2)"), 2)).alias("ImporteIntereses"),
        money(F.lit(0)).alias("ImporteComisiones"),
        money(F.round(F.col("Principal") - fee * capital * (n - 1), 2)).alias("CapitalPendiente"),
        F.when(paid, F.col("FechaVencimiento")).alias("FechaPago"), F.when(paid, fee).alias("ImportePagado"),
        F.when(paid, "Pagada").when(missed, "Impagada").otherwise("Pendiente").alias("EstadoCuota"),
        F.when(missed & ~paid, delay).otherwise(0).cast("int").alias("DiasRetraso"),
    )


def monthly_profile(moves: DataFrame, customer: str, day: str, amount: str) -> DataFrame:
    """Per customer and month: operations, mean absolute amount and total volume."""
    size = F.abs(F.col(amount))
    return moves.groupBy(F.col(customer).alias("PersonaID"), F.trunc(F.col(day), "month").alias("Mes")).agg(
        F.count(F.lit(1)).alias("NumeroTransaccionesMes"),
        money(F.round(F.avg(size), 2)).alias("ImportePromedioTransaccion"),
        money(F.sum(size)).alias("VolumenMensualOperaciones"),
    )
