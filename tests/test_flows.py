from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from bodega.operators.catalog import CatalogEntry, column_catalog, session_tables, table_catalog
from bodega.operators.control import ControlTables
from bodega.operators.lineage import MAPPING_COLUMNS, enrich, manual_rows, mapping_checks, one_mapping_per_target, propose_clean_layer, propose_star_layer
from bodega.operators.scd import open_versions
from bodega.plans import bank_gold, bank_silver, wholesale_gold, wholesale_silver
from bodega.plans.entity import run_clean_layer, spaced
from bodega.plans.mapping import CLEAN_GAPS, STAR_GAPS, invalid_rows, main_sources, secondary_rows
from bodega.plans.star import run_star_layer
from bodega.queries.raw import raw
from bodega.sources.store import Store
from bodega.streaming.incremental import load_new_files

DAY1, DAY2 = datetime(2024, 6, 30), datetime(2024, 7, 31)


@pytest.fixture(scope="module")
def bank(spark, tables, tmp_path_factory):
    root = tmp_path_factory.mktemp("bank")
    silver, gold = Store(spark, f"{root}/silver"), Store(spark, f"{root}/gold")
    first = run_clean_layer(bank_silver.LOADS, raw(tables), silver, DAY1, parallel=4)
    star = run_star_layer(bank_gold.DIMENSIONS, bank_gold.FACTS, silver.read, gold, DAY1, parallel=4)
    return silver, gold, first, star


@pytest.fixture(scope="module")
def wholesale(spark, tables, tmp_path_factory):
    root = tmp_path_factory.mktemp("wholesale")
    silver, gold = Store(spark, f"{root}/silver"), Store(spark, f"{root}/gold")
    first = run_clean_layer(wholesale_silver.LOADS, raw(tables), silver, DAY1, parallel=4)
    star = run_star_layer(wholesale_gold.DIMENSIONS, wholesale_gold.FACTS, silver.read, gold, DAY1, parallel=4)
    return silver, gold, first, star


def test_names_follow_the_rule():
    assert [spaced(n) for n in ("FechaCierre", "TAEAplicado", "NIF", "LTVPorcentaje", "EsSEPA", "CNAE")] == [
        "Fecha Cierre", "TAE Aplicado", "NIF", "LTV Porcentaje", "Es SEPA", "CNAE"]


def test_bank_layers_load_completely(bank, tables):
    silver, gold, first, star = bank
    assert (first.ok, first.errors, first.messages) == (17, 0, {}) and (star.ok, star.errors, star.messages) == (17, 0, {})
    assert first.rows["Cliente_Staging"] == tables.customer.count() + tables.supplier.count()
    assert first.rows["Movimiento_Staging"] == star.rows["Fact.Movimiento"] == tables.events.count()
    assert first.rows["Cuota_Staging"] == star.rows["Fact.CuotaPrestamo"] == tables.lineitem.count()


def test_bank_second_run_adds_nothing(bank, tables):
    silver, gold, _, _ = bank
    again = run_clean_layer(bank_silver.LOADS, raw(tables), silver, DAY2, parallel=4)
    assert again.errors == 0 and set(again.rows.values()) == {0}
    star = run_star_layer(bank_gold.DIMENSIONS, bank_gold.FACTS, silver.read, gold, DAY2, parallel=4)
    assert star.errors == 0 and set(star.rows.values()) == {0}, star


def test_bank_keys_are_unique_and_resolved(bank):
    _, gold, _, _ = bank
    for target, d in bank_gold.DIMENSIONS.items():
        dim = gold.read(target)
        assert dim.select(F.count_distinct(F.col(f"`{d.key}`")), F.min(F.col(f"`{d.key}`"))).first() == (dim.count(), 1)
    fact = gold.read("Fact.Movimiento")
    assert fact.filter(F.col("`Cuenta Key`") == 0).count() == 0 == fact.filter(F.col("`Cliente Key`") == 0).count()
    assert fact.select(F.count_distinct(F.col("`Movimiento Key`"))).first()[0] == fact.count()
    savings = gold.read("Dimension.Cuenta").filter(F.col("`WWI Cuenta ID`") > bank_silver.SPAN)
    assert savings.select("`Cliente Key`").distinct().collect() == [(0,)]


def test_risk_class_that_the_catalogue_does_not_name_is_unknown(bank):
    """Declarations say NORMAL, the catalogue RIESGO NORMAL."""
    silver, gold, _, _ = bank
    normal = silver.read("CIRBE_Staging").filter(F.col("`Clasificacion Riesgo`") == "NORMAL").count()
    assert normal > 0 and gold.read("Fact.CIRBE").filter(F.col("`Clasificacion Riesgo Key`") == 0).count() == normal


def test_changed_customer_gets_a_new_version(bank, tables, spark, tmp_path):
    silver, gold, _, _ = bank
    copy = Store(spark, str(tmp_path / "gold"))
    copy.replace("Dimension.Cliente", gold.read("Dimension.Cliente"))
    staging = silver.read("Cliente_Staging").withColumn("Segmento", F.when(F.col("`WWI Cliente ID`") == 5, "PREMIUM").otherwise(F.col("Segmento")))
    one = {"Dimension.Cliente": bank_gold.DIMENSIONS["Dimension.Cliente"]}
    result = run_star_layer(one, {}, lambda n: staging, copy, DAY2)
    assert result.rows == {"Dimension.Cliente": 1}
    versions = copy.read("Dimension.Cliente").filter(F.col("`WWI Cliente ID`") == 5).orderBy("`Valid From`").collect()
    assert [(v["Segmento"] == "PREMIUM", v["Valid From"], v["Valid To"].year) for v in versions] == [(False, DAY1, 2024), (True, DAY2, 9999)]
    assert versions[0]["Valid To"] == DAY2
    assert open_versions(copy.read("Dimension.Cliente")).count() == open_versions(gold.read("Dimension.Cliente")).count()


def test_many_loans_and_mortgages_load_once(tables, spark, tmp_path):
    """More loans than a narrow id range would hold: the second run on the same source adds nothing."""
    reader, shift = raw(tables), 20_000

    def many(name):
        df = reader(name)
        if name != "Credito.Prestamos":
            return df
        return df.unionByName(df.withColumn("PrestamoID", F.col("PrestamoID") + shift))

    some, store = {"Credito_Staging": bank_silver.LOADS["Credito_Staging"]}, Store(spark, str(tmp_path / "s"))
    first = run_clean_layer(some, many, store, DAY1)
    assert first.rows["Credito_Staging"] == 2 * tables.orders.count() + tables.part.count()
    credits = store.read("Credito_Staging")
    assert credits.select(F.count_distinct("`WWI Credito ID`")).first()[0] == credits.count()
    assert run_clean_layer(some, many, store, DAY2).rows == {"Credito_Staging": 0}


def test_an_id_outside_its_range_ends_the_load(tables, spark, tmp_path):
    reader = raw(tables)

    def far(name):
        df = reader(name)
        return df.withColumn("PrestamoID", F.col("PrestamoID") + bank_silver.SPAN) if name == "Credito.Prestamos" else df

    result = run_clean_layer({"Credito_Staging": bank_silver.LOADS["Credito_Staging"]}, far, Store(spark, str(tmp_path / "s")), DAY1)
    assert result.errors == 1 and "outside its id range" in result.messages["Credito_Staging"]


def test_rows_that_arrive_during_a_load_belong_to_the_next(tables, spark, tmp_path):
    reader, late = raw(tables), {"on": False}
    newest = tables.orders.agg(F.max("o_orderdate")).first()[0]

    def growing(name):
        df = reader(name)
        if name == "Sales.Orders" and late["on"]:
            extra = df.orderBy("OrderID").limit(1).withColumn("OrderDate", F.lit(str(newest)).cast("timestamp_ntz") + F.expr("interval 1 day"))
            return df.unionByName(extra)
        late["on"] = late["on"] or name == "Sales.Orders"  # arrives after the load has read its source
        return df

    some, store = {"Order_Staging": wholesale_silver.LOADS["Order_Staging"]}, Store(spark, str(tmp_path / "s"))
    assert run_clean_layer(some, growing, store, DAY1).rows["Order_Staging"] > 0
    assert {r[0]: r[1] for r in ControlTables(store).control().collect()}["Order_Staging"] == newest
    assert run_clean_layer(some, growing, store, DAY2).rows["Order_Staging"] > 0


def test_only_new_rows_of_each_subtype_are_loaded(bank, tables, spark):
    silver, _, _, _ = bank
    reader = raw(tables)

    def grown(name):
        df = reader(name)
        if name == "Credito.Prestamos":  # a loan newer than its kind but older than every mortgage id
            extra = df.orderBy(F.desc("PrestamoID")).limit(1).withColumn("PrestamoID", F.col("PrestamoID") + 1).withColumn("NumeroContrato", F.lit("pre-nuevo"))
            return df.unionByName(extra)
        return df

    result = run_clean_layer(bank_silver.LOADS, grown, silver, DAY2, only="Credito_Staging")
    assert result.rows == {"Credito_Staging": 1}
    assert silver.read("Credito_Staging").filter(F.col("`Numero Contrato`") == "PRE-NUEVO").count() == 1


def test_a_failing_load_does_not_stop_the_layer(tables, spark, tmp_path):
    def reader(name):
        if name == "Riesgo.EntidadesFinancieras":
            raise RuntimeError("source is gone")
        return raw(tables)(name)

    some = {k: bank_silver.LOADS[k] for k in ("EntidadFinanciera_Staging", "ClasificacionRiesgo_Staging")}
    store = Store(spark, str(tmp_path / "s"))
    result = run_clean_layer(some, reader, store, DAY1)
    assert (result.ok, result.errors) == (1, 1) and "source is gone" in result.messages["EntidadFinanciera_Staging"]
    assert [r["Estado"] for r in ControlTables(store).log().orderBy("TablaDestino").collect()] == ["Exitoso", "Error"]


def test_duplicate_segmentation_multiplies_unless_guarded(tables, spark, tmp_path):
    reader = raw(tables)

    def doubled(name):
        df = reader(name)
        return df.unionByName(df.withColumn("FechaSegmentacion", F.lit("2024-05-01").cast("date"))) if name == "Cliente.SegmentacionComercial" else df

    some = {"Cliente_Staging": bank_silver.LOADS["Cliente_Staging"]}
    wide = run_clean_layer(some, doubled, Store(spark, str(tmp_path / "a")), DAY1).rows["Cliente_Staging"]
    single = run_clean_layer(some, doubled, Store(spark, str(tmp_path / "b")), DAY1, single_lookups=True).rows["Cliente_Staging"]
    assert single == tables.customer.count() + tables.supplier.count() < wide


def test_wholesale_layers_load_completely(wholesale, tables):
    silver, gold, first, star = wholesale
    assert (first.ok, first.errors, first.messages) == (13, 0, {}) and (star.ok, star.errors, star.messages) == (13, 0, {})
    assert first.rows["Transaction_Staging"] == star.rows["Fact.Transaction"] == tables.orders.count() + tables.lineitem.count()
    assert star.rows["Fact.Stock Holding"] == tables.part.count()
    control = {r[0]: r[1] for r in ControlTables(silver).control().collect()}
    assert control["Order_Staging"] == tables.orders.agg(F.max("o_orderdate")).first()[0]
    assert control["Transaction_Staging/supplier"] == tables.lineitem.agg(F.max("l_shipdate")).first()[0]


def test_wholesale_second_run_adds_only_the_snapshot(wholesale, tables):
    silver, gold, _, _ = wholesale
    again = run_clean_layer(wholesale_silver.LOADS, raw(tables), silver, DAY2)
    assert again.errors == 0 and {k: v for k, v in again.rows.items() if v} == {"StockHolding_Staging": tables.part.count()}
    star = run_star_layer(wholesale_gold.DIMENSIONS, wholesale_gold.FACTS, silver.read, gold, DAY2)
    assert star.errors == 0 and {k: v for k, v in star.rows.items() if v} == {"Fact.Stock Holding": tables.part.count()}
    assert silver.read("StockHolding_Staging").count() == tables.part.count()


def test_slower_transaction_source_is_not_skipped(wholesale, tables):
    """Each source has its own watermark: a supplier row older than the newest customer row still loads."""
    silver, _, _, _ = wholesale
    reader = raw(tables)
    newest = tables.lineitem.agg(F.max("l_shipdate")).first()[0]

    def grown(name):
        df = reader(name)
        if name == "Purchasing.SupplierTransactions":
            extra = df.limit(1).withColumn("TransactionDate", F.lit(str(newest)).cast("timestamp_ntz") + F.expr("interval 1 day"))
            return df.unionByName(extra)
        if name == "Sales.CustomerTransactions":
            return df.withColumn("TransactionDate", F.col("TransactionDate") + F.expr("interval 9000 days"))
        return df

    result = run_clean_layer(wholesale_silver.LOADS, grown, silver, DAY2, only="Transaction_Staging")
    assert result.rows["Transaction_Staging"] == tables.orders.count() + 1


def test_corrected_sale_total(tables):
    from bodega.plans.entity import Sources

    s = Sources(raw(tables), DAY1)
    row = wholesale_silver.sale(s, corrected=True).first()
    assert row["Total Excluding Tax"] == row["Total Including Tax"] - row["Tax Amount"]
    assert isinstance(row["Profit"], Decimal)


# --- dictionary and lineage over the loaded layers ----------------------------------------------------

@pytest.fixture(scope="module")
def catalogue(spark, tables, bank):
    silver, gold, _, _ = bank
    entries = [CatalogEntry("Bronze", "origen", n.split(".")[0], n.split(".")[1], raw(tables)(n)) for n in (
        "Cliente.Personas", "Cliente.PersonasJuridicas", "Credito.Prestamos", "Cuenta.CuentasCorrientes", "Cuenta.CuentasAhorro", "Riesgo.EntidadesFinancieras")]
    entries += [CatalogEntry("Silver", "almacen", "Integration", n, silver.read(n)) for n in bank_silver.LOADS]
    entries += [CatalogEntry("Gold", "almacen", *n.split("."), gold.read(n)) for n in [*bank_gold.DIMENSIONS, *bank_gold.FACTS]]
    entries.append(CatalogEntry("Gold", "almacen", "Dimension", "Cliente_Archive", spark.range(1)))
    entries.append(CatalogEntry("Silver", "almacen", "Integration", "Lineage", spark.range(1)))
    return entries, table_catalog(entries).cache(), column_catalog(spark, entries).cache()


def test_catalogue_scope_and_counts(catalogue, tables):
    _, found, columns = catalogue
    assert found.groupBy("capa").count().orderBy("capa").collect() == [("Bronze", 6), ("Gold", 17), ("Silver", 17)]
    row = found.filter(F.col("table_name") == "Personas").first()
    assert (row["row_count"], row["column_count"]) == (tables.customer.count(), columns.filter(F.col("table_name") == "Personas").count())
    assert columns.filter(F.col("table_name").contains("Archive")).count() == 0


def test_mapping_round_trip(spark, catalogue):
    _, found, columns = catalogue
    clean = propose_clean_layer(columns, main_sources(spark, "origen"), CLEAN_GAPS)
    star = propose_star_layer(columns, STAR_GAPS)
    mapping = clean.unionByName(manual_rows(spark, secondary_rows("origen", "almacen"))).unionByName(star).unionByName(manual_rows(spark, invalid_rows("origen", "almacen")))
    assert tuple(mapping.columns) == MAPPING_COLUMNS
    one = one_mapping_per_target(mapping)
    assert one.groupBy("BDDestino", "EsquemaDestino", "TablaDestino", "NombreCampoDestino").count().filter("count > 1").count() == 0
    checked = enrich(one, columns, found).cache()
    assert checked.count() == one.count()
    invented = {r["NombreCampoDestino"] for r in checked.filter("campo_destino_inexistente = 1 and EsquemaDestino in ('Dimension', 'Fact')").collect()}
    assert {"Es Cliente VIP", "Oficina Legacy", "Score Buro Externo", "Loyalty Points"} <= invented
    # a gap left out on purpose is not mapped; a renamed staging table is reported missing
    assert checked.filter("TablaDestino = 'Cliente_Staging' and NombreCampoDestino = 'Subsegmento'").count() == 0
    renamed = checked.filter("NombreObjetoOrigen = 'CuotaPrestamo_Staging'")
    assert renamed.count() > 0 and renamed.filter("tabla_origen_inexistente = 0").count() == 0
    report = {r["EsquemaDestino"]: r for r in mapping_checks(checked).collect()}
    assert report["Dimension"]["duplicados"] == 0 and report["Dimension"]["campos_no_existentes"] >= 3


def test_session_catalogue(spark):
    spark.sql("create database if not exists capa_demo")
    spark.range(3).write.mode("overwrite").saveAsTable("capa_demo.centro_staging")
    entries = session_tables(spark, {"capa_demo": ("Silver", "almacen", "Integration")})
    assert [(e.layer, e.table, e.data.count()) for e in entries] == [("Silver", "centro_staging", 3)]
    spark.sql("drop database capa_demo cascade")


# --- the load as a stream -----------------------------------------------------------------------------

def test_stream_loads_each_file_once(spark, tmp_path):
    source, target, marks = (str(tmp_path / n) for n in ("in", "out", "marks"))
    spark.range(5).select("id", F.lit(" a ").alias("v")).write.parquet(source)
    schema = spark.read.parquet(source).schema

    def run():
        load_new_files(spark, source, schema, marks, target, lambda df: df.withColumn("v", F.upper(F.trim("v")))).awaitTermination(120)
        return spark.read.parquet(target)

    assert run().count() == 5
    assert run().count() == 5
    spark.range(5, 7).select("id", F.lit("b").alias("v")).write.mode("append").parquet(source)
    assert sorted((r["id"], r["v"]) for r in run().select("id", "v").collect())[-2:] == [(5, "B"), (6, "B")]
