from datetime import date, datetime
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bodega.operators import quality
from bodega.operators.quality import TableName, close_run, keep_newest_runs, not_done_today, profile, sweep

NAME, DAY = TableName("db", "s", "t"), "2024-06-30"


def results(df):
    return {r["columna"]: r.asDict() for r in profile(df, NAME, DAY).collect()}


def column(spark, values, kind="string", **metadata):
    schema = T.StructType([T.StructField("c", T._parse_datatype_string(kind), True, metadata)])
    return results(spark.createDataFrame([(v,) for v in values], schema))["c"]


def half_up(part, whole):
    return (Decimal(100) * part / Decimal(whole)).quantize(Decimal("0.01"), ROUND_HALF_UP)


def test_counts_and_scores_follow_their_formulas(spark):
    values = ["a", "a", "b", None, None, None, "c"]
    r = column(spark, values)
    n, nulls, distinct = 7, 3, 3
    assert (r["filas"], r["nulos"], r["duplicados"]) == (n, nulls, n - distinct - nulls)
    assert r["porc_nulos"] == half_up(nulls, n) and r["porc_duplicados"] == half_up(1, n) and r["completitud"] == half_up(n - nulls, n)
    lost = Decimal(100) * nulls / n * Decimal("0.6") + Decimal(100) * (n - distinct) / n * Decimal("0.4")
    assert r["scoring"] == (100 - lost).quantize(Decimal("0.01"), ROUND_HALF_UP)


@pytest.mark.parametrize("values, label, share", [
    ([f"a{i}@b.es" for i in range(19)] + ["ab.es"], "EMAIL", "95.00"), (["12345678Z", "00000000T"], "DNI", "100.00"), (["28001", "08002", "41001"], "CP", "100.00"),
    (["612345678", "712345678"], "TELEFONO", "100.00"), (["ES9121000418450200051332"], "IBAN", "100.00"), (["SI", "no", "SI"], "BOOLEANO", "100.00"),
    (["2024-01-01", "2024-02-01"], "FECHA", "100.00"), (["ROJO", "ROJO", "AZUL"], "CATEGORICA", "100.00"), (["1.5", "2.5", "3.5"], "NUMERICO", "100.00"),
    (["uno", "dos", "tres"], "SIN INFORMAR", "0.00"), ([None, None], "SIN INFORMAR", "0.00"), (["S"], "BOOLEANO", "100.00"),
])
def test_logical_type(spark, values, label, share):
    r = column(spark, values)
    assert (r["tipo_logico"], str(r["porc_coincidencia"])) == (label, share)


def test_close_match_wins_over_the_best(spark):
    """95 of 100 e-mails that are all also categorical: e-mail is tried first and reaches 95 % of the best."""
    r = column(spark, ["a@b.es"] * 96 + ["otro"] * 4)
    assert (r["tipo_logico"], str(r["porc_coincidencia"]), str(r["porc_email"])) == ("EMAIL", "100.00", "96.00")
    assert column(spark, ["a@b.es"] * 94 + ["otro"] * 6)["tipo_logico"] == "CATEGORICA"


def test_no_match_is_null_not_zero(spark):
    r = column(spark, ["x", "w"])
    assert (r["posibles_email"], r["porc_email"], r["posibles_booleano"], r["porc_booleano"]) == (None, None, 0, None)


def test_declared_length_limits_the_patterns(spark):
    assert column(spark, ["28001"], max_length=4)["posibles_cp"] is None
    r = column(spark, ["28001"], max_length=5)
    assert (r["posibles_cp"], r["posibles_dni"], r["posibles_email"]) == (1, None, None)


def test_not_evaluable_columns(spark):
    for r in (column(spark, [b"x", b"y"], "binary"), column(spark, [[1], [2]], "array<int>"), column(spark, ["x", "y"], max_length=-1)):
        assert (r["filas"], r["nulos"], r["scoring"], r["posibles_numerico"], r["porc_booleano"], r["tipo_logico"]) == (2, 0, 0, 0, 0, "NO EVALUABLE")
        assert (r["posibles_fecha"], r["num_distintos"], r["es_categorica"]) == (None, None, None)


def test_numeric_boolean_and_signed_zero(spark):
    assert column(spark, [0, 1, 1], "int")["tipo_logico"] == "BOOLEANO"
    assert column(spark, [True, False, None], "boolean")["posibles_booleano"] == 2
    assert column(spark, [1, 1], "int")["posibles_booleano"] is None
    assert column(spark, [0.0, -0.0, 1.0], "double")["posibles_booleano"] == 3
    assert column(spark, [Decimal("1.00"), Decimal("0.00")], "decimal(18,2)")["posibles_booleano"] is None
    assert column(spark, [10**15, 1, 2, 3], "bigint")["posibles_numerico"] == 3


def test_conformity(spark):
    good, bad = "ES9121000418450200051332", "ES0021000418450200051332"
    assert str(column(spark, [good] * 3 + [bad])["porc_conformidad"]) == "75.00"
    assert str(column(spark, ["12345678Z", "12345678A"])["porc_conformidad"]) == "50.00"
    assert column(spark, [good, "x", "y"])["porc_conformidad"] is None  # under 80 %


def test_long_texts_are_counted_whole(spark):
    long = "palabra " * 100
    r = column(spark, [long + "1", long + "2", long + "2", " " * 300 + "12.5"])
    assert (r["duplicados"], r["posibles_numerico"], r["num_distintos"]) == (1, 1, 3)


def test_seeded_defects_show_at_their_rates(spark):
    """Defects are functions of the row id, so the counts are exact."""
    n = 6600
    i = F.col("id")
    letter = F.substring(F.lit("TRWAGMYFPDXBNJZSQVHLCKE"), ((i * 7919 % 100000000 + F.when(i % 33 == 0, 1).otherwise(0)) % 23 + 1).cast("int"), F.lit(1))
    df = spark.range(1, n + 1).select(
        F.concat(F.lpad((i * 7919 % 100000000).cast("string"), 8, "0"), letter).alias("dni"),
        F.concat(F.lit("c"), i.cast("string"), F.when(i % 20 == 0, "").otherwise("@"), F.lit("mail.es")).alias("email"),
        F.when(i % 20 == 0, F.lpad((60000000 + i).cast("string"), 8, "0")).otherwise((600000000 + i).cast("string")).alias("movil"),
        F.when(i % 25 == 0, F.lit("2800")).otherwise(F.lpad((i % 53000).cast("string"), 5, "0")).alias("cp"),
        F.when(i % 5 != 0, i.cast("decimal(18,2)")).alias("limite"), F.when(i % 10 != 0, i).alias("ingresos"), F.when(i % 7 != 0, i).alias("patrimonio"),
        F.concat(F.lit("ES"), F.lpad((i % 79 + 21).cast("string"), 2, "0"), F.lpad(i.cast("string"), 16, "0")).alias("destino"),
    )
    r = results(df)
    assert r["dni"]["porc_conformidad"] == half_up(n - n // 33, n) and r["dni"]["tipo_logico"] == "DNI"
    assert r["email"]["porc_email"] == Decimal("95.00") == r["movil"]["porc_telefono"]
    assert r["cp"]["porc_cp"] == Decimal("96.00")
    assert r["limite"]["completitud"] == Decimal("80.00") and r["ingresos"]["completitud"] == Decimal("90.00")
    assert r["patrimonio"]["completitud"] == half_up(n - n // 7, n)
    assert r["destino"]["posibles_iban"] is None  # twenty characters


def test_unusual_column_names(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x")], "`Saldo Medio` int, `a.b` string")
    assert set(results(df)) == {"Saldo Medio", "a.b"}


def test_sweep_skips_retries_and_reports(spark):
    broken = spark.range(3).select("id", F.raise_error(F.lit("bad column")).cast("string").alias("roto"))
    saved = []

    def save(name, result):
        saved.extend((name.table, r["columna"]) for r in result.collect())

    tables = {TableName("db", "s", t): df for t, df in {
        "ok": spark.range(3), "vacia": spark.range(0), "hecha": spark.range(2), "mala": broken}.items()}
    out = sweep(tables, DAY, save, done=[TableName("db", "s", "hecha")])
    assert sorted(saved) == [("mala", "id"), ("ok", "id")]
    assert [n.table for n in out.skipped] == ["vacia", "hecha"]
    assert [(n.table, c) for n, c, _ in out.failures] == [("mala", "roto")] and "bad column" in out.failures[0][2]


def test_an_unreadable_table_does_not_end_the_sweep(spark, tmp_path):
    path = tmp_path / "t"
    spark.range(10).write.parquet(str(path))
    damaged = spark.read.parquet(str(path))
    for f in path.glob("part-*"):
        f.write_bytes(b"no parquet")
    tables = {TableName("db", "s", "rota"): damaged, TableName("db", "s", "ok"): spark.range(3)}
    out = sweep(tables, DAY, lambda name, result: result.collect())
    assert len(out.results) == 1 and {n.table for n, _, _ in out.failures} == {"rota"}


def test_retention_and_pending(spark):
    rows = [("db", "s", "t", date(2024, 6, d)) for d in (1, 2, 3, 4, 4)]
    res = spark.createDataFrame(rows, "base_datos string, schema_name string, tabla string, fecha_ejecucion date")
    assert sorted(r[3].day for r in keep_newest_runs(res).collect()) == [2, 3, 4, 4]
    catalog = spark.createDataFrame([("db", "s", "t", 5), ("db", "s", "u", 5), ("db", "s", "v", 0)],
                                    "base_datos string, schema_name string, table_name string, row_count long")
    assert [r["table_name"] for r in not_done_today(catalog, res, "2024-06-04").collect()] == ["u"]


def test_run_log_is_closed_once(spark):
    log = spark.createDataFrame(
        [("p", "sp", datetime(2024, 6, 30, 10, 0, 59), None, None, None, None, None, None, None),
         ("p", "sp", datetime(2024, 6, 29), datetime(2024, 6, 29, 1), 7, 0, 0, 1, 1, True)],
        "Paquete string, Procedimiento string, FechaEjecucion timestamp_ntz, FechaFinEjecucion timestamp_ntz, Nuevos int, Actualizados int, "
        "Eliminados int, DuracionSeg int, DuracionMin int, Correcto boolean")
    a, b = close_run(log, "p", "sp", 5, "2024-06-30 10:01:01", True).orderBy(F.desc("FechaEjecucion")).collect()
    assert (a["Nuevos"], a["DuracionSeg"], a["DuracionMin"], a["Correcto"]) == (5, 2, 1, True) and b["Nuevos"] == 7
    failed = close_run(log, "p", "sp", 5, "2024-06-30 10:01:01", False).orderBy(F.desc("FechaEjecucion")).first()
    assert (failed["Nuevos"], failed["Correcto"]) == (None, False)


def test_tests_fit_their_flag_bits():
    assert len(quality.TESTS) < 31 and all(set(quality.tests_of(k)) <= set(quality.TESTS) for k in ("bigint", "double", "date", "decimal(18,2)"))


def test_quality_run_end_to_end(spark, store):
    from bodega.operators.catalog import CatalogEntry
    from bodega.plans.quality_run import ERRORS, RUNS, QualityRun

    broken = spark.range(3).select("id", F.raise_error(F.lit("bad column")).cast("string").alias("roto"))
    entries = [CatalogEntry("Gold", "dw", "Dimension", "Cliente", spark.range(3)), CatalogEntry("Gold", "dw", "Fact", "Mala", broken),
               CatalogEntry("Gold", "dw", "Fact", "Vacia", spark.range(0)), CatalogEntry("Gold", "dw", "Fact", "Uno_Archive", spark.range(3))]
    run = QualityRun(store)
    out = run.run(entries, datetime(2024, 6, 1, 8))
    assert sorted((r["tabla"], r["columna"]) for r in run.results().collect()) == [("Cliente", "id"), ("Mala", "id")]
    assert [(r["Tabla"], r["Columna"]) for r in store.read(ERRORS).collect()] == [("Mala", "roto")] and len(out.skipped) == 1
    row = store.read(RUNS).first()
    assert (row["Nuevos"], row["Correcto"], row["DuracionSeg"]) == (2, True, 0)
    assert run.run(entries[:1], datetime(2024, 6, 1, 9)).results == []  # done today
    for day in (2, 3, 4):
        run.run(entries[:1], datetime(2024, 6, day))
    assert sorted(r["fecha_ejecucion"].day for r in run.results().collect()) == [2, 3, 4]
    assert store.read(RUNS).filter("Correcto").count() == 5


@pytest.mark.parametrize("name", ["lineitem", "documents", "people", "pages", "customer", "conversations"])
def test_the_profile_of_texts_compiles(spark, tables, name):
    """Generated code that does not compile ends the query here instead of falling back."""
    from bodega.queries.base import REGISTRY

    spark.conf.set("spark.sql.codegen.fallback", "false")
    try:
        assert REGISTRY[f"dq_profile_{name}"].run(tables).count() > 0
    finally:
        spark.conf.unset("spark.sql.codegen.fallback")
