from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from bodega.operators import audit, incremental, keys
from bodega.operators.control import ControlTables, run_layer
from bodega.operators.facts import daily_balance
from bodega.operators.joins import bridge, differs, pairs_in_use, key_per_value, latest_per_key, resolve
from bodega.operators.sampling import sample_rows
from bodega.operators.scd import as_of, first_versions, merge_versions, missing_members, newest, open_versions
from bodega.sources.relations import inline_rows, missing_rows

DAY1, DAY2, DAY3 = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


# --- keys --------------------------------------------------------------------------------------------

def test_keys_are_dense_unique_and_repeatable(spark):
    df = spark.range(5000).select((F.col("id") * 7).alias("id"))
    once = keys.number_rows(df, "k", ["id"], start=10, buckets=13)
    again = keys.number_rows(df.repartition(7), "k", ["id"], start=10, buckets=13)
    got = rows(once, "id")
    assert sorted(r[1] for r in got) == list(range(11, 5011))
    assert got == rows(again, "id")


def test_keys_with_text_order_and_a_hot_value(spark):
    df = spark.range(3000).select(F.when(F.col("id") < 1000, "hot").otherwise(F.col("id").cast("string")).alias("v"), "id")
    got = keys.number_rows(df, "k", ["v", "id"], buckets=17).select("k").collect()
    assert sorted(r[0] for r in got) == list(range(1, 3001))


def test_null_order_values_are_numbered(spark):
    df = spark.createDataFrame([(None,), (1,), (2,)], "id int")
    assert sorted(r[0] for r in keys.number_rows(df, "k", ["id"]).select("k").collect()) == [1, 2, 3]


# --- watermarks --------------------------------------------------------------------------------------

def test_id_ranges_have_their_own_watermarks(spark):
    ranges = incremental.id_ranges(loan=0, mortgage=10_000)
    target = spark.createDataFrame([(5,), (10_003,)], "id int")
    marks = incremental.range_high_water(target, "id", ranges)
    assert marks == {"loan": 5, "mortgage": 3}
    source = spark.createDataFrame([(4,), (6,), (10_003,), (10_004,)], "id int")
    assert rows(incremental.newer_in_ranges(source, "id", ranges, marks), "id") == [(6,), (10_004,)]
    assert incremental.range_high_water(None, "id", ranges) == {"loan": None, "mortgage": None}


def test_first_load_takes_key_zero(spark):
    df = spark.range(3)
    assert incremental.newer(df, "id", incremental.high_water(None, "id")).count() == 3
    assert incremental.newer(df, "id", incremental.high_water(df.limit(0), "id")).count() == 3
    assert incremental.newer(df, "id", 0).count() == 2


def test_union_of_subtypes_aligns_and_shifts(spark):
    ranges = incremental.id_ranges(a=0, b=100)
    got = incremental.union_subtypes({"a": spark.createDataFrame([(1, "x")], "id int, t string"), "b": spark.createDataFrame([(1,)], "id int")}, "id", ranges)
    assert rows(got, "id") == [(1, "x"), (101, None)]


# --- joins -------------------------------------------------------------------------------------------

def test_lookup_keeps_every_fact_once_and_defaults_to_zero(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "a")], "id int, v string")
    dim = spark.createDataFrame([(9, "a"), (7, "a"), (5, None)], "k int, n string")
    assert rows(resolve(facts, dim, {"v": "n"}, {"key": "k"}), "id") == [(1, "a", 7), (2, "b", 0), (3, None, 0), (4, "a", 7)]


def test_two_keys_come_from_the_same_row(spark):
    dim = spark.createDataFrame([("x", 2, 20), ("x", 1, 10)], "n string, k int, c int")
    assert rows(key_per_value(dim, "n", ["k", "c"])) == [("x", 1, 10)]


def test_bridge_takes_the_smallest_key_per_contract(spark):
    credits = spark.createDataFrame([("c1", 1), ("c1", 2), ("c2", 9)], "contract string, client int")
    dim = spark.createDataFrame([(30, 1), (20, 2)], "k int, id int")
    assert rows(bridge(credits, dim, {"client": "id"}, "contract", "k")) == [("c1", 20)]


def test_pairs_in_use_are_those_that_occur(spark):
    a, b = spark.range(11).withColumnRenamed("id", "a"), spark.range(4).withColumnRenamed("id", "b")
    uses = spark.createDataFrame([(1, 2), (1, 2), (1, 3), (9, 0), (9, 7), (None, 1)], "a long, b long")
    assert rows(pairs_in_use(uses, a, "a", b, "b"), "a", "b") == [(1, 2), (1, 3), (9, 0)]


def test_change_rules_for_null(spark):
    df = spark.createDataFrame([(None, "x"), ("x", None), ("x", "y"), (None, None), (None, "")], "a string, b string")
    old, new = {"c": F.col("a")}, {"c": F.col("b")}
    got = df.select(differs(old, new, {}), differs(old, new, {"c": ""}), differs(old, new, {}, null_safe=True)).collect()
    assert [tuple(r) for r in got] == [(False, True, True), (False, True, True), (True, True, True), (False, False, False), (False, False, True)]


def test_latest_per_key_is_deterministic_on_ties(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 4, "c"), (2, 1, "d")], "k int, t int, v string")
    first = rows(latest_per_key(df, ["k"], [F.col("t").desc()]), "k")
    assert first == rows(latest_per_key(df.repartition(3), ["k"], [F.col("t").desc()]), "k") and len(first) == 2


# --- dimensions --------------------------------------------------------------------------------------

def two_days(spark):
    one = spark.createDataFrame([(1, "A", 1), (2, "B", None), (3, None, 5)], "id int, name string, n int")
    two = spark.createDataFrame([(1, "Z", 1), (2, "B", 0), (3, None, 6), (4, "N", 1)], "id int, name string, n int")
    dim = first_versions(one, "key", ["id"], DAY1, buckets=3)
    return dim, two


def test_type_two_merge(spark):
    dim, two = two_days(spark)
    after = merge_versions(dim, two, "key", ["id"], {"n": 0}, DAY2, buckets=3)
    open_rows = {r["id"]: r for r in open_versions(after).collect()}
    assert sorted(open_rows) == [1, 2, 3, 4]
    assert open_rows[1]["name"] == "A"  # an untracked change is ignored
    assert open_rows[2]["key"] == {r["id"]: r["key"] for r in dim.collect()}[2]  # NULL counts as 0
    assert (open_rows[3]["n"], open_rows[3]["key"] > 3, open_rows[4]["key"] > 3) == (6, True, True)
    closed = [r for r in after.collect() if r["id"] == 3 and r["n"] == 5][0]
    assert closed["Valid To"] == datetime(2024, 2, 1) == open_rows[3]["Valid From"]


def test_merge_invariants_over_three_days(spark):
    dim, two = two_days(spark)
    three = two.withColumn("n", F.col("n") + 1)
    after = merge_versions(merge_versions(dim, two, "key", ["id"], {"n": 0}, DAY2), three, "key", ["id"], {"n": 0}, DAY3).collect()
    assert len({r["key"] for r in after}) == len(after)
    for ident in {r["id"] for r in after}:
        spans = sorted((r["Valid From"], r["Valid To"]) for r in after if r["id"] == ident)
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
        assert spans[-1][1].year == 9999


def test_same_snapshot_again_changes_nothing(spark):
    dim, two = two_days(spark)
    after = merge_versions(dim, two, "key", ["id"], {"n": 0, "name": None}, DAY2)
    assert sorted(rows(after)) == sorted(rows(merge_versions(after, two, "key", ["id"], {"n": 0, "name": None}, DAY3)))


def test_as_of_is_half_open(spark):
    dim, two = two_days(spark)
    after = merge_versions(dim, two, "key", ["id"], {"n": 0}, DAY2)
    assert {(r["id"], r["n"]) for r in as_of(after, DAY2).collect()} == {(1, 1), (2, None), (3, 6), (4, 1)}
    assert {(r["id"], r["n"]) for r in as_of(after, "2024-01-31 23:59:59").collect()} == {(1, 1), (2, None), (3, 5)}


def test_insert_only_dimension(spark):
    dim, two = two_days(spark)
    added = missing_members(dim, two, "key", ["id"], DAY2)
    assert [(r["id"], r["key"]) for r in added.collect()] == [(4, 4)]
    assert missing_members(dim.unionByName(added), two, "key", ["id"], DAY3).count() == 0


def test_newest_staging_row(spark):
    stg = spark.createDataFrame([(1, "old", date(2024, 1, 1)), (1, "new", date(2024, 2, 1))], "id int, v string, `Valid From` date")
    assert [r["v"] for r in newest(stg, ["id"], ["Valid From"]).collect()] == ["new"]


# --- facts, audits, sampling --------------------------------------------------------------------------

def test_daily_balance(spark):
    moves = spark.createDataFrame([(1, "a", date(2024, 1, 1), 10.0, 110.0), (2, "a", date(2024, 1, 1), -4.0, 106.0), (3, "a", date(2024, 1, 1), 0.0, 106.0)],
                                  "id int, acc string, d date, m double, s double").withColumns(
        {c: F.col(c).cast("decimal(18,2)") for c in ("m", "s")})
    row = daily_balance(moves, "acc", "d", "m", "s").first()
    assert [str(v) for v in row[2:]] == ["106.00", "110.00", "106.00", "110.00", "107.33", "3", "10.00", "4.00"]
    row = daily_balance(moves, "acc", "d", "m", "s", ident="id").first()
    assert (str(row["Saldo Apertura"]), str(row["Saldo Cierre"])) == ("110.00", "106.00")


def test_constraint_audit(spark):
    df = spark.createDataFrame([(1, "A", None), (1, "b", 2), (2, None, None), (3, "C", 9)], "id int, kind string, parent int")
    got = {r["objeto"]: (r["filas"], r["incumplen"]) for r in audit.audit([
        audit.not_null(df, "kind"), audit.unique(df, ["id"]), audit.foreign_key(df, "parent", spark.createDataFrame([(2,)], "pk int"), "pk"),
        audit.check(df, audit.among("kind", ["a", "B"]), "lista"), audit.check(df, audit.exactly_one_of(["kind", "parent"]), "uno"),
    ]).collect()}
    assert got == {"kind": (4, 1), "id": (4, 1), "parent": (4, 1), "lista": (4, 1), "uno": (4, 3)}


def test_sample_is_repeatable_and_whole_by_default(spark):
    df = spark.range(50_000)
    assert sample_rows(df, ["id"]).count() == 50_000
    a, b = (sorted(r[0] for r in sample_rows(d, ["id"], 0.25).collect()) for d in (df, df.repartition(7)))
    assert a == b and abs(len(a) - 12_500) < 600


def test_seeding_twice_adds_nothing(spark):
    seed = inline_rows(spark, "code string, name string", [("a", "A"), ("b", "B")])
    held = missing_rows(seed, seed.limit(0), "code")
    assert held.count() == 2 and missing_rows(seed, held, "code").count() == 0


# --- store, control, layer runner ---------------------------------------------------------------------

def test_store_versions_and_counts(spark, store):
    df = spark.range(5)
    assert not store.exists("t x") and store.is_empty("t x")
    assert store.append("t x", df) == 5 and store.append("t x", df.select((F.col("id") + 5).alias("id"))) == 5
    assert store.read("t x").count() == 10
    assert store.replace("t x", store.read("t x").filter("id < 3")) == 3  # reads the version it replaces
    assert store.read("t x").count() == 3
    assert store.append("t x", df.limit(0)) == 0
    with pytest.raises(LookupError):
        store.read("missing")


def test_layer_runner_isolates_failures_and_logs(spark, store):
    control, now = ControlTables(store), datetime(2024, 6, 30)

    def broken():
        raise RuntimeError("no source")

    result = run_layer({"a": lambda: 3, "b": broken, "c": lambda: 0}, control, now, parallel=2)
    assert (result.ok, result.errors, result.rows) == (2, 1, {"a": 3, "c": 0})
    log = {r["TablaDestino"]: (r["Estado"], r["RegistrosCargados"], r["MensajeError"]) for r in control.log().collect()}
    assert log == {"a": ("Exitoso", 3, None), "b": ("Error", 0, "no source"), "c": ("Exitoso", 0, None)}
    assert sorted(r[0] for r in control.control().collect()) == ["a", "c"]
    assert run_layer({"a": lambda: 1, "b": broken}, control, now, only="a").errors == 0
    status = control.status({"t": spark.range(4)})
    assert rows(status["rows"]) == [("t", 4)] and status["runs"].count() == 4
    assert control.purge_log(datetime(2024, 12, 1)) == 0 and control.log().count() == 0


def test_control_watermark_defaults_and_advances(spark, store):
    control = ControlTables(store)
    assert control.watermark("x") == datetime(1900, 1, 1)
    control.advance("x", datetime(2024, 1, 2), datetime(2024, 6, 30))
    control.advance("x", datetime(2024, 1, 5), datetime(2024, 6, 30))
    control.advance("y", None, datetime(2024, 6, 30))
    assert (control.watermark("x"), control.watermark("y")) == (datetime(2024, 1, 5), datetime(2024, 6, 30))
    assert control.control().count() == 2


@pytest.mark.parametrize("spread", [1, 5])
def test_lookup_is_the_same_however_it_is_spread(spark, spread):
    facts = spark.range(900).select("id", F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, F.lit(7)).otherwise(F.col("id")).alias("v"))
    dim = spark.range(0, 900, 2).select(F.col("id").alias("n"), (F.col("id") + 1000).alias("k")).unionByName(spark.createDataFrame([(7, 1)], "n long, k long"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = resolve(facts, dim, {"v": "n"}, {"key": "k"}, spread=spread)
        assert "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()
        got = {r["id"]: r["key"] for r in joined.collect()}
        # rows without a value do not share one partition
        empty = joined.filter(F.col("v").isNull()).select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {i: 0 if i % 3 == 0 else 1 if i % 3 == 1 else (i + 1000 if i % 2 == 0 else 0) for i in range(900)}
    assert empty == 4
