"""Stored tables and the loads over them: versions, statistics, reserved keys, held-back loads, what is read and written."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from bodega.operators.control import ControlTables, log_rows, purge_partitions, run_layer
from bodega.operators.joins import hot_values, resolve
from bodega.operators.keys import RESERVED, place_keys, reserve
from bodega.operators.snapshot import CHANGED, NEW, VANISHED, difference, digests
from bodega.plans import bank_gold, bank_silver
from bodega.plans.entity import load_changes, load_clean
from bodega.plans.quality_run import refresh_state
from bodega.plans.star import OPEN, is_open, load_dimension, load_fact, stored_open
from bodega.operators.quality import TableName, profile
from bodega.queries.flows import LINES, bank, bucketed_rows
from bodega.queries.raw import raw
from bodega.queries.warehouse import hot_lookup
from bodega.sources.store import Conflict, Store, Watch

NOW, LATER = datetime(2024, 6, 30), datetime(2024, 7, 31)


def ids(df):
    return sorted(r[0] for r in df.select("id").collect())


# --- store -------------------------------------------------------------------------------------------

def test_extremes_are_recorded_and_not_read(spark, store, monkeypatch):
    rows = spark.range(10).select("id", F.expr("date '2024-01-01' + cast(id as int)").alias("dia"), (F.col("id") + 1000).alias("otro"))
    watch = [Watch("id"), Watch("dia"), Watch("otro", 1000, 1004), Watch("otro", 5000)]
    store.append("t", rows, watch=watch)
    store.append("t", rows.filter("id < 3").withColumn("id", F.col("id") + 50), watch=watch)
    monkeypatch.setattr(Store, "read", lambda *a, **k: pytest.fail("the table was read"))
    found = store.extremes("t", watch)
    assert found == {"id": (0, 52), "dia": (date(2024, 1, 1), date(2024, 1, 10)), "otro in 1000..1004": (1001, 1004), "otro in 5000..None": (None, None)}
    assert store.rows("t") == 13 and not store.is_empty("t")
    assert [p.rows for p in store.newer_parts("t", {Watch("id"): 20})] == [3]
    assert len(store.newer_parts("t", {Watch("id"): None})) == 2 and store.newer_parts("t", {Watch("otro", 5000): None}) == []


def test_a_column_that_was_not_watched_is_read(spark, store):
    store.append("t", spark.range(5))
    store.append("t", spark.range(5, 9), watch=[Watch("id")])
    assert store.extremes("t", [Watch("id")]) == {"id": (0, 8)}
    assert store.extremes("none", [Watch("id")]) == {"id": (None, None)}


def test_two_writers_from_one_version(spark, store):
    store.append("t", spark.range(3), expect=0)
    with pytest.raises(Conflict):
        store.append("t", spark.range(3), expect=0)
    assert store.rows("t") == 3 and len(store._names(store.folder("t"))) == 2  # one batch and the versions
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: store.append("t", spark.range(i * 10, i * 10 + 2)), range(1, 5)))
    assert ids(store.read("t")) == [0, 1, 2, 10, 11, 20, 21, 30, 31, 40, 41]


def test_replaced_and_dropped_folders_are_removed_in_time(spark, store):
    store.replace("t", spark.range(3))
    opened = store.read("t")
    store.replace("t", spark.range(4))
    assert ids(opened) == [0, 1, 2]  # the version before is kept for its readers
    store.replace("t", spark.range(5))
    assert len([n for n in store._names(store.folder("t")) if n.startswith("_batch")]) == 2
    assert ids(store.read("t")) == [0, 1, 2, 3, 4]


def test_partitions_are_dropped_without_a_write(spark, store):
    rows = spark.range(12).select("id", F.expr("date '2024-01-01' + cast(id % 3 as int)").alias("dia"), F.when(F.col("id") % 4 > 0, "a=b/c").alias("texto"))
    store.append("t", rows, partition_by=("dia", "texto"))
    store.append("t", rows.withColumn("id", F.col("id") + 100))
    before = set(store._names(store.folder("t")))
    store.drop("t", lambda p: p.values["dia"] == "2024-01-02" or p.values["texto"] is None)
    assert set(store._names(store.folder("t"))) == before
    kept = store.read("t")
    assert kept.columns == ["id", "dia", "texto"] and {r.texto for r in kept.collect()} == {"a=b/c"}
    assert ids(kept) == [i + k for k in (0, 100) for i in range(12) if i % 3 != 1 and i % 4 > 0]


def test_small_parts_are_put_together(spark, store):
    for i in range(5):
        store.append("t", spark.range(i * 2, i * 2 + 2), watch=[Watch("id")])
    assert store.compact("t") == 5 and len(store.version("t").parts) == 1
    assert ids(store.read("t")) == list(range(10)) and store.extremes("t", [Watch("id")]) == {"id": (0, 9)} and store.rows("t") == 10
    assert store.compact("t") == 0


def test_an_append_to_very_many_parts_compacts(spark, store, monkeypatch):
    monkeypatch.setattr("bodega.sources.store.MANY_PARTS", 4)
    for i in range(8):
        log_rows(store, spark.createDataFrame([(i, datetime(2024, 1, 1 + i % 2))], "id long, FechaEjecucion timestamp_ntz"), "log")
    assert len(store.version("log").parts) <= 6 and ids(store.read("log")) == list(range(8))
    assert store.read("log").columns == ["id", "FechaEjecucion"]


def test_a_purge_writes_the_day_of_the_limit_alone(spark, store):
    rows = spark.range(40).select("id", F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, 12 * cast(id as int))").alias("FechaEjecucion"))
    log_rows(store, rows, "log")
    kept_paths = {p.path for p in store.version("log").parts if p.values["_day"] > "2024-01-10"}
    assert purge_partitions(store, "log", datetime(2024, 1, 20, 12), 10) == 1  # 10 January: noon stays, midnight goes
    assert ids(store.read("log")) == list(range(19, 40))
    assert kept_paths <= {p.path for p in store.version("log").parts}


# --- keys --------------------------------------------------------------------------------------------

def test_reserved_ranges_do_not_overlap(spark, store):
    with ThreadPoolExecutor(4) as pool:
        starts = sorted(pool.map(lambda _: reserve(store, "Fact.X", 10, NOW), range(6)))
    assert starts == [0, 10, 20, 30, 40, 50]
    assert reserve(store, "Fact.Y", 5, NOW, lambda: 700) == 700 and reserve(store, "Fact.Y", 1, NOW) == 705
    assert {(r.TablaDestino, r.Desde, r.Hasta) for r in store.read(RESERVED).collect()} >= {("Fact.X", 1, 10), ("Fact.X", 51, 60), ("Fact.Y", 701, 705), ("Fact.Y", 706, 706)}


def test_keys_by_place_are_dense_and_need_no_exchange(spark, store):
    store.append("t", spark.range(0, 1000, 1, 7))
    store.append("t", spark.range(1000, 1500, 1, 3))
    placed = place_keys(store.read("t", positions=True), "clave", lambda n: 100)
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Sort" not in plan and "Window" not in plan
    rows = placed.collect()
    assert sorted(r.clave for r in rows) == list(range(101, 1601)) and placed.columns == ["id", "clave"]
    assert [r.id for r in sorted(rows, key=lambda r: r.clave)] == list(range(1500))
    assert sorted(map(tuple, placed.collect())) == sorted(map(tuple, rows))


def test_a_second_load_does_not_read_its_fact(spark, tables, tmp_path, monkeypatch):
    f, silver, gold = bank(tables), Store(spark, str(tmp_path / "s")), Store(spark, str(tmp_path / "g"))
    load, fact = bank_silver.LOADS["Movimiento_Staging"], bank_gold.FACTS["Fact.Movimiento"]
    half = tables.events.count() // 2

    def lower(name):
        return raw(tables)(name).filter(F.col("MovimientoCuentaID") <= half)

    assert load_clean(load, lower, silver, NOW) == half == load_fact(fact, silver, gold, NOW, dims=f.dims)
    assert load_clean(load, raw(tables), silver, NOW) == tables.events.count() - half
    read, seen = Store.read, []
    monkeypatch.setattr(Store, "read", lambda self, table, *a, **k: seen.append(table) or read(self, table, *a, **k))
    assert load_fact(fact, silver, gold, NOW, dims=f.dims) == tables.events.count() - half
    assert "Fact.Movimiento" not in seen and "Movimiento_Staging" in seen
    monkeypatch.undo()
    keys = gold.read("Fact.Movimiento").select(F.count_distinct("`Movimiento Key`"), F.min("`Movimiento Key`"), F.max("`Movimiento Key`")).first()
    assert tuple(keys) == (tables.events.count(), 1, tables.events.count())
    assert load_fact(fact, silver, gold, NOW, dims=f.dims) == 0


# --- dimensions --------------------------------------------------------------------------------------

def test_a_merge_writes_open_versions_only(spark, tables, tmp_path):
    gold, d = Store(spark, str(tmp_path / "g")), bank_gold.DIMENSIONS["Dimension.Cliente"]
    staging = bank(tables).silver("Cliente_Staging").cache()
    n = staging.count()
    assert load_dimension(d, lambda _: staging, gold, NOW) == n
    changed = staging.withColumn("Segmento", F.when(F.col("`WWI Cliente ID`") <= 3, "OTRO").otherwise(F.col("Segmento")))
    assert load_dimension(d, lambda _: changed, gold, LATER) == 3
    closed = {p.path for p in gold.version(d.target).parts if not is_open(p)}
    again = changed.withColumn("Segmento", F.when(F.col("`WWI Cliente ID`") == 9, "NUEVO").otherwise(F.col("Segmento")))
    assert load_dimension(d, lambda _: again, gold, datetime(2024, 8, 31)) == 1
    parts = gold.version(d.target).parts
    assert closed < {p.path for p in parts if not is_open(p)}  # closed versions stay where they are
    assert OPEN not in gold.read(d.target).columns and gold.read(d.target).count() == n + 4
    assert stored_open(gold, d.target).count() == n
    key = gold.read(d.target).select(F.count_distinct("`Cliente Key`"), F.max("`Cliente Key`")).first()
    assert tuple(key) == (n + 4, n + 4)
    staging.unpersist()


def test_difference_by_digest(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", "x"), (3, "c", "y"), (4, None, "z")], "id long, u string, v string")
    new = spark.createDataFrame([(1, "a", None), (2, "b", "X"), (4, "z", None), (5, "e", "w")], "id long, u string, v string")
    assert sorted(map(tuple, difference(new, digests(old, ["id"]), ["id"]).collect())) == [(2, CHANGED), (3, VANISHED), (4, CHANGED), (5, NEW)]
    assert difference(old, digests(old, ["id"]), ["id"]).collect() == []
    assert difference(old.withColumn("v", F.lit("other")), digests(old, ["id"], ["v"]), ["id"], ["v"]).collect() == []


def test_unchanged_sources_stage_nothing(spark, tables, tmp_path):
    silver, load = Store(spark, str(tmp_path / "s")), bank_silver.LOADS["Centro_Staging"]
    assert load_changes(load, raw(tables), silver, NOW) == tables.supplier.count()
    assert load_changes(load, raw(tables), silver, LATER) == 0

    def fewer(name):
        rows = raw(tables)(name)
        return rows.filter("SucursalID > 2") if name == "Organizacion.Sucursales" else rows

    assert load_changes(load, fewer, silver, LATER) == 2
    assert load_changes(load, fewer, silver, LATER) == 0
    assert load_changes(load, raw(tables), silver, datetime(2024, 8, 31)) == 2  # they are back


# --- runner ------------------------------------------------------------------------------------------

def test_loads_follow_what_they_need(store):
    done = []

    def job(name, fails=False):
        def run():
            done.append(name)
            if fails:
                raise RuntimeError("no")
            return 1
        return run

    loads = {"f1": job("f1"), "f2": job("f2"), "f3": job("f3"), "a": job("a"), "b": job("b", True), "c": job("c")}
    needs = {"f1": {"a", "c"}, "f2": {"b"}, "f3": {"f2", "elsewhere"}, "c": {"a"}}
    result = run_layer(loads, ControlTables(store), NOW, parallel=3, needs=needs)
    assert done.index("a") < done.index("c") < done.index("f1") and "f2" not in done and "f3" not in done
    assert (result.ok, result.errors) == (3, 3) and result.messages["f3"] == "held back: f2 failed"
    assert run_layer(loads, ControlTables(store), NOW, only="f1", needs=needs).rows == {"f1": 1}


# --- lookups -----------------------------------------------------------------------------------------

def test_hot_and_missing_values_are_dealt_out(spark, tables):
    """One value and no value hold a third of the rows each: no task of the join has more than four times the median."""
    dim, facts = hot_lookup(tables)
    hot = hot_values(facts, ["s"], tasks=32)["s"]
    assert hot[1] >= 10 and all(n <= 3 for v, n in hot.items() if v != 1)
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        for k, v in zip(before, ("-1", "false", "16"), strict=True):
            spark.conf.set(k, v)
        joined = resolve(facts, dim, {"s": "s_suppkey"}, {"k": "Proveedor Key"}, identity=("l_orderkey", "l_linenumber"), hot=hot)
        sizes = sorted(r[1] for r in joined.groupBy(F.spark_partition_id()).count().collect())
        assert len(sizes) == 16 and sizes[-1] <= 4 * sizes[len(sizes) // 2]
        assert joined.count() == facts.count() and joined.filter("s = 1 and k = 0").count() == 0
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_headers_and_lines_in_buckets_meet_without_an_exchange(spark, tables):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for target, keys in LINES.values():
            plan = bucketed_rows(tables, target, keys)._jdf.queryExecution().executedPlan().toString()
            ident = next(iter(keys.values()))
            assert f"hashpartitioning({ident}#" not in plan, plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


# --- profile -----------------------------------------------------------------------------------------

def test_merged_states_are_the_profile_of_the_whole(spark, tables, tmp_path):
    data, states = Store(spark, str(tmp_path / "d")), Store(spark, str(tmp_path / "e"))
    rows = tables.orders.withColumn("vacio", F.lit(None).cast("string")).withColumn("lista", F.array("o_orderkey"))
    for part in (rows.filter("o_orderkey % 3 = 0"), rows.filter("o_orderkey % 3 > 0")):
        data.append("pedidos", part)
        state = refresh_state(data, "pedidos", states)
    name = TableName("a", "b", "pedidos")
    show = lambda df: sorted(map(str, df.collect()))
    assert show(profile(data.read("pedidos"), name, "2024-06-30", state)) == show(profile(rows, name, "2024-06-30"))
    seen = []
    original = Store.read
    try:
        Store.read = lambda self, table, *a, **k: seen.append(table) or original(self, table, *a, **k)
        refresh_state(data, "pedidos", states)
    finally:
        Store.read = original
    assert "pedidos" not in seen  # nothing is new
    data.replace("pedidos", rows.limit(10))
    assert refresh_state(data, "pedidos", states).agg(F.sum("veces")).first()[0] == 10 * len(rows.columns)
