import random
import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from bodega.llm import exact_dedup, line_dedup, sharding, simhash
from tests.llm import cases

BLANK = re.compile(r"[\x20\x09-\x0D]")


def key(i):
    return (i is None, i or 0)


# --- exact -------------------------------------------------------------------------------------------

def brute_exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[BLANK.sub("", t or "")].append((i, len(t or "")))
    out = []
    for body, members in groups.items():
        best = min(members, key=lambda m: (-m[1], key(m[0])))
        sha = hashlib.sha256(body.encode()).hexdigest()
        out += [(key(i), key(best[0]), len(members), sha) for i, _ in members]
    return sorted(out)


@pytest.mark.parametrize("size", [4096, 1000])
def test_exact_dedup_equals_brute_force(spark, size):
    got = exact_dedup.exact_dedup(cases.documents(spark), size).collect()
    assert sorted((key(r.doc_id), key(r.keep_id), r.group_size, r.text_sha256) for r in got) == brute_exact(cases.rows())
    assert sum(r.kept for r in got) == len({r.text_sha256 for r in got})
    assert all(r.keep_id == r.doc_id for r in got if r.kept)


def test_a_shared_digest_does_not_merge_texts(spark, monkeypatch):
    """Names come from contents: with a digest that says nothing, the result is the same."""
    monkeypatch.setattr(exact_dedup, "digest", lambda block: [F.lit(0).cast("long").alias("h1"), (F.length(block) % 3).cast("long").alias("h2")])
    rows = [(i, t) for i, t in cases.rows() if len(t or "") < 2000]
    got = exact_dedup.exact_dedup(cases.documents(spark, rows), 64).collect()
    assert sorted((key(r.doc_id), key(r.keep_id), r.group_size, r.text_sha256) for r in got) == brute_exact(rows)


def test_exact_dedup_of_nothing(spark):
    assert exact_dedup.exact_dedup(cases.empty(spark)).collect() == []


# --- lines -------------------------------------------------------------------------------------------

def brute_lines(rows):
    strip = " \t\n\x0b\x0c\r"
    lower = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    holders = defaultdict(set)
    no_id = line_dedup.NO_ID

    def keys(t):
        return [line.strip(strip).translate(lower) for line in (t or "").split("\n")]

    for i, t in rows:
        for k in keys(t):
            if len(k) >= 20:
                holders[k].add(no_id if i is None else i)
    out = []
    for i, t in rows:
        lines, own = (t or "").split("\n"), no_id if i is None else i
        kept = [x for x, k in zip(lines, keys(t)) if not (len(k) >= 20 and len(holders[k]) >= 3 and max(holders[k]) != own)]
        out.append((key(i), len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out)


def lines_of(df):
    return sorted((key(r.doc_id), r.n_lines, r.n_dropped, r.kept_sha256) for r in df.collect())


def test_line_dedup_equals_brute_force(spark):
    docs = cases.documents(spark)
    cleaned = line_dedup.clean(docs, line_dedup.LineIndex.build(docs))
    assert lines_of(cleaned) == brute_lines(cases.rows())
    assert cleaned.columns == [*docs.columns, "n_lines", "n_dropped", "kept_sha256"]
    assert cleaned.filter("text is null").count() == docs.filter("text is null").count()


def test_line_dedup_of_columns_with_its_own_names(spark):
    docs = cases.documents(spark).withColumn("n_lines", F.lit("own")).withColumn("kept_sha256", F.lit(5)).withColumn("n_dropped", F.lit(None).cast("date"))
    index = line_dedup.LineIndex.build(docs)
    assert lines_of(line_dedup.clean(docs, index)) == brute_lines(cases.rows())
    kept = line_dedup.clean(docs, index, counts=False)
    assert kept.schema.simpleString() == docs.schema.simpleString()
    assert kept.select("n_lines", "kept_sha256", "n_dropped").distinct().collect() == [("own", 5, None)]
    plain = line_dedup.clean(docs.select("doc_id", "text"), index)
    assert sorted(map(str, kept.select("doc_id", "text").collect())) == sorted(map(str, plain.select("doc_id", "text").collect()))


def test_insertions_and_deletions_are_reversible(spark):
    """After adding and removing documents the index says what a fresh one of the rest says."""
    rows = cases.rows()
    some, more = rows[:10], rows[10:]
    index = line_dedup.LineIndex.build(cases.documents(spark, some), shards=3)
    index = index.insert(cases.documents(spark, more))
    assert lines_of(line_dedup.clean(cases.documents(spark), index)) == brute_lines(rows)
    gone = spark.createDataFrame([(11,), (None,)], "doc_id long")
    index = index.delete(gone)
    left = [(i, t) for i, t in rows if i not in (11, None)]
    docs = cases.documents(spark, left)
    assert lines_of(line_dedup.clean(docs, index)) == brute_lines(left)
    back = index.insert(cases.documents(spark, [(i, t) for i, t in rows if i in (11, None)]))
    assert lines_of(line_dedup.clean(cases.documents(spark), back)) == brute_lines(rows)
    fresh = line_dedup.LineIndex.build(cases.documents(spark), shards=3)
    assert sorted(map(tuple, back.counts.collect())) == sorted(map(tuple, fresh.counts.collect()))


def test_filters_pass_every_repeated_key_and_few_others(spark, monkeypatch):
    docs = cases.documents(spark)
    index = line_dedup.LineIndex.build(docs, shards=4)
    monkeypatch.setattr(line_dedup, "ROUND_BYTES", 1)  # a round per shard
    passed = index.candidates().select("h1", "h2").distinct()
    assert index.repeated().join(passed, ["h1", "h2"], "left_anti").count() == 0


def test_line_dedup_of_nothing(spark):
    docs = cases.empty(spark)
    assert line_dedup.clean(docs, line_dedup.LineIndex.build(docs)).collect() == []


def test_cuckoo_filter_adds_tests_and_removes():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 1 << 63, (2, 20_000)).astype(np.uint64)
    made = line_dedup.CuckooFilter.for_keys(20_000)
    assert made.add(h[0], h[1]) and made.test(h[0], h[1]).all()
    other = rng.integers(0, 1 << 63, (2, 20_000)).astype(np.uint64)
    assert made.test(other[0], other[1]).mean() < 0.001
    made.remove(h[0][:10_000], h[1][:10_000])
    assert made.test(h[0][10_000:], h[1][10_000:]).all() and made.test(h[0][:10_000], h[1][:10_000]).mean() < 0.01
    copy = line_dedup.CuckooFilter.from_bytes(made.to_bytes())
    assert (copy.table == made.table).all()
    full = line_dedup.CuckooFilter.for_keys(8)
    assert not full.add(h[0][:100], h[1][:100])


# --- SimHash -----------------------------------------------------------------------------------------

def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[k:k + 3]) for k in range(len(words) - 2)] if len(words) >= 3 else [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, distance=3):
    distinct = sorted(set(prints))
    parent = {f: f for f in distinct}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for a in distinct:
        for b in distinct:
            if a < b and (a ^ b).bit_count() <= distance:
                parent[root(a)] = root(b)
    return {f: root(f) for f in distinct}


@pytest.mark.parametrize("partitions", [2, 3, 4])
def test_near_duplicates_equal_brute_force(spark, partitions):
    rows = cases.rows()
    prints = [brute_print(t) for _, t in rows]
    roots = brute_components(prints)
    first = {}
    for (i, _), f in zip(rows, prints):
        if i is not None:
            first[roots[f]] = min(first.get(roots[f], i), i)
    got = simhash.near_duplicates(cases.documents(spark), partitions=partitions).collect()
    want = sorted((key(i), f"{f:016x}", key(first.get(roots[f]))) for (i, _), f in zip(rows, prints))
    assert sorted((key(r.doc_id), r.fingerprint, key(r.component_id)) for r in got) == want


def test_links_in_clustered_fingerprints(spark):
    """Chains, clusters that share half of their bits, and the sign bit: every link is found, none is invented."""
    rng = np.random.default_rng(2)
    centres = rng.integers(0, 1 << 64, 30, dtype=np.uint64)
    prints = set(map(int, centres))
    for c in centres:
        x = int(c)
        for _ in range(25):
            for b in rng.choice(64, rng.integers(1, 4), replace=False):
                x ^= 1 << int(b)
            prints.add(x)
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in prints]
    df = spark.createDataFrame(signed, "fp long")
    found = {(r.a, r.b) for r in simhash.links(df).collect()}
    want = {(a, b) for (a,) in signed for (b,) in signed if a < b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 3}
    assert found == want
    labels = {r.vertex: r.label for r in simhash.components(simhash.links(df)).collect()}
    roots = brute_components([x[0] & ((1 << 64) - 1) for x in signed])
    groups = defaultdict(set)
    for (x,) in signed:
        groups[roots[x & ((1 << 64) - 1)]].add(x)
    assert labels == {x: min(g) for g in groups.values() for x in g if len(g) > 1}


def test_thresholds_keep_the_pigeonhole_sum():
    sample = np.random.default_rng(3).integers(0, 1 << 64, 500, dtype=np.uint64)
    for partitions in (1, 2, 3, 4):
        groups = simhash.group_bits(sample, partitions)
        assert sorted(b for g in groups for b in g) == list(range(64))
        for distance in (0, 3, 5):
            chosen = simhash.allocate(sample, groups, distance, 10**6)
            assert sum(t + 1 for t in chosen) == distance + 1 and min(chosen) >= -1


def test_one_document_of_each_group_stays(spark):
    rows = cases.rows()
    docs = cases.documents(spark)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    got = [r.doc_id for r in kept.collect()]
    roots = brute_components([brute_print(t) for _, t in rows])
    groups = defaultdict(list)
    for i, t in rows:
        groups[roots[brute_print(t)]].append(i)
    want = [min((i for i in g if i is not None), default=None) for g in groups.values()]
    assert sorted(map(key, got)) == sorted(map(key, want))


def test_simhash_of_nothing(spark):
    assert simhash.near_duplicates(cases.empty(spark)).collect() == [] == simhash.keep_one(cases.empty(spark)).collect()


# --- sharding ----------------------------------------------------------------------------------------

def test_shards_hold_near_equal_bytes_and_gapless_places(spark):
    import zlib

    rows = cases.rows()
    small = [(i, t) for i, t in rows if len(t or "") < 2000]
    got = sharding.shard_documents(cases.documents(spark, small), 4).collect()
    assert sorted((key(r.doc_id), r["size"], r.text_crc32) for r in got) == sorted(
        (key(i), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in small)
    load, places = defaultdict(int), defaultdict(list)
    for r in got:
        load[r.shard] += r["size"]
        places[r.shard].append(r.slot)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert max(load.values()) - min(load.values()) <= max(r["size"] for r in got)


def test_rows_repeated_whole_do_not_make_a_shard_heavy(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, "x" * rng.randint(1, 400)) for i in range(2000)] + [(7, "y" * 400)] * 1000 + [(None, None)] * 500
    path = str(tmp_path / "map")
    got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), 24, path).collect()
    load, places = defaultdict(int), defaultdict(list)
    for r in got:
        load[r.shard] += r["size"]
        places[r.shard].append(r.slot)
    assert len(got) == len(rows) and len(load) == 24
    assert max(load.values()) - min(load.values()) <= 408
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    one, two = ({r.virtual_slot: r.shard for r in sharding.load_map(spark, path, v).collect()} for v in (1, 2))
    assert set(one) == set(two) == set(range(sharding.SLOTS)) and all(s == v % 24 for v, s in one.items())
    assert all(two[r.virtual_slot] == r.shard for r in got)


def test_map_versions_are_kept_and_growth_moves_whole_slots(spark, tmp_path):
    rng = np.random.default_rng(4)
    weights = {v: int(rng.integers(1, 1000)) for v in range(500)}
    one = sharding.first_map(weights, 8, 512)
    two = sharding.rebalance(one, weights, 9)
    load = defaultdict(int)
    for v, s in two.items():
        load[s] += weights.get(v, 0)
    assert set(one) == set(two) == set(range(512)) and len(load) == 9
    assert max(load.values()) - min(load.values()) <= 0.02 * sum(load.values()) / 9
    assert sharding.rebalance(two, weights, 9) == two
    moved = [v for v in one if one[v] != two[v]]
    assert sum(weights.get(v, 0) for v in moved) <= 1.2 * sum(weights.values()) / 9
    path = str(tmp_path / "map")
    sharding.save_map(spark, path, 1, one, weights)
    sharding.save_map(spark, path, 2, two, weights)
    assert {r.virtual_slot: r.shard for r in sharding.load_map(spark, path, 1).collect()} == one
    assert {r.virtual_slot: r.shard for r in sharding.load_map(spark, path, 2).collect()} == two


def test_sharding_of_nothing(spark):
    assert sharding.shard_documents(cases.empty(spark), 3).collect() == []
