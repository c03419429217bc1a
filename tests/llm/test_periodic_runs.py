"""Runs of words against a search of every period of every text."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from bodega.llm import common, periodic_runs, queries
from tests.llm import cases

SMALL = "/root/testdata/sf0.001"


def brute_runs(words, min_length=6, min_exponent=4):
    """Every maximal stretch of every period; of equal stretches the smallest period."""
    n, seen, out = len(words), set(), []
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= 2 * q and (i, j + q) not in seen:
                seen.add((i, j + q))
                if j + q - i >= max(min_length, min_exponent * q):
                    out.append((i, j + q - i, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def check(documents, **limits):
    found, kept = periodic_runs.runs_of(documents, **limits)
    for words, runs, left in zip(documents, found, kept, strict=True):
        want = brute_runs(words, **limits)
        assert [(r["start"], r["length"], r["period"]) for r in runs] == want, words
        assert left == brute_collapsed(words, want)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=60), min_size=1, max_size=6), st.sampled_from([(6, 4), (2, 2), (3, 3)]))
def test_random_sequences(documents, limits):
    check(documents, min_length=limits[0], min_exponent=limits[1])


def test_planted_periods():
    rng = random.Random(3)
    documents = []
    for _ in range(300):
        part = [b"w%d" % rng.randrange(5) for _ in range(rng.randint(1, 12))]
        body = part * rng.randint(1, 9) + part[: rng.randrange(len(part) + 1)]
        documents.append([b"w%d" % rng.randrange(4) for _ in range(rng.randrange(20))] + body + [b"w%d" % rng.randrange(4) for _ in range(rng.randrange(20))])
    check(documents)
    check(documents, min_length=2, min_exponent=2)


def test_one_word_only_and_fibonacci_words():
    a, b = [b"a"], [b"a", b"b"]
    while len(b) < 600:
        a, b = b, b + a
    check([[b"x"] * 500, b, []], min_length=2, min_exponent=2)
    found, kept = periodic_runs.runs_of([[b"x"] * 300_000])
    assert found == [[{"start": 0, "length": 300_000, "period": 1}]] and kept == [[b"x"]]


def test_ranks_are_classes_of_doubled_prefixes():
    rng = np.random.default_rng(1)
    keys = np.append(rng.integers(0, 3, 200), 9)
    for k, level in enumerate(periodic_runs.ranks(keys)):
        parts = [tuple(keys[i:i + 2 ** k]) for i in range(len(keys))]
        assert level.tolist() == [sum(p < q for p in parts) for q in parts]


def test_awkward_rows(spark):
    rows = {}
    for r in periodic_runs.periodic_runs(cases.documents(spark)).collect():
        rows.setdefault(r.doc_id, []).append(r)
    assert sorted((i, len(t)) for i, t in rows.items() if i is not None) == sorted(
        {i: sum(j == i for j, _ in cases.rows()) for i, _ in cases.rows() if i is not None}.items())
    assert rows[0][0].runs == rows[1][0].runs == rows[2][0].runs == [] and rows[0][0].collapsed == rows[2][0].collapsed == ""
    assert rows[12][0].collapsed == "a b c\x1cd\xa0e"
    assert len(rows[None]) == 3 and len(rows[14]) == 2
    assert periodic_runs.periodic_runs(cases.empty(spark)).collect() == []


def contract(doc_id, text):
    """The query's row, from its definition."""
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(brute_collapsed(words, runs))).hexdigest())


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in common.table(spark, SMALL, "documents").collect()]
    docs = [(i, t) for i, t in docs if len((t or "").split()) < 3000]
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in queries.op11_suffix_runs(spark, SMALL).select(*COLUMNS).collect()}
    assert len(got) >= 200
    want = {i: contract(i, t) for i, t in docs}
    assert sum(w[1] > 0 for w in want.values()) >= 10
    assert {i: got[i] for i in want} == want


@pytest.mark.parametrize("doc_id", [None, 7, 36, 46])
def test_query_on_short_and_empty_texts(spark, doc_id):
    texts = [None, "", " \n", "one", "one two", "a b " * 40, "x " * 9]
    rows = queries.suffix_runs(spark.createDataFrame([(doc_id, t, 1) for t in texts], "doc_id long, text string, runs int")).select(*COLUMNS)
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, rows.collect()), key=key) == sorted((contract(doc_id, t) for t in texts), key=key)
