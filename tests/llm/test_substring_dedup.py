"""Substring dedup against every window of every text."""

from __future__ import annotations

import hashlib
import random

import pytest

from bodega.llm import common, queries, substring_dedup
from tests.llm import cases

SMALL = "/root/testdata/sf0.001"


def brute(rows, window):
    """Per row (doc_id, n_words, n_removed, kept words), from the definition."""
    order = lambda i: float("inf") if i is None else i
    least = {}
    cut = [(i, (t or "").encode().split()) for i, t in rows]
    for i, words in cut:
        for s in range(len(words) - window + 1):
            key = tuple(words[s:s + window])
            least[key] = min(least.get(key, float("inf")), order(i))
    out = []
    for i, words in cut:
        gone = set()
        for s in range(len(words) - window + 1):
            if least[tuple(words[s:s + window])] < order(i):
                gone.update(range(s, s + window))
        out.append((i, len(words), len(gone), b" ".join(w for k, w in enumerate(words) if k not in gone).decode()))
    return sorted(out, key=sort_key)


def sort_key(row):
    return (row[0] is None, row[0] or 0, *row[1:])


def got(docs, **how):
    rows = substring_dedup.remove_repeats(docs, **how).collect()
    for r in rows:
        ends = [x.start + x.length for x in r.removed]
        assert sum(x.length for x in r.removed) == r.n_removed
        assert all(a < b.start for a, b in zip(ends, r.removed[1:]))
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in rows), key=sort_key)


def texts(seed, n, vocabulary):
    """Texts of shared passages, cut at any place, between words of their own."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    passages = [[rng.choice(words) for _ in range(rng.randint(3, 40))] for _ in range(8)]
    out = []
    for i in range(n):
        body = []
        for _ in range(rng.randint(0, 5)):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            body += p[a:rng.randint(a, len(p))] if rng.random() < 0.5 else p
            body += [rng.choice(words) for _ in range(rng.randrange(4))]
        out.append((rng.choice([i, i, i, None, 3]), rng.choice([" ", "\n", "  "]).join(body)))
    return out


@pytest.mark.parametrize("seed,vocabulary,window,k", [(1, 200, 6, 3), (2, 3, 8, 2), (3, 30, 10, 10), (4, 50, 5, 1)])
def test_shared_passages(spark, seed, vocabulary, window, k):
    rows = texts(seed, 120, vocabulary)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute(rows, window)
    assert sum(w[2] > 0 for w in want) > 20
    assert got(docs, window=window, k=k) == want


def test_awkward_rows(spark):
    own = [(i, t) for i, t in cases.rows()] + [(400, " ".join(["x"] * 300)), (401, " ".join(["x"] * 51)), (2 ** 63 - 1, " ".join(["x"] * 60))]
    assert got(cases.documents(spark, own)) == brute(own, 50)
    assert substring_dedup.remove_repeats(cases.empty(spark)).collect() == []


def test_a_hot_passage_is_not_paired(spark):
    """Windows that travel grow with the documents that hold a passage, not with its pairs."""
    rng = random.Random(7)
    passage = " ".join(f"p{i}" for i in range(80))
    rows = [(i, " ".join(f"o{rng.randrange(10 ** 6)}" for _ in range(60)) + " " + passage + f" end{i} " + f"z{i} " * 40) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(docs) == brute(rows, 50)
    assert substring_dedup.repeats(docs).count() < 300 * 80


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in common.table(spark, SMALL, "documents").collect()]
    want = [(i, n, m, hashlib.sha256(t.encode()).hexdigest()) for i, n, m, t in brute(rows, 50)]
    found = sorted(map(tuple, queries.op13_seed_extend(spark, SMALL).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()))
    assert found == sorted(want) and sum(w[2] > 0 for w in want) > 5
