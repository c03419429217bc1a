import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from pyspark.sql import functions as F

from bodega.llm import common, decontamination, language_id, quality, queries, simhash, training, url_filter
from tests.conftest import SMALL
from tests.llm import cases
from tests.llm.test_dedup import brute_components, brute_lines, brute_print, key

MEDIUM = "/root/testdata/sf0.01"


# --- URL filter --------------------------------------------------------------------------------------

URLS = [
    (1, "https://A.Example.ORG/es/1?x=/en/"), (2, "http://example.org/en/12"), (3, "http://example.org/en/2"), (4, "http://notexample.org/es/3"),
    (5, "https://shop.com/fr/a#b"), (6, "https://shop.com/de/"), (7, "https://shop.com/de"), (8, "https://org"), (9, "https://org/"), (10, None),
    (11, ""), (12, "no scheme"), (13, "x://h?p#q"), (14, "x://h#q"), (15, "a://b://c/d"), (16, "http://cheap-pills.example.net/en/1"),
    (17, "http://cheap-pills.example.net/en/1"), (18, "http://" + "a" * 3000 + ".net/" + "b" * 3000), (None, "https://blog.ththan.example.net/es/4"),
    (19, "http://EXAMPLE.org:80/es/"), (20, "HTTP://ÑU.Org/É\nes"),
]


def brute_rule(host, path):
    best = None
    for h, p, verdict in url_filter.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, verdict)
    return best or (None, None)


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(i, u, "h", 1) for i, u in URLS], "page_id long, url string, host string, path long")
    got = {(r.page_id, r.host, r.path): r for r in url_filter.filter_urls(pages).collect()}
    assert len(got) == len(URLS)
    for i, url in URLS:
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host, tail = re.match(r"(?s)([^/?#]*)(.*)", rest).groups()
        path = re.match(r"(?s)[^?#]*", tail).group()
        host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
        row = got[i, host, path]
        rule, verdict = brute_rule(host, path)
        assert row.rule == rule and row.verdict == (verdict or ("block" if row.block_score >= 0.5 else "allow"))
        assert 0 <= row.block_score <= 1


def test_url_model_on_held_out_addresses(spark):
    model = url_filter.fit(url_filter.labelled_urls(spark))
    bad = ["https://spam-farm.example.net/es/4", "http://cheap-pills.example.com/de/9", "https://casino-win.example.com/en/2", "http://m.free-bets.example.com/en/8"]
    good = ["https://www.ththat.example.net/en/88", "https://therou.example.com/es/4.html", "https://library.example.net/item/7", "https://m.ththth.example.net/en/25#top"]
    pages = spark.createDataFrame(list(enumerate(bad + good)), "page_id long, url string")
    score = {r.page_id: r.block_score for r in url_filter.filter_urls(pages, rules=[]).collect()}
    assert min(score[i] for i in range(len(bad))) > max(score[i] for i in range(len(bad), len(bad + good)))
    assert len(model[1]) == url_filter.BUCKETS
    none = url_filter.fit(url_filter.labelled_urls(spark).filter("label = 1"))
    assert none == (-1.0, [0.0] * url_filter.BUCKETS)


def test_url_filter_of_nothing(spark):
    assert url_filter.filter_urls(spark.createDataFrame([], "page_id long, url string")).collect() == []


# --- decontamination ---------------------------------------------------------------------------------

ITEM = [f"token{i}" for i in range(30)]


def planted(*wrong):
    return " ".join("odd" if i in wrong else w for i, w in enumerate(ITEM))


def leaks(spark, docs, items):
    table = spark.createDataFrame(docs, "doc_id long, text string, tokens string, i long").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string, j long, seed long")
    return {(r.doc_id, r.item_id): (r.score, r.start) for r in decontamination.overlaps(table, bench).collect()}


def test_passages_with_replaced_words_are_found_and_others_are_not(spark):
    filler = " ".join(f"f{i}" for i in range(50))
    docs = [
        (1, planted()), (2, f"{filler} {planted(3, 9, 15, 21, 27)} {filler}"), (3, " ".join(ITEM[5:18])), (4, " ".join(ITEM[:6])), (5, filler), (6, None), (7, ""),
        (8, planted().upper().replace(" ", " -- ")), (9, " ".join(w for k, w in enumerate(ITEM) if k % 3)), (None, planted()), (1, planted()),
        (10, " ".join(["token0 token1"] * 40)), (11, f"{filler} " * 3000 + planted()), (12, "a b c d e f g"),
    ]
    items = [(100, planted()), (100, planted()), (101, None), (102, ""), (103, "short item"), (104, "A b c d e f g"), (None, filler.replace("f1 ", "f1 x "))]
    got = leaks(spark, [(i, t, "x", 1) for i, t in docs], [(i, t, 1, 1) for i, t in items])
    assert {d for d, i in got if i == 100} == {1, 2, 3, 8, None, 11}
    assert got[1, 100] == (30, 0) and got[2, 100][1] == 50 and got[3, 100] == (13, 0) and (12, 104) in got
    assert {i for _, i in got} == {100, 104, None}


def brute_overlap(text, item):
    split = lambda t: [w for w in re.split(r"[^\w]|_", (t or "").lower()) if w]
    a, b = split(text), split(item)
    best = 0
    places = defaultdict(list)
    for j, w in enumerate(b):
        places[w].append(j)
    for shift in {i - j for i, w in enumerate(a) for j in places.get(w, ())}:
        now = 0
        for k in range(len(b)):
            same = 0 <= shift + k < len(a) and a[shift + k] == b[k]
            now = max(0, now + (1 if same else -decontamination.MISMATCH))
            best = max(best, now)
    return best >= min(decontamination.MIN_SCORE, len(b)) if b else False


def test_given_documents_against_brute_force(spark):
    con = duckdb.connect()
    docs = con.execute(f"select doc_id, text from '{SMALL}/documents.parquet'").fetchall()
    items = con.execute(f"select item_id, text from '{SMALL}/benchmark.parquet'").fetchall()
    got = {(r.doc_id, r.item_id) for r in queries.op6_spaced_seeds(spark, SMALL).collect()}
    want = {(d, i) for d, t in docs for i, item in items if brute_overlap(t, item)}
    assert got == want and got


def test_masks_meet_any_two_replaced_words():
    from itertools import combinations

    for wrong in combinations(range(13), 2):
        assert any(all(s + p not in wrong for p in m) for m in decontamination.MASKS for s in range(13 - m[-1]))


def test_clean_keeps_columns_and_clean_rows(spark):
    docs = cases.documents(spark)
    bench = spark.createDataFrame([(1, "the same text for a hot group of copies"), (2, "without an id")], "item_id long, text string")
    kept = decontamination.clean(docs, bench)
    assert kept.columns == docs.columns
    assert kept.count() == docs.count() - 60
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.clean(docs, nothing).count() == docs.count()
    assert decontamination.overlaps(cases.empty(spark), bench).collect() == []


# --- language ----------------------------------------------------------------------------------------

def held_out(i, folds, which):
    return zlib.crc32(b"" if i is None else str(i).encode()) % folds == which


def test_language_accuracy_on_the_held_out_fold(spark):
    got = queries.op7_language_codes(spark, MEDIUM).collect()
    known = dict(duckdb.sql(f"select doc_id, lang from '{MEDIUM}/documents.parquet'").fetchall())
    assert all(r.held_out == held_out(r.doc_id, 4, 2) and 0 <= r.score <= 1 for r in got)
    own = [r for r in got if r.held_out]
    assert sum(r.lang_pred == known[r.doc_id] for r in own) / len(own) > 0.97


def test_language_edge_cases(spark):
    got = language_id.identify(cases.documents(spark)).collect()
    assert len(got) == len(cases.rows())
    text = cases.rows()
    letters = {key(i): bool(t and any(map(str.isalpha, t))) for i, t in text}
    assert all((r.lang_pred == "und") == (not letters[key(r.doc_id)]) for r in got if r.doc_id is not None)
    assert {r.lang_pred for r in got} <= {"und", "en"}
    unlabelled = cases.documents(spark, [(2, "some text"), (4, None)])
    assert {(r.lang_pred, r.score) for r in language_id.identify(unlabelled).collect()} == {("und", 0.0)}
    assert language_id.identify(cases.empty(spark)).collect() == []


def test_codewords_stay_apart_and_one_wrong_bit_is_mended():
    for n in (2, 3, 4, 9, 40):
        code = language_id.codewords(n)
        gaps = [int((code[i] != code[j]).sum()) for i in range(n) for j in range(i)]
        assert min(gaps) >= 3 and ((code.max(0) - code.min(0)) == 1).all()
        bits = code.shape[1]
        model = language_id.Model([str(i) for i in range(n)], code, np.eye(bits), np.zeros(bits), np.ones(bits))
        for i in range(n):
            margins = 4.0 * (2 * code[i] - 1)
            margins[0] *= -1
            assert model.decode(margins[None].astype(float))[0][0] == i


# --- quality -----------------------------------------------------------------------------------------

def test_quality_on_the_held_out_fold(spark):
    got = queries.op10_compression_quality(spark, MEDIUM).collect()
    known = dict(duckdb.sql(f"select doc_id, quality from '{MEDIUM}/labels.parquet'").fetchall())
    assert all(r.held_out == held_out(r.doc_id, 5, 0) and r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in got)
    own = [(known[r.doc_id], r.score) for r in got if r.held_out and r.doc_id in known]
    good, bad = [s for y, s in own if y], [s for y, s in own if not y]
    assert sum((a > b) + 0.5 * (a == b) for a in good for b in bad) / (len(good) * len(bad)) > 0.95


def test_quality_edge_cases(spark):
    docs = cases.documents(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {round(r.score, 6) for r in quality.score(docs, quality.train(docs, none)).collect()} == {0.5}
    few = spark.createDataFrame([(3, 1, 0), (4, 0, None), (None, 1, 1), (5, None, 0), (9, 7, 0), (300, 1, 0), (301, 1, 0), (100, 0, 0)], none.schema)
    model = quality.train(docs, few)
    got = quality.score(docs, model).collect()
    assert len(got) == len(cases.rows()) and all(0 <= r.score <= 1 for r in got)
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.predicted for r in got)
    assert quality.score(cases.empty(spark), model).collect() == [] == quality.keep_good(cases.empty(spark), model).collect()


def test_bounded_samples_are_bounded_and_repeatable(spark):
    rows = spark.range(20_000).selectExpr("id as doc_id", "case when id % 100 = 0 then 'b' else 'a' end as y")
    one, two = (sorted(map(tuple, training.bounded(r, "y", 500).collect())) for r in (rows, rows.repartition(7)))
    assert one == two
    assert 350 < sum(y == "a" for _, y in one) < 650 and sum(y == "b" for _, y in one) == 200


def test_one_labelled_document_repeated_very_often_counts_once(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"good words here number {i} " * 5 if i % 2 else f"BUY NOW!!! cheap {i} " * 5) for i in range(300)], "doc_id long, text string")
    hot = spark.range(5000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("good words here " * 30).alias("text"))
    other = spark.range(2000).select(F.lit(3).cast("long").alias("doc_id"), F.concat(F.lit("good "), F.col("id").cast("string")).alias("text"))
    labels = spark.range(300).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    seen = []
    monkeypatch.setattr(quality.Model, "fit", classmethod(lambda cls, labelled: seen.append(labelled)))
    quality.train(docs.unionByName(hot), labels)
    assert len(seen[0]) <= 301 and sum(t.startswith("good words here good") for _, t in seen[0]) <= 1
    monkeypatch.setattr(quality, "SAMPLE_PER_LABEL", 100)
    quality.train(docs.unionByName(hot).unionByName(other), labels)
    assert len(seen[1]) <= 200
    monkeypatch.setattr(quality, "SAMPLE_BYTES", 1000)
    quality.train(docs, labels)
    assert 0 < sum(len(t.encode()) for _, t in seen[2]) <= 1000


# --- pipeline ----------------------------------------------------------------------------------------

def test_pipeline_against_brute_force(spark):
    """Every stage's rows from a plain version of it, given the models that the stages train."""
    docs = common.table(spark, SMALL, "documents")
    labels, bench = (common.table(spark, SMALL, n) for n in ("labels", "benchmark"))
    model = quality.train(docs, labels)
    pair = model.compressors()
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    rows = [(i, t) for i, t in rows if model.scores([t], pair)[0] >= quality.THRESHOLD]

    stages = dict(corpus_pipeline.STAGES)
    after, kept = docs, []
    for name in list(stages)[:4]:
        after = common.settle(stages[name](spark, after, SMALL), "test-stage")
        assert after.columns == docs.columns
        kept.append(sorted((r.doc_id, r.text) for r in after.collect()))
    assert kept[0] == rows

    want = {i[1]: sha for i, _, _, sha in brute_lines(rows)}
    import hashlib
    assert {i: hashlib.sha256(t.encode()).hexdigest() for i, t in kept[1]} == want

    prints = {i: brute_print(t) for i, t in kept[1]}
    roots = brute_components(list(prints.values()))
    first = {}
    for i, f in sorted(prints.items()):
        first.setdefault(roots[f], i)
    assert [i for i, _ in kept[2]] == sorted(first.values())
    assert simhash.fingerprint(rows[0][1]) == brute_print(rows[0][1])

    items = [r.text for r in bench.collect()]
    assert kept[3] == [(i, t) for i, t in kept[2] if not any(brute_overlap(t, x) for x in items)]

    packed = corpus_pipeline.run(spark, SMALL).collect()
    assert {r.doc_id for r in packed} == {i for i, _ in kept[3]}
    total = sum(r.length for r in packed)
    assert len({r.sequence_id for r in packed}) <= -(-total // 4096) + 1


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_queries_match_their_sql(spark, name):
    from tests.compare import differences, oracle_connection

    assert differences(queries.QUERIES[name](spark, SMALL), oracle_connection(SMALL), queries.ORACLE[name]) is None
