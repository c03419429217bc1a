"""The trained operators' predictions recomputed in plain Python, one row and one feature at a time, from the trained numbers."""

from __future__ import annotations

import math
import re
import zlib

import pytest
import xxhash
import zstandard

from bodega.llm import common, language_id, quality, queries, training, url_filter

SMALL = "/root/testdata/sf0.001"


def sigmoid(x):
    return 1 / (1 + math.exp(-x))


# --- URL filter --------------------------------------------------------------------------------------

def gram_buckets(text, kind):
    letters, out = list(f"^{text}$"), []
    for n in url_filter.GRAMS:
        for i in range(len(letters) - n + 1):
            h = 42
            for part in (kind, *letters[i:i + n]):
                h = xxhash.xxh64_intdigest(part.encode(), seed=h)
            out.append((h - (1 << 64) if h >> 63 else h) % url_filter.BUCKETS)
    return out


def plain_url(url, model):
    """(host, path, probability to be blocked) of an address."""
    rest = url.split("://", 1)[1] if "://" in url else ""
    host = re.split("[/?#]", rest, maxsplit=1)[0].lower()
    path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
    total = model[0]
    for text, kind in ((host, "host"), (path, "path")):
        found = gram_buckets(text, kind)
        total += sum(model[1][b] for b in found) / math.sqrt(len(found))
    return host, path, sigmoid(total)


def test_url_scores_and_verdicts(spark):
    pages = common.table(spark, SMALL, "pages").select("page_id", "url")
    model = url_filter.fit(url_filter.labelled_urls(spark))
    want = {}
    for r in pages.collect():
        host, path, p = plain_url(r.url or "", model)
        rules = [(h + q, v) for h, q, v in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(q)]
        rule, verdict = max(rules, key=lambda x: len(x[0])) if rules else (None, "block" if p >= 0.5 else "allow")
        want[r.page_id] = (host, path, rule, verdict, round(p, 9))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict, round(r.block_score, 9)) for r in queries.op3_url_filter(spark, SMALL).collect()}
    assert got == want and {w[3] for w in want.values()} == {"allow", "block"}


def test_the_labelled_table_holds_no_given_address(spark):
    own = {line.split()[1] for line in url_filter.LABELLED.strip().split("\n")}
    hosts = {plain_url(u, (0.0, [0.0] * url_filter.BUCKETS))[0] for u in own}
    for folder in ("sf0.001", "sf0.01"):
        given = [r.url or "" for r in common.table(spark, f"/root/testdata/{folder}", "pages").select("url").collect()]
        assert not own & set(given)
        assert not hosts & {plain_url(u, (0.0, [0.0] * url_filter.BUCKETS))[0] for u in given}


def test_accuracy_on_hosts_that_are_not_in_the_table(spark):
    """In the given pages a site to be blocked has a name of two words with a hyphen; no host of them is in the table."""
    pages = common.table(spark, "/root/testdata/sf0.01", "pages")
    right = wrong = 0
    for r in url_filter.filter_urls(pages, rules=[]).select("host", "verdict").distinct().collect():
        right, wrong = (right + 1, wrong) if ("-" in r.host) == (r.verdict == "block") else (right, wrong + 1)
    assert right + wrong > 50 and wrong <= 0.05 * (right + wrong)


# --- languages ---------------------------------------------------------------------------------------

def plain_features(text):
    octets, counts, total = text.lower().encode("utf-8", "replace"), {}, 0
    for k in range(3):
        for i in range(len(octets) - k):
            gram = int.from_bytes(octets[i:i + k + 1], "big")
            bucket = ((gram + k) * 0x9E3779B1 % (1 << 32)) >> 21
            counts[bucket] = counts.get(bucket, 0) + 1
            total += 1
    return {b: math.sqrt(n / total) for b, n in counts.items()}


def test_language_predictions(spark):
    docs = common.table(spark, SMALL, "documents")
    model = language_id.train(docs)
    got = {r.doc_id: r for r in language_id.identify(docs, model).collect()}
    for r in docs.collect():
        text, row = r.text or "", got[r.doc_id]
        assert row.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        if not any(c.isalpha() for c in text):
            assert (row.lang_pred, row.score) == ("und", 0.0)
            continue
        found = plain_features(text)
        losses = []
        for word in model.code[:len(model.languages)]:
            loss = 0.0
            for b, bit in enumerate(word):
                margin = model.intercepts[b] + sum(w * model.weights[i][b] for i, w in found.items())
                loss += model.trust[b] * math.log1p(math.exp(-margin * (1 if bit else -1)))
            losses.append(loss / sum(model.trust) * len(word))
        shares = [math.exp(-x) for x in losses]
        best = max(range(len(shares)), key=shares.__getitem__)
        assert row.score == pytest.approx(shares[best] / sum(shares), abs=2e-3)
        assert row.lang_pred == model.languages[best] or row.ambiguous


def test_languages_learn_from_the_other_folds_alone(spark):
    docs = common.table(spark, SMALL, "documents")
    left = docs.filter(training.fold(docs.doc_id, language_id.FOLDS) != language_id.HELD_OUT)
    one, two = language_id.train(docs), language_id.train(left)
    assert (one.weights == two.weights).all() and one.languages == two.languages


# --- quality -----------------------------------------------------------------------------------------

def test_quality_scores(spark):
    docs, labels = (common.table(spark, SMALL, n) for n in ("documents", "labels"))
    model = quality.train(docs, labels)
    sizes = {}
    for name, data in (("good", model.good), ("bad", model.bad)):
        made = zstandard.ZstdCompressor(level=quality.LEVEL, dict_data=zstandard.ZstdCompressionDict(data), write_content_size=False,
                                        write_checksum=False, write_dict_id=False)
        sizes[name] = lambda text, made=made: sum(len(made.compress(text[i:i + quality.CHUNK])) for i in range(0, len(text), quality.CHUNK))
    got = {r.doc_id: r for r in quality.score(docs, model).collect()}
    for r in docs.collect():
        raw, row = (r.text or "").encode(), got[r.doc_id]
        good, bad = (sizes[n](raw) for n in ("good", "bad")) if raw else (1, 1)
        x = [(bad - good) / (bad + good), float(not raw)]
        want = sigmoid(model.intercept + sum((v - m) / s * w for v, m, s, w in zip(x, model.shift, model.scale, model.weights, strict=True)))
        assert row.score == pytest.approx(want, abs=1e-9) and row.predicted == int(want >= 0.3)
        assert row.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_quality_learns_from_the_other_folds_alone(spark):
    docs, labels = (common.table(spark, SMALL, n) for n in ("documents", "labels"))
    left = docs.filter(training.fold(docs.doc_id, quality.FOLDS) != quality.HELD_OUT)
    one, two = quality.train(docs, labels), quality.train(left, labels)
    assert (one.good, one.bad, one.intercept) == (two.good, two.bad, two.intercept)
