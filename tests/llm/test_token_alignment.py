"""Alignment of two tokenizers against the libraries and a plain search of common ends."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
import public_tokenizers

from bodega.llm import common, queries, token_alignment
from tests.llm import cases

SMALL = "/root/testdata/sf0.001"
BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def plain():
    """Groups of one text: both libraries on the whole text, cut at the byte offsets where a token of each ends."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(BYTE)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    codes = {c: n for n, c in token_alignment.Encoder(BYTE).characters.items()}
    names = {i: t for t, i in a.get_vocab().items()}

    def groups(text):
        if not text:
            return []
        raw = (" " + text).encode()
        left = a.encode(" " + text, add_special_tokens=False).ids
        right = b.encode(text)
        left_bytes = [bytes(codes[c] for c in names[i]) for i in left]
        right_bytes = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in right]
        if b"".join(left_bytes) != raw or b"".join(right_bytes) != raw:
            return []
        ends = []
        for parts in (left_bytes, right_bytes):
            at, own = 0, []
            for p in parts:
                at += len(p)
                own.append(at)
            ends.append(own)
        out, i, j = [], 0, 0
        for cut in sorted(set(ends[0]) & set(ends[1])):
            m, k = i, j
            while i < len(left) and ends[0][i] <= cut:
                i += 1
            while j < len(right) and ends[1][j] <= cut:
                j += 1
            out.append((left[m:i], right[k:j]))
        return out

    return groups


def text_of(groups):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


def brute(rows, plain):
    found = [(i, plain(t)) for i, t in rows]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for _, g in found]
    counts = Counter(p for own in links for p in own)
    highest = {}
    for (x, _), n in counts.items():
        highest[x] = max(n, highest.get(x, 0))
    return sorted((
        (i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(own.values()),
         sum(n for p, n in own.items() if counts[p] == highest[p[0]]), sum(n * counts[p] for p, n in own.items()),
         hashlib.sha256(text_of(g).encode()).hexdigest() if g else "")
        for (i, g), own in zip(found, links, strict=True)), key=repr)


def rows_of(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


ODD = ["a▁b", "x  y   z", "  lead", "trail   ", " ", "\n", "\n\nq", "q\n", "a\r\nb", "a\tb\t\tc", "\x1cq", "q\x1c\x1dr", "tab\t", "é é ﬁ ½ Å", "日本語のテキスト 日本",
       "<s> </s> <unk> <|endoftext|> <0x0A>", "don't we'll 'tis", "😀😀 👩‍👩‍👧", "　x　y", "a\xa0b \xa0c", "\x85n\x85", "xxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxx", "a\x00b", "​z​ y",
       "١٢٣ ४५६", "foo(bar);  // x\n\treturn {};", "﻿bom", "ÿþ ǆ ß ẞ"]


def test_odd_texts_one_by_one(plain):
    tool = token_alignment.Aligner(BYTE, PIECE)
    assert tool.cuts
    rng = random.Random(11)
    letters = list("ab'sx \n\t  1é日.,-") + ["\xa0", "\r", "\x1d", "　", "😀", "́", "<s>", "▁"]
    texts = ODD + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 30))) for _ in range(3000)]
    for text, found in zip(texts, token_alignment.documents_of(tool, texts), strict=True):
        want = plain(text)
        assert (found is None and want == []) or found[1] == text_of(want), repr(text)


def test_awkward_rows(spark, plain):
    own = cases.rows() + [(500 + i, t) for i, t in enumerate(ODD)]
    want = brute(own, plain)
    assert sum(w[1] == 0 for w in want) >= 4
    for chunk in (token_alignment.CHUNK, 200):
        assert rows_of(token_alignment.align(cases.documents(spark, own), BYTE, PIECE, chunk)) == want
    assert token_alignment.align(cases.empty(spark), BYTE, PIECE).collect() == []
    assert token_alignment.align(spark.createDataFrame([(1, None), (None, "")], "doc_id long, text string"), BYTE, PIECE).count() == 2


def test_a_worker_that_starts_afresh(spark, plain, monkeypatch):
    monkeypatch.setattr(token_alignment, "KEPT_UNITS", 30)
    monkeypatch.setattr(token_alignment, "NEW_UNITS", 7)
    tool = token_alignment.Aligner(BYTE, PIECE)
    for text in ["one two three", " ".join(f"w{i}" for i in range(100)), "one two three four"] * 2:
        (found,) = token_alignment.documents_of(tool, [text])
        assert found[1] == text_of(plain(text))


def test_units_end_before_marks():
    tool = token_alignment.Aligner(BYTE, PIECE)
    assert tool.units("the, the. don't x,y z!!  ") == [" the", ",", " the", ".", " don", "'t", " x", ",y", " z", "!!", "  "]
    for text in ODD + [t for _, t in cases.rows() if t]:
        assert "".join(u if isinstance(u, str) else u[0] for u in tool.units(text)) == " " + text


@pytest.mark.parametrize("together", [True, False])
def test_marks_after_letters(plain, monkeypatch, together):
    tool = token_alignment.Aligner(BYTE, PIECE)
    if not together:
        monkeypatch.setattr(tool, "_together", lambda units: None)
    rng = random.Random(12)
    letters = list("aeé'stmd,.!-_1²ªß ") + ["'ll", "re", "ing", "\u0301", "<s>", "\n", "x.y"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 40))) for _ in range(2000)]
    for text, found in zip(texts, token_alignment.documents_of(tool, texts), strict=True):
        want = plain(text)
        assert (found is None and want == []) or found[1] == text_of(want), repr(text)


def test_the_most_used_units_stay(plain, monkeypatch):
    monkeypatch.setattr(token_alignment, "KEPT_UNITS", 30)
    tool, added = token_alignment.Aligner(BYTE, PIECE), Counter()
    add = tool._add
    monkeypatch.setattr(tool, "_add", lambda keys, *rest: (added.update(keys), add(keys, *rest)))
    for i in range(20):
        text = "one two, one two. " * 5 + " ".join(f"w{i}w{j}" for j in range(20))
        (found,) = token_alignment.documents_of(tool, [text])
        assert found[1] == text_of(plain(text))
    assert [added[u] for u in (" one", " two", ",", ".")] == [1, 1, 1, 1]
    assert len(tool.number) <= 45


def test_coalesce():
    import numpy as np

    group = token_alignment.coalesce(np.array([0, 3, 5, 0, 2, 5]), np.array([3, 5, 9, 2, 5, 9]))
    assert group.tolist() == [0, 0, 1, 0, 0, 1]


def test_query_against_brute_force(spark, plain):
    rows = [(r.doc_id, r.text) for r in common.table(spark, SMALL, "documents").collect()]
    assert rows_of(queries.op12_interval_alignment(spark, SMALL)) == brute(rows, plain)


def test_groups_are_what_the_digest_is_of(spark):
    docs = cases.documents(spark)
    sums = Counter(r.groups_sha256 for r in token_alignment.align(docs, BYTE, PIECE).collect())
    own = Counter(
        hashlib.sha256(text_of([(g.a, g.b) for g in r.groups]).encode()).hexdigest() if r.groups else ""
        for r in token_alignment.groups(docs, BYTE, PIECE).collect())
    assert own == sums
