import io
import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from bodega.llm import packing, token_files, tokens
from bodega.llm.tokens import Encoder
from tests.llm import cases

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_unit_cache_gives_the_tokenizers_ids(path):
    rng = random.Random(3)
    parts = ["a", "B", "é", "é", "1", " ", "  ", "\n", "\t", "'s", "!", "\xa0", "́", "日", "\x1c", "\0", "İ", "Σ", "ﬁ", "<|endoftext|>", " "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 25))) for _ in range(3000)] + [t or "" for _, t in cases.rows()]
    encoder = Encoder(path)
    for text in texts:
        assert encoder.encode(text) == encoder.whole(text), repr(text)
    assert encoder.encode(None) == encoder.encode("") == b""


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_texts_encoded_together_have_their_own_ids(path):
    import pyarrow as pa

    rng = random.Random(4)
    parts = ["a", "the", "é", "1", " ", "  ", "\n", "\t", "'s", "'", "!", ",", "-", "\xa0", "\u0301", "日", "\0", "İ", "×", "<|endoftext|>", " of", "x" * 70]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(3000)] + [None, "", " "] + [t for _, t in cases.rows()]
    encoder = Encoder(path)
    want = [encoder.whole(t) if t else b"" for t in texts]
    assert encoder.encode_all(pa.array(texts, pa.string())) == want
    assert encoder.encode_all(pa.array([None, *texts], pa.string()).slice(1)) == want
    assert encoder.encode_all(pa.array([], pa.string())) == []


def test_a_unit_of_texts_encoded_together_is_encoded_once(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(tokens, "CACHE", 2)
    encoder, seen = Encoder(BYTE), []
    unit = encoder.unit
    monkeypatch.setattr(encoder, "unit", lambda u: (seen.append(u), unit(u))[1])
    encoder.encode_all(pa.array([" one two, three four two,", "x one two, three"] * 50, pa.string()))
    assert len(seen) == len(set(seen))


def test_parts_of_batches_are_all_rows_in_order():
    import pyarrow as pa

    rows = [(i, t) for i, t in enumerate([None, "", "a" * 5, "b" * 50, "c", None, "d" * 9, "e" * 10, ""] * 4)]
    batch = pa.record_batch([pa.array([i for i, _ in rows]), pa.array([t for _, t in rows], pa.string())], names=["doc_id", "text"])
    parts = list(token_files.parts_of(iter([batch, batch.slice(0, 0), batch.slice(3, 2)]), 10))
    assert [r for p in parts for r in zip(*[c.to_pylist() for c in p.columns])] == rows + rows[3:5]
    assert len(parts) > 8 and all(p.num_rows for p in parts)


def ids_of(path, text, end):
    return Encoder(path).whole(text or "") + end.to_bytes(4, "little")


def brute(path, end):
    encoder = Encoder(path)
    return [(i, (encoder.whole(t) if t else b"") + end.to_bytes(4, "little")) for i, t in cases.rows()]


def test_packing_is_complete_gapless_and_tight(spark):
    capacity = 512
    got = packing.pack_documents(cases.documents(spark), WORD, capacity).collect()
    want = sorted(((i is None, i or 0), k, at // 4, len(ids[at:at + 4 * capacity]) // 4, zlib.crc32(ids[at:at + 4 * capacity]))
                  for i, ids in brute(WORD, 1) for k, at in enumerate(range(0, len(ids), 4 * capacity)))
    assert sorted(((r.doc_id is None, r.doc_id or 0), r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(by) <= -(-sum(r.length for r in got) // capacity) + 1


def test_sequences_hold_the_ids(spark):
    own = [(i, t) for i, t in dict(cases.rows()).items() if i is not None]
    docs, packed = cases.documents(spark, own), None
    packed = packing.pack_documents(docs, WORD, 256)
    glued = {r.sequence_id: bytes(r.ids) for r in packing.sequences(docs, packed, WORD, 256).collect()}
    for r in packed.collect():
        assert zlib.crc32(glued[r.sequence_id][4 * r.offset:4 * (r.offset + r.length)]) == r.ids_crc32


@pytest.mark.parametrize("lengths", [[], [1], [4096] * 5, [2048] * 7 + [4096], [1] * 9000, [3000, 1096, 500, 500, 500, 97], [2500] * 40 + [1600] * 40])
def test_plan_places_everything(lengths):
    histogram = {n: lengths.count(n) for n in set(lengths)}
    plan = packing.best_plan(histogram)
    assert {n: sum(b - a for m, a, b, *_ in plan.rows if m == n) for n in histogram} == histogram
    fill = {}
    for n, lo, hi, first, per, offset in plan.rows:
        for k in range(hi - lo):
            fill.setdefault(first + k // per, []).append((offset + k % per * n, n))
    assert len(fill) == plan.sequences
    for places in fill.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= 4096
    if lengths and max(lengths) < 2049:
        assert plan.sequences <= -(-sum(lengths) // 4096) * 1.3 + 1


MIXES = {
    "log-normal": lambda r: r.lognormal(6, 0.8, 60_000), "short": lambda r: r.integers(50, 700, 60_000), "tiny": lambda r: r.integers(1, 60, 60_000),
    "thirds": lambda r: r.integers(1000, 1900, 30_000), "halves": lambda r: r.integers(1500, 2600, 30_000),
    "few lengths": lambda r: r.choice([900, 1100, 1300, 1500, 1700], 30_000),
    "two kinds": lambda r: np.concatenate([r.integers(1200, 1400, 20_000), r.integers(2600, 2900, 12_000)]),
}


@pytest.mark.parametrize("name", MIXES)
def test_patterns_serve_every_mix(name):
    """No mix is without patterns, and the plan never needs more sequences than best fit decreasing alone."""
    lengths, counts = np.unique(np.clip(MIXES[name](np.random.default_rng(0)).astype(int), 1, 4096), return_counts=True)
    histogram = dict(zip(lengths.tolist(), counts.tolist(), strict=True))
    pats = packing.patterns(lengths, 4096)
    assert set(pats.lengths[pats.times > 0].tolist()) == set(lengths.tolist())
    assert (pats.waste(4096) >= 0).all()
    alone = packing.make_plan(histogram, 4096, 0.0, pats, np.zeros(len(pats))).sequences
    plan = packing.best_plan(histogram)
    assert plan.sequences <= alone
    if name in ("short", "thirds"):
        assert plan.sequences < alone


def test_files_round_trip(spark, tmp_path):
    got = token_files.encode_documents(cases.documents(spark), BYTE, str(tmp_path / "files")).collect()
    assert sorted(((r.doc_id is not None, r.doc_id or 0), r.n_tokens, r.ids_crc32) for r in got) == sorted(
        ((i is not None, i or 0), len(b) // 4, zlib.crc32(b)) for i, b in brute(BYTE, 2))
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))


def test_empty_tables(spark, tmp_path):
    assert packing.pack_documents(cases.empty(spark), WORD).collect() == []
    assert token_files.encode_documents(cases.empty(spark), BYTE, str(tmp_path / "files")).collect() == []


def one_file(docs, frame_ids=8, id_bytes=2):
    out = io.BytesIO()
    writer = token_files.Writer(out, id_bytes, frame_ids)
    for i, ids in docs:
        writer.add(i, np.array(ids, "<u4").tobytes())
    writer.close()
    return out.getvalue(), writer


@pytest.mark.parametrize("id_bytes", [2, 4])
def test_reader_gets_any_document_and_the_file_is_plain_zstandard(id_bytes):
    import zstandard

    docs = [(5, range(3)), (None, []), (9, range(100, 140)), (9, [7]), (-1, range(16))]
    data, _ = one_file(docs, id_bytes=id_bytes)
    reader = token_files.Reader(io.BytesIO(data))
    assert [d.doc_id for d in reader.documents] == [5, None, 9, 9, -1]
    for doc, (_, ids) in reversed(list(zip(reader.documents, docs))):
        assert reader.read(doc).tolist() == list(ids)
    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert np.frombuffer(whole, f"<u{id_bytes}").tolist() == [x for _, ids in docs for x in ids]


def test_reader_decompresses_only_the_frames_it_needs():
    data, _ = one_file([(i, [i] * 8) for i in range(50)])
    reader, read = token_files.Reader(io.BytesIO(data)), []
    plain = reader.decompressor.decompress

    class Counting:
        def decompress(self, block):
            read.append(len(block))
            return plain(block)

    reader.decompressor = Counting()
    assert reader.read(reader.documents[30]).tolist() == [30] * 8 and len(read) == 1


def test_damage_is_found():
    data, writer = one_file([(1, range(1000, 1040))])
    spoiled = bytearray(data)
    spoiled[writer.seek[0][0] + writer.seek[1][0] // 2] ^= 0xFF
    reader = token_files.Reader(io.BytesIO(bytes(spoiled)))
    with pytest.raises(Exception, match="."):
        reader.read(reader.documents[0])
    with pytest.raises(ValueError):
        token_files.Reader(io.BytesIO(data[:-3] + b"abc"))
