"""Substring dedup by seed and extend: passages that an earlier document holds too are removed.

Seeds. Every window of `window` words holds `window - k + 1` runs of k words; the one with the smallest hash (the first of
equals) is the window's anchor. Neighbouring windows mostly share their anchor, so a text has about 2 / (window - k + 2)
anchors a word, and two equal windows always have equal anchors. Documents are joined on anchors that at least two of
them hold.

Extension. An anchor's occurrence stands for a stretch of consecutive windows. Occurrences that agree on the whole stretch
form a class by one aggregate, and all but those of its smallest doc_id are settled: their stretch is repeated. So copies,
however many, are one class and are not paired. Only where an anchor has several classes is it extended to both sides
window by window, for the first document of each class alone, and each extended window goes to its smallest doc_id.
Windows overlap to the maximal repeats of at least `window` words.

Windows, stretches and anchors are known by 64- or 128-bit sums over the words' 128-bit digests. Nothing grows with the
square of a group: what travels is one row per anchor, per class and per extended window, and each text packed, at most twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bodega.llm import common

WINDOW = 50
ANCHOR = 15
#: Stands for a missing doc_id, which counts as larger than all others.
NO_ID = (1 << 63) - 1
#: Odd bases of the two sums.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: Words whose digests a worker keeps; it starts afresh beyond that.
CACHE = 500_000


class Digests(dict):
    """128-bit digest of a word, kept once it is made."""

    def __missing__(self, word: bytes) -> bytes:
        import xxhash

        made = xxhash.xxh3_128_digest(word)
        if len(word) <= 64:
            if len(self) >= CACHE:
                self.clear()
            self[word] = made
        return made


class Powers:
    """Powers of a base and of its inverse, modulo 2^64."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = 2 * n
            self.up, self.down = (
                np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, x, np.uint64)])) for x in (self.base, self.inverse))
        return self.up[:n], self.down[:n]


class Sums:
    """Sums of stretches of one text's words: equal for equal stretches, wherever they stand."""

    powers = tuple(Powers(b) for b in BASES)
    digests = Digests()

    def __init__(self, words: list[bytes]):
        halves = np.frombuffer(b"".join(map(self.digests.__getitem__, words)), "<u8").reshape(-1, 2)
        self.parts = []
        for half, powers in zip(halves.T, self.powers, strict=True):
            up, down = powers.of(len(words) + 1)
            self.parts.append((np.concatenate([np.zeros(1, np.uint64), np.cumsum(half * up[:-1], dtype=np.uint64)]), down))

    def get(self, part: int, start: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        total, down = self.parts[part]
        return (total[start + size] - total[start]) * down[start]


def anchors_of(sums: Sums, n: int, window: int, k: int) -> tuple[np.ndarray, ...]:
    """(anchor sum, sum of the stretch, first window, number of windows) of a text of n >= window words."""
    runs = sums.get(0, np.arange(n - k + 1), k)
    chosen = np.lib.stride_tricks.sliding_window_view(runs, window - k + 1).argmin(axis=1) + np.arange(n - window + 1)
    first = np.concatenate([[0], np.flatnonzero(chosen[1:] != chosen[:-1]) + 1])
    count = np.diff(np.append(first, len(chosen)))
    stretch = sums.get(1, first, count + window - 1) + count.astype(np.uint64)
    return runs[chosen[first]].view(np.int64), stretch.view(np.int64), first.astype(np.int32), count.astype(np.int32)


def keyed(docs: DataFrame) -> DataFrame:
    """(doc, row, text, doc_id): rows are told apart by doc_id and a hash of the text; rows equal in both have equal results."""
    doc_id = F.col("doc_id").cast("long")
    return docs.select(F.coalesce(doc_id, F.lit(NO_ID)).alias("doc"), F.xxhash64(F.col("text")).alias("row"), F.col("text"), doc_id.alias("doc_id"))


def anchors(docs: DataFrame, window: int = WINDOW, k: int = ANCHOR) -> DataFrame:
    """One row (anchor, stretch, doc, row, first, count) per anchor occurrence."""
    import pyarrow as pa

    names = ["anchor", "stretch", "doc", "row", "first", "count"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[np.ndarray, ...]] = []
            for doc, row, text in zip(batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2), strict=True):
                words = (text.as_py() or "").encode().split()
                if len(words) >= window:
                    found = anchors_of(Sums(words), len(words), window, k)
                    out.append((*found[:2], np.full(len(found[0]), doc), np.full(len(found[0]), row), *found[2:]))
            if out:
                yield pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=names)

    return keyed(docs).select("doc", "row", "text").mapInArrow(run, "anchor long, stretch long, doc long, row long, first int, count int")


def packed(docs: DataFrame) -> DataFrame:
    """(doc, row, words, doc_id): the words of each text, joined by a space and compressed, so that texts travel small."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            words = [pack(b" ".join((t.as_py() or "").encode().split())) for t in batch.column(2)]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(words, pa.binary()), batch.column(3)],
                                  names=["doc", "row", "words", "doc_id"])

    return keyed(docs).mapInArrow(run, "doc long, row long, words binary, doc_id long")


def own(name: str) -> Column:
    """The stretches (first, count) of one document: at most as many as it has words."""
    return F.collect_set(F.struct("first", "count")).alias(name)


def extended(texts: DataFrame, asked: DataFrame, window: int) -> DataFrame:
    """(w1, w2, doc, row, first): every window of the asked stretches (doc, row, first, count)."""
    import pyarrow as pa

    names = ["w1", "w2", "doc", "row", "first"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = []
            rows = zip(batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2), batch.column(3), strict=True)
            for doc, row, words, stretches in rows:
                sums = Sums(unpack(words.as_py()).split())
                at = stretches.values
                first, count = (at.field(c).to_numpy().astype(np.int64) for c in ("first", "count"))
                places = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
                w1, w2 = (sums.get(p, places, window).view(np.int64) for p in (0, 1))
                out.append((w1, w2, np.full(len(places), doc), np.full(len(places), row), places.astype(np.int32)))
            if out:
                yield pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=names)

    rows = asked.groupBy("doc", "row").agg(own("stretches"))
    return (texts.join(rows, ["doc", "row"]).select("doc", "row", "words", "stretches")
            .mapInArrow(run, "w1 long, w2 long, doc long, row long, first int"))


def shared(rows: DataFrame, *keys: str) -> DataFrame:
    """Per key that more than one doc_id has: the smallest of them, as `least`."""
    return rows.groupBy(*keys).agg(F.min("doc").alias("least"), F.max("doc").alias("most")).filter("least < most").drop("most")


def repeats(docs: DataFrame, window: int = WINDOW, k: int = ANCHOR) -> DataFrame:
    """(doc, row, first, count): settled stretches of windows that also start in a document with a smaller doc_id."""
    found = common.settle(anchors(docs, window, k), "anchors")
    # Both sides of each join are settled, so that a hot key is split among tasks.
    common_anchors = common.settle(shared(found, "anchor").select("anchor"), "shared-anchors")
    seeds = common.settle(found.join(common_anchors, "anchor", "left_semi"), "seeds")
    classes = common.settle(seeds.groupBy("anchor", "stretch").agg(F.min("doc").alias("least"), F.max("doc").alias("most")), "classes")
    mixed = common.settle(
        classes.groupBy("anchor").agg(F.min("least").alias("a"), F.max("least").alias("b")).filter("a < b").select("anchor", F.lit(True).alias("mixed")),
        "mixed-anchors")
    known = common.settle(
        classes.join(mixed, "anchor", "left").filter("mixed or least < most").select("anchor", "stretch", "least", F.coalesce("mixed", F.lit(False)).alias("mixed")),
        "known-classes")
    met = common.settle(
        seeds.join(known, ["anchor", "stretch"]).filter("doc > least or mixed")
        .select("doc", "row", "first", "count", (F.col("doc") > F.col("least")).alias("gone")), "seeds-met")
    windows = common.settle(extended(packed(docs), met.filter("not gone"), window), "windows")
    firsts = common.settle(shared(windows, "w1", "w2"), "first-windows")
    hits = windows.join(firsts, ["w1", "w2"]).filter("doc > least").select("doc", "row", "first", F.lit(1).alias("count"))
    return common.settle(met.filter("gone").select("doc", "row", "first", "count").unionByName(hits), "repeats")


def remove_repeats(docs: DataFrame, window: int = WINDOW, k: int = ANCHOR) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept (the words that stay, joined by one space), removed (the maximal ranges).

    A word goes if it is in a window of `window` consecutive words that also starts in a document with a smaller doc_id;
    windows are judged on the texts as given. Words are what stands between white space (space, tab to carriage return),
    unchanged; a null text has none. A null doc_id counts as larger than all others; rows with equal doc_id (or none) take
    nothing from each other. Other columns are not read; an empty table gives an empty one.
    """
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        ranges = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
        for batch in batches:
            n_words, n_removed, kept, removed = [], [], [], []
            for text, stretches in zip(batch.column(1), batch.column(2), strict=True):
                text, words, gone = unpack(text.as_py()), None, []
                if stretches.is_valid:
                    words = text.split()
                    change = np.zeros(len(words) + 1, np.int64)
                    first, count = (stretches.values.field(c).to_numpy() for c in ("first", "count"))
                    np.add.at(change, first, 1)
                    np.add.at(change, first + count + window - 1, -1)
                    out = np.cumsum(change[:-1]) > 0
                    edges = np.flatnonzero(np.diff(out.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
                    gone = [{"start": a, "length": b - a} for a, b in edges.tolist()]
                    text = b" ".join([w for w, x in zip(words, out.tolist(), strict=True) if not x])
                n_words.append(len(words) if words is not None else text.count(b" ") + 1 if text else 0)
                n_removed.append(sum(g["length"] for g in gone))
                kept.append(text.decode())
                removed.append(gone)
            yield pa.record_batch(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string()), pa.array(removed, ranges)],
                names=["doc_id", "n_words", "n_removed", "kept", "removed"])

    own_repeats = repeats(docs, window, k).groupBy("doc", "row").agg(own("stretches"))
    rows = packed(docs).join(own_repeats, ["doc", "row"], "left")
    return rows.select("doc_id", "words", "stretches").mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept string, removed array<struct<start: long, length: long>>")
