"""Best-fit packing by patterns: few-document length patterns fitted to the length histogram, residuals best-fit.

Everything that decides is the histogram of lengths, which has at most `capacity` bins however many documents there
are. The plan is a table of intervals: documents of one length, in the order of their numbers, take the places of the
intervals in turn. Assigning a document is a lookup of (length, number).
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bodega.llm import common
from bodega.llm.tokens import encoder

CAPACITY = 4096
END_ID = 1
#: Patterns enumerated for the fit, of each kind; a parameter of the solver's size, not of the data.
PATTERNS = 8_000
STEPS = 300
#: Parts of the fitted counts that are tried; what is not used is packed as residual, with the last part all of it.
SHARES = (1.0, 0.9, 0.75, 0.5, 0.0)
#: Price of a wasted place against a document that the fit misses.
WASTE = 2.0

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@dataclass(frozen=True)
class Patterns:
    """Patterns as rows: up to three lengths (0: none) and how often each occurs in a sequence."""

    lengths: np.ndarray
    times: np.ndarray

    def __len__(self) -> int:
        return len(self.lengths)

    def waste(self, capacity: int) -> np.ndarray:
        return capacity - (self.lengths * self.times).sum(axis=1)


def thinned(rows: np.ndarray, limit: int) -> np.ndarray:
    """At most `limit` rows, taken evenly."""
    return rows[np.linspace(0, len(rows) - 1, min(limit, len(rows))).astype(int)] if len(rows) else rows


def patterns(lengths: np.ndarray, capacity: int, limit: int = PATTERNS) -> Patterns:
    """Patterns of the given lengths, at most `limit` of each kind: pairs, then triples, that fill a sequence to the last place; one
    length with as many of another as fit and one that fills the rest, for short documents; and for every length as many of it as
    fit with the longest that fits the rest, so that no length is without a pattern.

    Where there are more than `limit` of a kind, they are taken evenly; what the fit then misses is packed as residual.
    """
    present = np.zeros(capacity + 1, bool)
    present[lengths] = True
    largest = np.maximum.accumulate(np.where(present, np.arange(capacity + 1), 0))  # the longest of at most so many ids
    rows = [np.array([[capacity, 1, 0, 0, 0, 0]])] if present[capacity] else []

    small = lengths[(lengths * 2 <= capacity) & present[capacity - lengths] & (lengths < capacity)]
    one, none = np.ones_like(small), np.zeros_like(small)
    rows.append(thinned(np.stack([capacity - small, one, small, one, none, none], axis=1), limit))

    triples = [np.zeros((0, 6), int)]
    for a in lengths[lengths * 3 <= capacity]:
        b = lengths[(lengths >= a) & (lengths * 2 <= capacity - a)]
        b = b[present[capacity - a - b]]
        one = np.ones_like(b)
        triples.append(np.stack([capacity - a - b, one, b, one, np.full_like(b, a), one], axis=1))
    rows.append(thinned(np.concatenate(triples), limit))

    filled = [np.zeros((0, 6), int)]
    for a in thinned(lengths[lengths * 2 <= capacity], max(1, limit // 16)):
        b = lengths[lengths * 4 <= capacity - a]
        many = np.where(b > 0, (capacity - a) // np.maximum(b, 1), 0)
        many = many - (np.arange(len(b)) % 2)  # with the most that fit, or one less and a longer rest
        rest = capacity - a - b * many
        fits = present[rest] | (rest == 0)
        b, many, rest = b[fits], many[fits], rest[fits]
        one = np.ones_like(b)
        filled.append(np.stack([np.full_like(b, a), one, b, many, rest, one * (rest > 0)], axis=1))
    rows.append(thinned(np.concatenate(filled), limit))

    many = capacity // lengths
    rest = largest[capacity - many * lengths]
    none = np.zeros_like(lengths)
    rows.append(np.stack([lengths, many, rest, (rest > 0).astype(int), none, none], axis=1))
    found = np.unique(np.concatenate(rows), axis=0)
    return Patterns(found[:, ::2], found[:, 1::2])


def fit_counts(pats: Patterns, histogram: np.ndarray, capacity: int = CAPACITY, steps: int = STEPS) -> np.ndarray:
    """Repeat counts x >= 0 that minimise |A x - histogram|^2 / 2 and a price for wasted places, by accelerated projected gradient steps.

    A has a row per length and a column per pattern; it is used through the patterns' three lengths only.
    """
    if not len(pats):
        return np.zeros(0)
    weight = (pats.times * (pats.lengths > 0)).astype(float)

    def times(x):
        return np.bincount(pats.lengths.ravel(), (weight * x[:, None]).ravel(), len(histogram))

    def back(r):
        return (r[pats.lengths] * weight).sum(axis=1)

    price = WASTE * pats.waste(capacity) / capacity
    v = np.ones(len(pats))
    for _ in range(30):
        v = back(times(v))
        norm = np.linalg.norm(v)
        v /= norm
    step = 1 / (1.05 * norm)
    x = y = np.zeros(len(pats))
    t = 1.0
    for _ in range(steps):
        new = np.maximum(0, y - step * (back(times(y) - histogram) + price))
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


@dataclass
class Plan:
    """Intervals (length, first number, last number + 1, first sequence, documents per sequence, first offset)."""

    capacity: int
    rows: list[tuple[int, int, int, int, int, int]] = field(default_factory=list)
    sequences: int = 0


class _Open:
    """Sequences with room left: per room a list of runs [first sequence, count]."""

    def __init__(self):
        self.rooms: list[int] = []
        self.runs: dict[int, list[tuple[int, int]]] = defaultdict(list)

    def put(self, room: int, first: int, count: int) -> None:
        if count and room:
            if not self.runs[room]:
                insort(self.rooms, room)
            self.runs[room].append((first, count))

    def take(self, least: int) -> tuple[int, int, int] | None:
        """The run with the least room that is enough."""
        at = bisect_left(self.rooms, least)
        if at == len(self.rooms):
            return None
        room = self.rooms[at]
        first, count = self.runs[room].pop()
        if not self.runs[room]:
            self.rooms.pop(at)
        return room, first, count


def make_plan(histogram: dict[int, int], capacity: int, share: float, pats: Patterns, fitted: np.ndarray) -> Plan:
    """The plan for one share of the fitted counts: patterns first, then best fit decreasing for the rest."""
    plan, left, used = Plan(capacity), dict(histogram), defaultdict(int)
    gaps: list[tuple[int, int, int]] = []

    def place(length: int, count: int, first: int, per: int, offset: int) -> None:
        plan.rows.append((length, used[length], used[length] + count, first, per, offset))
        used[length] += count
        left[length] -= count

    for p in np.argsort(-fitted, kind="stable"):
        wanted = int(fitted[p] * share)
        if wanted < 1:
            break
        own = [(int(n), int(k)) for n, k in zip(pats.lengths[p], pats.times[p], strict=True) if n and k]
        needed: dict[int, int] = defaultdict(int)
        for n, k in own:
            needed[n] += k
        times = min(wanted, *(left[n] // k for n, k in needed.items()))
        if times < 1:
            continue
        offset = 0
        for n, k in own:
            place(n, times * k, plan.sequences, k, offset)
            offset += n * k
        # Places that the pattern leaves are open to the residuals.
        if offset < capacity:
            gaps.append((capacity - offset, plan.sequences, times))
        plan.sequences += times

    rest = _Open()
    for room, first, count in gaps:
        rest.put(room, first, count)
    for n in sorted(left, reverse=True):
        while left[n]:
            run = rest.take(n)
            if run is None:
                per = capacity // n
                room, first, count = capacity, plan.sequences, -(-left[n] // per)
                plan.sequences += count
            else:
                room, first, count = run
                per = room // n
            full = min(count, left[n] // per)
            if full:
                place(n, full * per, first, per, capacity - room)
                rest.put(room - per * n, first, full)
            if full < count and left[n]:
                some = left[n]
                place(n, some, first + full, per, capacity - room)
                rest.put(room - some * n, first + full, 1)
                full += 1
            rest.put(room, first + full, count - full)
    return plan


def best_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """The plan with the fewest sequences over the tried shares of the fitted counts."""
    if not histogram:
        return Plan(capacity)
    counts = np.zeros(capacity + 1)
    for n, c in histogram.items():
        counts[n] = c
    pats = patterns(np.array(sorted(histogram)), capacity)
    fitted = fit_counts(pats, counts, capacity)
    least = -(-sum(n * c for n, c in histogram.items()) // capacity)
    best = None
    for share in SHARES:
        plan = make_plan(histogram, capacity, share, pats, fitted)
        if best is None or plan.sequences < best.sequences:
            best = plan
        if best.sequences == least:
            break
    return best


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to settled rows with columns length (1 to capacity) and part.

    One row stays one row; rows of equal length are interchangeable. An empty table gives an empty table.
    """
    import pyarrow as pa

    histogram = {int(r["length"]): int(r["n"]) for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    # Intervals in the order of length and first number: a row's is the last that starts at or before it. Their number depends on
    # the lengths and patterns, not on the documents.
    plan = np.array(sorted(best_plan(histogram, capacity).rows), np.int64).reshape(-1, 6)
    held = pieces.sparkSession.sparkContext.broadcast(plan)
    order = [c for c in ("doc_id", "piece") if c in pieces.columns] or ["length"]
    numbered = common.number_within(pieces, ["length"], order, "_number")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, first, _, sequence, per, offset = held.value.T
        places = length * (1 << 48) + first
        for batch in batches:
            own, number = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "_number"))
            at = np.searchsorted(places, own * (1 << 48) + number, "right") - 1
            inside = number - first[at]
            kept = batch.drop_columns(["_number"])
            yield pa.record_batch([*kept.columns, pa.array(sequence[at] + inside // per[at]), pa.array(offset[at] + inside % per[at] * own)],
                                  names=[*kept.schema.names, "sequence_id", "offset"])

    schema = T.StructType([f for f in numbered.schema if f.name != "_number"]).add("sequence_id", "long").add("offset", "long")
    return numbered.mapInArrow(run, schema)


def cut(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, ids: bool = False) -> DataFrame:
    """Rows of (doc_id, piece, start, length, ids_crc32): a document's ids and `end_id`, cut only beyond `capacity`.

    Null and empty texts have the end id alone. Null and repeated doc_ids are kept, a row each. With `ids`, the packed
    ids come along as column ids (binary, little-endian unsigned 32-bit).
    """
    import pyarrow as pa

    end, width = end_id.to_bytes(4, "little"), 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                packed = encode(text.as_py()) + end
                for k, at in enumerate(range(0, len(packed), width)):
                    piece = packed[at:at + width]
                    rows.append((doc_id, k, at // 4, len(piece) // 4, zlib.crc32(piece), *([piece] if ids else [])))
            columns = list(zip(*rows, strict=True)) if rows else [()] * (5 + ids)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names[:5 + ids])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES + (", ids binary" if ids else ""))


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Every piece of every document with its sequence and place. Texts are tokenized once; no ids are shuffled."""
    pieces = common.settle(cut(docs, tokenizer, capacity, end_id).withColumn("part", F.spark_partition_id()), "pieces")
    return pack(pieces, capacity).drop("part")


def sequences(docs: DataFrame, packed: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (binary), for doc_ids that are unique and not null."""
    import pandas as pd

    def glue(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("offset")
        return pd.DataFrame({"sequence_id": frame["sequence_id"].iloc[:1], "ids": [b"".join(frame["ids"])]})

    pieces = cut(docs, tokenizer, capacity, end_id, ids=True).select("doc_id", "piece", "ids")
    # A sequence has at most `capacity` ids, so a group is small.
    return (packed.join(pieces, ["doc_id", "piece"]).select("sequence_id", "offset", "ids")
            .groupBy("sequence_id").applyInPandas(glue, "sequence_id long, ids binary"))
