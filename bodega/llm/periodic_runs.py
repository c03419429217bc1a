"""Periodic runs of words by branching tandem repeats in an enhanced suffix array.

A run is a stretch of words with smallest period q that no neighbouring word extends. Words q apart are equal in it, so
it ends in a square (a part of q words twice in a row) whose next word breaks the period: a branching tandem repeat.

The words of several documents make one sequence, each document in an alphabet of its own and closed by a separator, so
that nothing is shared between documents. Prefix doubling gives the suffix array, its inverse (ISA) and, since the ranks
of every round are kept, the LCP array. Every LCP interval of depth d is split into its children; for the suffixes i of
all children but the largest, ISA[i + d] and ISA[i - d] tell whether the suffix d words on or back is in the interval too,
but in another child: then the words from the earlier of the two are a branching square. Squares are rotated to the left
as far as their period holds, by blocks whose ranks are known; those that meet in one stretch are one run, of the smallest
of their periods. Intervals are found by pointer jumping over the LCP array; there is no tree and no loop over words.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_LENGTH = 6
MIN_EXPONENT = 4
#: Documents are taken together up to this number of words; a longer document is taken alone.
BATCH_WORDS = 1 << 16

RESULT = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def ranks(keys: np.ndarray) -> list[np.ndarray]:
    """Per round k the class of the 2^k keys from each place: how many places start with less. The last has no ties.

    The last key is unique, and so is at least one key of any stretch that could reach beyond the end.
    """
    n = len(keys)
    order = np.argsort(keys, kind="stable")
    rank = np.empty(n, np.int64)
    fresh = np.concatenate([[True], keys[order[1:]] != keys[order[:-1]]])
    starts = np.flatnonzero(fresh)
    rank[order] = starts[np.cumsum(fresh) - 1]
    sizes = np.diff(np.append(starts, n))
    open_ = order[np.repeat(sizes > 1, sizes)]
    out, step = [rank], 1
    while len(open_):
        first = rank[open_]
        both = first * n + rank[open_ + step]
        order = np.argsort(both, kind="stable")
        open_, first, both = open_[order], first[order], both[order]
        at = np.arange(len(open_))
        class_start = np.maximum.accumulate(np.where(np.concatenate([[True], first[1:] != first[:-1]]), at, 0))
        fresh = np.concatenate([[True], both[1:] != both[:-1]])
        starts = np.flatnonzero(fresh)
        sizes = np.diff(np.append(starts, len(open_)))
        own_start = np.repeat(starts, sizes)
        rank = rank.copy()
        rank[open_] = first + own_start - class_start
        out.append(rank)
        open_ = open_[np.repeat(sizes > 1, sizes)]
        step *= 2
    return out


def lcp_array(levels: list[np.ndarray], sa: np.ndarray) -> np.ndarray:
    """lcp[k]: words that suffixes sa[k - 1] and sa[k] share; -1 before the first and after the last suffix."""
    n = len(sa)
    lcp = np.zeros(n + 1, np.int64)
    lcp[0] = lcp[n] = -1
    same = np.flatnonzero(levels[0][sa[1:]] == levels[0][sa[:-1]])
    a, b = sa[same], sa[same + 1]
    shared = np.zeros(len(same), np.int64)
    for k in range(len(levels) - 2, -1, -1):
        shared += (levels[k][a + shared] == levels[k][b + shared]).astype(np.int64) << k
    lcp[same + 1] = shared
    return lcp


def nearest_smaller(lcp: np.ndarray, at: np.ndarray, side: int) -> np.ndarray:
    """For each place of `at`, the nearest place to its left (side -1) or right (+1) with a smaller value."""
    jump = np.arange(len(lcp)) + side
    open_ = at
    while len(open_):
        seen = jump[open_]
        wide = lcp[seen] >= lcp[open_]
        open_ = open_[wide]
        jump[open_] = jump[seen[wide]]
    return jump[at]


def ranges(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All whole numbers of all ranges first..last, and the range that each is from."""
    sizes = last - first + 1
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + first[owner], owner


def branching_squares(sa: np.ndarray, isa: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) of all squares that the next word does not continue."""
    n = len(sa)
    inner = np.flatnonzero(lcp >= 1)
    if not len(inner):
        return inner, inner
    lo, hi = nearest_smaller(lcp, inner, -1), nearest_smaller(lcp, inner, 1) - 1
    order = np.argsort(lo * (n + 1) + hi, kind="stable")
    inner, lo, hi = inner[order], lo[order], hi[order]
    opens = np.concatenate([[True], (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])])
    # An interval's children: from lo to the first boundary, between boundaries, from the last one to hi.
    closes = np.append(opens[1:], True)
    child_first = np.concatenate([lo[opens], inner])
    child_last = np.concatenate([inner[opens] - 1, np.where(closes, hi, np.append(inner[1:], 0) - 1)])
    interval = np.cumsum(opens) - 1
    owner = np.concatenate([np.arange(interval[-1] + 1), interval])
    low, high, depth = lo[opens][owner], hi[opens][owner], lcp[inner[opens]][owner]
    order = np.lexsort((child_last - child_first, owner))
    smaller = order[:-1][owner[order[:-1]] == owner[order[1:]]]  # all but the largest child of each interval
    place, child = ranges(child_first[smaller], child_last[smaller])
    child = smaller[child]
    low, high, depth, own_low, own_high = low[child], high[child], depth[child], child_first[child], child_last[child]
    i = sa[place]

    def in_other_child(suffix: np.ndarray) -> np.ndarray:
        r = isa[suffix]
        return (r >= low) & (r <= high) & ((r < own_low) | (r > own_high))

    on = in_other_child(i + depth)
    back = (i >= depth) & in_other_child(np.maximum(i - depth, 0))
    return np.concatenate([i[on], (i - depth)[back]]), np.concatenate([depth[on], depth[back]])


def find_runs(keys: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of the runs of a sequence whose documents have keys of their own and end in a unique one."""
    levels = ranks(keys)
    isa = levels[-1]
    sa = np.empty(len(isa), np.int64)
    sa[isa] = np.arange(len(isa))
    at, period = branching_squares(sa, isa, lcp_array(levels, sa))
    moved = np.zeros(len(at), np.int64)
    for k in range(len(levels) - 2, -1, -1):  # rotate to the left by blocks of 2^k words
        before = at - moved - (1 << k)
        seen = np.maximum(before, 0)
        moved += ((before >= 0) & (levels[k][seen] == levels[k][seen + period])).astype(np.int64) << k
    start, end = at - moved, at + 2 * period
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    first = np.ones(len(start), bool)  # of the squares of one stretch, the one with the smallest period
    first[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    long = first & (end - start >= np.maximum(min_length, min_exponent * period))
    start, end, period = start[long], end[long], period[long]
    order = np.lexsort((period, start))
    return start[order], (end - start)[order], period[order]


def runs_of(documents: list[list[bytes]], min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT
            ) -> tuple[list[list[dict[str, int]]], list[list[bytes]]]:
    """Per document its runs (by start, then period) and the words left when of each run only the first period stays."""
    number = defaultdict(count(1).__next__)
    sizes = np.array([len(d) for d in documents], np.int64)
    ends = np.cumsum(sizes + 1) - 1  # the places of the separators
    begins = ends - sizes
    keys = np.zeros(int(ends[-1]) + 1, np.int64)
    for b, e, words in zip(begins.tolist(), ends.tolist(), documents, strict=True):
        keys[b:e] = list(map(number.__getitem__, words))
    keys += np.repeat(np.arange(len(documents)), sizes + 1) * (len(number) + 1)
    start, length, period = find_runs(keys, min_length, min_exponent)
    found: list[list[dict[str, int]]] = [[] for _ in documents]
    kept = list(documents)
    if len(start):
        change = np.zeros(len(keys) + 1, np.int64)
        np.add.at(change, start + period, 1)
        np.add.at(change, start + length, -1)
        stays = np.cumsum(change) == 0
        owner = np.searchsorted(begins, start, "right") - 1
        for d, s, n, q in zip(owner.tolist(), (start - begins[owner]).tolist(), length.tolist(), period.tolist(), strict=True):
            found[d].append({"start": s, "length": n, "period": q})
        for d in np.unique(owner).tolist():
            kept[d] = [w for w, stay in zip(documents[d], stays[begins[d]:ends[d]].tolist(), strict=True) if stay]
    return found, kept


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """Per row: doc_id, its runs of at least `min_length` words and `min_exponent` periods, and the collapsed text.

    Words are what stands between white space (space, tab to carriage return). A run's words after its first period are
    dropped from the collapsed text, whose words are joined by one space. A text that is null, empty or white space has
    no runs and an empty collapsed text. Null and repeated doc_ids are ordinary rows, other columns are not read, and an
    empty table gives an empty one. Each text is worked on where it is read: nothing is shuffled.
    """
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

        def done(ids: list, words: list[list[bytes]]) -> pa.RecordBatch:
            found, kept = runs_of(words, min_length, min_exponent)
            texts = [b" ".join(k).decode() for k in kept]
            return pa.record_batch([pa.array(ids, pa.int64()), pa.array(found, kinds), pa.array(texts, pa.string())],
                                   names=["doc_id", "runs", "collapsed"])

        for batch in batches:
            ids, words, total = [], [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = (text.as_py() or "").encode().split()
                if words and total + len(own) > BATCH_WORDS:
                    yield done(ids, words)
                    ids, words, total = [], [], 0
                ids.append(doc_id)
                words.append(own)
                total += len(own)
            if words:
                yield done(ids, words)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(run, RESULT)
