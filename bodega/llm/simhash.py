"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints of 64 bits link when they differ in at most `distance` bits. The bits are grouped into partitions, bits
that go together in one partition, and each partition i gets a threshold t_i so that the t_i + 1 sum to distance + 1:
two linked fingerprints then differ in at most t_i bits of some partition i. Thresholds may differ; dynamic programming
takes those with the fewest expected probes and candidates, estimated from a bounded sample. Each distinct fingerprint
is looked up under every value within t_i of its own, and what it meets is verified on all bits. The estimate decides
cost only: every allocation finds every link.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bodega.llm import common

BITS = 64
WORDS = 3
DISTANCE = 3
SEED = 42
#: Fingerprints that the bit groups and thresholds are estimated from (the smallest by a hash of the fingerprint).
SAMPLE = 4096
#: Partitions. Two of 32 bits keep candidates rare up to billions of fingerprints.
PARTITIONS = 2


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """A hash per shingle, repeats included: runs of `words` words, or the whole of a shorter text. No words, no shingle."""
    from itertools import repeat

    import xxhash

    cut = (text or "").encode().lower().split()
    if len(cut) <= words:
        shingles = [b" ".join(cut)] if cut else []
    else:
        shingles = list(map(b" ".join, zip(*[cut[i:] for i in range(words)], strict=False)))
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, len(shingles))


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """The 64-bit fingerprint of a text: a bit is 1 if set in over half of its shingles' hashes (repeats included)."""
    hashes = shingle_hashes(text, words)
    if not len(hashes):
        return 0
    octets = hashes.view(np.uint8).reshape(-1, 8)  # little-endian: column 0 has bits 0 to 7
    if len(hashes) < 400:
        counts = np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int64)
    else:
        counts = np.concatenate([np.bincount(octets[:, i], minlength=256) @ OCTET_BITS for i in range(8)])
    return int.from_bytes(np.packbits(counts * 2 > len(hashes), bitorder="little").tobytes(), "little")


OCTET_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprints(docs: DataFrame, words: int = WORDS, keys: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, other long `keys`, fp): fp as a signed 64-bit integer. Null texts are empty; rows are kept as they are."""
    import pyarrow as pa

    names = ["doc_id", *keys, "fp"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), words) for t in batch.column(0)], np.uint64).view(np.int64)
            yield pa.record_batch([*batch.columns[1:], pa.array(found)], names=names)

    rows = docs.select("text", *[F.col(k).cast("long").alias(k) for k in names[:-1]])
    return rows.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def group_bits(sample: np.ndarray, partitions: int = PARTITIONS) -> list[list[int]]:
    """Partitions of the bit positions, equal in size up to one: each is grown by the bit most correlated with it."""
    bits = ((sample[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(float)
    centred = bits - bits.mean(0) if len(bits) else np.zeros((1, BITS))
    spread = np.sqrt((centred ** 2).mean(0))
    scaled = centred / np.where(spread > 0, spread, 1)
    close = np.abs(scaled.T @ scaled) / max(1, len(scaled))
    np.fill_diagonal(close, 0)
    left, out = list(range(BITS)), []
    for k in range(partitions):
        size = -(-len(left) // (partitions - k))
        own = [max(left, key=lambda b: (close[b, left].sum(), -b))]
        left.remove(own[0])
        while len(own) < size:
            best = max(left, key=lambda b: (close[b, own].sum(), -b))
            own.append(best)
            left.remove(best)
        out.append(sorted(own))
    return out


def expected(sample: np.ndarray, bits: list[int], radius: int, distinct: int) -> float:
    """Expected cost per fingerprint of probing a partition within `radius`: probes and the candidates they meet."""
    if radius < 0:
        return 0.0
    probes = sum(comb(len(bits), r) for r in range(radius + 1))
    floor = probes / 2.0 ** len(bits)
    if len(sample) > 1:
        mask = np.uint64(sum(1 << b for b in bits))
        own = sample & mask
        near = sum(int((np.bitwise_count(own[i + 1:] ^ own[i]) <= radius).sum()) for i in range(len(own) - 1))
        floor = max(floor, near / (len(own) * (len(own) - 1) / 2))
    return probes + floor * distinct


def allocate(sample: np.ndarray, groups: list[list[int]], distance: int, distinct: int) -> list[int]:
    """Thresholds, one per partition, with sum(t + 1) = distance + 1 and the least expected cost. -1: not probed."""
    total = distance + 1
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for bits in groups:
        cost = [expected(sample, bits, t - 1, distinct) for t in range(total + 1)]
        new: dict[int, tuple[float, list[int]]] = {}
        for used, (so_far, chosen) in best.items():
            for t in range(total - used + 1):
                option = (so_far + cost[t], [*chosen, t - 1])
                if used + t not in new or option < new[used + t]:
                    new[used + t] = option
        best = new
    return best[total][1]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def masked(fp: Column, bits: list[int]) -> Column:
    return fp.bitwiseAND(F.lit(_signed(sum(1 << b for b in bits))))


def probes(fp: Column, bits: list[int], radius: int) -> Column:
    """All values within `radius` bits of the fingerprint's own value in a partition."""
    flips = [0] + [sum(1 << b for b in c) for r in range(1, radius + 1) for c in combinations(bits, r)]
    values = F.array(*[F.lit(_signed(x)) for x in flips])
    own = masked(fp, bits)
    return F.transform(values, lambda x: own.bitwiseXOR(x))


def links(distinct: DataFrame, distance: int = DISTANCE, partitions: int = PARTITIONS) -> DataFrame:
    """All pairs (a < b) of settled distinct fingerprints (column fp) that differ in at most `distance` bits."""
    n = distinct.count()
    rows = distinct.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()  # at most SAMPLE numbers
    sample = np.array([r["fp"] for r in rows], np.int64).view(np.uint64)
    groups = group_bits(sample, partitions)
    chosen = [(i, b, t) for i, (b, t) in enumerate(zip(groups, allocate(sample, groups, distance, n), strict=True)) if t >= 0]
    fp = F.col("fp")

    def tagged(i: int, values: Column) -> Column:
        return F.transform(values, lambda v: F.struct(F.lit(i).alias("i"), v.alias("v")))

    asked = F.concat(*[tagged(i, probes(fp, b, t)) for i, b, t in chosen])
    held = F.array(*[F.struct(F.lit(i).alias("i"), masked(fp, b).alias("v")) for i, b, _ in chosen])
    left = distinct.select(fp.alias("a"), F.explode(asked).alias("k")).select("a", "k.i", "k.v")
    right = distinct.select(fp.alias("b"), F.explode(held).alias("k")).select("b", "k.i", "k.v")
    return (
        left.join(right, ["i", "v"])
        .filter((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance))
        .select("a", "b").distinct())


def components(edges: DataFrame) -> DataFrame:
    """(vertex, label) for every vertex of settled edges (a, b): label is the smallest vertex reachable.

    Alternating large-star and small-star steps: each links neighbours to a vertex's smallest neighbour, by an aggregate
    per vertex and a join, until nothing changes. Each round is settled.
    """
    edges = common.settle(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    if not edges.limit(1).count():
        return edges.select(F.col("u").alias("vertex"), F.col("v").alias("label"))
    state = None
    while True:
        # Large star: every larger neighbour of u gets u's smallest neighbour (or u).
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        edges = common.settle(
            both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large-star")
        # Small star: every smaller neighbour of u, and u itself, get u's smallest neighbour.
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        joined = edges.join(least, "u")
        edges = common.settle(
            joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        new = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if new == state:
            break
        state = new
    return edges.select(F.col("u").alias("vertex"), F.col("v").alias("label")).union(
        edges.select(F.col("v").alias("vertex"), F.col("v").alias("label"))).distinct()


def component_labels(prints: DataFrame, distance: int = DISTANCE, partitions: int = PARTITIONS) -> DataFrame:
    """(fp, label) for every distinct fingerprint of settled rows: equal labels are one component."""
    distinct = common.settle(prints.select("fp").distinct(), "classes")
    labels = components(common.settle(links(distinct, distance, partitions), "links"))
    labels = labels.select(F.col("vertex").alias("fp"), "label")
    return common.settle(distinct.join(labels, "fp", "left").select("fp", F.coalesce("label", "fp").alias("label")), "labelled")


def near_duplicates(docs: DataFrame, words: int = WORDS, distance: int = DISTANCE, partitions: int = PARTITIONS) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits), component_id, the smallest doc_id reachable over links.

    Texts without words have fingerprint 0 and are linked like any other. A null doc_id is an ordinary row and the
    component_id only where all of a component are null. Equal fingerprints are one vertex, however many rows have it.
    """
    prints = common.settle(fingerprints(docs, words), "fingerprints")
    labels = component_labels(prints, distance, partitions)
    first = prints.groupBy("fp").agg(F.min("doc_id").alias("first")).join(labels, "fp")
    smallest = first.groupBy("label").agg(F.min("first").alias("component_id"))
    ids = labels.join(smallest, "label").select(F.col("fp").alias("_fp"), "component_id")
    return prints.join(ids, F.col("fp") == F.col("_fp")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keyed_rows(docs: DataFrame) -> DataFrame:
    """(_row, doc_id, hash, text): whole rows, told apart by doc_id and a hash of the text."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64("text").alias("hash"), "text")


def row_key() -> Column:
    """What rows are ordered and found by. Null doc_ids come last."""
    return F.struct(F.col("doc_id").isNull().alias("u"), F.col("doc_id").alias("d"), F.col("hash").alias("h"))


def first_rows(keyed: DataFrame, least: DataFrame, names: list[str]) -> DataFrame:
    """The keyed row with the least `key` of each `label`, with the columns `names`; of equal keys, one."""
    kept = least.groupBy("label").agg(F.min("key").alias("key")).select(F.col("key.d").alias("_d"), F.col("key.h").alias("_h"))
    rows = keyed.drop("text").join(kept, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("hash") == F.col("_h")), "left_semi")
    return rows.dropDuplicates(["doc_id", "hash"]).select(*[F.col(f"_row.`{c}`").alias(c) for c in names])


def keep_one(docs: DataFrame, words: int = WORDS, distance: int = DISTANCE, partitions: int = PARTITIONS) -> DataFrame:
    """The rows of `docs`, all columns, of one document per component: the one with the smallest doc_id.

    Null doc_ids come last. Rows are told apart by doc_id and text; of rows equal in both, one stays.
    """
    keyed = keyed_rows(docs)
    prints = common.settle(fingerprints(keyed, words, ("hash",)), "fingerprints")
    least = prints.groupBy("fp").agg(F.min(row_key()).alias("key")).join(component_labels(prints, distance, partitions), "fp")
    return first_rows(keyed, least, docs.columns)
