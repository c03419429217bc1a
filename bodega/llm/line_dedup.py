"""Reversible line dedup: sharded cuckoo filters of repeated lines, backed by exact reference counts.

The index is a folder of Parquet tables, one version per change:

* ``refs``     one row per (key digest, document) that holds the line: the exact reference table;
* ``counts``   per key: how many documents hold it and the largest of their ids;
* ``filters``  per shard of the key space a cuckoo filter of the keys with at least `min_docs` references.

Inserting documents adds references, deleting takes them away; a key whose count crosses `min_docs` enters or leaves its
shard's filter. A line is tested against the filter first, and only lines that pass are looked up exactly. So the
filter decides no line, and any sequence of insertions and deletions gives what a fresh index of the remaining
documents gives.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bodega.llm import common

MIN_POINTS = 20
MIN_DOCS = 3
#: Keys that a shard of the key space should hold.
SHARD_KEYS = 200_000
#: Filters that are held by every task at once, in bytes; more shards than fit are tested in further rounds.
ROUND_BYTES = 64 << 20
#: Stands for a missing doc_id: such rows count as one document, smaller than all others.
NO_ID = -(1 << 63)

WHITE = common.SPACES.encode()
SLOTS_PER_BUCKET = 4
KICKS = 500


def key_of(line: bytes) -> bytes:
    """A line's key: white space stripped, A-Z lower-cased."""
    return line.strip(WHITE).lower()


def digest_of(key: bytes) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(key)


def long_enough(key: bytes, points: int) -> bool:
    return len(key) >= points and (len(key) >= 4 * points or len(key.decode("utf-8", "replace")) >= points)


class CuckooFilter:
    """16-bit fingerprints in buckets of four; insertion, deletion and test by a 128-bit digest (two integers)."""

    def __init__(self, table: np.ndarray):
        self.table = table
        self.mask = len(table) - 1

    @classmethod
    def for_keys(cls, n: int) -> CuckooFilter:
        """Room for n keys at a load of at most 0.85, in a power of two of buckets."""
        buckets = 1 << max(1, int(np.ceil(np.log2(max(n, 1) / 0.85 / SLOTS_PER_BUCKET))))
        return cls(np.zeros((buckets, SLOTS_PER_BUCKET), np.uint16))

    @staticmethod
    def spread(prints):
        return (prints * np.uint64(0x5BD1E995)) >> np.uint64(7)

    def places(self, h1: np.ndarray, h2: np.ndarray):
        """Fingerprints (never 0) and the two buckets of each digest."""
        prints = (h2 & np.uint64(0xFFFF)) % np.uint64(0xFFFF) + np.uint64(1)
        first = h1 & np.uint64(self.mask)
        second = (first ^ self.spread(prints)) & np.uint64(self.mask)
        return prints.astype(np.uint16), first.astype(np.int64), second.astype(np.int64)

    def test(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        prints, a, b = self.places(h1, h2)
        return (self.table[a] == prints[:, None]).any(1) | (self.table[b] == prints[:, None]).any(1)

    def add(self, h1: np.ndarray, h2: np.ndarray) -> bool:
        """False when no room is found: the caller then builds a larger filter from the exact table."""
        prints, a, b = self.places(h1, h2)
        table, mask, turn = self.table, self.mask, 0
        for p, i, j in zip(prints.tolist(), a.tolist(), b.tolist(), strict=True):
            for bucket in (i, j):
                free = np.flatnonzero(table[bucket] == 0)
                if len(free):
                    table[bucket, free[0]] = p
                    break
            else:
                bucket = i
                for _ in range(KICKS):
                    turn = (turn + 1) % SLOTS_PER_BUCKET
                    table[bucket, turn], p = p, int(table[bucket, turn])
                    bucket = (bucket ^ int(self.spread(np.uint64(p)))) & mask
                    free = np.flatnonzero(table[bucket] == 0)
                    if len(free):
                        table[bucket, free[0]] = p
                        break
                else:
                    return False
        return True

    def remove(self, h1: np.ndarray, h2: np.ndarray) -> None:
        """Take out one fingerprint per digest; each must have been added before."""
        prints, a, b = self.places(h1, h2)
        for p, i, j in zip(prints.tolist(), a.tolist(), b.tolist(), strict=True):
            for bucket in (i, j):
                at = np.flatnonzero(self.table[bucket] == p)
                if len(at):
                    self.table[bucket, at[0]] = 0
                    break

    def to_bytes(self) -> bytes:
        return self.table.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        return cls(np.frombuffer(data, np.uint16).reshape(-1, SLOTS_PER_BUCKET).copy())


def _unsigned(column) -> np.ndarray:
    return np.asarray(column, np.int64).view(np.uint64)


def references(docs: DataFrame, points: int = MIN_POINTS) -> DataFrame:
    """One row (h1, h2, doc) per document row and distinct key of at least `points` code points in it."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, owners = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                keys = {key_of(line) for line in (text.as_py() or "").encode().split(b"\n") if len(line) >= points}
                own = {digest_of(k) for k in keys if long_enough(k, points)}
                digests += own
                owners += [doc] * len(own)
            both = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            yield pa.record_batch([pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(owners, pa.int64())], names=["h1", "h2", "doc"])

    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    return docs.select(doc.alias("doc"), "text").mapInArrow(run, "h1 long, h2 long, doc long")


def counted(refs: DataFrame) -> DataFrame:
    """References per key: n documents, the largest of them."""
    return refs.groupBy("h1", "h2").agg(F.countDistinct("doc").alias("n"), F.max("doc").alias("last"))


def shard_of(shards: int):
    """The shard of a key: the upper bits of its digest."""
    return F.pmod(F.shiftright("h1", 32), F.lit(shards)).cast("int").alias("shard")


@dataclass(frozen=True)
class LineIndex:
    """One version of the index. Changing it gives a new version; the old one stays valid."""

    spark: SparkSession
    refs_path: str
    counts_path: str
    filters_path: str
    shards: int
    points: int = MIN_POINTS
    min_docs: int = MIN_DOCS

    @property
    def refs(self) -> DataFrame:
        return self.spark.read.schema("h1 long, h2 long, doc long").parquet(self.refs_path)

    @property
    def counts(self) -> DataFrame:
        return self.spark.read.schema("h1 long, h2 long, n long, last long").parquet(self.counts_path)

    @property
    def filters(self) -> DataFrame:
        return self.spark.read.schema("shard int, bytes binary").parquet(self.filters_path)

    @classmethod
    def build(cls, docs: DataFrame, points: int = MIN_POINTS, min_docs: int = MIN_DOCS, shards: int | None = None) -> LineIndex:
        """The index of `docs`. Shards are as many as the repeated keys need; keys spread evenly by their digest."""
        spark = docs.sparkSession
        refs, counts, filters = (common.scratch(spark, f"line-{x}") for x in ("refs", "counts", "filters"))
        references(docs, points).write.parquet(refs)
        counted(spark.read.parquet(refs)).write.parquet(counts)
        index = cls(spark, refs, counts, filters, shards or 1, points, min_docs)
        repeated = index.repeated()
        if shards is None:
            index = cls(spark, refs, counts, filters, -(-max(repeated.count(), 1) // SHARD_KEYS), points, min_docs)
        index._fresh_filters(repeated).write.parquet(filters)
        return index

    def repeated(self) -> DataFrame:
        return self.counts.filter(F.col("n") >= self.min_docs)

    def _fresh_filters(self, keys: DataFrame) -> DataFrame:
        import pandas as pd

        def fill(frame: pd.DataFrame) -> pd.DataFrame:
            room = len(frame)
            while True:
                made = CuckooFilter.for_keys(room)
                if made.add(_unsigned(frame["h1"]), _unsigned(frame["h2"])):
                    return pd.DataFrame({"shard": frame["shard"].iloc[:1], "bytes": [made.to_bytes()]})
                room *= 2

        # Groups are the distinct repeated keys of a shard, about SHARD_KEYS by the choice of the number of shards.
        return keys.select("h1", "h2", shard_of(self.shards)).groupBy("shard").applyInPandas(fill, "shard int, bytes binary")

    def _changed_filters(self, crossed: DataFrame, now: DataFrame) -> DataFrame:
        """Filters after the keys of `crossed` (h1, h2, up) entered or left; rebuilt from `now` where one is full."""
        import pandas as pd

        def change(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            up = left[left["up"]]
            down = left[~left["up"]]
            if len(right):
                made = CuckooFilter.from_bytes(right["bytes"].iloc[0])
            else:
                made = CuckooFilter.for_keys(len(up))
            made.remove(_unsigned(down["h1"]), _unsigned(down["h2"]))
            full = not made.add(_unsigned(up["h1"]), _unsigned(up["h2"]))
            shard = int((left if len(left) else right)["shard"].iloc[0])
            return pd.DataFrame({"shard": [shard], "bytes": [None if full else made.to_bytes()]})

        changed = common.settle(
            crossed.select("h1", "h2", "up", shard_of(self.shards)).groupBy("shard")
            .cogroup(self.filters.groupBy("shard")).applyInPandas(change, "shard int, bytes binary"), "line-changed")
        full = changed.filter("bytes is null").select("shard")
        keys = now.filter(F.col("n") >= self.min_docs).select("h1", "h2", shard_of(self.shards)).join(full, "shard", "left_semi")
        return changed.filter("bytes is not null").union(self._fresh_filters(keys))

    def _next(self, refs: DataFrame, touched: DataFrame) -> LineIndex:
        """The version with these references; counts change for the keys of `touched` only."""
        paths = [common.scratch(self.spark, f"line-{x}") for x in ("refs", "counts", "filters")]
        refs.write.parquet(paths[0])
        new_refs = self.spark.read.schema("h1 long, h2 long, doc long").parquet(paths[0])
        keys = common.settle(touched.select("h1", "h2").distinct(), "line-keys")
        new = common.settle(counted(new_refs.join(keys, ["h1", "h2"], "left_semi")), "line-new-counts")
        (self.counts.join(keys, ["h1", "h2"], "left_anti").unionByName(new)).write.parquet(paths[1])
        old = self.counts.join(keys, ["h1", "h2"], "left_semi").select("h1", "h2", (F.col("n") >= self.min_docs).alias("was"))
        crossed = (
            keys.join(old, ["h1", "h2"], "left").join(new.select("h1", "h2", (F.col("n") >= self.min_docs).alias("is")), ["h1", "h2"], "left")
            .select("h1", "h2", F.coalesce("was", F.lit(False)).alias("was"), F.coalesce("is", F.lit(False)).alias("up"))
            .filter("was <> up"))
        index = LineIndex(self.spark, *paths, self.shards, self.points, self.min_docs)
        self._changed_filters(crossed, index.counts).write.parquet(paths[2])
        return index

    def insert(self, docs: DataFrame) -> LineIndex:
        """With `docs` added. A document that is there already counts once."""
        more = common.settle(references(docs, self.points), "line-more")
        return self._next(self.refs.unionByName(more), more)

    def delete(self, doc_ids: DataFrame) -> LineIndex:
        """Without the documents of `doc_ids` (column doc_id)."""
        gone = doc_ids.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc")).distinct()
        lost = common.settle(self.refs.join(gone, "doc", "left_semi"), "line-lost")
        return self._next(self.refs.join(gone, "doc", "left_anti").select("h1", "h2", "doc"), lost)

    def candidates(self) -> DataFrame:
        """References whose key passes its shard's filter: all repeated lines, and a few others.

        Each round holds the filters of as many shards as fit in ROUND_BYTES, and tests the references of those.
        """
        import pyarrow as pa

        spark, out = self.spark, None
        sizes = [(int(r[0]), int(r[1])) for r in self.filters.select("shard", F.octet_length("bytes")).orderBy("shard").collect()]
        rounds: list[list[int]] = []
        room = 0
        for shard, size in sizes:
            if not rounds or room + size > ROUND_BYTES:
                rounds.append([])
                room = 0
            rounds[-1].append(shard)
            room += size
        for own in rounds:
            part = self.filters.filter(F.col("shard").between(own[0], own[-1])).collect()  # at most ROUND_BYTES
            held = spark.sparkContext.broadcast({int(r["shard"]): bytes(r["bytes"]) for r in part})

            def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
                filters: dict[int, CuckooFilter] = {}
                for batch in batches:
                    h1, h2 = _unsigned(batch.column(0)), _unsigned(batch.column(1))
                    shards, hit = batch.column(3).to_numpy(), np.zeros(len(h1), bool)
                    for shard in np.unique(shards):
                        if shard not in filters:
                            filters[shard] = CuckooFilter.from_bytes(held.value[int(shard)])
                        at = np.flatnonzero(shards == shard)
                        hit[at] = filters[shard].test(h1[at], h2[at])
                    yield batch.filter(pa.array(hit)).select(["h1", "h2", "doc"])

            refs = self.refs.select("h1", "h2", "doc", shard_of(self.shards)).filter(F.col("shard").isin(own))
            found = refs.mapInArrow(run, "h1 long, h2 long, doc long")
            out = found if out is None else out.unionByName(found)
        return out if out is not None else self.refs.limit(0)

    def drops(self) -> DataFrame:
        """Per document the digests of the keys that it loses: doc, keys (packed, 16 bytes each).

        A document's keys are at most its own lines.
        """
        lost = (
            self.candidates().join(self.repeated().select("h1", "h2", "last"), ["h1", "h2"])
            .filter("doc <> last"))
        packed = F.struct("h1", "h2")
        return lost.groupBy("doc").agg(F.collect_set(packed).alias("keys"))


COUNTS = ("n_lines", "n_dropped", "kept_sha256")


def clean(docs: DataFrame, index: LineIndex, counts: bool = True) -> DataFrame:
    """All columns of `docs` with `text` without its dropped lines; with `counts` also n_lines, n_dropped and kept_sha256, which
    then stand in place of columns of `docs` of these names.

    A null or empty text is one empty line; a null text stays null if it lost nothing (its sum is that of an empty
    text). Rows with equal doc_id lose the same keys.
    """
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, lost, sums = [], [], [], []
            at = batch.schema.get_field_index("_text")
            keys_at = batch.schema.get_field_index("_keys")
            for value, keys in zip(batch.column(at), batch.column(keys_at), strict=True):
                text = value.as_py()
                raw = (text or "").encode()
                keys = keys.as_py()
                if keys:
                    gone = {k["h1"].to_bytes(8, "little", signed=True) + k["h2"].to_bytes(8, "little", signed=True) for k in keys}
                    lines = raw.split(b"\n")
                    kept = [x for x in lines if len(x) < points or digest_of(key_of(x)) not in gone]
                    counts.append(len(lines))
                    lost.append(len(lines) - len(kept))
                    raw = b"\n".join(kept)
                    text = raw.decode() if len(kept) < len(lines) else text
                else:
                    counts.append(raw.count(b"\n") + 1)
                    lost.append(0)
                texts.append(text)
                sums.append(hashlib.sha256(raw).hexdigest())
            yield pa.record_batch(
                [batch.column(batch.schema.get_field_index("_row")), pa.array(texts, pa.string()), pa.array(counts, pa.int64()),
                 pa.array(lost, pa.int64()), pa.array(sums, pa.string())],
                names=["_row", "_text", "n_lines", "n_dropped", "kept_sha256"])

    points = index.points
    names = docs.columns
    rest = [c for c in names if c != "text"]
    row = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in rest]).alias("_row"), F.col("text").alias("_text"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"))
    marked = row.join(index.drops().withColumnRenamed("keys", "_keys"), "doc", "left").select("_row", "_text", "_keys")
    kind = row.schema["_row"].dataType.simpleString()
    done = marked.mapInArrow(run, f"_row {kind}, _text string, n_lines long, n_dropped long, kept_sha256 string")
    shown = [c for c in names if not (counts and c in COUNTS)]
    own = [(F.col("_text") if c == "text" else F.col(f"_row.`{c}`")).alias(c) for c in shown]
    return done.select(*own, *(COUNTS if counts else ()))
