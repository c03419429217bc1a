"""Quality classifier by compression.

Two zstandard dictionaries are built, one from good and one from bad labelled texts. A text is compressed with either,
in chunks so that the dictionaries matter throughout; the difference of the two sizes over their sum is the raw score. A
logistic curve fitted on labelled texts that the dictionaries have not seen makes it a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bodega.llm import common, training

CHUNK = 2048
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
#: Labelled rows per label at most; half of them make the dictionaries, half the calibration.
SAMPLE_PER_LABEL = 2000
#: Bytes of their texts at most, over both labels.
SAMPLE_BYTES = 64 << 20
#: Text bytes that a dictionary is built from at most.
DICTIONARY_INPUT = 8 << 20
THRESHOLD = 0.3
FOLDS, HELD_OUT = 5, 0

OUT = "doc_id long, held_out boolean, score double, predicted int"


def chunks(text: str) -> list[bytes]:
    """The whole text's bytes, cut into chunks."""
    raw = text.encode("utf-8", "replace")
    return [raw[i:i + CHUNK] for i in range(0, len(raw), CHUNK)]


def dictionary(texts: list[str]) -> bytes:
    """A trained dictionary; where there is too little text to train on, the text itself."""
    import zstandard

    pieces, size = [], 0
    for text in texts:
        for c in chunks(text):
            if size < DICTIONARY_INPUT:
                pieces.append(c)
                size += len(c)
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, pieces).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(pieces)[-DICTIONARY_BYTES:]


class Compressor:
    """Compressed sizes with one dictionary."""

    def __init__(self, data: bytes):
        import zstandard

        made = zstandard.ZstdCompressionDict(data) if data else None
        if made is not None:
            made.precompute_compress(level=LEVEL)
        self.compress = zstandard.ZstdCompressor(
            level=LEVEL, dict_data=made, write_content_size=False, write_checksum=False, write_dict_id=False).compress

    def size(self, parts: list[bytes]) -> int:
        return sum(len(self.compress(p)) for p in parts)


def raw_scores(texts: list[str | None], good: Compressor, bad: Compressor) -> np.ndarray:
    """(n, 2): the normalised difference of the compressed sizes, positive where the good dictionary does better, 0 for
    empty texts, which the second marks."""
    out = np.zeros((len(texts), 2))
    for i, text in enumerate(texts):
        if not text:
            out[i, 1] = 1
            continue
        parts = chunks(text)
        a, b = good.size(parts), bad.size(parts)
        out[i, 0] = (b - a) / (a + b)
    return out


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    weights: np.ndarray
    intercept: float
    scale: np.ndarray
    shift: np.ndarray

    def scores(self, texts: list[str | None], pair: tuple[Compressor, Compressor]) -> np.ndarray:
        x = (raw_scores(texts, *pair) - self.shift) / self.scale
        return 1 / (1 + np.exp(-np.clip(x @ self.weights + self.intercept, -30, 30)))

    def compressors(self) -> tuple[Compressor, Compressor]:
        return Compressor(self.good), Compressor(self.bad)

    @classmethod
    def fit(cls, labelled: list[tuple[int, str]]) -> Model:
        """From (label, text). Without both labels the score is the share of label 1, or a half without any."""
        first, second = labelled[::2], labelled[1::2]
        good, bad = (dictionary([t for y, t in first if y == label]) for label in (1, 0))
        y = np.array([y for y, _ in second], float)
        if len(y) < 2 or y.min() == y.max():
            every = [v for v, _ in labelled]
            share = np.clip(np.mean(every), 0.01, 0.99) if every else 0.5
            return cls(good, bad, np.zeros(2), float(np.log(share / (1 - share))), np.ones(2), np.zeros(2))
        x = raw_scores([t for _, t in second], Compressor(good), Compressor(bad))
        shift, scale = x.mean(0), np.where(x.std(0) > 0, x.std(0), 1)
        weights, intercept = training.logistic((x - shift) / scale, y[:, None], penalty=1e-4, steps=500)
        return cls(good, bad, weights[:, 0], float(intercept[0]), scale, shift)


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on a bounded sample of labelled documents outside the held-out fold; their texts are collected.

    At most about SAMPLE_PER_LABEL distinct (doc_id, text) of each label and SAMPLE_BYTES in all, chosen by a hash; a row that
    repeats counts once.
    """
    known = labels.filter(F.col("quality").isin(0, 1) & (training.fold(F.col("doc_id"), FOLDS) != HELD_OUT))
    chosen = training.bounded(known.select("doc_id", "quality"), "quality", SAMPLE_PER_LABEL)
    texts = docs.select("doc_id", "text").filter("text is not null")
    # `chosen` has at most a few thousand rows of two numbers. A repeated doc_id may still bring many texts, so they are chosen from again.
    rows = texts.join(F.broadcast(chosen.distinct()), "doc_id").withColumn("h", F.xxhash64("doc_id", "text"))
    rows = common.settle(rows.groupBy("h", "quality").agg(F.first("text").alias("text")), "labelled")
    sizes = rows.select("h", "quality", F.octet_length("text").alias("n")).orderBy("h", "quality").limit(2 * SAMPLE_PER_LABEL).collect()
    left, taken = SAMPLE_BYTES, []
    for r in sizes:
        if r["n"] <= left:
            taken.append((r["h"], r["quality"]))
            left -= r["n"]
    wanted = docs.sparkSession.createDataFrame(taken, "h long, quality long")
    got = rows.withColumn("quality", F.col("quality").cast("long")).join(F.broadcast(wanted), ["h", "quality"]).collect()
    got = sorted((r["h"], r["text"], int(r["quality"])) for r in got)
    return Model.fit([(y, t) for _, t, y in got])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: doc_id, held_out, score (probability of label 1), predicted (1 if score >= 0.3).

    Null and empty texts get the score that the calibration gives to a text without bytes. Only the text decides.
    """
    import pyarrow as pa

    held = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of DICTIONARY_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = held.value.compressors()
        for batch in batches:
            found = held.value.scores(batch.column(2).to_pylist(), pair)
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(found), pa.array((found >= THRESHOLD).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])

    held_out = training.fold(F.col("doc_id"), FOLDS) == HELD_OUT
    return docs.select(F.col("doc_id").cast("long"), held_out.alias("held_out"), "text").mapInArrow(run, OUT)


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of `docs`, all columns, that the model predicts to be good."""
    import pyarrow as pa

    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = held.value.compressors()
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            yield batch.filter(pa.array(held.value.scores(texts, pair) >= THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
