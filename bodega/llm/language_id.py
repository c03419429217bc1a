"""Language identification by error-correcting output codes.

Each language has a codeword of bits. For every bit a binary classifier on hashed byte n-grams predicts it, and the
language whose codeword has the least loss against all predicted margins wins; bits count by how well their classifier
did. Some wrong bits still leave the right codeword nearest, and a near tie is flagged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bodega.llm import training

#: Length of the feature vector.
BUCKETS = 2048
#: Bits of a codeword at least; more languages get more.
BITS = 15
#: Training rows per language at most, and in all.
SAMPLE_PER_LANGUAGE = 600
SAMPLE = 6000
#: Softmax difference of the best two languages below which a prediction is ambiguous.
AMBIGUOUS = 0.1
UNKNOWN = "und"
FOLDS, HELD_OUT = 4, 2

OUT = "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean"


def features(text: str) -> np.ndarray:
    """Square roots of the shares of hashed byte n-grams (1 to 3) of the lower-cased whole text; length 1."""
    octets = np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)
    total = np.zeros(BUCKETS)
    gram = np.zeros(len(octets), np.uint32)
    for k in range(min(3, len(octets))):
        gram = (gram[:len(octets) - k] << np.uint32(8)) | octets[k:]
        mixed = (gram + np.uint32(k)) * np.uint32(0x9E3779B1)
        total += np.bincount(mixed >> np.uint32(21), minlength=BUCKETS)
    return np.sqrt(total / max(total.sum(), 1)).astype(np.float32)


def codewords(languages: int, bits: int = BITS, tries: int = 400) -> np.ndarray:
    """One row of 0/1 per language. Of deterministic random codes the one with the largest least distance; every bit
    splits the languages."""
    bits = max(bits, 2 * int(np.ceil(np.log2(max(languages, 2)))) + 1)
    rng, best, best_gap = np.random.default_rng(17), None, -1
    for _ in range(tries):
        code = rng.integers(0, 2, (languages, bits))
        if languages > 1:
            for b in np.flatnonzero((code.min(0) == code.max(0))):
                code[rng.integers(languages), b] ^= 1
        gap = min((int((code[i] != code[j]).sum()) for i in range(languages) for j in range(i)), default=0)
        if gap > best_gap:
            best, best_gap = code, gap
    return best


@dataclass(frozen=True)
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    intercepts: np.ndarray
    trust: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, labels: list[str]) -> Model:
        languages = sorted(set(labels))
        code = codewords(max(len(languages), 1))
        if not languages:
            return cls([], code, np.zeros((BUCKETS, code.shape[1])), np.zeros(code.shape[1]), np.ones(code.shape[1]))
        at = {v: i for i, v in enumerate(languages)}
        y = code[[at[v] for v in labels]].astype(np.float32)
        weights, intercepts = training.logistic(x, y, penalty=1e-5)
        margins = x @ weights + intercepts
        loss = np.log1p(np.exp(-np.clip(margins * (2 * y - 1), -30, 30))).mean(0)
        return cls(languages, code, weights, intercepts, 1 / (0.05 + loss))

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the nearest codeword, its softmax share, and the lead over the second."""
        margins = x @ self.weights + self.intercepts
        signs = 2 * self.code - 1
        loss = (np.log1p(np.exp(-np.clip(margins[:, None, :] * signs[None], -30, 30))) * self.trust).sum(2) / self.trust.sum()
        loss *= self.code.shape[1]
        share = np.exp(-(loss - loss.min(1, keepdims=True)))
        share /= share.sum(1, keepdims=True)
        order = np.sort(share, axis=1)
        lead = order[:, -1] - (order[:, -2] if share.shape[1] > 1 else 0)
        return share.argmax(1), order[:, -1], lead


def train(docs: DataFrame) -> Model:
    """Fit on a bounded sample of documents with a language outside the held-out fold; the features are collected."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t.as_py() or "").tobytes() for t in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(found, pa.binary())], names=["lang", "x"])

    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()
                       & (training.fold(F.col("doc_id"), FOLDS) != HELD_OUT)).select("doc_id", "lang", "text")
    languages = rows.select("lang").distinct().count()
    most = min(SAMPLE_PER_LANGUAGE, SAMPLE // max(languages, 1))
    got = training.bounded(rows, "lang", max(most, 1)).select("lang", "text").mapInArrow(run, "lang string, x binary").collect()
    got = sorted((r["lang"], bytes(r["x"])) for r in got)
    x = np.frombuffer(b"".join(b for _, b in got), np.float32).reshape(-1, BUCKETS)
    return Model.fit(x, [v for v, _ in got])


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score, ambiguous.

    A null text and one without any letter is `und` with score 0; so is every text if nothing could be learned. Rows are
    kept as they are; only the text decides.
    """
    import pyarrow as pa

    model = model or train(docs)
    held = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x bits numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in batches:
            n = batch.num_rows
            names, scores, unsure = [UNKNOWN] * n, np.zeros(n), np.ones(n, bool)
            at, found = [], []
            for i, value in enumerate(batch.column(2)):
                text = value.as_py()
                if text and model.languages and any(map(str.isalpha, text)):
                    at.append(i)
                    found.append(features(text))
            if at:
                best, share, lead = model.decode(np.stack(found))
                scores[at], unsure[at] = share, lead < AMBIGUOUS
                for i, k in zip(at, best, strict=True):
                    names[i] = model.languages[k]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores), pa.array(unsure)],
                                  names=["doc_id", "held_out", "lang_pred", "score", "ambiguous"])

    held_out = training.fold(F.col("doc_id"), FOLDS) == HELD_OUT
    return docs.select(F.col("doc_id").cast("long"), held_out.alias("held_out"), "text").mapInArrow(run, OUT)
