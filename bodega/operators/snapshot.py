"""Differences between a source and its last snapshot, by row digests.

A load by watermark sees what is new above the mark, not rows that changed or vanished below it. Here the digest of every row is
kept with its key; the next run compares digests, so that only new and changed rows are staged, and vanished ones ended.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bodega.operators.joins import q

NEW, CHANGED, VANISHED = "new", "changed", "vanished"


def row_digest(columns: Sequence[str]) -> list[Column]:
    """Two 64-bit hashes over the columns and over which of them are NULL (a hash alone passes over a NULL)."""
    cells = [*[q(c) for c in columns], *[q(c).isNull() for c in columns]]
    return [F.xxhash64(*cells).alias("_d1"), F.xxhash64(F.lit(1), *cells).alias("_d2")]


def digests(rows: DataFrame, key: Sequence[str], ignore: Sequence[str] = ()) -> DataFrame:
    """The key of each row and the digest of its other columns."""
    watched = [c for c in rows.columns if c not in (*key, *ignore)]
    return rows.select(*[q(k) for k in key], *row_digest(watched))


def difference(rows: DataFrame, known: DataFrame, key: Sequence[str], ignore: Sequence[str] = ()) -> DataFrame:
    """The keys of rows that are new, changed or gone since `known` (digests), with `_state`; unchanged ones are left out.

    Keys and digests alone are joined. `key` must be unique on both sides.
    """
    now = digests(rows, key, ignore).select(*[q(k) for k in key], F.struct("_d1", "_d2").alias("_now"))
    before = known.select(*[q(k) for k in key], F.struct("_d1", "_d2").alias("_before"))
    state = F.when(F.col("_before").isNull(), NEW).when(F.col("_now").isNull(), VANISHED).when(F.col("_now") != F.col("_before"), CHANGED)
    joined = now.join(before, list(key), "full").withColumn("_state", state)
    return joined.filter(F.col("_state").isNotNull()).select(*[q(k) for k in key], "_state")
