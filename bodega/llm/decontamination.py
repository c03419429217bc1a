"""Benchmark decontamination by spaced seeds, with DataFrame operations only.

Fixed masks select some of a few consecutive tokens and ignore the rest, so a replaced word spoils only the masks that
look at it. Hashes of the selected tokens of all documents meet those of the benchmark; each meeting fixes an alignment of
a document and an item, which is then verified token by token: equal tokens count 1, replaced ones cost `MISMATCH`, and
the best local sum must reach `MIN_SCORE`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bodega.llm import common

#: Selected positions of each mask. Together they meet every stretch of 13 tokens in which any two are replaced.
MASKS = ((0, 1, 2, 3, 4, 5), (0, 1, 2, 4, 6, 7), (0, 1, 4, 8, 9, 10), (0, 1, 3, 4, 7, 8))
MIN_SCORE = 7
MISMATCH = 2
#: Seeds of the benchmark up to which they are broadcast (about 100 bytes each); beyond, both sides are shuffled.
#: A quarter as many alignments are broadcast, too.
BROADCAST_SEEDS = 1_000_000
#: Tokens of a text that are spread out at once.
CHUNK = 2048


def token_hashes(text: Column) -> Column:
    """Hashes of a text's tokens: maximal runs of letters and digits, lower case. Null and empty texts have none."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def sown(rows: DataFrame, keys: list[str], tokens: str) -> DataFrame:
    """A row (keys, i, seed) for every position i of the token array and every mask that fits there.

    The array is cut into chunks, and each position's next few tokens become columns of its row: no row carries an
    array, whatever the length of the text.
    """
    span = max(m[-1] for m in MASKS) + 1
    n = F.size(tokens)
    starts = F.when(n > 0, F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(CHUNK)))
    chunks = rows.select(*keys, tokens, F.explode(starts).alias("_start")).select(
        *keys, "_start", F.slice(F.col(tokens), F.col("_start") + 1, CHUNK + span - 1).alias("_chunk"))
    size = F.least(F.size("_chunk"), F.lit(CHUNK))
    fields = [F.sequence(F.col("_start"), F.col("_start") + size - 1).alias("i")]
    fields += [F.slice("_chunk", k + 1, size).alias(f"h{k}") for k in range(span)]
    wide = chunks.select(*keys, F.inline(F.arrays_zip(*fields)).alias("i", *[f"h{k}" for k in range(span)]))
    found = [
        F.when(F.col(f"h{mask[-1]}").isNotNull(), F.xxhash64(F.lit(number), *[f"h{p}" for p in mask]))
        for number, mask in enumerate(MASKS)
    ]
    return wide.select(*keys, "i", F.explode(F.array(*found)).alias("seed")).filter("seed is not null")


def local_score(tokens: Column, item: Column, shift: Column) -> Column:
    """The best sum over a stretch of the alignment in which token k of the item lies on token shift + k."""
    zero = F.struct(F.lit(0).alias("now"), F.lit(0).alias("best"))

    def step(state: Column, k: Column) -> Column:
        same = F.coalesce(F.get(tokens, shift + k) == F.get(item, k), F.lit(False))
        now = F.greatest(state["now"] + F.when(same, 1).otherwise(-MISMATCH), F.lit(0))
        return F.struct(now.alias("now"), F.greatest(state["best"], now).alias("best"))

    return F.aggregate(F.sequence(F.lit(0), F.size(item) - 1), zero, step, lambda s: s["best"])


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and benchmark item that overlap: doc_id, item_id, score, start (token number)."""
    return matches(docs, benchmark).groupBy("doc_id", "item_id").agg(
        F.max("score").alias("score"), F.max_by("start", F.struct("score", -F.col("start"))).alias("start"))


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The verified alignments: doc_id, text_hash, item_id, score, start.

    An item of fewer tokens than the shortest mask covers is no evidence and matches nothing; one of fewer than MIN_SCORE
    tokens must be met whole. Null texts have no tokens. Documents are told apart by doc_id and a hash of the text;
    null ids are values like others. Empty tables give an empty result.
    """
    keys = ["doc_id", "text_hash"]
    items = benchmark.select("item_id", token_hashes(F.col("text")).alias("item")).filter(F.size("item") > 0).distinct()
    items = common.settle(items.withColumn("item_key", F.xxhash64("item_id", F.to_json("item"))), "benchmark-items")
    planted = common.settle(
        sown(items.select("item_key", "item"), ["item_key"], "item").select("seed", "item_key", F.col("i").alias("j")).distinct(),
        "benchmark-seeds")
    longest = items.agg(F.max(F.size("item"))).first()[0] or 0
    small = planted.count() <= BROADCAST_SEEDS
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    spread = sown(own.select(*keys, token_hashes(F.col("text")).alias("tokens")), keys, "tokens")
    met = spread.join(F.broadcast(planted) if small else planted, "seed")
    # A row per alignment, so that nothing grows with the alignments of one text or the texts of one item.
    aligned = common.settle(
        met.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "item_key", (F.col("i") - F.col("j")).alias("shift")).distinct(),
        "alignments")
    few = aligned.count() <= BROADCAST_SEEDS // 4

    def sent(rows: DataFrame) -> DataFrame:
        return F.broadcast(rows) if few else rows

    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    # A text is read again only where something was met, in chunks that reach an item's length beyond their end.
    texts = own.join(sent(aligned.select("_id", "_hash").distinct()), same, "left_semi")
    tokens = texts.select(*keys, token_hashes(F.col("text")).alias("tokens"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("tokens") - 1, F.lit(0)), F.lit(CHUNK))
    cut = F.transform(starts, lambda start: F.slice("tokens", start + 1, F.lit(CHUNK + longest)))
    chunks = tokens.select(*keys, F.posexplode(cut).alias("number", "chunk"))
    inside = F.greatest("shift", F.lit(0))
    placed = (
        chunks.join(sent(aligned), same & (F.col("number") == F.floor(inside / CHUNK)))
        .select(*keys, "item_key", "shift", F.slice("chunk", inside % CHUNK + 1, F.lit(longest)).alias("window"))
        .join(F.broadcast(items) if small else items, "item_key"))
    scored = placed.select(*keys, "item_id", F.size("item").alias("n"), F.greatest("shift", F.lit(0)).alias("start"),
                           local_score(F.col("window"), F.col("item"), F.least(F.col("shift"), F.lit(0))).alias("score"))
    return scored.filter(F.col("score") >= F.least(F.lit(MIN_SCORE), F.col("n"))).drop("n")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, that overlap with no benchmark item. Rows are told apart by doc_id and text."""
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                         F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("_hash"))
    found = common.settle(matches(docs, benchmark).select(F.col("doc_id").alias("_i"), F.col("text_hash").alias("_h")).distinct(), "contaminated")
    kept = marked.join(found, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_hash") == F.col("_h")), "left_anti")
    return kept.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
