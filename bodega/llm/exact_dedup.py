"""Exact duplicates by deterministic block naming.

A document's normalised text is cut into fixed-size blocks. Equal blocks get one integer name by sorting; then
adjacent names are paired and the pairs named, until each document is one name. Two documents of the same number of
blocks have the same name only if they are equal character by character: names stand for contents, not for hashes.

Contents travel once, to meet equal contents. After that a block is known by a digest, and by its content where a
digest stands for more than one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bodega.llm import common

BLOCK = 4096
#: The second name of the last, unpaired block of a level. Names start at 0.
NONE = -1


def normalised(text: Column) -> Column:
    """The text without white space; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), common.SPACES, "")


def blocks(content: Column, size: int) -> Column:
    """The text in blocks of `size` characters, cut in one pass; an empty text is one empty block."""
    cut = F.regexp_extract_all(content, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    return F.when(F.size(cut) > 0, cut).otherwise(F.array(F.lit("")))


def digest(block: Column) -> list[Column]:
    return [F.xxhash64(block).alias("h1"), F.xxhash64(F.lit(1), block).alias("h2")]


def name_blocks(docs: DataFrame, size: int) -> DataFrame:
    """The name table: h1, h2, name, content (null unless the digest stands for several contents)."""
    found = docs.select(F.explode(blocks(normalised(F.col("text")), size)).alias("content")).select(*digest(F.col("content")), "content")
    met = found.groupBy("h1", "h2").agg(F.array_sort(F.collect_set("content")).alias("contents"))
    alone = F.size("contents") == 1
    return common.settle(
        met.select("h1", "h2", alone.alias("alone"), F.explode("contents").alias("content"))
        .sortWithinPartitions("content", "h1", "h2")
        .select("h1", "h2", F.when(~F.col("alone"), F.col("content")).alias("content"), F.monotonically_increasing_id().alias("name")),
        "block-names")


def name_pairs(rows: DataFrame) -> DataFrame:
    """One level up: (row, pos, name) with adjacent names paired and each distinct pair named."""
    pairs = rows.groupBy("row", F.floor(F.col("pos") / 2).cast("int").alias("pos")).agg(
        F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("left"),
        F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(NONE)).alias("right"))
    pairs = common.settle(pairs, "pairs")
    names = common.settle(
        pairs.select("left", "right").distinct().sortWithinPartitions("left", "right")
        .withColumn("name", F.monotonically_increasing_id()), "pair-names")
    return pairs.join(names, ["left", "right"]).select("row", "pos", "name")


def identify(docs: DataFrame, size: int = BLOCK) -> DataFrame:
    """One settled row per input row: row, doc_id, n_points, text_sha256, n_blocks, name.

    Rows are equal after normalising exactly if (n_blocks, name) is equal. Null texts are empty; null and repeated
    doc_ids are ordinary rows; an empty table gives an empty one.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    names = name_blocks(docs, size)
    shared = bool(names.filter(F.col("content").isNotNull()).limit(1).count())
    content = normalised(F.col("text"))
    each = F.transform(blocks(content, size), lambda b: F.struct(*digest(b), *([b.alias("content")] if shared else [])))
    narrow = common.settle(
        docs.select("doc_id", F.char_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_points"),
                    F.sha2(content, 256).alias("text_sha256"), each.alias("blocks"))
        .withColumn("row", F.monotonically_increasing_id()),
        "documents-blocks")
    facts = narrow.select("row", "doc_id", "n_points", "text_sha256", F.size("blocks").alias("n_blocks"))
    rows = narrow.select("row", F.posexplode("blocks").alias("pos", "b")).select("row", "pos", "b.*")
    same = (rows.h1 == names.h1) & (rows.h2 == names.h2)
    if shared:
        same = same & (names.content.isNull() | (names.content == rows.content))
    named = common.settle(rows.join(names, same).select("row", "pos", "name"), "named-blocks")

    done = named.join(facts.filter("n_blocks = 1").select("row"), "row").select("row", "name")
    level = named.join(facts.filter("n_blocks > 1").select("row"), "row")
    most = facts.agg(F.max("n_blocks")).first()[0] or 0
    while most > 1:
        most = -(-most // 2)
        level = common.settle(name_pairs(level), "names")
    if level is not None:
        done = done.union(level.select("row", "name"))
    return facts.join(done, "row")


def exact_dedup(docs: DataFrame, size: int = BLOCK) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the most code points in the original text stays, then the smallest doc_id; a null
    doc_id is larger than all others. Of rows repeated whole, the first stays.
    """
    rows = common.settle(identify(docs, size), "identities")
    best = rows.groupBy("n_blocks", "name").agg(
        F.count(F.lit(1)).alias("group_size"),
        F.min(F.struct((-F.col("n_points")).alias("p"), F.col("doc_id").isNull().alias("u"), F.col("doc_id").alias("d"), F.col("row").alias("r"))).alias("best"))
    # Settled, so that the join below reads both sides as they are and a large group of copies is split among tasks.
    best = common.settle(best.select(F.col("n_blocks").alias("_n"), F.col("name").alias("_name"), "group_size", "best"), "kept")
    return (
        rows.join(best, (F.col("n_blocks") == F.col("_n")) & (F.col("name") == F.col("_name")))
        .select("doc_id", F.col("best.d").alias("keep_id"), "group_size",
                (F.col("row") == F.col("best.r")).alias("kept"), "text_sha256")
    )
