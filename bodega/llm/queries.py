"""One query per operator, over its whole table with production parameters, and what SQL can say about them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bodega.llm import (
    decontamination, exact_dedup, language_id, line_dedup, packing, periodic_runs, quality, sharding, simhash, substring_dedup,
    token_alignment, token_files, url_filter,
)
from bodega.llm.common import table

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
SHARDS = 24


def op1_pattern_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), WORD_TOKENIZER)


def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return line_dedup.clean(docs, line_dedup.LineIndex.build(docs)).select("doc_id", "n_lines", "n_dropped", "kept_sha256")


def op3_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, folder, "pages"))


def op4_block_naming(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, folder, "documents"))


def op5_virtual_slots(spark: SparkSession, folder: str) -> DataFrame:
    rows = sharding.shard_documents(table(spark, folder, "documents"), SHARDS)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")


def op6_spaced_seeds(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.overlaps(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op7_language_codes(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.identify(table(spark, folder, "documents"))


def op8_token_frames(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.encode_documents(table(spark, folder, "documents"), BYTE_TOKENIZER)


def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op10_compression_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality.score(docs, quality.train(docs, table(spark, folder, "labels")))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text): a tenth of the documents, by the crc32 of the id, repeat a part of their words to the end.

    A null doc_id has no decimal form; such a text stays as it is.
    """
    h = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    rows = docs.select("doc_id", "text", words.alias("w"), F.expr("crc32(cast(cast(doc_id as long) as string)) div 10").alias("g"))
    rows = rows.withColumn("n", F.size("w")).withColumn("a", F.expr("if(n > 0, g % n, 0)").cast("int"))
    rows = rows.withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    again = F.expr("slice(flatten(array_repeat(slice(w, a + 1, p), cast((n - a) div p + 1 as int))), 1, n - a)")
    planted = F.concat_ws(" ", F.concat(F.expr("slice(w, 1, a)"), again))
    return rows.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


def suffix_runs(docs: DataFrame) -> DataFrame:
    """The contract's digest of the runs in `docs` after planting."""
    rows = periodic_runs.periodic_runs(with_planted_periods(docs))
    best = F.expr("array_min(transform(runs, r -> struct(-r.length as minus, r.start as start, r.period as period)))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    rows = rows.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), lines.alias("lines"), "collapsed")
    length = -F.col("best.minus")
    return rows.select(
        "doc_id", "n_runs", F.col("best.start").alias("start"), length.alias("length"), F.col("best.period").alias("period"),
        F.expr("(1000 * -best.minus) div best.period").alias("exponent_milli"),
        F.sha2(F.col("lines"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"))


def op11_suffix_runs(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_runs(table(spark, folder, "documents"))


def op12_interval_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return token_alignment.align(table(spark, folder, "documents"), BYTE_TOKENIZER, PIECE_MODEL)


def op13_seed_extend(spark: SparkSession, folder: str) -> DataFrame:
    rows = substring_dedup.remove_repeats(table(spark, folder, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_pattern_packing, op2_line_dedup, op3_url_filter, op4_block_naming, op5_virtual_slots, op6_spaced_seeds,
        op7_language_codes, op8_token_frames, op9_simhash, op10_compression_quality, op11_suffix_runs,
        op12_interval_alignment, op13_seed_extend)
}

SPACES = r"[\x20\x09-\x0D]"

ORACLE = {
    "op2_line_dedup": rf"""
        with lines as (
            select doc_id, u.i, u.line,
                   translate(regexp_replace(u.line, '^{SPACES}+|{SPACES}+$', '', 'g'),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
            from (select doc_id, string_split(coalesce(text, ''), chr(10)) as a from documents) d,
                 lateral (select unnest(a) as line, generate_subscripts(a, 1) as i) u),
        repeated as (
            select key, max(doc_id) as last from lines where length(key) >= 20
            group by key having count(distinct doc_id) >= 3),
        marked as (
            select l.*, coalesce(r.last <> l.doc_id, false) as gone from lines l left join repeated r using (key))
        select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
               sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not gone), '')) as kept_sha256
        from marked group by doc_id""",
    "op4_block_naming": rf"""
        with n as (
            select doc_id, length(coalesce(text, '')) as points,
                   regexp_replace(coalesce(text, ''), '{SPACES}', '', 'g') as body from documents),
        k as (
            select *, first_value(doc_id) over (partition by body order by points desc, doc_id) as keep_id,
                   count(*) over (partition by body) as group_size from n)
        select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(body) as text_sha256 from k""",
}
