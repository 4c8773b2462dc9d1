"""The operators on the driver's tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortweave.llm import (
    bpe,
    chat,
    decontam,
    language_id,
    lexical,
    line_dedup,
    merkle,
    near_dedup,
    packing,
    quality,
    sharding,
    substring_dedup,
    topk,
)
from cohortweave.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_sharding")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(read_table(spark, sf_dir, "documents"), 16)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query("op5_best_fit_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), packing.default_tokenizer())


@query("op6_line_dedup", line_dedup.DEDUP_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", "kept_sha256")


@query("op9_chat_formatting", chat.FORMAT_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(read_table(spark, sf_dir, "conversations"))


@query("op3_near_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))


@query("op10_decontamination", decontam.CONTAMINATED_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query("op7_language_id")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify_held_out(read_table(spark, sf_dir, "documents"))


@query("op8_substring_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.dedup_substrings(read_table(spark, sf_dir, "documents"), with_text=False)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query("op2_exact_top_k", topk.TOP_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_inner_products(read_table(spark, sf_dir, "embeddings"))


@query("op4_quality_classifier")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = (read_table(spark, sf_dir, t) for t in ("documents", "labels"))
    return quality.classify(documents, labels, with_text=False).select("doc_id", "source", "lang", "p_poor", "p_toxic", "accepted")


@query("op13_bpe_encoding_and_decoding")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(read_table(spark, sf_dir, "documents"), bpe.default_tokenizer())


@query("op11_merkle_dataset_manifest", merkle.audit_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(read_table(spark, sf_dir, "documents"), merkle.lower_cased)


@query("op12_ranked_lexical_search", lexical.RANKED_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
