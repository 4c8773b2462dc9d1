"""Documents to training sequences: five stages, each over all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortweave.llm import decontam, line_dedup, near_dedup, packing, quality
from cohortweave.llm.common import prepare, read_table, written
from cohortweave.session import stage_tables


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    prepare(spark)
    return quality.accepted_documents(docs, read_table(spark, sf_dir, "labels"))


def line_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that later documents repeat."""
    prepare(spark)
    return line_dedup.dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_duplicate_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    prepare(spark)
    return near_dedup.drop_near_duplicates(docs).select(*docs.columns)


def benchmark_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no item of the benchmark."""
    prepare(spark)
    return decontam.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces with their places in sequences."""
    prepare(spark)
    return packing.pack_documents(docs, packing.default_tokenizer())


STAGES = [
    ("quality_classifier", quality_filter),
    ("line_dedup", line_filter),
    ("near_dedup", near_duplicate_filter),
    ("benchmark_decontamination", benchmark_filter),
    ("best_fit_packing", pack),
]

#: SQL cannot express hashed features, sketches or tokens; tests hold stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents that the stages keep.

    Each stage's result is written; the tables written on the way to it go as soon as it is
    there. Nulls, empty and repeated documents are treated as each stage's operator states; an
    empty table gives an empty result.
    """
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with stage_tables(spark) as tables:
            docs = tables.keep(written(stage(spark, docs, sf_dir), name))
    return docs


QUERIES = {"pipeline": run}
ORACLES = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
