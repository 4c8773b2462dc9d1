"""The corpus pipeline stage by stage on odd, repeated and no documents, and whole."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cohortweave import session
from cohortweave.llm.common import prepare, written

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and very long texts, repeated rows and ids, copies and a benchmark item."""
    long_text = " ".join(f"word{i % 977}" for i in range(40_000))
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    rows = [(1, None, None, None, None), (None, "a text without an id, long enough here", "en", "s", 38), (2, "", "en", None, 0), (None,) * 5]
    rows += [(4, long_text, "en", "s", 9), (4, long_text, "en", "s", 9), (5, f"{long_text} end", "en", "s", 9), (6, f"before {item} after", "en", "s", 9)]
    rows += [(i, f"one line that many documents repeat\nand line {i} of its own", "en", "s", 60) for i in range(10, 14)]
    return prepare(spark).createDataFrame(rows, DOCS)


def test_every_stage_takes_odd_documents_and_none(spark, odd):
    kept = {}
    docs = odd
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, odd.limit(0), SF)
        docs = written(stage(spark, docs, SF), name)
        assert empty.count() == 0 and empty.columns == docs.columns
        if name != "best_fit_packing":
            assert docs.columns == odd.columns
        kept[name] = [r["doc_id"] for r in docs.collect()]
    assert set(kept["line_dedup"]) == set(kept["quality_classifier"])
    assert len([d for d in kept["near_dedup"] if d in (4, 5)]) <= 2 and 5 not in kept["near_dedup"]
    assert 6 in kept["near_dedup"] and 6 not in kept["benchmark_decontamination"]
    assert set(kept["best_fit_packing"]) == set(kept["benchmark_decontamination"])


def test_run_leaves_one_table_per_stage(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_folder", lambda spark: str(tmp_path))
    found = corpus_pipeline.run(spark, SF)
    assert sorted(p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir()) == sorted(n for n, _ in corpus_pipeline.STAGES)
    pieces = found.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0]
    ids = {r["doc_id"] for r in found.select("doc_id").collect()}
    assert pieces <= 1024 and 0 < len(ids) < 200
