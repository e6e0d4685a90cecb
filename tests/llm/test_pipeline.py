"""The pipeline's stages: what each keeps, on awkward rows, with clashing columns and on an empty table."""

import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tripflow.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def folder(text_spark, docs, tmp_path_factory):
    home = tmp_path_factory.mktemp("tables")
    docs.write.parquet(f"{home}/documents.parquet")
    leak = " ".join(f"base{k}" for k in range(20, 34))
    items = text_spark.createDataFrame([(1, leak), (2, None)], "item_id long, text string")
    items.write.parquet(f"{home}/benchmark.parquet")
    return str(home)


def test_stages_are_the_named_ones():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "near_duplicates", "benchmark_decontamination", "personal_data", "byte_bpe",
    ]
    assert {f"op{k}_" for k in range(2, 14)} == {name.partition("_")[0] + "_" for name in QUERIES}
    assert set(ORACLES) <= set(QUERIES)


def test_each_stage(text_spark, docs, clashing, folder):
    language, near, leaks, private, tokens = (stage for _, stage in corpus_pipeline.STAGES)
    for frame in (docs, clashing):
        kept = language(text_spark, frame, folder)
        assert kept.columns == frame.columns
        assert {r["doc_id"] for r in kept.collect()} == {0, 1, 5, 6, 7, 9, 10, 11, None}
        single = near(text_spark, frame, folder)
        assert single.columns == frame.columns
        # 0, 1, 1 and 11 are near copies; 5 and 6 differ in case only; texts without words stay.
        assert sorted(r["doc_id"] if r["doc_id"] is not None else -1 for r in single.collect()) == [-1, 0, 2, 3, 4, 5, 7, 8, 9, 10]
        clean = leaks(text_spark, frame, folder)
        assert clean.columns == frame.columns
        assert not {0, 1, 11} & {r["doc_id"] for r in clean.collect()} and clean.count() == frame.count() - 4
    mail = docs.withColumn("text", F.concat(F.lit("a@b.cc "), "text")).withColumn("n_chars", F.length("text").cast("long"))
    masked = private(text_spark, mail, folder)
    assert masked.columns == docs.columns
    assert masked.where("text not like '[EMAIL] %' or n_chars <> length(text)").isEmpty()
    out = {(r["doc_id"], r["decoded_sha256"]) for r in tokens(text_spark, docs, folder).collect()}
    assert out == {(r["doc_id"], hashlib.sha256((r["text"] or "").encode()).hexdigest()) for r in docs.collect()}


def test_whole_run_and_empty_tables(text_spark, docs, empty, folder):
    got = corpus_pipeline.run(text_spark, folder)
    assert sorted(r["doc_id"] if r["doc_id"] is not None else -1 for r in got.collect()) == [-1, 5, 7, 9, 10]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(text_spark, empty, folder).isEmpty()
