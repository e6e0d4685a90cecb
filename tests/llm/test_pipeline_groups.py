"""Stages of the pipeline on groups and texts that the small documents do not hold."""

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def texts(name, n=30):
    return " ".join(f"{name}{k}" for k in range(n))


def test_groups_that_share_an_id_or_have_none_each_keep_a_document(text_spark):
    rows = [
        (None, texts("a")), (None, texts("a")), (None, texts("b")), (None, texts("b") + " more"), (None, texts("c")),
        # Two unrelated texts under one id, the smallest of each group; one of them has a near copy.
        (1, texts("d")), (1, texts("e")), (2, texts("e") + " more"),
        # A row without an id beside one with an id.
        (None, texts("f")), (7, texts("f") + " more"),
    ]
    frame = text_spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], SCHEMA).repartition(3)
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates(text_spark, frame, "").collect()]
    assert sorted(t[0] for _, t in got) == ["a", "b", "c", "d", "e", "f"]
    assert {(i, t[0]) for i, t in got} == {(None, "a"), (None, "b"), (None, "c"), (1, "d"), (1, "e"), (7, "f")}


def test_texts_without_n_grams_keep_their_place(text_spark):
    rows = [(k, "the cat and the dog went over the hill to the sea", "en") for k in range(30)]
    rows += [(50, "A.", "en"), (51, " b ", "en"), (52, "é", "fr"), (60, "12 .", "en"), (61, "", "en"), (62, None, "en")]
    rows += [(70, "qqxzk wvvjk zzqpx kkjqw xxzvq", None)]
    frame = text_spark.createDataFrame([(i, t, lang, "s", 1) for i, t, lang in rows], SCHEMA)
    kept = corpus_pipeline.language_id(text_spark, frame, "")
    assert kept.columns == frame.columns
    assert {r["doc_id"] for r in kept.collect()} == {*range(30), 50, 51, 52}
