"""SentencePiece encoding and decoding against the library: awkward texts, random texts, whole tables."""

import random
import struct

import pytest
from pyspark.sql import functions as F

from tripflow.llm import pieces

public = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def path():
    return public.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library(path):
    return sentencepiece.SentencePieceProcessor(model_file=path)


@pytest.fixture(scope="module")
def model(path):
    return pieces.Model(pieces.read_model(path))


def ids_of(model, texts):
    return [list(struct.unpack(f"<{len(r) // 4}i", r)) for r in pieces.Encoder(model).encode(texts)]


def made_texts():
    rng = random.Random(4)
    letters = "aàbcdeé  \n\t▁<>0x1中文字日本語😀‍�\x00"
    parts = ["the", "ing", "membre", "s", "er", "tion", "00", "1", "====", "aaaa", "a", "_", "-", "▁", "  "]
    texts = ["", " ", "  ", "   a  b   ", "▁", "a▁b", "<s>", "</s> <unk> <0x0A>", "x" * 5000, "ab" * 3000, " " * 1000, "é" * 100]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 300))) for _ in range(200)]
    texts += ["".join(rng.choice("abcdeinorst") for _ in range(rng.randint(60, 2000))) for _ in range(60)]
    return texts + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 300))) for _ in range(200)]


def test_ids_are_those_of_the_library(model, library):
    texts = made_texts()
    assert ids_of(model, texts) == library.encode(texts, add_eos=True)


def test_a_forgetful_worker_gives_the_same_ids(model, library, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED_BYTES", 0)
    encoder, texts = pieces.Encoder(model), made_texts()[:60]
    for text in [*texts, *texts]:
        (row,) = encoder.encode([text])
        assert list(struct.unpack(f"<{len(row) // 4}i", row)) == library.encode(text, add_eos=True)


def test_merging_all_pairs_of_a_round_equals_merging_one_at_a_time(model):
    """Also where words are longer than LONG, so that pairs are compared within a window only."""
    rng = random.Random(8)
    rank_of = lambda a, b: int(model.rank[model.pair_at(model.symbol_of[[a]], model.symbol_of[[b]])[0]])
    assert rank_of(ord("e"), ord("r")) < pieces.NO_RANK and rank_of(ord("\n"), ord("\n")) == pieces.NO_RANK
    import numpy as np

    for size in (1, 2, 30, 64, 65, 400):
        text = "".join(rng.choice("aeinrst") for _ in range(size))
        now = model.symbol_of[[ord(c) for c in text]]
        merged, places = pieces.merge_rounds(model, now.copy(), np.zeros(size, np.int32))
        plain = now.tolist()
        while len(plain) > 1:
            pairs = model.pair_at(np.array(plain[:-1]), np.array(plain[1:]))
            best = int(np.argmin(model.rank[pairs]))
            if model.rank[pairs[best]] == pieces.NO_RANK:
                break
            plain[best : best + 2] = [int(model.product[pairs[best]])]
        assert merged.tolist() == plain and places[0] == 0


def test_decoding_random_ids(model, library):
    rng = random.Random(6)
    for _ in range(3000):
        ids = [rng.randrange(32000) if rng.random() < 0.5 else rng.randrange(259) for _ in range(rng.randint(0, 20))]
        assert pieces.decoded(model, ids) == library.decode(ids)


def test_tables(text_spark, docs, clashing, empty, path, library):
    encoded = pieces.encode(docs, path, keep=("doc_id", "text"))
    rows = pieces.decode(encoded, path, keep=("doc_id", "text", "ids")).collect()
    assert len(rows) == docs.count()
    for row in rows:
        assert row["ids"] == library.encode(row["text"] or "", add_eos=True)
        assert row["decoded"] == library.decode(row["ids"])
    ids = lambda frame: sorted((tuple(r["ids"]) for r in pieces.encode(frame, path).collect()))
    assert ids(docs) == ids(clashing.withColumn("decoded", F.lit(1)))
    assert pieces.encode(empty, path).isEmpty() and pieces.decode(pieces.encode(empty, path), path).isEmpty()


def test_other_models_are_refused():
    with pytest.raises(ValueError, match="BPE"):
        pieces.Model(b"")
