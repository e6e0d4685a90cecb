"""What a worker holds for the encoder, while it works and between tasks."""

import pickle
import tracemalloc

import pytest

from tripflow.llm import bpe


def test_sent_vocabulary_is_small_and_pairs_are_given_back():
    public = pytest.importorskip("public_tokenizers")
    vocabulary = bpe.Vocabulary(bpe.load_ranks(public.path("byte_bpe_multi_50k.tiktoken")))
    sent = pickle.dumps(vocabulary)
    tracemalloc.start()
    copy = pickle.loads(sent)
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 30_000_000  # 38 MB while every table had integers and pairs of its own
    for table in ("ranks", "tokens", "size", "reachable", "left_half", "right_half", "joined", "reach", "longest"):
        assert getattr(copy, table) == getattr(vocabulary, table)

    text = "Tokenisation of unfamiliar wordings, wiederholte Zusammensetzungen und so weiter"
    whole, lean = bpe.Encoder(vocabulary, public.PATTERN), bpe.Encoder(copy, public.PATTERN, share=0.25)
    assert whole.ids(text) == lean.ids(text)
    assert copy.apart
    lean.forget()
    assert not copy.apart
    assert whole.ids(text) == lean.ids(text)
