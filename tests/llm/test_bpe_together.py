"""New pieces of a batch are encoded together, as arrays."""

import random

import pytest

from tripflow.llm import bpe


@pytest.fixture(scope="module")
def public():
    return pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def vocabulary(public):
    return bpe.Vocabulary(bpe.load_ranks(public.path("byte_bpe_multi_50k.tiktoken")))


def made_texts():
    rng, letters = random.Random(7), "aaabehiinngrstth éüß漢字🎉'\n  01.,*"
    return [None, "", *("".join(rng.choice(letters) for _ in range(rng.randint(1, 90))) for _ in range(400))]


def test_a_batch_is_encoded_as_plain_merging_would(public, vocabulary, monkeypatch):
    texts = made_texts()
    encoder = bpe.Encoder(vocabulary, public.PATTERN)
    plain = [[i for p in encoder.split(t or "") for i in vocabulary.merged(p.encode())] for t in texts]
    alone = []
    monkeypatch.setattr(bpe.PrefixTable, "append", lambda self, data, f=bpe.PrefixTable.append: alone.append(data) or f(self, data))
    ids = encoder.encode(texts)
    assert [bpe.np.frombuffer(x, "<u4").tolist() for x in ids] == plain
    # Only long pieces go one by one.
    assert all(len(data) > bpe.SHORT_PIECE_BYTES for data in alone)


def test_pairs_that_meet_in_memory_and_ranks_with_gaps(public, vocabulary):
    # Ranks far apart, and so small a memory of pairs that they drive each other out.
    ranks = {token: 5 + 7 * rank for token, rank in vocabulary.ranks.items()}
    other = bpe.Vocabulary(ranks)
    other.tables.pairs = bpe.np.full(4, -1, bpe.np.int64)
    texts = made_texts()
    some = [bpe.np.frombuffer(x, "<u4").tolist() for x in bpe.Encoder(other, public.PATTERN).encode(texts)]
    same = [bpe.np.frombuffer(x, "<u4").tolist() for x in bpe.Encoder(vocabulary, public.PATTERN, share=0.01).encode(texts)]
    assert some == [[5 + 7 * i for i in x] for x in same]
