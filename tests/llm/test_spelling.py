"""Spelling variants against plain comparison of all words."""

import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from tripflow.llm import spelling

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_apart(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def plain_variants(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(FOLD)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            k = h % len(run)
            counts[run[:k] + run[k + 1 :] if h % 199 == 0 else run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = {w: [v for v in counts if one_apart(w, v)] for w in counts}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[word] = best if best is not None and counts[best] >= 5 * counts[word] else None

    def root(word):
        while form[word] is not None:
            word = form[word]
        return word

    return sorted(
        ((w, form[w], root(w), n, len(near[w]), None if form[w] is None else counts[form[w]]) for w, n in counts.items()), key=repr
    )


def made_docs():
    rng = random.Random(12)
    stems = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(5, 11))) for _ in range(120)]
    stems += ["A" + s for s in stems[:10]] + ["x" * 300, "x" * 299, "x" * 301, "Àbcdef", "Ébcdef", "ab×cd÷e", "abccde", "abcde"]
    weights = [1 / (k + 1) for k in range(len(stems))]
    docs = []
    for k in range(300):
        words = rng.choices(stems, weights, k=60)
        for i, w in enumerate(words):
            if rng.random() < 0.3:
                at = rng.randrange(len(w))
                words[i] = rng.choice([w[:at] + w[at + 1 :], w[:at] + rng.choice("abcdeé") + w[at:], w[:at] + "e" + w[at + 1 :]])
        docs.append((k, " ".join(words)))
    # Chains of forms, and ties of the largest count.
    docs += [(1000, "chained " * 5 + "chainedd " * 100 + "chaineddd " * 700), (1001, "tiedword " * 5 + "tiedwore " * 50 + "tiedwora " * 50)]
    return [*docs, (None, "chained " * 7), (1000, None), (1002, ""), (1000, "chained " * 5)]


def rows_of(frame):
    return sorted((tuple(r) for r in frame.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=repr)


def test_variants(text_spark, empty):
    made = made_docs()
    frame = text_spark.createDataFrame(made, "doc_id long, text string").repartition(5)
    want = plain_variants(made)
    assert len(want) > 300 and sum(r[1] is not None for r in want) > 20 and any(r[1] != r[2] for r in want if r[1])
    assert rows_of(spelling.variants(frame)) == want
    extra = frame.select("*", *[F.lit("z").alias(c) for c in ("word", "n", "near", "shard", "side", "key", "id")])
    assert rows_of(spelling.variants(extra)) == want
    assert spelling.variants(empty).isEmpty()


def test_crowded_keys_are_cut(text_spark, monkeypatch):
    """Shards of four words: every key is crowded, most lengths too."""
    made = made_docs()
    want = plain_variants(made)
    monkeypatch.setattr(spelling, "SHARD_WORDS", 4)
    frame = text_spark.createDataFrame(made, "doc_id long, text string")
    assert rows_of(spelling.variants(frame)) == want


def test_both_halves_and_every_edit():
    rng = random.Random(2)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(6, 8))) for _ in range(900)}
    words |= {"a" * n for n in range(6, 60)}
    words = sorted(words)
    found = []
    for from_start in (True, False):
        found += zip(*spelling.near_words(words, words, from_start), strict=True)
    assert len(found) == len(set(found))
    assert set(found) == {(a, b) for a in words for b in words if one_apart(a, b)}


def test_intervals_that_are_read_and_those_that_try_every_letter(monkeypatch):
    rng = random.Random(3)
    words = sorted({"abc" + "".join(rng.choice("abcdef") for _ in range(rng.randint(3, 5))) for _ in range(600)})
    want = {(a, b) for a in words for b in words if one_apart(a, b)}
    for limit in (0, 10_000):
        monkeypatch.setattr(spelling, "READ_RANKS", limit)
        found = [*zip(*spelling.near_words(words, words, True), strict=True), *zip(*spelling.near_words(words, words, False), strict=True)]
        assert set(found) == want


def test_short_table(text_spark):
    few = text_spark.createDataFrame([(1, "single " * 5), (2, "a b c")], "doc_id long, text string")
    assert rows_of(spelling.variants(few)) == [("single", None, "single", 5, 0, None)]
