"""Each operator against brute force on documents with nulls, empty and very long texts, ties and repeated rows;
with columns whose names clash; and on an empty table."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tripflow.llm import (
    bpe,
    decontaminate,
    extract,
    jaccard_join,
    langid,
    pii,
    quality,
    suffix_dedup,
    toxicity,
)
from tripflow.llm.components import components

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


# --- toxicity ---


def test_toxicity_learns_words_and_ignores_everything_else(text_spark, docs, clashing, empty):
    rng = random.Random(3)
    words = [f"word{k}" for k in range(200)]
    made = []
    for k in range(400):
        text = [rng.choice(words) for _ in range(rng.randint(5, 80))]
        if k % 4 == 0:
            text.insert(rng.randrange(len(text)), "vile")
        made.append((k, " ".join(text), "en", int(k % 4 == 0)))
    frame = text_spark.createDataFrame(made, "doc_id long, text string, lang string, toxic int")
    train, test = frame.where("doc_id < 300"), frame.where("doc_id >= 300")
    model = toxicity.fit(train.drop("toxic"), train.select("doc_id", "toxic"))
    scored = {r["doc_id"]: r["score"] for r in toxicity.score(test, model).collect()}
    right = sum((scored[k] >= 0.5) == bool(y) for k, _, _, y in made if k >= 300)
    assert right >= 95
    out = toxicity.score(docs, model)
    assert out.count() == docs.count() and out.where("score is null or score < 0 or score > 1").isEmpty()
    assert rows_of(out) == rows_of(toxicity.score(clashing, model))
    assert toxicity.score(empty, model).isEmpty()
    one_class = toxicity.fit(train.drop("toxic"), train.select("doc_id", F.lit(0).alias("toxic")))
    assert {r["score"] for r in toxicity.score(docs, one_class).collect()} == {0.0}
    labels = train.select("doc_id", "toxic")
    # Labels of both classes without documents, and without any labelled document.
    for lacking in (empty, docs.where("doc_id is null"), docs.withColumn("doc_id", F.lit(-1).cast("long"))):
        assert toxicity.score(docs, toxicity.fit(lacking, labels)).where("score <> 0").isEmpty()
    repeated = toxicity.fit(train.drop("toxic").unionByName(train.drop("toxic")), labels.unionByName(labels))
    again = {r["doc_id"]: r["score"] for r in toxicity.score(test, repeated).collect()}
    assert sum((again[k] >= 0.5) == bool(y) for k, _, _, y in made if k >= 300) >= 95
    nothing = toxicity.fit(empty, empty.select("doc_id", F.lit(0).alias("toxic")))
    assert toxicity.score(docs, nothing).where("score <> 0").isEmpty()


def test_gradients_agree_with_differences_in_the_loss():
    rng = np.random.default_rng(0)
    texts = [rng.integers(0, 40, 12).astype(np.int32) for _ in range(60)]
    labels = (np.array([(t == 3).any() for t in texts])).astype(np.int64)
    net = toxicity.train(texts, labels)
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    logits = net.logits(np.concatenate(texts), first)
    assert ((logits > toxicity.best_threshold(logits, labels)) == labels).mean() > 0.95


# --- decontamination ---


def leaks(rows, items, window):
    phrases = {}
    for item, text in items:
        w = PLAIN.findall((text or "").translate(FOLD))
        for k in range(max(1, len(w) - window + 1) if w else 0):
            phrases.setdefault(tuple(w[k : k + window]), set()).add(item)
    out = []
    for doc, text, *_ in rows:
        w = PLAIN.findall((text or "").translate(FOLD))
        hit, found = set(), set()
        for size in {len(p) for p in phrases}:
            for k in range(len(w) - size + 1):
                names = phrases.get(tuple(w[k : k + size]))
                if names:
                    found |= names
                    hit.update(range(k, k + size))
        out.append((doc, len(w), len(hit), sorted(found)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("per_pass", [200_000, 7])
def test_exact_phrases(text_spark, docs, awkward, clashing, empty, per_pass):
    items = [
        ("7", " ".join(f"BASE{k}" for k in range(30, 45))),
        ("12", "One, two!"),
        ("a", None),
        ("b", "..."),
        ("9", " ".join(f"w{k % 97}x{k % 31}" for k in range(50, 75))),
        ("10", "w0x0 w1x1"),
    ]
    test = text_spark.createDataFrame(items, "item_id string, text string")
    for frame in (docs, clashing):
        found = decontaminate.exact_hits(decontaminate.build_index(frame), test, phrases_per_pass=per_pass)
        got = [(r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in found.collect()]
        assert sorted(got, key=repr) == leaks(awkward, items, 10)
    assert decontaminate.exact_hits(decontaminate.build_index(empty), test).isEmpty()
    none = decontaminate.exact_hits(decontaminate.build_index(docs), test.limit(0))
    assert none.where("n_hit > 0 or size(items) > 0").isEmpty() and none.count() == len(awkward)


def test_random_phrases(text_spark):
    rng = random.Random(5)
    rows = [(k, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 60)))) for k in range(60)]
    items = [(str(k), " ".join(rng.choice("abc") for _ in range(rng.randint(0, 14)))) for k in range(25)]
    docs = text_spark.createDataFrame(rows, "doc_id long, text string")
    test = text_spark.createDataFrame(items, "item_id string, text string")
    found = decontaminate.exact_hits(decontaminate.build_index(docs), test, window=6)
    got = [(r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in found.collect()]
    assert sorted(got, key=repr) == leaks(rows, items, 6)


def test_proximity(text_spark):
    rows = [(0, "alpha x x beta"), (1, "alpha x x x x x x beta"), (2, "beta alpha"), (3, "alpha"), (4, None)]
    docs = text_spark.createDataFrame(rows, "doc_id long, text string")
    found = decontaminate.near_matches(decontaminate.build_index(docs), [("q", "Alpha beta")], slop=3)
    assert rows_of(found) == [("q", 0), ("q", 2)]


# --- language ---


def test_language(text_spark, docs, clashing, empty):
    rng = random.Random(1)
    stems = {"en": ["the", "thing", "ation", "ly"], "de": ["ung", "keit", "sch", "über"], "fr": ["eaux", "ç", "oi", "très"]}
    made = []
    for k in range(300):
        lang = ["en", "de", "fr"][k % 3]
        text = " ".join("".join(rng.choice(stems[lang]) for _ in range(rng.randint(1, 3))) for _ in range(20))
        made.append((k, text, lang))
    frame = text_spark.createDataFrame(made, "doc_id long, text string, lang string")
    model = langid.fit(frame.where("doc_id < 200"))
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predict(frame.where("doc_id >= 200"), model).collect()}
    assert all(got[k] == lang for k, _, lang in made if k >= 200)
    out = langid.predict(docs, model)
    assert {r["doc_id"] for r in out.where("lang_pred = 'und'").collect()} == {2, 3, 4, 8}
    assert out.where("score < 0 or score > 1 or score is null").isEmpty()
    assert rows_of(out) == rows_of(langid.predict(clashing, model))
    assert langid.predict(empty, model).isEmpty()
    unlearned = langid.fit(empty)
    assert langid.predict(docs, unlearned).where("lang_pred <> 'und' or score <> 0").isEmpty()


def test_filter_returns_all_languages_of_a_gram():
    hashes, first, _ = langid.gram_hashes(["abcd", ""])
    assert first.tolist() == [0, 3, 3]
    a, b = langid.places(hashes, langid.FILTER_BITS)
    masks = np.zeros(1 << langid.FILTER_BITS, np.uint64)
    for k in (0, 2):
        np.bitwise_or.at(masks, a, np.uint64(1 << k))
        np.bitwise_or.at(masks, b, np.uint64(1 << k))
    model = langid.LanguageFilter(["x", "y", "z"], [masks])
    counts, n, _ = model.counts(["ABCD"])
    assert n.tolist() == [3] and counts[0, 1] == 0 and counts[0, 0] == pytest.approx(3, abs=0.01) == counts[0, 2]


# --- BPE ---


@pytest.fixture(scope="module")
def tokenizer():
    public = pytest.importorskip("public_tokenizers")
    tiktoken = pytest.importorskip("tiktoken")
    path = public.path("byte_bpe_multi_50k.tiktoken")
    ranks = bpe.load_ranks(path)
    plain = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return path, public.PATTERN, bpe.Vocabulary(ranks), plain


def test_bpe_round_trip(docs, awkward, clashing, empty, tokenizer):
    path, pattern, _, plain = tokenizer
    expected = sorted(
        ((d, np.array(plain.encode_ordinary(t or ""), "<u4").tobytes()) for d, t, *_ in awkward), key=repr
    )
    for frame in (docs, clashing):
        ids = bpe.encode(frame, path, pattern)
        assert sorted(((r["doc_id"], bytes(r["ids"])) for r in ids.collect()), key=repr) == expected
        back = sorted(((r["doc_id"], bytes(r["decoded"])) for r in bpe.decode(ids, path).collect()), key=repr)
        assert back == sorted(((d, (t or "").encode()) for d, t, *_ in awkward), key=repr)
    assert bpe.encode(empty, path, pattern).isEmpty()


def test_bpe_appends_and_edits(tokenizer):
    _, pattern, vocabulary, plain = tokenizer
    encoder, rng = bpe.Encoder(vocabulary, pattern), random.Random(2)
    letters = "abehtns é'’lls 012\n\t　漢🎉%*"
    for _ in range(150):
        text = bpe.EditableEncoding(encoder, "".join(rng.choice(letters) for _ in range(rng.randint(0, 60))))
        for _ in range(4):
            old = text.text
            a = rng.randint(0, len(old))
            b = rng.randint(a, min(len(old), a + 6))
            text.edit(a, b, "".join(rng.choice(letters) for _ in range(rng.randint(0, 5))))
            assert text.ids() == plain.encode_ordinary(text.text)
        text.append("'ll do")
        assert text.ids() == plain.encode_ordinary(text.text)


def test_prefix_table(tokenizer):
    _, _, vocabulary, _ = tokenizer
    rng = random.Random(4)
    for _ in range(60):
        data = bytes(rng.choice(b"abetnsh  ing==***") for _ in range(rng.randint(1, 200)))
        table = bpe.PrefixTable(vocabulary, data)
        assert table.ids() == vocabulary.merged(data)
        assert table.ids(len(data) // 2) == vocabulary.merged(data[: len(data) // 2])
        at = rng.randint(0, len(data))
        table.edit(at, min(len(data), at + 3), b"the")
        assert table.ids() == vocabulary.merged(data[:at] + b"the" + data[at + 3 :])
    long_text = b"thing " * 400
    table = bpe.PrefixTable(vocabulary, long_text)
    assert table.edit(10, 11, b"x") < 200 < len(long_text)


# --- personal data ---


def base_spans(text):
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub(r"\D", "", m[0])
        if 16 <= len(digits) <= 19 and pii.luhn(digits):
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub(r"\D", "", m[0])) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(6)
    for _ in range(6000):
        text = "".join(rng.choice("aZ.@_-%+0 19225().é") for _ in range(rng.randint(0, 40)))
        assert [s[:3] for s in pii.find_spans(text) if s[0] in pii.BASE_KINDS] == base_spans(text)


def test_personal_data_of_long_and_odd_texts(docs, awkward, clashing, empty):
    assert pii.find_spans("a" * 300_000 + "1" * 300_000 + "." * 1000) == []
    found = {k for k, *_ in pii.find_spans("IBAN GB82 WEST 1234 5698 7654 32, ssn 123-45-6789, call (663) 555-6869")}
    assert {"iban", "national_id", "phone_local"} <= found
    assert pii.find_spans("GB82 WEST 1234 5698 7654 33, 123-45-6789") == []
    assert pii.masked("to a@b.cc now", pii.find_spans("to a@b.cc now")) == "to [EMAIL] now"
    assert pii.with_spans(docs).count() == len(awkward) == pii.with_spans(clashing).count()
    assert rows_of(pii.mask_documents(docs)) == rows_of(docs)
    assert pii.mask_documents(clashing).columns == clashing.columns
    assert pii.with_spans(empty).isEmpty() and pii.mask_documents(empty).isEmpty()


# --- pages ---


def test_extraction(text_spark):
    page = (
        "<html><head><title>t</title><style>p{}</style></head><body><div class='menu'><a href=/>Home</a></div>"
        "<div id=content><h1>The &eacute;nd</h1><p>A first   paragraph, with text.<p>A <b>second</b> one; it is longer.</p>"
        "<script>var t='</p>';</script><form>Name: <input></form><div class='comments'><p>Nice post, really nice!</p></div>"
        "<p>x</p></div><footer>Imprint, 2020.</footer>"
    )
    text = "The énd\nA first paragraph, with text.\nA second one; it is longer.\nx"
    assert extract.main_text(page) == text
    assert extract.main_text(page[: page.index("<p>x")]) == text[:-2]
    rows = [(1, "u", page), (1, "u", page), (2, None, None), (3, "u", ""), (4, "u", "<p <a \"> '"), (None, "u", "just text, no markup.")]
    pages = text_spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {(r["page_id"], r["text"]) for r in extract.extract(pages).collect()}
    assert (1, text) in got and (2, "") in got and (3, "") in got and (None, "just text, no markup.") in got
    clash = pages.withColumn("text", F.lit("clash")).withColumn("n_chars", F.lit(1))
    assert rows_of(extract.extract(clash)) == rows_of(extract.extract(pages))
    assert extract.extract(pages.limit(0)).isEmpty()
    assert len(extract.main_text("<article>" + "<p>word, word.</p>" * 20_000)) == 20_000 * 12 - 2 + 1


# --- near duplicates ---


def near(rows, percent=75):
    sets = []
    for doc, text, *_ in rows:
        w = SPACED.findall((text or "").translate(FOLD))
        sets.append((doc, {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())))
    group = list(range(len(sets)))

    def top(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                group[max(top(i), top(j))] = min(top(i), top(j))
    names = {}
    for k, (doc, _) in enumerate(sets):
        old = names.get(top(k))
        names[top(k)] = doc if old is None else (old if doc is None else min(old, doc))
    return sorted(((d, len(s), names[top(k)] if s else d) for k, (d, s) in enumerate(sets)), key=repr)


def test_near_duplicates(docs, awkward, clashing, empty):
    for frame in (docs, clashing):
        got = jaccard_join.near_duplicates(frame).select("doc_id", "n_shingles", "component_id")
        assert rows_of(got) == near(awkward)
    assert jaccard_join.near_duplicates(empty).isEmpty()


@pytest.mark.parametrize("columns, block", [(32, 1024), (2, 8)])
def test_near_duplicates_in_large_groups(text_spark, monkeypatch, columns, block):
    """Groups of variants, most pairs of which do not link; with tiny blocks each group spans many of them."""
    monkeypatch.setattr(jaccard_join, "PAIR_COLUMN", columns)
    monkeypatch.setattr(jaccard_join, "BLOCK_ROWS", block)
    monkeypatch.setattr(jaccard_join, "PIVOTS", 3)
    rng = random.Random(8)
    rows = []
    for g in range(4):
        base = [f"g{g}w{k}" for k in range(40)]
        for _ in range(30):
            text = list(base)
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = f"new{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(text)))
    shared = " ".join(f"common{k}" for k in range(20))
    for _ in range(40):
        rows.append((len(rows), shared + " " + " ".join(f"own{rng.randrange(10**6)}" for _ in range(rng.randint(0, 30)))))
    frame = text_spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = jaccard_join.near_duplicates(frame).select("doc_id", "n_shingles", "component_id")
    assert rows_of(got) == near(rows)


def test_overlap_matrix():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, rng.integers(0, 50)).astype(np.uint64)) for _ in range(30)]
    got = jaccard_join.overlaps(sets)
    assert (got == [[len(np.intersect1d(a, b)) for b in sets] for a in sets]).all()


def test_components(text_spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, 101), (102, 101), (7, 7), (200, 150), (150, 200)]
    found = dict(rows_of(components(text_spark.createDataFrame(edges, "a long, b long"))))
    assert found == {**{k: 0 for k in range(41)}, 100: 100, 101: 100, 102: 100, 150: 150, 200: 150}
    assert components(text_spark.createDataFrame([], "a long, b long")).isEmpty()


# --- quality ---


def test_quality(text_spark, docs, awkward, clashing, empty):
    expected = []
    for doc, text, *_ in awkward:
        text = text or ""
        w = SPACED.findall(text)
        at = {}
        for k in range(len(w) - 4):
            at.setdefault(tuple(w[k : k + 5]), []).append(k)
        again = {j for places in at.values() if len(places) > 1 for k in places for j in range(k, k + 5)}
        lines = [x for x in text.split("\n") if SPACED.search(x)]
        n = len(w)
        failed = n < 10 or 100 * len(again) > 20 * n
        symbols = sum(c in "#*$%&|<>" for c in text)
        expected.append((doc, n, sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(again), failed))
    for frame in (docs, clashing.drop("kept").withColumn("kept", F.lit(1))):
        got = quality.judge(frame)
        assert rows_of(got.drop("kept")) == sorted(expected, key=repr)
        assert got.where("kept is null or (base_failed and kept)").isEmpty()
    assert quality.judge(empty).isEmpty()
    # A group's own spread decides: many symbols pass where they are usual.
    rows = [(k, "& " * (k % 20) + "plain words here " * 5, "x", "a", 1) for k in range(400)]
    rows += [(1000 + k, "plain words here and there " + f"n{k} " * 10 + "& " * (15 * (k == 0)), "x", "b", 1) for k in range(400)]
    judged = {r["doc_id"]: r["kept"] for r in quality.judge(text_spark.createDataFrame(rows, docs.schema), quality.Rules(max_repeat_percent=100)).collect()}
    assert not judged[1000]


def test_limits_follow_language_and_source(text_spark, docs):
    """The same ratios, judged by groups in which they are usual and in which they are not; no fixed limit."""
    plain = lambda k: " ".join(f"w{k:03}x{i}" for i in range(20))
    marked = lambda k, n: plain(k) + " #" * n
    rows = [(k, marked(k, k % 8), "xx", "a", 1) for k in range(400)]
    rows += [(1000 + k, marked(k, 4 if k == 7 else 0), "yy", "a", 1) for k in range(400)]
    # A source of few documents borrows the limits of its language.
    rows += [(2000, marked(1, 4), "xx", "b", 1), (2001, marked(1, 4), "yy", "b", 1), (2002, marked(1, 30), "xx", "b", 1)]
    frame = text_spark.createDataFrame(rows, docs.schema)
    fine = quality.sketches(quality.measures(frame))
    limits = {r["lang"]: r["max_symbols"] for r in quality.fences(quality.merge(fine, "lang"), quality.Rules(), "lang").collect()}
    assert limits["xx"] > 30 and limits["yy"] == 0
    judged = {r["doc_id"]: r["kept"] for r in quality.judge(frame).collect()}
    assert judged[4] and not judged[1007] and judged[1008]
    assert judged[2000] and not judged[2001] and not judged[2002]


def test_sketches_merge(text_spark):
    rows = [(k, "word " * 10 + "#" * (k % 7), "en", f"s{k % 3}", 1) for k in range(90)]
    frame = text_spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    measured = quality.measures(frame)
    fine = quality.sketches(measured)
    whole = quality.sketches(measured, ("lang",))
    assert rows_of(quality.merge(fine, "lang")) == rows_of(whole)
    halves = quality.sketches(measured.where("doc_id % 2 = 0")).unionByName(quality.sketches(measured.where("doc_id % 2 = 1")))
    assert rows_of(quality.merge(halves, "lang", "source")) == rows_of(quality.merge(fine, "lang", "source"))


# --- repeated passages ---


def cut(rows, length=100):
    seen, out = set(), []
    docs = sorted(set((-1 if d is None else d, t or "") for d, t, *_ in rows))
    done = {}
    for d, t in docs:
        body, gone = t.encode(), bytearray(len(t.encode()))
        for k in range(len(body) - length + 1):
            piece = body[k : k + length]
            if piece in seen:
                gone[k : k + length] = b"\1" * length
            seen.add(piece)
        kept = bytes(x for x, y in zip(body, gone, strict=True) if not y)
        spans = sum(bool(gone[k]) and (k == 0 or not gone[k - 1]) for k in range(len(gone)))
        done[d, t] = (len(body), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    for d, t, *_ in rows:
        out.append((d, *done[-1 if d is None else d, t or ""]))
    return sorted(out, key=repr)


def digest(frame):
    return frame.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept"))


def test_repeats(docs, awkward, clashing, empty):
    for frame in (docs, clashing):
        assert rows_of(digest(suffix_dedup.remove_repeats(frame))) == cut(awkward)
    assert suffix_dedup.remove_repeats(empty).isEmpty()


@pytest.mark.parametrize("group, shard, portion", [(20_000, 1 << 16, 1 << 20), (20_000, 300, 2000), (1, 1 << 16, 1 << 20)])
def test_repeats_in_shards_and_large_groups(text_spark, monkeypatch, group, shard, portion):
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    monkeypatch.setattr(suffix_dedup, "SHARD", shard)
    monkeypatch.setattr(suffix_dedup, "PORTION", portion)
    rng = random.Random(9)
    passages = ["".join(rng.choice("abcd é") for _ in range(rng.randint(90, 260))) for _ in range(5)] + ["na " * 70, "x" * 240]
    rows = []
    for k in range(60):
        parts = [rng.choice(passages) if rng.random() < 0.5 else "".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 150))) for _ in range(4)]
        rows.append((k, "".join(parts)))
    rows += [(70 + k, rows[5][1]) for k in range(10)]
    frame = text_spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert rows_of(digest(suffix_dedup.remove_repeats(frame))) == cut(rows)


def test_merged_transform_orders_by_prefix():
    rng = np.random.default_rng(2)
    shards = [rng.integers(97, 99, n).astype(np.uint8) for n in (300, 41, 500)]
    place, block = suffix_dedup.merged_blocks(shards)
    whole, base = [], 0
    for s in shards:
        whole += [bytes(np.roll(s, -k))[:100] if len(s) >= 100 else (bytes(np.roll(s, -k)) * 100)[:100] for k in range(len(s))]
        base += len(s)
    ordered = [whole[k] for k in place]
    assert ordered == sorted(whole)
    assert [int(b) for b in block] == list(np.cumsum([0] + [x != y for x, y in zip(ordered[1:], ordered[:-1], strict=True)]))


def test_words_match_the_patterns():
    from tripflow.llm.common import PLAIN_WORD, SPACED_WORD, row_bytes, word_spans

    rng = random.Random(7)
    texts = ["".join(rng.choice("aZ09 \t\n\x0b\x0c\r.é漢@[`{\x7f\x00") for _ in range(rng.randint(0, 30))) for _ in range(300)]
    body, offsets = row_bytes(pa.array([*texts, None], pa.string()))
    for table, pattern in ((SPACED_WORD, SPACED), (PLAIN_WORD, re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))):
        starts, ends, first = word_spans(body, offsets, table)
        for k, text in enumerate(texts):
            own = [bytes(body[a:b]).decode() for a, b in zip(starts[first[k] : first[k + 1]], ends[first[k] : first[k + 1]], strict=True)]
            assert own == pattern.findall(text)
