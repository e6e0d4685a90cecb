"""Language identification with Bloom filters that answer for all languages at once.

One filter of 2^b places holds, at each place, a bitmask of languages (the per-language filters cut into
slices of one bit a place). Looking an n-gram up takes the AND of its places and gives all languages whose texts
contain it. A text counts, per language, how many of its n-grams carry that language's bit; the count is
corrected by the language's false positive rate, and the highest count decides.

N-grams are `NGRAM` characters of lower-cased text where anything but letters is one kind of gap, so word
beginnings and endings are part of them.

Defined results: a null text or one without letters is `und` with score 0, and so is every text when no
language was learned; equal counts go to the language that sorts first; repeated rows get equal results; an
empty table gives an empty table; the added columns are named by the caller (`lang_pred` and `score`), all others come from `keep`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.llm.common import free_name, lean, mix

NGRAM = 4
UNKNOWN = "und"
# The fit reads about so many rows of each language, chosen by a hash of their text.
ROWS_PER_LANGUAGE = 2000
FILTER_BITS = 18
# An n-gram belongs to a language when at least this share of its sampled texts (and two of them) has it.
MIN_TEXT_SHARE = 0.002
SLICE_CHARS = 1 << 18

_letters: list[np.ndarray] = []
_STEP = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)


def letter_table() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def gram_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all n-grams, the first index of each text's (n + 1), and whether each text has a letter."""
    lowered = [" " + t.lower() + " " for t in texts]
    ends = np.cumsum([0, *map(len, lowered)])
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = letter_table()[codes]
    # Of several gap characters in a row one is kept.
    keep = letter.copy()
    keep[:1] = True
    keep[1:] |= letter[:-1]
    keep[ends[:-1]] = True
    kept_before = np.concatenate([[0], np.cumsum(keep)])
    codes = np.where(letter[keep], codes[keep], 0).astype(np.uint64)
    first = kept_before[ends]
    n = max(len(codes) - NGRAM + 1, 0)
    total = np.zeros(n, np.uint64)
    for k in range(NGRAM):
        total += (codes[k : k + n] + np.uint64(1)) * np.uint64(_STEP[k])
    # A text of m characters has m - NGRAM + 1 n-grams; those that run into the next text are dropped.
    sizes = np.maximum(np.diff(first) - NGRAM + 1, 0)
    whole = np.zeros(n + 1, np.int64)
    live = sizes > 0
    np.add.at(whole, first[:-1][live], 1)
    np.add.at(whole, first[:-1][live] + sizes[live], -1)
    inside = np.cumsum(whole[:n]) > 0
    has_letter = np.diff(np.concatenate([[0], np.cumsum(letter)])[ends]) > 0
    return mix(total[inside]), np.concatenate([[0], np.cumsum(sizes)]), has_letter


def places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    low = np.uint64((1 << bits) - 1)
    return (hashes & low).astype(np.int64), ((hashes >> np.uint64(32)) & low).astype(np.int64)


@dataclass
class LanguageFilter:
    languages: list[str]
    # One array of 64-bit masks for every 64 languages.
    slices: list[np.ndarray]
    bits: int = FILTER_BITS
    false_rate: np.ndarray = field(init=False)

    def __post_init__(self):
        count = len(self.languages)
        fill = [float(((self.slices[k // 64] >> np.uint64(k % 64)) & np.uint64(1)).mean()) for k in range(count)]
        self.false_rate = np.minimum(np.array(fill) ** 2, 0.99)
        if count <= 8:
            self.slices = [s.astype(np.uint8) for s in self.slices]

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text and language the corrected n-gram count; the number of n-grams; whether it has a letter."""
        hashes, first, has_letter = gram_hashes(texts)
        a, b = places(hashes, self.bits)
        out = np.zeros((len(texts), len(self.languages)))
        for k in range(len(self.languages)):
            if k % 64 == 0:
                mask = self.slices[k // 64][a] & self.slices[k // 64][b]
            one = mask.dtype.type(1)
            hits = np.concatenate([[0], np.cumsum((mask >> mask.dtype.type(k % 64)) & one, dtype=np.int64)])
            out[:, k] = np.diff(hits[first])
        n = np.diff(first)
        corrected = np.maximum(out - n[:, None] * self.false_rate, 0) / (1 - self.false_rate)
        return np.minimum(corrected, n[:, None]), n, has_letter

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        return self.judged(texts)[:2]

    def judged(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Per text the language, its score, and the number of n-grams that the score is measured on."""
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), np.int64)
        counts, n, has_letter = self.counts(texts)
        best = counts.argmax(axis=1)
        share = np.where(has_letter, counts[np.arange(len(texts)), best] / np.maximum(n, 1), 0.0)
        return [self.languages[k] if ok else UNKNOWN for k, ok in zip(best, has_letter, strict=True)], share, n


def text_slices(texts: list[str | None], limit: int = SLICE_CHARS) -> Iterator[list[str]]:
    part, size = [], 0
    for t in texts:
        if part and size + len(t or "") > limit:
            yield part
            part, size = [], 0
        part.append(t or "")
        size += len(t or "")
    if part:
        yield part


def fit(
    train: DataFrame,
    text: str = "text",
    lang: str = "lang",
    rows_per_language: int = ROWS_PER_LANGUAGE,
    bits: int = FILTER_BITS,
) -> LanguageFilter:
    """Learn from the rows of `train` that have text and language; the driver gets the filter's places only."""
    rows = train.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    rows = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    seen = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).toLocalIterator()}
    languages = sorted(seen)
    size = 1 << bits
    if not languages:
        return LanguageFilter([], [np.zeros(size, np.uint64)], bits)
    scale = 1 << 30
    limits = F.create_map(
        *[F.lit(x) for k in languages for x in (k, min(scale, scale * rows_per_language // seen[k]))]
    )
    sample = rows.where(F.pmod(F.xxhash64("text"), F.lit(scale)) < limits[F.col("lang")])
    place = {k: i for i, k in enumerate(languages)}

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array([place[x] for x in batch.column("lang").to_pylist()], np.int64)
            at = 0
            for part in text_slices(batch.column("text").to_pylist()):
                hashes, first, _ = gram_hashes(part)
                doc = np.repeat(np.arange(len(part)), np.diff(first))
                once = np.unique(np.column_stack([doc.astype(np.uint64), hashes]), axis=0) if len(doc) else None
                if once is not None:
                    own = langs[at : at + len(part)][once[:, 0].astype(np.int64)]
                    for k in np.unique(own).tolist():
                        gram, count = np.unique(once[own == k, 1], return_counts=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(gram), k, np.int32)), pa.array(gram.view(np.int64)), pa.array(count)],
                            ["lang", "gram", "n"],
                        )
                at += len(part)

    least = F.create_map(
        *[
            F.lit(x)
            for k in languages
            for x in (place[k], max(2.0 if seen[k] >= 20 else 1.0, MIN_TEXT_SHARE * min(seen[k], rows_per_language)))
        ]
    )
    known = (
        sample.mapInArrow(lean(grams), "lang int, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= least[F.col("lang")])
    )
    low = F.lit(size - 1).cast("long")
    bit = F.expr("shiftleft(1L, lang % 64)")
    marked = known.select(
        F.floor(F.col("lang") / 64).cast("int").alias("slice"),
        bit.alias("bit"),
        F.explode(
            F.array(F.col("gram").bitwiseAND(low), F.shiftrightunsigned("gram", 32).bitwiseAND(low))
        ).alias("place"),
    )
    # At most one row per slice and place, whatever the input.
    table = marked.groupBy("slice", "place").agg(F.bit_or("bit").alias("mask")).toArrow()
    slices = [np.zeros(size, np.uint64) for _ in range((len(languages) + 63) // 64)]
    which, at, mask = (table.column(c).to_numpy() for c in ("slice", "place", "mask"))
    for k, s in enumerate(slices):
        own = which == k
        s[at[own]] = mask[own].astype(np.int64).view(np.uint64)
    return LanguageFilter(languages, slices, bits)


def predict(
    docs: DataFrame,
    model: LanguageFilter,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    added: tuple[str, ...] = ("lang_pred", "score"),
) -> DataFrame:
    """Columns `keep` and the predicted language and its score, one row per input row.

    With a third name in `added`, also the number of n-grams of the text: a score of 0 on none says nothing.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    # A text that is kept crosses to Python once.
    body = text if text in keep else free_name([*keep, *added], "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores, grams = [], [], []
            for part in text_slices(batch.column(body).to_pylist()):
                some, share, n = shared.value.judged(part)
                langs += some
                scores += share.tolist()
                grams += n.tolist()
            found = [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(grams, pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), *found[: len(added)]],
                [*keep, *added],
            )

    kinds = (T.StringType(), T.DoubleType(), T.LongType())
    schema = T.StructType(
        [*(docs.schema[c] for c in keep), *[T.StructField(a, k) for a, k in zip(added, kinds, strict=False)]]
    )
    given = docs.select(*keep) if text in keep else docs.select(*keep, F.col(text).alias(body))
    return given.mapInArrow(lean(run), schema)
