"""Finding test phrases in training texts with a positional inverted index.

The index is cut by documents: a segment holds the sorted terms of a few megabytes of text and, for each term, the
ascending positions of its occurrences. A frequent term is thereby spread over all segments, building needs no
shuffle, and a phrase never crosses segments. The index is a stored table and can be searched again.

A phrase is searched from its rarest term in the segment: that term's positions, moved back by its place in the
phrase, are the candidates; the lists of the other terms, rarest first, are intersected with them.

Terms are words of digits, ASCII letters (lower case) and characters beyond ASCII, kept as 64-bit hashes.

Defined results: a null or empty text has no words and no hits; test items without words have no phrases; a null
item id is named by the empty string; repeated rows are reported as often as they occur; an empty table of either
kind gives no hits; columns other than id and text are ignored, so no name can clash.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import FOLD, PLAIN_WORD, RangeHash, lean, row_bytes, sliced, stored, word_spans

WINDOW_WORDS = 10
SEGMENT_BYTES = 1 << 20
# Test phrases searched in one pass over the index; a larger test set takes several passes.
PHRASES_PER_PASS = 200_000
# Candidate positions held at once within a segment.
CANDIDATES = 1 << 20

INDEX_SCHEMA = (
    "segment long, doc_ids array<long>, text_keys array<long>, first binary, terms binary, starts binary, positions binary"
)
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
HIT_SCHEMA = (
    "segment long, place int, doc_id long, text_key long, n_words long, n_hit long, "
    "runs array<struct<start:long,end:long>>, items array<string>"
)


def terms_of(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, first = word_spans(body, offsets, PLAIN_WORD)
    return RangeHash(body, FOLD)(starts, ends), first


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The stored index: one row per segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        segment = (context.partitionId() if context else 0) << 32
        for batch in batches:
            for part in sliced(batch, "text", SEGMENT_BYTES):
                hashes, first = terms_of(*row_bytes(part.column("text")))
                order = np.argsort(hashes, kind="stable")
                ordered = hashes[order]
                opens = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(ordered) else np.empty(0, np.int64)
                one = lambda x: pa.array([x.tobytes()], pa.binary())
                whole = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([segment], pa.int64()),
                        whole(part.column("doc_id").cast(pa.int64())),
                        whole(part.column("text_key").cast(pa.int64())),
                        one(first.astype("<i8")),
                        one(ordered[opens].astype("<u8")),
                        one(np.append(opens, len(ordered)).astype("<i8")),
                        one(order.astype("<i4")),
                    ],
                    ["segment", "doc_ids", "text_keys", "first", "terms", "starts", "positions"],
                )
                segment += 1

    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    keyed = narrow.withColumn("text_key", F.xxhash64("text"))
    return stored(keyed.mapInArrow(lean(run), INDEX_SCHEMA), "index")


@dataclass
class Segment:
    first: np.ndarray
    terms: np.ndarray
    starts: np.ndarray
    positions: np.ndarray

    def __post_init__(self):
        self.n = int(self.first[-1])
        counts = np.diff(self.starts)
        # (term, position) as one ascending number: membership in any term's list is one binary search.
        self.packed = np.repeat(np.arange(len(self.terms), dtype=np.int64), counts) * max(self.n, 1) + self.positions

    def lists(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each hash its place among the terms (-1: absent) and the length of its list."""
        if not len(self.terms):
            return np.full(len(hashes), -1), np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        found = self.terms[at] == hashes
        return np.where(found, at, -1), np.where(found, self.starts[at + 1] - self.starts[at], 0)

    def has(self, term: np.ndarray, position: np.ndarray) -> np.ndarray:
        if not self.n or not len(position):
            return np.zeros(len(position), bool)
        wanted = term * self.n + position
        at = np.minimum(np.searchsorted(self.packed, wanted), len(self.packed) - 1)
        return (self.packed[at] == wanted) & (position >= 0) & (position < self.n)

    def doc_of(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, position, side="right") - 1

    def expand(self, term: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(index into `term`, position) of all listed positions, in bounded portions."""
        counts = self.starts[term + 1] - self.starts[term]
        ends = np.cumsum(counts)
        for low in range(0, int(ends[-1]) if len(ends) else 0, CANDIDATES):
            k = np.arange(low, min(low + CANDIDATES, int(ends[-1])))
            owner = np.searchsorted(ends, k, side="right")
            yield owner, self.positions[self.starts[term[owner]] + k - (ends[owner] - counts[owner])].astype(np.int64)


def find_phrases(segment: Segment, vocabulary: np.ndarray, phrases: np.ndarray, sizes: np.ndarray):
    """(phrase, start) of all exact occurrences. `phrases`: places in `vocabulary`, -1 beyond a phrase's size."""
    place, count = segment.lists(vocabulary)
    lengths = np.where(phrases >= 0, count[phrases], np.iinfo(np.int64).max)
    alive = np.flatnonzero((lengths > 0).all(axis=1) & (sizes > 0))
    rarest_first = np.argsort(lengths[alive], axis=1, kind="stable")
    found_phrase, found_start = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    pivot = rarest_first[:, 0]
    for owner, position in segment.expand(place[phrases[alive, pivot]]):
        start = position - pivot[owner]
        for k in range(1, phrases.shape[1]):
            offset = rarest_first[owner, k]
            term = phrases[alive[owner], offset]
            good = (term < 0) | segment.has(place[term], start + offset)
            owner, start = owner[good], start[good]
        last = start + sizes[alive[owner]] - 1
        inside = (start >= 0) & (last < segment.n)
        owner, start, last = owner[inside], start[inside], last[inside]
        same = segment.doc_of(start) == segment.doc_of(last)
        found_phrase.append(alive[owner[same]])
        found_start.append(start[same])
    return np.concatenate(found_phrase), np.concatenate(found_start)


def find_near(segment: Segment, wanted: np.ndarray, slop: int) -> np.ndarray:
    """Documents (by place) where every wanted term lies within `slop` words of one occurrence of the rarest."""
    place, count = segment.lists(np.unique(wanted))
    if not len(place) or (count == 0).any():
        return np.empty(0, np.int64)
    order = np.argsort(count, kind="stable")
    out = [np.empty(0, np.int64)]
    for _, pivot in segment.expand(place[order[:1]]):
        doc = segment.doc_of(pivot)
        low, high = np.maximum(pivot - slop, segment.first[doc]), np.minimum(pivot + slop, segment.first[doc + 1] - 1)
        good = np.ones(len(pivot), bool)
        for term in place[order[1:]]:
            at = np.searchsorted(segment.packed, term * segment.n + low)
            hit = segment.packed[np.minimum(at, len(segment.packed) - 1)]
            good &= (at < len(segment.packed)) & (hit <= term * segment.n + high)
        out.append(np.unique(doc[good]))
    return np.unique(np.concatenate(out))


@dataclass
class Phrases:
    """One pass worth of test phrases: every window of `WINDOW_WORDS` words, short items whole."""

    items: list[str]
    owner: np.ndarray
    sizes: np.ndarray
    vocabulary: np.ndarray
    words: np.ndarray


def _phrase_block(rows: list[tuple[str, np.ndarray]], window: int) -> Phrases:
    items, owner, grams = [], [], []
    for item, words in rows:
        for k in range(max(1, len(words) - window + 1)):
            owner.append(len(items))
            grams.append(words[k : k + window])
        items.append(item)
    sizes = np.array([len(g) for g in grams], np.int64)
    vocabulary, codes = np.unique(np.concatenate(grams), return_inverse=True)
    table = np.full((len(grams), window), -1, np.int64)
    table[np.arange(window)[None, :] < sizes[:, None]] = codes
    # The same phrase of the same item need not be searched twice.
    keyed = np.unique(np.column_stack([np.array(owner), sizes, table]), axis=0)
    return Phrases(items, keyed[:, 0], keyed[:, 1], vocabulary, keyed[:, 2:])


def phrase_blocks(test: DataFrame, item_id: str, text: str, window: int, limit: int) -> Iterator[Phrases]:
    """The test set in blocks of about `limit` phrases; only one block is on the driver at a time."""
    rows, count = [], 0
    for item, value in test.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")), F.col(text)).toLocalIterator():
        words, _ = terms_of(*row_bytes(pa.array([value], pa.string())))
        # An item of very many words is cut; neighbours share window - 1 words, so no phrase is lost.
        step = max(1, limit)
        for k in range(0, max(len(words) - window + 1, 1) if len(words) else 0, step):
            part = words[k : k + step + window - 1]
            rows.append((item, part))
            count += max(1, len(part) - window + 1)
            if count >= limit:
                yield _phrase_block(rows, window)
                rows, count = [], 0
    if rows:
        yield _phrase_block(rows, window)


def _merge_runs(starts: np.ndarray, ends: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    change = np.bincount(starts, minlength=n + 1) - np.bincount(ends, minlength=n + 1)
    covered = np.concatenate([[False], np.cumsum(change)[:n] > 0, [False]])
    edge = np.flatnonzero(covered[1:] != covered[:-1])
    return edge[::2], edge[1::2]


def _search(index: DataFrame, phrases: Phrases) -> DataFrame:
    block = index.sparkSession.sparkContext.broadcast(phrases)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = block.value
        for batch in batches:
            for row in batch.to_pylist():
                seg = Segment(*(np.frombuffer(row[c], t) for c, t in zip(("first", "terms", "starts", "positions"), ("<i8", "<u8", "<i8", "<i4"), strict=True)))
                which, start = find_phrases(seg, p.vocabulary, p.words, p.sizes)
                yield _hits_of(row, seg, p, which, start)

    return index.mapInArrow(lean(run), HIT_SCHEMA)


def _hits_of(row: dict, seg: Segment, p: Phrases, which: np.ndarray, start: np.ndarray) -> pa.RecordBatch:
    n_docs = len(row["doc_ids"])
    runs: list[list[dict]] = [[] for _ in range(n_docs)]
    items: list[list[str]] = [[] for _ in range(n_docs)]
    n_hit = np.zeros(n_docs, np.int64)
    doc = seg.doc_of(start)
    pairs = np.unique(np.column_stack([doc, p.owner[which]]), axis=0) if len(which) else np.empty((0, 2), np.int64)
    for d, k in pairs.tolist():
        items[d].append(p.items[k])
    by_doc = np.argsort(doc, kind="stable")
    bounds = np.flatnonzero(np.r_[True, np.diff(doc[by_doc]) != 0, True]) if len(doc) else np.zeros(1, np.int64)
    for low, high in zip(bounds[:-1], bounds[1:], strict=True):
        own = by_doc[low:high]
        d = int(doc[own[0]])
        base = seg.first[d]
        a, b = _merge_runs(start[own] - base, start[own] - base + p.sizes[which[own]], int(seg.first[d + 1] - base))
        n_hit[d] = (b - a).sum()
        runs[d] = [{"start": x, "end": y} for x, y in zip(a.tolist(), b.tolist(), strict=True)]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([row["segment"]] * n_docs, pa.int64()),
            pa.array(range(n_docs), pa.int32()),
            pa.array(row["doc_ids"], pa.int64()),
            pa.array(row["text_keys"], pa.int64()),
            pa.array(np.diff(seg.first), pa.int64()),
            pa.array(n_hit),
            pa.array(runs, _RUNS),
            pa.array([sorted(set(x)) for x in items], pa.list_(pa.string())),
        ],
        ["segment", "place", "doc_id", "text_key", "n_words", "n_hit", "runs", "items"],
    )


def _merged(parts: list[DataFrame]) -> DataFrame:
    """Hits of several passes as those of one: per document the union of the runs and of the items."""
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    each = union.groupBy("segment", "place").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("text_key").alias("text_key"),
        F.max("n_words").alias("n_words"),
        F.sort_array(F.flatten(F.collect_list("runs"))).alias("runs"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs, hit = [], []
            for n, found in zip(batch.column("n_words").to_pylist(), batch.column("runs").to_pylist(), strict=True):
                a, b = _merge_runs(
                    np.array([r["start"] for r in found], np.int64), np.array([r["end"] for r in found], np.int64), n
                )
                hit.append(int((b - a).sum()))
                runs.append([{"start": x, "end": y} for x, y in zip(a.tolist(), b.tolist(), strict=True)])
            columns = {c: batch.column(c) for c in batch.schema.names}
            columns |= {"n_hit": pa.array(hit, pa.int64()), "runs": pa.array(runs, _RUNS)}
            names = ["segment", "place", "doc_id", "text_key", "n_words", "n_hit", "runs", "items"]
            yield pa.RecordBatch.from_arrays([columns[c] for c in names], names)

    return each.mapInArrow(lean(run), HIT_SCHEMA)


def exact_hits(
    index: DataFrame,
    test: DataFrame,
    item_id: str = "item_id",
    text: str = "text",
    window: int = WINDOW_WORDS,
    phrases_per_pass: int = PHRASES_PER_PASS,
) -> DataFrame:
    """One row per indexed document: words, words inside an occurrence, their runs, and the items found."""
    blocks: Iterable[Phrases] = phrase_blocks(test, item_id, text, window, phrases_per_pass)
    parts = [_search(index, block) for block in blocks]
    if not parts:
        nothing = Phrases([], np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64), np.empty((0, window), np.int64))
        return _search(index, nothing)
    return parts[0] if len(parts) == 1 else _merged(parts)


def near_matches(index: DataFrame, queries: list[tuple[str, str]], slop: int = 20) -> DataFrame:
    """(query, doc_id) where all words of a stated query stand close to the rarest of them."""
    words = [(name, terms_of(*row_bytes(pa.array([value], pa.string())))[0]) for name, value in queries]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                seg = Segment(*(np.frombuffer(row[c], t) for c, t in zip(("first", "terms", "starts", "positions"), ("<i8", "<u8", "<i8", "<i4"), strict=True)))
                pairs = [(name, row["doc_ids"][d]) for name, w in words for d in find_near(seg, w, slop).tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x for x, _ in pairs], pa.string()), pa.array([y for _, y in pairs], pa.int64())],
                    ["query", "doc_id"],
                )

    return index.mapInArrow(run, "query string, doc_id long")
