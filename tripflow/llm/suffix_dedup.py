"""Repeated passages: every byte covered by a string of `LENGTH` bytes that also starts earlier is removed.

The order of starts is (doc_id, position); strings never cross documents and are judged on the input.

1. A string of LENGTH bytes is filed under the smallest hash of its GRAM-byte substrings; neighbouring strings
   mostly share that key, so a text becomes a few runs of strings, each with its stretch of text. Equal strings have
   equal keys. Keys that occur once in the corpus (and once in their run) are done.
2. Equal stretches under one key repeat as a whole: all but the first are marked. This is summed up before the
   shuffle, so a passage with copies in a third of all rows is no group of that size.
3. What differs under one key goes, with its text, to one task per portion of keys. The stretches are cut into
   shards; each shard's Burrows-Wheeler transform is made by itself, and the transforms are merged by
   refining their interleave: one stable distribution by the transform's symbols orders all suffixes by one
   more symbol. Blocks that no refinement up to LENGTH bytes has split are the intervals of the merged transform with
   common prefixes of LENGTH or more: repeated strings. No suffixes are compared or sorted again.
4. A key with more than `GROUP` different stretches is not gathered: its strings become keys themselves.

Defined results: null and empty texts have no bytes and nothing removed; rows with the same id and text are one
document and get the same result; different texts under one id are ordered by a hash; null ids come first; an
empty table gives an empty table; columns other than id and text are ignored, so no name can clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import RangeHash, discard, mix, row_bytes, sliced, stored

LENGTH = 100
GRAM = 24
# Bytes of one shard and of all shards that are merged at once (a larger key stays whole): small enough for the
# processor's cache, and for wide symbols to fit 16 bits.
SHARD = 1 << 14
PORTION = 1 << 17
GROUP = 20_000
# Lists of wanted stretches up to so many rows are sent to all executors (about 60 MB); longer ones are shuffled.
BROADCAST_ROWS = 2_000_000

RUNS = "doc long, text_key long, h long, ch long, p int, r int, inner boolean"


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each `width` neighbours, from running minima of two block passes."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def runs_of(body: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(row, start in the row, number of strings, key, hash of the stretch, key met again) of each run.

    The key is met again when its first place drops out of the sliding string and the key stays: only then can a
    run repeat a string within itself.
    """
    count = np.maximum(np.diff(offsets) - length + 1, 0)
    total = int(count.sum())
    if not total:
        none = np.empty(0, np.int64)
        return none, none, none, none.view(np.uint64), none.view(np.uint64), none.astype(bool)
    hashes = RangeHash(body)
    n = len(body) - gram + 1
    grams = mix((hashes.sums[gram:] - hashes.sums[:-gram]) * hashes.down[:n])
    keys = sliding_least(grams, length - gram + 1)
    before = np.concatenate([[0], np.cumsum(count)])
    at = np.repeat(offsets[:-1] - before[:-1], count) + np.arange(total)
    key = keys[at]
    first = np.ones(total, bool)
    first[1:] = key[1:] != key[:-1]
    first[before[:-1][count > 0]] = True
    opens = np.flatnonzero(first)
    size = np.diff(np.append(opens, total))
    start = at[opens]
    row = np.searchsorted(offsets, start, side="right") - 1
    inner = np.logical_or.reduceat((grams[at] == key) & ~np.append(first[1:], True), opens)
    return row, start - offsets[row], size, key[opens], hashes(start, start + size + length - 1), inner


def _runs(docs: DataFrame) -> DataFrame:
    """Runs with the key h; a run that repeats an earlier one of the same slice has no key: it is marked already."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, "text"):
                row, p, r, h, ch, inner = runs_of(*row_bytes(part.column("text")))
                doc = part.column("doc").to_numpy()[row]
                text = part.column("text_key").to_numpy()[row]
                order = np.lexsort((p, text, doc, ch, h))
                h, ch, doc, text, p, r, inner = (x[order] for x in (h, ch, doc, text, p, r, inner))
                again = np.zeros(len(h), bool)
                again[1:] = (h[1:] == h[:-1]) & (ch[1:] == ch[:-1])
                lead = np.maximum.accumulate(np.where(again, 0, np.arange(len(h)))) if len(h) else np.empty(0, np.int64)
                # The same place of a row that is there twice is not earlier than itself.
                again &= ~((doc == doc[lead]) & (text == text[lead]) & (p == p[lead]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc),
                        pa.array(text),
                        pa.array(h.view(np.int64), mask=again),
                        pa.array(ch.view(np.int64)),
                        pa.array(p.astype(np.int32)),
                        pa.array(r.astype(np.int32)),
                        pa.array(inner),
                    ],
                    ["doc", "text_key", "h", "ch", "p", "r", "inner"],
                )

    return docs.mapInArrow(run, RUNS)


def _interval() -> list:
    return ["doc", "text_key", F.col("p").alias("a"), (F.col("p") + F.col("r") + LENGTH - 1).alias("b")]


def _firsts(runs: DataFrame) -> DataFrame:
    return runs.groupBy("h", "ch").agg(F.min(F.struct("doc", "text_key", "p")).alias("first"), F.max("r").alias("r"), F.max("inner").alias("inner"))


def _later(runs: DataFrame, firsts: DataFrame) -> DataFrame:
    """Intervals of the runs that are not the first of their kind."""
    both = runs.join(firsts.select("h", "ch", "first"), ["h", "ch"])
    return both.where(F.struct("doc", "text_key", "p") > F.col("first")).select(*_interval())


def _stretches(docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """(h, doc, text_key, p, r, bytes): the text of the wanted runs."""
    wanted = firsts.select("h", "first.*", "r").groupBy("doc", "text_key").agg(F.collect_list(F.struct("h", "p", "r")).alias("runs"))
    wanted = F.broadcast(wanted) if firsts.count() <= BROADCAST_ROWS else wanted

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["h", "doc", "text_key", "p", "r", "bytes"]
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            out: list[list] = [[] for _ in names]
            for doc, key, text, runs in zip(
                batch.column("doc").to_pylist(), batch.column("text_key").to_pylist(), texts, batch.column("runs").to_pylist(), strict=True
            ):
                text = text.as_py()
                for x in runs:
                    values = (x["h"], doc, key, x["p"], x["r"], text[x["p"] : x["p"] + x["r"] + LENGTH - 1])
                    for column, value in zip(out, values, strict=True):
                        column.append(value)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names)

    found = docs.join(wanted, ["doc", "text_key"]).select("doc", "text_key", "text", "runs")
    return found.mapInArrow(run, "h long, doc long, text_key long, p int, r int, bytes binary")


def shard_order(body: np.ndarray) -> np.ndarray:
    """Rotations of a cyclic shard in the order of their first LENGTH bytes or more (prefix doubling)."""
    n = len(body)
    packed = np.zeros(n, np.uint64)
    for k in range(8):
        packed = (packed << np.uint64(8)) | np.roll(body, -k).astype(np.uint64)
    rank = np.unique(packed, return_inverse=True)[1].astype(np.int64)
    depth = 8
    while depth < LENGTH and rank.max() < n - 1:
        rank = np.unique(rank * n + np.roll(rank, -depth), return_inverse=True)[1].astype(np.int64)
        depth *= 2
    return np.argsort(rank, kind="stable")


def merged_blocks(shards: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The merged transform of cyclic shards down to LENGTH bytes.

    Returns positions in the concatenated shards, in merged order, and for each the number of its block:
    positions of one block have the same LENGTH bytes (cyclically) ahead.
    """
    base = np.cumsum([0, *map(len, shards)])
    order, last = [], []
    joint_symbols, width = _symbols_of_shards(shards)
    for k, shard in enumerate(shards):
        own = shard_order(shard)
        order.append(own + base[k])
        last.append(joint_symbols[base[k] : base[k + 1]][own])
    suffixes, transform = np.concatenate(order), np.concatenate(last)
    n = len(suffixes)
    small = np.uint8 if len(shards) <= 256 else np.uint16
    source = np.repeat(np.arange(len(shards)).astype(small), np.diff(base))
    block = np.zeros(n, np.int32)
    symbol = np.empty(n, np.uint16)
    for _ in range(LENGTH // width):
        # Read each shard's transform in order, where the interleave calls for it; then distribute by symbol.
        symbol[np.argsort(source, kind="stable")] = transform
        moved = np.argsort(symbol, kind="stable")
        source, behind, head = source[moved], block[moved], symbol[moved]
        block[0] = 0
        np.cumsum((head[1:] != head[:-1]) | (behind[1:] != behind[:-1]), out=block[1:])
        if block[-1] == n - 1:
            break
    place = np.empty(n, np.int64)
    place[np.argsort(source, kind="stable")] = suffixes
    return place, block


def _symbols_of_shards(shards: list[np.ndarray]) -> tuple[np.ndarray, int]:
    """What stands before each position, cyclically within its shard, as small integers of one coding; and its width.

    The widest of 4, 2 and 1 bytes (all divide LENGTH) whose different values fit 16 bits.
    """
    for width in (4, 2, 1):
        packed = []
        for shard in shards:
            value = np.zeros(len(shard), np.uint32)
            for k in range(width):
                value = (value << np.uint32(8)) | np.roll(shard, width - k).astype(np.uint32)
            packed.append(value)
        values, codes = np.unique(np.concatenate(packed), return_inverse=True)
        if len(values) <= 1 << 16:
            return codes.astype(np.uint16), width
    raise AssertionError("single bytes always fit")


def later_strings(texts: list[bytes], count: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, from, to): runs of strings, by start, that equal a string of lower rank; `rank` is that of a text's first start."""
    sizes = np.array([len(t) for t in texts])
    ends = np.cumsum(sizes)
    # Shards are whole texts; a text longer than a shard is one of its own.
    shards, first = [], 0
    body = np.frombuffer(b"".join(texts), np.uint8)
    while first < len(texts):
        low = ends[first] - sizes[first]
        last = max(int(np.searchsorted(ends, low + SHARD, side="right")), first + 1)
        shards.append(body[low : ends[last - 1]])
        first = last
    place, block = merged_blocks(shards)
    owner = np.searchsorted(ends, place, side="right")
    offset = place - (ends[owner] - sizes[owner])
    starts = offset < count[owner]
    owner, offset, block = owner[starts], offset[starts], block[starts]
    key = rank[owner] + offset
    opens = np.flatnonzero(np.r_[True, block[1:] != block[:-1]]) if len(block) else np.empty(0, np.int64)
    least = np.repeat(np.minimum.reduceat(key, opens), np.diff(np.r_[opens, len(key)])) if len(key) else key
    marked = key > least
    owner, offset = owner[marked], offset[marked]
    order = np.lexsort((offset, owner))
    owner, offset = owner[order], offset[order]
    new = np.r_[True, (owner[1:] != owner[:-1]) | (offset[1:] != offset[:-1] + 1)] if len(owner) else np.empty(0, bool)
    opens = np.flatnonzero(new)
    closes = np.r_[opens[1:], len(owner)] - 1 if len(opens) else opens
    return owner[opens], offset[opens], offset[closes] + 1


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Whole keys together, about PORTION bytes of stretches at a time; rows come sorted by key."""
    held, size, key = [], 0, None
    for batch in batches:
        h = batch.column("h").to_numpy()
        cuts = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.empty(0, np.int64)
        lengths = np.concatenate([[0], np.cumsum(batch.column("r").to_numpy().astype(np.int64) + LENGTH - 1)])
        for low, high in zip(cuts, np.r_[cuts[1:], len(h)], strict=True):
            if h[low] != key and size >= PORTION:
                yield pa.Table.from_batches(held)
                held, size = [], 0
            key = h[low]
            held.append(batch.slice(low, high - low))
            size += int(lengths[high] - lengths[low])
    if held:
        yield pa.Table.from_batches(held)


def _by_transform(stretches: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _portions(batches):
            h, doc, key, p, r = (table.column(c).to_numpy() for c in ("h", "doc", "text_key", "p", "r"))
            texts = table.column("bytes").to_pylist()
            # A document's place in the order, with room for every start.
            order = np.lexsort((key, doc))
            new = np.r_[True, (doc[order][1:] != doc[order][:-1]) | (key[order][1:] != key[order][:-1])]
            rank = np.empty(len(doc), np.int64)
            rank[order] = np.cumsum(new) - 1
            text, low, high = later_strings(texts, r.astype(np.int64), (rank << 32) + p)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc[text]),
                    pa.array(key[text]),
                    pa.array((p[text] + low).astype(np.int32)),
                    pa.array((p[text] + high + LENGTH - 1).astype(np.int32)),
                ],
                ["doc", "text_key", "a", "b"],
            )

    dealt = stretches.repartition("h").sortWithinPartitions("h")
    return dealt.mapInArrow(run, "doc long, text_key long, a int, b int")


def _single_strings(stretches: DataFrame) -> DataFrame:
    """Each string of a stretch as a run of its own, under its own hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, "bytes"):
                body, offsets = row_bytes(part.column("bytes"))
                r = part.column("r").to_numpy().astype(np.int64)
                row = np.repeat(np.arange(len(r)), r)
                within = np.arange(len(row)) - np.repeat(np.cumsum(r) - r, r)
                start = offsets[row] + within
                h = RangeHash(body)(start, start + LENGTH)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(part.column("doc").to_numpy()[row]),
                        pa.array(part.column("text_key").to_numpy()[row]),
                        pa.array(h.view(np.int64)),
                        pa.array(part.column("h").to_numpy()[row]),
                        pa.array((part.column("p").to_numpy()[row] + within).astype(np.int32)),
                        pa.array(np.ones(len(row), np.int32)),
                        pa.array(np.zeros(len(row), bool)),
                    ],
                    ["doc", "text_key", "h", "ch", "p", "r", "inner"],
                )

    return stretches.mapInArrow(run, RUNS)


def repeated_intervals(keyed: DataFrame) -> DataFrame:
    """(doc, text_key, a, b): byte intervals to remove, of texts (doc, text_key, text). They may overlap."""
    runs = stored(_runs(keyed), "runs")
    keys = runs.where("h is not null").groupBy("h").agg(F.count("*").alias("k"), F.max("inner").alias("inner"))
    keys = keys.where("k > 1 or inner")
    shared = stored(runs.where("h is not null").join(keys.select("h"), "h"), "shared")
    marked = stored(runs.where("h is null").select(*_interval()), "marked")
    discard(runs)
    firsts = stored(_firsts(shared), "firsts")
    kinds = firsts.groupBy("h").agg(F.count("*").alias("kinds"), F.max("inner").alias("met"))
    kinds = kinds.where("kinds > 1 or met").drop("met")
    several = stored(firsts.join(kinds, "h"), "several")
    parts = [marked, _later(shared, firsts), _by_transform(_stretches(keyed, several.where(F.col("kinds") <= GROUP)))]
    large = several.where(F.col("kinds") > GROUP)
    if not large.isEmpty():
        strings = stored(_single_strings(_stretches(keyed, large)), "strings")
        parts.append(_later(strings, _firsts(strings)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _cut(text: bytes, intervals: list[dict] | None) -> tuple[bytes, int, int]:
    """The bytes outside the intervals, how many were inside, and in how many maximal runs."""
    if not intervals:
        return text, 0, 0
    kept, at, spans, removed = [], 0, 0, 0
    low, high = None, 0
    for x in sorted((x["a"], x["b"]) for x in intervals):
        if low is None or x[0] > high:
            if low is not None:
                kept.append(text[at:low])
                removed += high - low
                spans, at = spans + 1, high
            low, high = x
        else:
            high = max(high, x[1])
    kept += [text[at:low], text[high:]]
    return b"".join(kept), removed + high - low, spans + 1


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (the remaining bytes), one row per input row."""
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    keyed = narrow.select(
        F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc"), F.xxhash64("text").alias("text_key"), "text"
    )
    found = repeated_intervals(keyed).groupBy("doc", "text_key").agg(F.collect_list(F.struct("a", "b")).alias("cuts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, "text", 8 << 20):
                texts = part.column("text").cast(pa.binary()).to_pylist()
                done = [_cut(t, c) for t, c in zip(texts, part.column("cuts").to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([len(t) for t in texts], pa.int64()),
                        pa.array([x[1] for x in done], pa.int64()),
                        pa.array([x[2] for x in done], pa.int64()),
                        pa.array([x[0] for x in done], pa.binary()),
                    ],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
                )

    named = narrow.withColumn("doc", F.coalesce("doc_id", F.lit(-(1 << 63)))).withColumn("text_key", F.xxhash64("text"))
    both = named.join(found, ["doc", "text_key"], "left").select("doc_id", "text", "cuts")
    return both.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
