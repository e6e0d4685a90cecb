"""Near duplicates: an exact Jaccard self-join on word shingles, as a blocked sparse matrix product.

A document is the set of its distinct 5-word shingles (64-bit hashes). The product of the document by shingle
matrix with its transpose holds all overlaps; these steps keep it small without losing a link:

1. Equal sets are one class with one representative; copies never enter the product.
2. Shingles are ordered, frequent ones last (frequencies from a sample of the texts: any order gives the same
   links, a good one is faster). Sets of n and m shingles that link have an overlap of at least 3/4 of the larger,
   so their first `l` common shingles both lie among the first n - ceil(3n/4) + l of the order. With l growing
   with n, chance meetings fall below the bound.
3. Half of a link's common shingles lie in columns of few documents, or half of them in columns of many. Columns
   of few give candidate pairs, whose counts of common shingles are summed and cut at l / 2. A column of many gives
   one edge per document (with l / 2 such columns) to its smallest: no pairs are formed.
4. Components of these candidates are cut into blocks of bounded size. Each block is multiplied in one task and
   gives its linked documents as a forest. Components of several blocks share a few pivot documents; then only
   what is not in the component's largest part is multiplied with the other blocks. Nothing is dropped.

Defined results: null and empty texts have no shingles and are their own component; fewer words than a shingle are
one shingle; repeated rows are one class; a component is named by its smallest non-null doc_id; an empty
table gives an empty table; columns other than id and text are ignored, so no name can clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripflow.llm.common import (
    FOLD,
    SPACED_WORD,
    U64,
    RangeHash,
    gram_hashes,
    grouped,
    lean,
    mix,
    row_bytes,
    sliced,
    stored,
    word_spans,
)
from tripflow.llm.components import components

SHINGLE = 5
PERCENT = 75
# Texts (by hash) whose shingles are counted for the order, and how many shingles may be called frequent.
ORDER_SAMPLE = 8
MAX_FREQUENT = 500_000
# One more common shingle is asked for with so many shingles of a set.
MEET = 24
# Columns of more documents than this give star edges in place of pairs.
PAIR_COLUMN = 32
# A block holds so many documents and shingles at most (or one larger document).
BLOCK_ROWS = 512
BLOCK_SHINGLES = 1 << 18
PIVOTS = 16
# Candidate lists up to so many rows are sent to all executors (about 32 MB); longer ones are shuffled.
BROADCAST_ROWS = 1_000_000


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> list[np.ndarray]:
    """The ascending distinct shingle hashes of each text."""
    body, offsets = row_bytes(column)
    starts, ends, first = word_spans(body, offsets, SPACED_WORD)
    words = RangeHash(body, FOLD)(starts, ends)
    grams = gram_hashes(words, size)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(grams[a : b - size + 1]))
        elif b > a:
            # A short text is one shingle of its own length.
            out.append(gram_hashes(words[a:b], b - a))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def need(n: int, percent: int) -> int:
    """The least overlap that a set of n can have with a set it links to."""
    return -(-percent * n // 100)


def meets(n: int) -> int:
    """How many common shingles are asked for among the first ones."""
    return 1 + n // MEET


def _frequent(docs: DataFrame, size: int) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, "text"):
                sets = shingle_sets(part.column("text"), size)
                found, count = np.unique(np.concatenate(sets), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(count)], ["s", "n"])

    some = docs.where(F.pmod(F.xxhash64("text", F.lit("order")), F.lit(ORDER_SAMPLE)) == 0).select("text")
    counted = stored(some.mapInArrow(lean(run), "s long, n long").groupBy("s").agg(F.sum("n").alias("n")).where("n >= 3"), "order")
    # Steps of the count's logarithm: a bounded table, whatever the corpus.
    steps = counted.groupBy(F.floor(F.log2("n") * 4).alias("step")).agg(F.count("*").alias("c"), F.min("n").alias("low"))
    total, low = 0, None
    for row in sorted(steps.collect(), key=lambda r: -r["step"]):
        total += row["c"]
        if total > MAX_FREQUENT:
            break
        low = row["low"]
    if low is None:
        return np.empty(0, np.uint64)
    found = counted.where(F.col("n") >= low).select("s").toArrow().column("s").to_numpy()
    return np.sort(found.view(np.uint64))


def _signed(docs: DataFrame, frequent: np.ndarray, size: int, percent: int) -> DataFrame:
    """Per row: the set's size and 128-bit signature, and its first shingles in the common order."""
    late = docs.sparkSession.sparkContext.broadcast(frequent)

    def first_ones(x: np.ndarray) -> np.ndarray:
        f = late.value
        if len(f) and len(x):
            common = f[np.minimum(np.searchsorted(f, x), len(f) - 1)] == x
            x = np.concatenate([x[~common], x[common]])
        return x[: len(x) - need(len(x), percent) + meets(len(x))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, "text"):
                sets = shingle_sets(part.column("text"), size)
                heads = [first_ones(x) for x in sets]
                ends = np.cumsum([0, *map(len, heads)]).astype(np.int32)
                flat = np.concatenate(heads) if heads else np.empty(0, np.uint64)
                signs = [
                    pa.array([int(mix(x ^ U64(salt)).sum(dtype=np.uint64).astype(np.int64)) for x in sets], pa.int64())
                    for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("text_key"),
                        pa.array([len(x) for x in sets], pa.int32()),
                        *signs,
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64))),
                    ],
                    ["doc_id", "text_key", "n", "hi", "lo", "head"],
                )

    made = docs.mapInArrow(lean(run), "doc_id long, text_key long, n int, hi long, lo long, head array<long>")
    return stored(made.withColumn("row", F.monotonically_increasing_id()), "sets")


def _cells(heads: DataFrame, frequent: np.ndarray) -> DataFrame:
    """(s, node, n, k): the first shingles that k > 1 representatives have.

    Shingles that the sample calls frequent are counted before the shuffle and joined, so that a column of very many
    rows is split. All others are shuffled once and counted where they lie.
    """
    late = heads.sparkSession.sparkContext.broadcast(frequent)

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = late.value
        for batch in batches:
            head = batch.column("head")
            x = head.flatten().to_numpy().view(np.uint64)
            common = f[np.minimum(np.searchsorted(f, x), len(f) - 1)] == x if len(f) else np.zeros(len(x), bool)
            # The order puts frequent ones last: each list is cut in two.
            ends = np.cumsum(np.concatenate([[0], np.asarray(head.value_lengths())]))
            rare = np.concatenate([[0], np.cumsum(~common)])[ends]
            often = np.concatenate([[0], np.cumsum(common)])[ends]
            lists = lambda at, mask: pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(x[mask].view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("n"), lists(rare, ~common), lists(often, common)], ["node", "n", "rare", "often"]
            )

    parted = heads.mapInArrow(lean(known), "node long, n int, rare array<long>, often array<long>")
    rare = parted.select("node", "n", F.explode("rare").alias("s"))
    rare = rare.withColumn("k", F.count("*").over(Window.partitionBy("s"))).where("k > 1")
    often = parted.select("node", "n", F.explode("often").alias("s"))
    shared = often.groupBy("s").agg(F.count("*").alias("k")).where("k > 1")
    return stored(rare.unionByName(often.join(shared, "s")), "cells")


def _candidates(cells: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) between representatives such that every link lies inside a component of them."""
    few = cells.where(F.col("k") <= PAIR_COLUMN)
    left = few.select("s", F.col("node").alias("a"), F.col("n").alias("na"))
    right = few.select("s", F.col("node").alias("b"), F.col("n").alias("nb"))
    near = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
    pairs = left.join(right, "s").where((F.col("a") < F.col("b")) & near)
    least = (F.floor(F.least("na", "nb") / MEET) + 1).cast("long")
    # A link has `l` common shingles here: half of them in columns of few documents, or half of them in the others.
    counted = pairs.groupBy("a", "b").agg(F.count("*").alias("c"), F.min(least).alias("l")).where("2 * c >= l")
    many = cells.where(F.col("k") > PAIR_COLUMN)
    # The smallest set that a set of n may link with decides how many that are at least.
    fewest = F.floor(F.ceil(F.col("n") * percent / 100) / MEET) + 1
    able = many.groupBy("node").agg(F.count("*").alias("c"), F.max("n").alias("n")).where(2 * F.col("c") >= fewest)
    many = stored(many.join(able.select("node"), "node"), "many")
    stars = many.join(many.groupBy("s").agg(F.min("node").alias("b")), "s").where("node <> b")
    return counted.select("a", "b").unionByName(stars.select(F.col("node").alias("a"), "b").distinct())


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """The symmetric matrix of overlaps of one block: the product of its incidence matrix with its transpose.

    Columns of few documents are added pair by pair, frequent ones as dense slabs.
    """
    m = len(sets)
    total = np.zeros((m, m), np.float32)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(m), [len(x) for x in sets])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    opens = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]]) if len(flat) else np.empty(0, np.int64)
    counts = np.diff(np.r_[opens, len(flat)])
    for k in range(2, 9):
        at = opens[counts == k]
        cells = owner[at[:, None] + np.arange(k)[None, :]]
        for i in range(k):
            for j in range(i + 1, k):
                np.add.at(total, (cells[:, i], cells[:, j]), 1)
                np.add.at(total, (cells[:, j], cells[:, i]), 1)
    wide = np.flatnonzero(counts > 8)
    for low in range(0, len(wide), 2048):
        own = wide[low : low + 2048]
        column = np.repeat(np.arange(len(own)), counts[own])
        cell = np.concatenate([np.arange(opens[c], opens[c] + counts[c]) for c in own])
        slab = np.zeros((m, len(own)), np.float32)
        slab[owner[cell], column] = 1
        total += slab @ slab.T
    np.fill_diagonal(total, [len(x) for x in sets])
    return total


def forest(linked: np.ndarray) -> np.ndarray:
    """For a symmetric link matrix the smallest reachable place of each row."""
    label = np.arange(len(linked))
    links = linked | np.eye(len(linked), dtype=bool)
    while True:
        low = np.where(links, label[None, :], len(label)).min(axis=1)
        low = np.minimum(low, low[low])
        if (low == label).all():
            return label
        label = low


def _block_links(percent: int):
    """(cluster, node, label): each document of a block with the smallest one it reaches within the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, rows in grouped(batches, ["cluster", "block", "part"]):
            node, at = np.unique(rows.column("node").to_numpy(), return_index=True)
            if len(node) < 2:
                continue
            packed = rows.column("shingles")
            sets = [np.frombuffer(packed[int(k)].as_py(), "<u8") for k in at]
            label = _linked_labels(sets, percent)
            own = np.flatnonzero(label != np.arange(len(node)))
            if len(own):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(own), key[0], np.int64)), pa.array(node[own]), pa.array(node[label[own]])],
                    ["cluster", "node", "label"],
                )

    return run


def _linked_labels(sets: list[np.ndarray], percent: int) -> np.ndarray:
    n = np.array([len(x) for x in sets], np.float64)
    both = overlaps(sets).astype(np.float64)
    return forest(100 * both >= percent * (n[:, None] + n[None, :] - both))


def _with_sets(docs: DataFrame, members: DataFrame, size: int) -> DataFrame:
    """`members` (node, doc_id, text_key and more) with the shingles of their texts."""
    keep = [c for c in members.columns if c not in ("doc_id", "text_key")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, "text"):
                packed = pa.array([x.astype("<u8").tobytes() for x in shingle_sets(part.column("text"), size)], pa.binary())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), packed], [*keep, "shingles"])

    wanted = members.select(*keep, F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
    wanted = F.broadcast(wanted) if members.count() <= BROADCAST_ROWS else wanted
    found = docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["_id"]) & (docs["text_key"] == wanted["_key"]))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in members.schema if f.name in keep)
    return found.select(*keep, "text").mapInArrow(lean(run), f"{schema}, shingles binary")


def _multiplied(rows: DataFrame, percent: int) -> DataFrame:
    dealt = rows.repartition("cluster", "block", "part").sortWithinPartitions("cluster", "block", "part")
    return dealt.mapInArrow(lean(_block_links(percent)), "cluster long, node long, label long")


def _block_counts(members: DataFrame) -> DataFrame:
    sizes = members.groupBy("cluster").agg(F.count("*").alias("rows"), F.sum("n").alias("cells"))
    blocks = F.greatest(F.ceil(F.col("rows") / BLOCK_ROWS), F.ceil(F.col("cells") / BLOCK_SHINGLES)).cast("int")
    return sizes.select("cluster", "rows", blocks.alias("blocks"))


def _by_size(members: DataFrame, percent: int) -> DataFrame:
    """Clusters of several blocks, cut by size: sets that link are in the same or in neighbouring bands.

    A band spans the factor by which linked sets may differ; a document goes to the two windows of two bands
    that it lies in, under which every pair that may link meets.
    """
    large = stored(_block_counts(members).where("blocks > 1").select("cluster", F.lit(1).alias("_large")), "large")
    band = F.floor(F.log("n") / F.log(F.lit(100.0 / percent)) + F.lit(1e-9)).cast("long")
    windows = F.when(F.col("_large") == 1, F.array(band, band + 1)).otherwise(F.array(F.lit(-1).cast("long")))
    dealt = members.join(large, "cluster", "left").withColumn("_window", F.explode(windows))
    # Windows of one cluster are told apart by a hash; 64 bits keep two of them from meeting.
    named = F.when(F.col("_window") >= 0, F.xxhash64("cluster", "_window")).otherwise(F.col("cluster"))
    return dealt.withColumn("cluster", named).drop("_large", "_window")


def _links(docs: DataFrame, members: DataFrame, size: int, percent: int) -> DataFrame:
    """(node, label) of documents that link with a smaller one, from members (node, n, cluster, doc_id, text_key)."""
    members = _by_size(members, percent)
    sizes = stored(_block_counts(members), "clusters")
    placed = members.join(sizes, "cluster")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    pivot = F.pmod(F.xxhash64("node", F.lit("pivot")), F.greatest(F.lit(1), F.floor(F.col("rows") / PIVOTS))) == 0
    placed = stored(
        placed.select("cluster", "node", "n", "doc_id", "text_key", "blocks", own.alias("own"), pivot.alias("pivot")), "placed"
    )
    sets = _with_sets(docs, placed.drop("n"), size)
    where = F.when(F.col("pivot") & (F.col("blocks") > 1), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("own"))
    once = sets.select("cluster", "node", "shingles", F.explode(where).alias("block"), F.lit(0).alias("part"))
    inside = stored(_multiplied(once, percent), "links")
    several = placed.where("blocks > 1")
    if several.isEmpty():
        return components(inside.select(F.col("node").alias("a"), F.col("label").alias("b"))).where("node <> label")
    # Parts of clusters that span blocks: join what the pivots have tied together.
    spanning = sizes.where("blocks > 1").select("cluster")
    tied = inside.join(spanning, "cluster").select(F.col("node").alias("a"), F.col("label").alias("b"))
    # Documents of two windows are tied in both; a window's parts are named by the components of all.
    parts = several.join(components(tied), "node", "left").withColumn("label", F.coalesce("label", "node"))
    parts = stored(parts, "parts")
    by_part = parts.groupBy("cluster", "label").agg(F.count("*").alias("c"), F.sum("n").alias("cells"))
    main = by_part.groupBy("cluster").agg(
        F.max_by("label", F.struct("c", "label")).alias("main"),
        (F.sum("c") - F.max("c")).alias("rows"),
        (F.sum("cells") - F.max_by("cells", F.struct("c", "label"))).alias("cells"),
    )
    groups = F.greatest(F.ceil(F.col("rows") / BLOCK_ROWS), F.ceil(F.col("cells") / BLOCK_SHINGLES)).cast("int")
    main = main.withColumn("groups", groups).where("rows > 0")
    parts = parts.join(main.select("cluster", "main", "groups"), "cluster")
    parts = stored(parts.withColumn("minor", F.col("label") != F.col("main")).drop("n", "pivot", "label", "main"), "minors")
    rest = _with_sets(docs, parts, size)
    every_block, every_group = F.sequence(F.lit(0), F.col("blocks") - 1), F.sequence(F.lit(0), F.col("groups") - 1)
    group = F.pmod(F.xxhash64("node", F.lit("minor")), F.col("groups")).cast("int")
    at_home = rest.select("cluster", "node", "shingles", F.col("own").alias("block"), F.explode(every_group).alias("part"))
    visiting = rest.where("minor").select("cluster", "node", "shingles", F.explode(every_block).alias("block"), group.alias("part"))
    across = stored(_multiplied(at_home.unionByName(visiting), percent), "across")
    tied = tied.unionByName(across.select(F.col("node").alias("a"), F.col("label").alias("b")))
    single = inside.join(spanning, "cluster", "left_anti").select(F.col("node").alias("a"), F.col("label").alias("b"))
    return components(tied.unionByName(single)).where("node <> label")


def labelled(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """The columns of `near_duplicates` and `component`, one value per component; null for texts without shingles."""
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    narrow = narrow.withColumn("text_key", F.xxhash64("text"))
    frequent = _frequent(narrow, size)
    rows = _signed(narrow, frequent, size, percent)
    classes = rows.where("n > 0").groupBy("hi", "lo").agg(F.min("row").alias("node"), F.min("doc_id").alias("first_id"))
    classes = stored(classes, "classes")
    nodes = classes.select("node")
    nodes = F.broadcast(nodes) if classes.count() <= BROADCAST_ROWS else nodes
    heads = rows.select(F.col("row").alias("node"), "n", "head").join(nodes, "node")
    clusters = components(_candidates(_cells(heads, frequent), percent))
    members = clusters.withColumnRenamed("label", "cluster").join(
        rows.select(F.col("row").alias("node"), "n", "doc_id", "text_key"), "node"
    )
    links = _links(narrow, stored(members, "members"), size, percent)
    # Name each component by its smallest id; classes outside all links keep their own.
    named = classes.join(links, "node", "left").withColumn("label", F.coalesce("label", "node"))
    names = named.groupBy("label").agg(F.min("first_id").alias("component_id"))
    named = stored(named.join(names, "label").select("hi", "lo", "component_id", "label"), "named")
    out = rows.select("doc_id", "text_key", "n", "hi", "lo").join(named, ["hi", "lo"], "left")
    return out.select(
        "doc_id", "text_key", F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.col("label").alias("component"),
    )


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """doc_id, text_key (hash of the text), n_shingles and component_id, one row per input row.

    Components whose rows have no id, or that begin with the same id, share a component_id; `labelled` tells them apart.
    """
    return labelled(docs, doc_id, text, size, percent).drop("component")
