"""Trees grown from histograms of binned rows.

Rows are kept in blocks: a byte per input (its bin) and the residual, for many rows at once. Spark deals the blocks and adds
up what its tasks count: per node, input and bin, how many residuals are below, at and above zero. A tree is chosen from
those counts, a level at a time. Nothing here needs Spark itself; the tasks import this module.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa

MOST_BINS = 255
BLOCK_ROWS = 50_000
# Residuals are ranked in hundredths of a cent.
RESIDUAL_UNITS = 100
# A pass over the residuals of a leaf tells this many equal ranges apart.
RANGE_BITS = 12


@dataclass(frozen=True)
class Block:
    """Rows of one kind: all of them held back from the trees, or none."""

    held: bool
    bins: np.ndarray
    residual: np.ndarray

    def units(self) -> np.ndarray:
        scaled = self.residual * RESIDUAL_UNITS
        return np.copysign(np.floor(np.abs(scaled) + 0.5), scaled).astype(np.int64)

    def signs(self) -> np.ndarray:
        """0, 1 or 2: below, at or above zero."""
        return (np.sign(self.residual) + 1).astype(np.int64)


def pack(edges: list[np.ndarray], start: float):
    """Record batches of (f, cents, held_back) to rows of one block each."""

    def blocks(f: np.ndarray, cents: np.ndarray, held: np.ndarray) -> Iterator[pa.RecordBatch]:
        bins = np.stack([np.searchsorted(e, f[:, k], "left").astype(np.uint8) for k, e in enumerate(edges)])
        for flag in (False, True):
            rows = held == flag
            if rows.any():
                yield pa.RecordBatch.from_pydict({
                    "held": pa.array([flag]),
                    "bins": pa.array([np.ascontiguousarray(bins[:, rows]).tobytes()], pa.binary()),
                    "residual": pa.array([(cents[rows] - start).tobytes()], pa.binary()),
                })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n = [], 0
        for batch in batches:
            f = batch.column("f").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(edges))
            cents = batch.column("cents").to_numpy(zero_copy_only=False).astype(np.float64)
            parts.append((f, cents, batch.column("held_back").to_numpy(zero_copy_only=False).astype(bool)))
            n += batch.num_rows
            if n >= BLOCK_ROWS:
                yield from blocks(*(np.concatenate(p) for p in zip(*parts)))
                parts, n = [], 0
        if n:
            yield from blocks(*(np.concatenate(p) for p in zip(*parts)))

    return run


def unpack(row, inputs: int) -> Block:
    return Block(row["held"], np.frombuffer(row["bins"], np.uint8).reshape(inputs, -1), np.frombuffer(row["residual"]))


@dataclass
class Tree:
    """Nodes in the order they were made, the root first. A node without children is its own child."""

    feature: list[int] = field(default_factory=lambda: [0])
    edge: list[int] = field(default_factory=lambda: [MOST_BINS])
    child: list[list[int]] = field(default_factory=lambda: [[0, 0]])
    counts: list = field(default_factory=lambda: [None])
    depth: int = 0

    def is_leaf(self, node: int) -> bool:
        return self.child[node][0] == node

    def split(self, node: int, feature: int, edge: int) -> list[int]:
        first = len(self.child)
        self.feature[node], self.edge[node], self.child[node] = feature, edge, [first, first + 1]
        for made in self.child[node]:
            self.feature.append(0)
            self.edge.append(MOST_BINS)
            self.child.append([made, made])
            self.counts.append(None)
        return self.child[node]

    def leaves(self, node: int = 0) -> list[int]:
        """The leaves from left to right, as Spark numbers them."""
        if self.is_leaf(node):
            return [node]
        return [leaf for child in self.child[node] for leaf in self.leaves(child)]

    def place(self, bins: np.ndarray) -> np.ndarray:
        """The node that each row reaches."""
        n = bins.shape[1]
        node, at, flat = np.zeros(n, np.int64), np.arange(n), bins.reshape(-1)
        feature, edge = np.array(self.feature) * n, np.array(self.edge)
        child = np.array(self.child).reshape(-1)
        for _ in range(self.depth):
            above = flat[feature[node] + at] > edge[node]
            node = child[2 * node + above]
        return node


def sign_counts(blocks: Iterable[Block], tree: Tree, active: list[int], sizes: list[int]) -> np.ndarray:
    """Counts by input, active node, bin and sign, flat. Rows that have reached another node are left out."""
    slot = np.full(len(tree.child), len(active))
    slot[active] = np.arange(len(active))
    totals = [np.zeros((len(active) + 1) * size * 3, np.int64) for size in sizes]
    for block in blocks:
        if not block.held:
            row, sign = slot[tree.place(block.bins)], block.signs()
            for k, size in enumerate(sizes):
                totals[k] += np.bincount((row * size + block.bins[k]) * 3 + sign, minlength=len(totals[k]))
    return np.concatenate([t[: len(active) * size * 3] for t, size in zip(totals, sizes)])


def by_input(flat: np.ndarray, nodes: int, sizes: list[int]) -> list[np.ndarray]:
    """The flat counts as an array (node, bin, sign) per input."""
    ends = np.cumsum([nodes * size * 3 for size in sizes])
    return [part.reshape(nodes, size, 3) for part, size in zip(np.split(flat, ends[:-1]), sizes)]


def best_split(counts: list[np.ndarray]) -> tuple[int, int] | None:
    """(input, last bin to the left) that lowers the variance of the signs most; None where nothing lowers it.

    `counts` holds an array (bin, sign) per input.
    """
    found, most = None, 1e-9
    for k, c in enumerate(counts):
        n, s = c.sum(axis=1).cumsum().astype(float), (c[:, 2] - c[:, 0]).cumsum().astype(float)
        left_n, left_s = n[:-1], s[:-1]
        right_n, right_s = n[-1] - left_n, s[-1] - left_s
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = left_s**2 / left_n + right_s**2 / right_n - s[-1] ** 2 / n[-1]
        gain = np.where((left_n > 0) & (right_n > 0), gain, 0.0)
        if len(gain) and gain.max() > most:
            most, found = float(gain.max()), (k, int(gain.argmax()))
    return found


def grow(root: np.ndarray, sizes: list[int], depth: int, count) -> Tree:
    """A tree of at most `depth` levels. `root` are the counts at the root, `count(tree, nodes)` those of a later level."""
    tree, active, counts = Tree(), [0], by_input(root, 1, sizes)
    tree.counts[0] = counts[0][0].sum(axis=0)
    while active and tree.depth < depth:
        made = []
        for i, node in enumerate(active):
            found = best_split([c[i] for c in counts])
            if found:
                k, edge = found
                left, right = tree.split(node, k, edge)
                tree.counts[left] = counts[k][i, : edge + 1].sum(axis=0)
                tree.counts[right] = counts[k][i, edge + 1 :].sum(axis=0)
                made += [left, right]
        tree.depth, active = tree.depth + bool(made), made
        if made and tree.depth < depth:
            counts = by_input(count(tree, made), len(made), sizes)
    return tree


def range_counts(blocks: Iterable[Block], tree: Tree, leaves: list[int], origins: np.ndarray, shift: int) -> np.ndarray:
    """Per row of `origins` and leaf: how many residuals lie in each of 2 ** RANGE_BITS ranges of 2 ** shift units from there."""
    ranges, slot = 1 << RANGE_BITS, np.zeros(len(tree.child), np.int64)
    slot[leaves] = np.arange(len(leaves))
    totals = np.zeros((len(origins), len(leaves) * ranges), np.int64)
    for block in blocks:
        if not block.held:
            leaf, units = slot[tree.place(block.bins)], block.units()
            for k, origin in enumerate(origins):
                at = (units - origin[leaf]) >> shift
                inside = (at >= 0) & (at < ranges)
                totals[k] += np.bincount((leaf * ranges + at)[inside], minlength=totals.shape[1])
    return totals


def leaf_medians(tree: Tree, least: int, most: int, count) -> list[float]:
    """The exact median residual, in units, per leaf from left to right; `least` and `most` bound all of them.

    Both middle positions are narrowed down from pass to pass, `count(leaves, origins, shift)` counts one.
    """
    leaves = tree.leaves()
    n = np.array([tree.counts[leaf].sum() for leaf in leaves])
    wanted = np.stack([(n - 1) // 2, n // 2])
    origins, shift = np.full(wanted.shape, least), max(0, (most - least).bit_length() - RANGE_BITS)
    while True:
        together = np.array_equal(origins[0], origins[1])
        totals = count(leaves, origins[:1] if together else origins, shift).reshape(-1, len(leaves), 1 << RANGE_BITS)
        for k in (0, 1):
            upto = totals[0 if together else k].cumsum(axis=1)
            at = (upto <= wanted[k][:, None]).sum(axis=1)
            wanted[k] -= np.where(at > 0, upto[np.arange(len(leaves)), np.maximum(at, 1) - 1], 0)
            origins[k] += at << shift
        if not shift:
            return [float(m) for m in origins.sum(axis=0) / 2]
        shift = max(0, shift - RANGE_BITS)


def moved(block: Block, tree: Tree, values: np.ndarray) -> Block:
    """The block once every row's quote has moved by the value of its node."""
    return Block(block.held, block.bins, block.residual - values[tree.place(block.bins)])


@dataclass
class Summary:
    """What a round needs to know of the rows: counts at the root, bounds of the residuals, error of the rows that judge."""

    root: np.ndarray
    least: int = 1 << 62
    most: int = -(1 << 62)
    judged: int = 0
    error: float = 0.0

    def plus(self, other: Summary) -> Summary:
        return Summary(
            self.root + other.root, min(self.least, other.least), max(self.most, other.most),
            self.judged + other.judged, self.error + other.error,
        )


def summary(blocks: Iterable[Block], sizes: list[int], judges_held: bool) -> Summary:
    total = Summary(np.zeros(sum(sizes) * 3, np.int64))
    for block in blocks:
        one = Summary(sign_counts([block], Tree(), [0], sizes))
        if not block.held:
            units = block.units()
            one.least, one.most = int(units.min()), int(units.max())
        if block.held == judges_held:
            one.judged, one.error = len(block.residual), float(np.abs(block.residual).sum())
        total = total.plus(one)
    return total
