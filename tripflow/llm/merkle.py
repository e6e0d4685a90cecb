"""Merkle manifest of a dataset: leaves per row, a subtree per source, one root, proofs and their verification.

Every row is hashed to a leaf where it is read, so only digests are shuffled. Leaves are numbered within their source
from a range sort (no source is gathered in a task). A superblock is FAN ** HEIGHT neighbouring nodes of a source,
reduced in one task to the node on top of it; the nodes on top are the leaves of the next tier, until each source has
one node, its subroot. The subroots, ordered by source, are reduced in the same way to the root.

Proofs come from the top down: the rows of a superblock are cogrouped with the one outer row of that block (the
siblings from its top node up to the root), and the task reduces the block again, joins the proofs and folds them.

Digests are lowercase hex; H hashes its inputs one after the other, digests as hex text.

Defined results: null cells enter a leaf as `-`; a null source is a source of its own and comes first; null ids come
first in their source; rows that agree in source and id are ordered by their leaves, and rows that agree in all five
columns are interchangeable; a table of one row has that leaf as its root and the hash of nothing as its proof; an
empty table gives an empty table; other columns are ignored, so no name can clash.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripflow.llm.common import crc_rest, stored

FAN = 3
# A superblock has FAN ** HEIGHT nodes: 2,187.
HEIGHT = 7

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<pos:int,siblings:array<string>>>"


def leaf_hash(*fields: F.Column) -> F.Column:
    """H of the fields: `-` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = [f.cast("string") for f in fields]
    whole = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]
    return F.sha2(F.concat(*whole).cast("binary"), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, leaf, changed): `tree` names the source, `changed` is the leaf of the row as tampered with."""
    tampered = F.when(crc_rest(F.col("doc_id"), 2) == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    given = [F.col(c) for c in FIELDS]
    return docs.select(
        # Never null, and ordered as sources are: null first, then by bytes.
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("tree"),
        "doc_id",
        leaf_hash(*given).alias("leaf"),
        leaf_hash(*given[:-1], tampered).alias("changed"),
    )


def numbered(nodes: DataFrame, *order: str) -> DataFrame:
    """The rows with `idx`, the place of each in its tree by `order`, and `n`, the rows of that tree.

    After a range sort the places follow from the number of rows in each sorted part; a list with a row per tree and
    part is all that is added up.
    """
    # Rows equal in everything may stand in any order; the row number spreads them over the parts.
    sort = ["tree", *(F.col(c).asc_nulls_first() for c in order), "_row"]
    spread = nodes.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*sort)
    parts = spread.sortWithinPartitions(*sort).drop("_row")
    parts = stored(parts.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), "sorted")
    sizes = parts.groupBy("tree", "part").agg(F.count("*").alias("size"), F.min("at").alias("first"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        "tree",
        "part",
        (F.coalesce(F.sum("size").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("size").over(Window.partitionBy("tree")).alias("n"),
    )
    placed = parts.join(sizes, ["tree", "part"])
    return placed.withColumn("idx", F.col("at") + F.col("shift")).drop("part", "at", "shift")


def _height(n: int) -> int:
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def reduce_block(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes of a block level by level; the last level has the node on top."""
    out = [nodes]
    for _ in range(levels):
        below = out[-1]
        out.append([hashlib.sha256("".join(below[k : k + FAN]).encode()).hexdigest() for k in range(0, len(below), FAN)])
    return out


def block_path(levels: list[list[str]], k: int) -> list[tuple[int, list[str]]]:
    """(place among its run, the run's others) of node k at each level below the top."""
    path = []
    for nodes in levels[:-1]:
        first = k - k % FAN
        run = nodes[first : first + FAN]
        path.append((k - first, run[: k - first] + run[k - first + 1 :]))
        k //= FAN
    return path


def fold(node: str, path: list[tuple[int, list[str]]]) -> str:
    """The root that a node and the siblings on its way up give."""
    for place, siblings in path:
        node = hashlib.sha256("".join([*siblings[:place], node, *siblings[place:]]).encode()).hexdigest()
    return node


def _blocks(nodes: DataFrame, height: int) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("idx") / FAN**height))


def _tops(nodes: DataFrame, height: int) -> DataFrame:
    """The next tier: one node per superblock, with its place in the tree and the size of that tier."""

    def top(rows: pd.DataFrame) -> pd.DataFrame:
        n, rows = int(rows["n"].iloc[0]), rows.sort_values("idx")
        node = reduce_block(rows["leaf"].tolist(), min(height, _height(n)))[-1][0]
        tier = -(-n // FAN**height)
        return pd.DataFrame({"tree": rows["tree"].iloc[:1], "idx": rows["block"].iloc[:1], "n": [tier], "leaf": [node]})

    given = _blocks(nodes, height).select("tree", "block", "idx", "n", "leaf")
    return given.groupBy("tree", "block").applyInPandas(top, "tree string, idx long, n long, leaf string")


def _climb(nodes: DataFrame, name: str, height: int) -> list[DataFrame]:
    """The tiers of all trees, from the given nodes to one node per tree."""
    tiers = [nodes]
    while not tiers[-1].where("n > 1").isEmpty():
        tiers.append(stored(_tops(tiers[-1], height), name))
    return tiers


def _local(rows: pd.DataFrame, outer: pd.DataFrame, height: int):
    """The rows of a block in order, its levels, and the outer row with the path above it."""
    rows = rows.sort_values("idx")
    levels = reduce_block(rows["leaf"].tolist(), min(height, _height(int(rows["n"].iloc[0]))))
    above = outer.iloc[0]
    path = [(int(step["pos"]), list(step["siblings"])) for step in above["path"]]
    return rows, levels, above, path


def _down(nodes: DataFrame, outer: DataFrame, height: int) -> DataFrame:
    """(tree, idx, path, subroot, root) of each node of a tier, from the outer rows of its blocks."""

    def join(rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows, levels, top, path = _local(rows, above, height)
        paths = [block_path(levels, k) + path for k in range(len(rows))]
        return pd.DataFrame(
            {
                "tree": rows["tree"],
                "idx": rows["idx"],
                "path": [[{"pos": p, "siblings": s} for p, s in x] for x in paths],
                "subroot": top["subroot"],
                "root": top["root"],
            }
        )

    left = _blocks(nodes, height).select("tree", "block", "idx", "n", "leaf").groupBy("tree", "block")
    right = outer.withColumnRenamed("idx", "block").groupBy("tree", "block")
    return left.cogroup(right).applyInPandas(join, f"tree string, idx long, path {PATH}, subroot string, root string")


PROVED = "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _prove(nodes: DataFrame, outer: DataFrame, height: int) -> DataFrame:
    """The rows of the manifest: the exchange of leaves and outer rows by superblock."""

    def join(rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows, levels, top, path = _local(rows, above, height)
        # The part of every proof that lies above the block is the same.
        tail = "".join(chain_of(path))
        proofs, folded = [], []
        for k, changed in enumerate(rows["changed"]):
            inside = block_path(levels, k)
            proofs.append(hashlib.sha256(("".join(chain_of(inside)) + tail).encode()).hexdigest())
            folded.append(fold(changed, inside + path))
        return pd.DataFrame(
            {
                "doc_id": rows["doc_id"].array,
                "leaf": rows["leaf"].array,
                "subroot": top["subroot"],
                "root": top["root"],
                "proof_sha256": proofs,
                "folded_root": folded,
                "verified": np.array(folded, object) == top["root"],
            }
        )

    left = _blocks(nodes, height).select("tree", "block", "idx", "n", "doc_id", "leaf", "changed").groupBy("tree", "block")
    right = outer.withColumnRenamed("idx", "block").groupBy("tree", "block")
    return left.cogroup(right).applyInPandas(join, PROVED)


def chain_of(path: list[tuple[int, list[str]]]) -> list[str]:
    return [sibling for _, siblings in path for sibling in siblings]


def _descend(tiers: list[DataFrame], outer: DataFrame, name: str, height: int) -> DataFrame:
    """Outer rows for the lowest of the tiers' blocks, from those of the topmost nodes."""
    for tier in reversed(tiers):
        outer = stored(_down(tier, outer, height), name)
    return outer


def manifest(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified, one row per row of `docs`."""
    nodes = stored(numbered(stored(leaves(docs), "leaves"), "doc_id", "leaf"), "numbered")
    tiers = _climb(nodes, "subtree", height)
    # The subroots are the leaves of one more tree.
    subroots = tiers[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("leaf"))
    forest = stored(numbered(subroots, "name"), "subroots")
    upper = _climb(forest, "forest", height)
    root = upper[-1].select("tree", "idx", F.from_json(F.lit("[]"), PATH).alias("path"), F.lit("").alias("subroot"), F.col("leaf").alias("root"))
    over = _descend(upper[:-1], root, "roots", height)
    # The topmost node of each source, with the path from there to the root. Where every source has one leaf that is the
    # leaf itself.
    outer = forest.join(over.drop("tree", "subroot"), "idx").select(
        F.col("name").alias("tree"), F.lit(0).cast("long").alias("idx"), "path", F.col("leaf").alias("subroot"), "root"
    )
    outer = _descend(tiers[1:-1], outer, "outer", height)
    proved = _prove(nodes.withColumn("doc_id", F.col("doc_id").cast("string")), outer, height)
    return proved.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))
