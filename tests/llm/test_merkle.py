"""The manifest against a plain tree per source, from one leaf to more leaves than a superblock holds."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tripflow.llm import merkle


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(*fields):
    return digest("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest("".join(out[-1][k : k + 3])) for k in range(0, len(out[-1]), 3)])
    return out


def climb(levels, k, node, proof):
    for nodes in levels[:-1]:
        run = nodes[k - k % 3 : k - k % 3 + 3]
        proof += run[: k % 3] + run[k % 3 + 1 :]
        node = digest("".join([*run[: k % 3], node, *run[k % 3 + 1 :]]))
        k //= 3
    return node


def plain_manifest(rows):
    """Rows are (doc_id, source, lang, n_chars, text)."""
    sources = {}
    for row in rows:
        sources.setdefault(row[1], []).append((row, leaf(*row)))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in order:
        sources[source].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees[source] = levels_of([node for _, node in sources[source]])
    top = levels_of([trees[s][-1][0] for s in order])
    out = []
    for place, source in enumerate(order):
        for k, (row, node) in enumerate(sources[source]):
            text = row[4]
            if text is not None and zlib.crc32(("" if row[0] is None else str(row[0])).encode()) % 2 == 0:
                text = text.replace("\n", "")
            proof = []
            folded = climb(trees[source], k, leaf(*row[:4], text), proof)
            folded = climb(top, place, folded, proof)
            out.append((row[0], node, trees[source][-1][0], top[-1][0], digest("".join(proof)), folded, folded == top[-1][0]))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def same(frame, **tree):
    rows = [tuple(r[c] for c in COLUMNS) for r in frame.collect()]
    got = sorted((tuple(r) for r in merkle.manifest(frame, **tree).collect()), key=repr)
    assert got == plain_manifest(rows)


def test_awkward_rows(docs, clashing, empty):
    same(docs)
    got = lambda frame: sorted((tuple(r) for r in merkle.manifest(frame).collect()), key=repr)
    assert got(docs) == got(clashing.withColumn("tree", F.lit(1)).withColumn("leaf", F.lit(2)))
    assert merkle.manifest(empty).isEmpty()


@pytest.mark.parametrize("n", [1, 2, 3, 4, 10])
def test_small_trees(text_spark, n):
    one = [(k, "s", "en", k, f"text\n{k}") for k in range(n)]
    same(text_spark.createDataFrame(one, SCHEMA))
    # As many sources, of one row each.
    same(text_spark.createDataFrame([(k, f"é{k}", None, None, None) for k in range(n)], SCHEMA))


def test_trees_of_several_superblocks(text_spark):
    """Nine leaves a superblock: a hot source of four tiers, sources beyond one superblock, ties and null ids."""
    rows = [(k * 7919 % 1009, "hot", "en", k, f"a\nb{k}") for k in range(900)]
    rows += [(k, f"s{k % 31}", "de", None, "x\n" * (k % 3)) for k in range(200)]
    rows += [(None, None, None, None, None)] * 5 + [(3, "hot", "en", 1, "tie"), (3, "hot", "en", 1, "tie"), (3, "hot", "en", 2, "tie")]
    rows += [(5, "one", "en", 3, "alone\n")]
    same(text_spark.createDataFrame(rows, SCHEMA).repartition(7), height=2)


def test_very_long_text_and_only_line_ends(text_spark):
    same(text_spark.createDataFrame([(1, "a", "en", 1, "é\n" * 200_000), (2, "a", "en", 1, "\n" * 50), (4, "b", "", 0, "")], SCHEMA))
