"""Connected components of small and large edge tables, and what a round costs."""

import random

import pytest

from tripflow.llm import components as module


def smallest_reached(edges):
    label = {}

    def root(x):
        while label.setdefault(x, x) != x:
            x = label[x]
        return x

    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        label[high] = low
    return sorted((x, root(x)) for x in label)


def made_edges():
    rng = random.Random(11)
    path = list(range(60))
    rng.shuffle(path)
    hub = [(1000, 1001 + k) for k in range(200)]
    some = [(2000 + rng.randint(0, 300), 2000 + rng.randint(0, 300)) for _ in range(250)]
    return [*zip(path, path[1:]), *hub, *some, (1003, 2001), (5000, 5001), (5001, 5000)]


@pytest.mark.parametrize("few", [module.FEW_EDGES, 0])
def test_labels_are_the_smallest_reachable_node(text_spark, monkeypatch, few):
    monkeypatch.setattr(module, "FEW_EDGES", few)
    edges = [e for e in made_edges() if e[0] != e[1]]
    found = module.components(text_spark.createDataFrame(made_edges(), "a long, b long"))
    assert sorted((r["node"], r["label"]) for r in found.collect()) == smallest_reached(edges)
    assert module.components(text_spark.createDataFrame([], "a long, b long")).isEmpty()


def test_rounds_over_few_edges_take_few_tasks(text_spark, monkeypatch):
    files, write = [], module.stored
    monkeypatch.setattr(module, "stored", lambda f, n: (out := write(f, n), files.append(len(out.inputFiles())))[0])
    changed = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "40"}
    before = {k: text_spark.conf.get(k) for k in changed}
    try:
        for k, v in changed.items():
            text_spark.conf.set(k, v)
        stars = text_spark.createDataFrame([(k, k % 30) for k in range(30, 400)], "a long, b long")
        module.components(stars)
        # Edges that are stars already need no round, so they are written once.
        assert len(files) == 1
        module.components(text_spark.createDataFrame(made_edges(), "a long, b long"))
        assert len(files) > 3 and max(files[2:]) == 1
    finally:
        for k, v in before.items():
            text_spark.conf.set(k, v)
