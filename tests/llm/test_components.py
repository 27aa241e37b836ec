"""Components of random graphs, chains and hubs against union-find."""

import random

import pytest

from basketry.llm import components as C
from basketry.llm.scratch import Scratch


def union_find(links):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for u, v in links:
        if u != v:
            a, b = sorted((find(u), find(v)))
            root[b] = a
    return {x: find(x) for x in list(root)}


def graphs():
    rnd = random.Random(1)
    ids = lambda n: list({rnd.getrandbits(64) - 2**63 for _ in range(n)})
    chain = ids(300)
    hub = ids(2000)
    yield [(a, b) for a, b in zip(chain, chain[1:])]
    yield [(hub[1000], x) for x in hub] * 2
    nodes = ids(900)
    yield [(rnd.choice(nodes), rnd.choice(nodes)) for _ in range(500)]
    yield [(5, 5), (1, 2), (2, 1), (2, 3)]
    yield []


@pytest.mark.parametrize("links", list(graphs()), ids=["chain", "hub", "random", "loops", "none"])
def test_components_are_those_of_union_find(spark, links, monkeypatch):
    frame = spark.createDataFrame(links, "u long, v long")
    got = [(r.node, r.component) for r in C.components(frame, Scratch(spark, "graph")).collect()]
    assert sorted(got) == sorted(union_find(links).items())
