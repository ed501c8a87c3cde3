import random

import pytest

from sensorlake.llm.graph import components
from tests.llm import brute


def graph(kind, draw):
    if kind == "sparse":
        return [(draw.randrange(300), draw.randrange(300)) for _ in range(200)]
    if kind == "hub least":
        return [(0, i) for i in range(1, 300)]
    if kind == "hub greatest":
        return [(999, i) for i in range(300)]
    if kind == "hub between":
        return [(150, i) for i in range(300)] + [(i, i + 1000) for i in range(0, 300, 7)]
    if kind == "chain":
        nodes = list(range(120))
        draw.shuffle(nodes)
        return list(zip(nodes, nodes[1:]))
    return [(5, 5), (None, 1), (1, None), (-3, 2), (2, -3), (2, 9), (2, 9)]


@pytest.mark.parametrize("kind", ["sparse", "hub least", "hub greatest", "hub between", "chain", "odd"])
def test_components_against_a_plain_version(spark, kind):
    links = graph(kind, random.Random(kind))
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long").repartition(5)).collect()}
    proper = [(a, b) for a, b in links if a is not None and b is not None and a != b]
    exp = {n: min(c) for n, c in brute.roots({x for e in proper for x in e}, proper).items()}
    assert got == {n: r for n, r in exp.items() if n != r}


def test_no_links(spark):
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
