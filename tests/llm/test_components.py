from __future__ import annotations

import random

from estatelake.llm.components import components
from tests.llm import brute


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 200)]
    edges += [(rng.randint(2000, 2400), rng.randint(2000, 2400)) for _ in range(150)] + [(5000, 5000), (-3, 7), (7, -3)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long").repartition(4)).collect()}
    linked = {frozenset(e) for e in edges}
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert got == brute.classes(nodes, lambda a, b: frozenset((a, b)) in linked)


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
