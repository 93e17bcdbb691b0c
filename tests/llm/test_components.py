from __future__ import annotations

import random

import pytest

from tabwright.llm.components import connected_components


def brute_components(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in edges:
        if a is not None and b is not None:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    linked = {x for a, b in edges if a != b and None not in (a, b) for x in (a, b)}
    return {(x, find(x)) for x in linked}


@pytest.mark.parametrize("edges", [
    [(1, 1)], [(1, 2), (2, 1), (1, 2)], [(1, None), (None, 2), (3, 4)],
    [(k, k + 1) for k in range(60)], [(0, k) for k in range(1, 300)],
    [(random.Random(k).randrange(200), random.Random(-k).randrange(200)) for k in range(1, 150)],
])
def test_components_equal_union_find(spark, edges):
    found = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {tuple(r) for r in found} == brute_components(edges)
    assert len(found) == len({r.node for r in found})


def test_no_edges_and_text_nodes(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
    found = connected_components(spark.createDataFrame([("b", "c"), ("a", "c")], "a string, b string")).collect()
    assert {tuple(r) for r in found} == {("a", "a"), ("b", "a"), ("c", "a")}
