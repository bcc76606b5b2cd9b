from __future__ import annotations

import random

import pytest

from llm_helpers import workers_find_the_package  # noqa: F401
from millrace.llm.components import connected_components


@pytest.mark.parametrize("edges", [
    [],
    [(5, 5)],
    [(i, i + 1) for i in range(60)],
    [(0, i) for i in range(1, 80)] + [(100, i) for i in range(101, 150)],
    [(random.Random(i).randrange(90), random.Random(-i).randrange(90)) for i in range(70)],
    [(-3, 4), (4, -3), (-(1 << 63), (1 << 63) - 1)],
])
def test_components_like_a_plain_version(spark, edges):
    root = {n: n for edge in edges for n in edge}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    found = {row["node"]: row["component"]
             for row in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {n: r for n, r in root.items() if any(a != b and n in (a, b) for a, b in edges)}
