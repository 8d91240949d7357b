from __future__ import annotations

import random

from vaultline.llm.components import connected_components


def found(spark, links):
    frame = spark.createDataFrame(links, "a bigint, b bigint")
    return {r["node"]: r["component"] for r in connected_components(frame).collect()}


def test_shapes(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 560)]
    high_star = [(999, i) for i in range(700, 760)]
    got = found(spark, path + star + high_star + [(5, 5), (None, 7), (2, 1), (1, 2)])
    assert {got[i] for i in range(100, 161)} == {100}
    assert {got[i] for i in range(500, 560)} == {500}
    assert {got[i] for i in [*range(700, 760), 999]} == {700}
    assert got[1] == got[2] == 1
    assert 5 not in got


def test_no_links(spark):
    assert found(spark, []) == {}


def test_random_graph(spark):
    rng = random.Random(3)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)]
    head = list(range(400))
    for _ in range(400):
        for a, b in links:
            head[a] = head[b] = min(head[a], head[b])
    got = found(spark, links)
    assert all(got[a] == head[a] for a, b in links if a != b)
