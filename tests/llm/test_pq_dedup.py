from __future__ import annotations

import numpy as np
import pytest

from vaultline.llm import pq_dedup
from vaultline.llm.pq_dedup import Quantiser, as_units, embedding_dedup, fit, forest

SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, n bigint"


def clustered(seed, n, size=16, spread=0.05):
    rng = np.random.default_rng(seed)
    heads = rng.normal(size=(max(1, n // 4), size))
    vectors = heads[rng.integers(0, len(heads), n)] + spread * rng.normal(size=(n, size)) * rng.integers(0, 3, (n, 1))
    return vectors.astype(np.float32)


def brute(rows, similarity=0.98):
    good = [
        (i, np.array(v, np.float64), label)
        for i, v, label in rows
        if v and label is not None and None not in v and np.isfinite(np.array(v, float)).all() and np.any(v)
    ]
    links = {i: 0 for i, _, _ in rows}
    head = {i: i for i, _, _ in rows}
    pairs = [
        (a[0], b[0])
        for a in good
        for b in good
        if a[0] != b[0] and a[2] == b[2] and len(a[1]) == len(b[1]) and as_units(a[1][None])[0] @ as_units(b[1][None])[0] >= similarity
    ]
    for a, _ in pairs:
        links[a] += 1
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            if head[b] < head[a]:
                head[a], changed = head[b], True
    return {i: (links[i], head[i], head[i] == i) for i, _, _ in rows}


def found(spark, rows, **options):
    frame = spark.createDataFrame([(*row, "x", 1) for row in rows], SCHEMA)
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup(frame, **options).collect()}


@pytest.mark.parametrize("lists", [1, 24, None])
def test_equals_brute_force(spark, lists):
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(clustered(1, 400))]
    assert sum(n for n, _, _ in brute(rows).values()) > 300
    assert found(spark, rows, lists=lists) == brute(rows)


def test_small_blocks_lose_nothing(spark, monkeypatch):
    rows = [(i, v.tolist(), 0) for i, v in enumerate(clustered(2, 150, spread=0.02))]
    monkeypatch.setattr(pq_dedup, "STORED", 4)
    monkeypatch.setattr(pq_dedup, "ASKED", 6)
    assert found(spark, rows) == brute(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0), (3, [2.0, 4.0], 0), (4, [1.0, 2.0], 1), (5, [1.0, 2.0], None),
        (6, None, 0), (7, [], 0), (8, [0.0, 0.0], 0), (9, [1.0, None], 0), (10, [nan, 1.0], 0), (11, [inf, 1.0], 0),
        (12, [1.0, 2.0, 0.0], 0), (13, [1.0, 2.0, 0.0], 0), (14, [-1.0, -2.0], 0), (15, [1e-30, 2e-30], 0),
        (16, [0.0, 1.0], 0), (17, [-0.0, 1.0], 0), (18, [1e38, 2e38], 0),
    ]
    assert found(spark, rows) == brute(rows)


def test_empty_table_and_repeated_rows(spark):
    assert found(spark, []) == {}
    frame = spark.createDataFrame([(5, [1.0], 0, "", 0)] * 2 + [(None, [1.0], 0, "", 0)], SCHEMA)
    rows = sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"])) for r in embedding_dedup(frame).collect())
    assert rows == [("5", 1, "5"), ("5", 1, "5"), ("None", 0, "None")]


def test_probes_hold_every_partner():
    units = as_units(clustered(3, 600).astype(np.float64))
    quantiser = fit(units, 20)
    lists = pq_dedup.nearest(units, quantiser.centres)
    probes = quantiser.probes(units, 0.2)
    near = units @ units.T >= 0.98
    for a, b in zip(*np.nonzero(near), strict=True):
        assert lists[b] in probes[a]
    assert np.mean([len(p) for p in probes]) < 20


def test_codes_bound_the_distance():
    units = as_units(clustered(4, 200).astype(np.float64))
    quantiser = fit(units, 4, codes=8)
    lists = pq_dedup.nearest(units, quantiser.centres)
    codes, errors = quantiser.encode(units, lists)
    assert isinstance(quantiser, Quantiser)
    for at in range(len(quantiser.centres)):
        own = np.flatnonzero(lists == at)
        tables = quantiser.tables(units, at)
        coded = np.sqrt(sum(t[:, codes[own, i]] for i, t in enumerate(tables)))
        true = np.sqrt(((units[:, None] - units[own][None]) ** 2).sum(2))
        assert (np.abs(coded - true) <= errors[own] + 1e-6).all()


def test_forest_connects():
    nodes, heads = forest(np.array([0, 0, 1, 3]), np.array([0, 1, 1, 2]), 4, 3)
    assert dict(zip(nodes.tolist(), heads.tolist(), strict=True)) == {1: 0, 4: 0, 5: 0, 6: 3}
