"""History loads: the worked example, boundaries, and random loads against plain Python."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from frames import OPEN, ts

from vaultline.operators import scd2
from vaultline.operators.checks import duplicate_keys, history_rules, violations

HISTORY = (
    "key string, a string, b string, effective_from timestamp_ntz, effective_to timestamp_ntz, deleted_flg string"
)
STAGE = "key string, a string, b string, create_dt timestamp_ntz, update_dt timestamp_ntz"
ARGS = dict(key="key", tracked=("a", "b"))
T0, U, NOW = ts("2024-01-01 00:00:00"), ts("2024-01-10 00:00:00"), ts("2024-01-11 00:00:00")
SECOND = timedelta(seconds=1)


def hist(spark, *rows):
    return spark.createDataFrame([(k, a, None, f, t or OPEN, d) for k, a, f, t, d in rows], HISTORY)


def stage(spark, *rows):
    return spark.createDataFrame([(k, a, None, c, u) for k, a, c, u in rows], STAGE)


def keys(spark, *names):
    return spark.createDataFrame([(name,) for name in names], "key string")


def load(spark, history, staged, active, as_of=NOW):
    result = scd2.scd2_load(history, staged, active, as_of=as_of, **ARGS)
    return sorted(
        (r.key, r.a, r.effective_from, r.effective_to, r.deleted_flg) for r in result.collect()
    )


def test_worked_example(spark):
    history = hist(spark, ("1", "a", T0, None, "N"), ("2", "b", T0, None, "N"), ("3", "c", T0, None, "N"))
    staged = stage(spark, ("1", "a2", T0, U), ("2", "b", T0, U), ("4", "d", T0, U))
    assert load(spark, history, staged, keys(spark, "1", "2", "4")) == [
        ("1", "a", T0, U, "N"),
        ("1", "a2", U + SECOND, OPEN, "N"),
        ("2", "b", T0, OPEN, "N"),
        ("3", "c", T0, NOW, "N"),
        ("3", "c", NOW + SECOND, OPEN, "Y"),
        ("4", "d", U, OPEN, "N"),
    ]


@pytest.mark.parametrize(
    ("old", "new"), [(None, "x"), ("x", None), ("x", "y")], ids=["from null", "to null", "value"]
)
def test_changes_with_null(spark, old, new):
    history, staged = hist(spark, ("1", old, T0, None, "N")), stage(spark, ("1", new, T0, U))
    result = scd2.scd2_load(history, staged, keys(spark, "1"), as_of=NOW, **ARGS)
    assert [(r.a, r.effective_from, r.effective_to) for r in result.orderBy("effective_from").collect()] == [
        (old, T0, U),
        (new, U + SECOND, OPEN),
    ]


def test_late_update_is_ignored(spark):
    history = hist(spark, ("1", "a", U, None, "N"))
    staged = stage(spark, ("1", "late", T0, T0 + SECOND))
    assert load(spark, history, staged, keys(spark, "1")) == [("1", "a", U, OPEN, "N")]


def test_creation_time_stands_in_for_a_missing_update_time(spark):
    history = hist(spark, ("1", "a", T0, U, "N"), ("1", "a", U + SECOND, None, "Y"))
    at = U + timedelta(days=1)
    staged = stage(spark, ("1", "back", at, None), ("2", "new", at, None))
    assert load(spark, history, staged, keys(spark, "1", "2")) == [
        ("1", "a", T0, U, "N"),
        ("1", "a", U + SECOND, OPEN, "Y"),
        ("1", "back", at + SECOND, OPEN, "N"),
        ("2", "new", at, OPEN, "N"),
    ]


def test_stage_rows_of_dead_keys_are_left_out(spark):
    """A known key that died after it was extracted is deleted, an unknown one ignored."""
    history = hist(spark, ("1", "a", T0, None, "N"))
    staged = stage(spark, ("1", "late", T0, U), ("2", "dead", T0, U))
    assert load(spark, history, staged, keys(spark, "3")) == [
        ("1", "a", T0, NOW, "N"),
        ("1", "a", NOW + SECOND, OPEN, "Y"),
    ]


def test_key_twice_in_the_stage_fails(spark):
    staged = stage(spark, ("1", "a", T0, U), ("1", "b", T0, U))
    with pytest.raises(Exception, match="key twice in the stage: 1"):
        load(spark, hist(spark), staged, keys(spark, "1"))


def steps(history, staged, active, as_of):
    """The four steps one after the other."""
    changes = scd2.scd2_changes(history, staged, active, as_of=as_of, **ARGS)
    merged = scd2.scd2_merge(history, changes, **ARGS)
    parts = [
        scd2.scd2_close(history, changes, **ARGS),
        scd2.scd2_insert_new(history, changes, **ARGS),
    ]
    rows = sorted((tuple(r) for part in parts for r in part.collect()), key=repr)
    assert sorted(map(tuple, merged.collect()), key=repr) == rows
    return rows + [tuple(r) for r in scd2.scd2_reopen(merged, changes, **ARGS).collect()]


def in_python(history: list[tuple], source: dict, as_of: datetime) -> list[tuple]:
    """The same load, key by key. ``source`` maps live keys to (a, b, update time)."""
    result = list(history)
    current = {r[0]: r for r in history if r[5] == "N" and r[4] == OPEN}
    known = {r[0] for r in history if r[5] == "N"}
    for key in set(current) | set(source):
        if key in source:
            a, b, at = source[key]
            flag = "N"
        else:
            (_, a, b, *_), at, flag = current[key], as_of, "Y"
        old = current.get(key)
        if old is not None:
            if old[3] >= at or (flag == "N" and old[1:3] == (a, b)):
                continue
            result.remove(old)
            result.append((*old[:4], at, "N"))
        result.append((key, a, b, at + SECOND if key in known else at, OPEN, flag))
    return result


@pytest.mark.parametrize("seed", [1, 2])
def test_random_loads(spark, seed):
    """Keys come, change, go and return. After each load: as in Python, as step by step,
    invariants hold, the snapshot can be read back, and a second load changes nothing."""
    rng = random.Random(seed)
    names = [f"k{i}" for i in range(60)]
    rows: list[tuple] = []
    at = T0
    for _ in range(5):
        at += timedelta(seconds=rng.randrange(4, 100_000))
        live = [k for k in names if rng.random() < 0.7]
        source = {k: (rng.choice(["x", "y", None]), rng.choice(["p", "q"]), at) for k in live}
        history = spark.createDataFrame(rows, HISTORY)
        staged = spark.createDataFrame([(k, a, b, T0, u) for k, (a, b, u) in source.items()], STAGE)
        active = keys(spark, *live)
        as_of = at + SECOND
        result = scd2.scd2_load(history, staged, active, as_of=as_of, **ARGS)
        got = sorted(map(tuple, result.collect()), key=repr)
        assert got == sorted(in_python(rows, source, as_of), key=repr)
        assert got == sorted(steps(history, staged, active, as_of), key=repr)
        rows = got

        state = spark.createDataFrame(rows, HISTORY)
        assert violations(state, history_rules("key")).filter("violations > 0").count() == 0
        assert duplicate_keys(state.filter(scd2.is_current()), "key").count() == 0
        later = as_of + timedelta(seconds=2)
        seen = {r[0]: r[1:3] for r in rows if r[5] == "N" and r[3] <= later <= r[4]}
        assert seen == {k: v[:2] for k, v in source.items()}
        again = scd2.scd2_load(state, staged, active, as_of=later, **ARGS)
        assert sorted(map(tuple, again.collect()), key=repr) == rows
    for key in names:
        spans = sorted(r[3:5] for r in rows if r[0] == key and r[5] == "N")
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))
