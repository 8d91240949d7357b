"""As-of joins: boundaries, and one join to overlaid spans against a chain of joins."""

from __future__ import annotations

import random
from datetime import timedelta

import frames
from pyspark.sql import functions as F
from frames import OPEN, START, ts

from vaultline import schemas
from vaultline.functions.columns import whole_second
from vaultline.operators.asof import asof_carried, asof_dim_join, without_gaps
from vaultline.plans import fraud

U = ts("2024-01-15 00:00:00")
SECOND = timedelta(seconds=1)


def test_version_boundaries(spark):
    cards = frames.history(
        spark, schemas.CARDS,
        [("c", "old", None, U, "N"), ("c", "new", U + SECOND, None, "N"), ("d", "gone", None, None, "Y")],
    )
    moments = [U, U + SECOND, U + timedelta(milliseconds=500), U]
    tx = spark.createDataFrame(
        [(i, m, "d" if i == 3 else "c") for i, m in enumerate(moments)],
        "id int, raw timestamp_ntz, card_num string",
    ).withColumn("at", whole_second("raw"))
    joined = asof_dim_join(
        tx, cards, fact_key="card_num", dim_key="card_num", ts="at", attrs={"account_num": "account"}
    )
    assert {r.id: r.account for r in joined.collect()} == {0: "old", 1: "new", 2: "old", 3: None}


def test_whole_second_ignores_the_session_time_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(ts("2024-03-10 02:30:15.25"),)], "t timestamp_ntz")
        assert df.select(whole_second("t")).first()[0] == ts("2024-03-10 02:30:15")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_spans_cover_all_time(spark):
    cards = frames.history(
        spark, schemas.CARDS,
        [("c", "a", ts("2024-01-02 00:00:00"), ts("2024-01-05 00:00:00"), "N"),
         ("c", "b", ts("2024-01-07 00:00:00"), ts("2024-01-08 00:00:00"), "N")],
    )
    spans = without_gaps(cards, key="card_num", attrs=["account_num"]).orderBy("_span_from").collect()
    assert [s.account_num for s in spans] == [None, "a", None, "b", None]
    assert spans[0]._span_from == ts("0001-01-01 00:00:00")
    assert spans[-1]._span_to == OPEN
    assert all(b._span_from - a._span_to == SECOND for a, b in zip(spans, spans[1:], strict=False))


def _random_history(spark, dim, keys, values, rng):
    rows = []
    for key in keys:
        start = START
        for _ in range(rng.randrange(0, 4)):
            end = ts("2024-01-01 00:00:00") + timedelta(hours=rng.randrange(24 * 30))
            if end <= start:
                break
            # a missing or deleted version now and then leaves a gap
            if rng.random() < 0.8:
                rows.append((key, *values(rng), start, end, "N" if rng.random() < 0.9 else "Y"))
            start = end + SECOND
        if rng.random() < 0.7:
            rows.append((key, *values(rng), start, None, "N"))
    return frames.history(spark, dim, rows)


def test_chain_equals_joins_one_by_one(spark):
    rng = random.Random(7)
    ids = [str(i) for i in range(40)]
    cards = _random_history(spark, schemas.CARDS, ids, lambda r: (r.choice([*ids, None]),), rng)
    accounts = _random_history(
        spark, schemas.ACCOUNTS, ids,
        lambda r: (U + timedelta(days=r.randrange(20)), r.choice([*ids, None])), rng,
    )
    clients = _random_history(
        spark, schemas.CLIENTS, ids,
        lambda r: ("l", None, "m", None, r.choice([*ids, None]), None, str(r.random())), rng,
    )
    tx = spark.createDataFrame(
        [
            (i, ts("2024-01-01 00:00:00") + timedelta(hours=rng.randrange(24 * 32)), rng.choice([*ids, None, "x"]))
            for i in range(1_500)
        ],
        "trans_id int, trans_date timestamp_ntz, card_num string",
    )
    step = asof_dim_join(
        tx, cards, fact_key="card_num", dim_key="card_num", ts="trans_date", attrs=["account_num"]
    )
    step = asof_dim_join(
        step, accounts, fact_key="account_num", dim_key="account_num", ts="trans_date",
        attrs=fraud.ACCOUNT_ATTRS,
    )
    step = asof_dim_join(
        step, clients, fact_key="client_id", dim_key="client_id", ts="trans_date", attrs=fraud.CLIENT_ATTRS
    )
    chained = fraud.asof_chain(tx, cards, accounts, clients).select(*step.columns)
    expected = sorted(map(repr, step.collect()))
    assert sorted(map(repr, chained.collect())) == expected
    assert any("phone='0" in row for row in expected)


CARRIED = dict(fact_key="card_num", dim_key="card_num", ts="at", attrs={"account_num": "account"})


def _bag(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_carried_versions_equal_the_join(spark):
    """Random times around slot ends, gaps, deleted versions, keys without versions, missing keys and times."""
    rng = random.Random(8)
    versions = []
    for key in range(5):
        at = ts("2024-01-01 00:00:00") + timedelta(seconds=rng.choice([0, rng.randrange(86_400)]))
        for v in range(rng.randrange(1, 30)):
            end = at + timedelta(seconds=rng.choice([0, 3_600, 86_399, 86_400 * 3]) + rng.randrange(50))
            versions.append((f"c{key}", f"v{v}", at, end, rng.choice("NNNY")))
            at = end + timedelta(seconds=rng.choice([1, 1, 1, 500]))
    versions.append(("c0", "early", START, ts("2023-12-31 23:59:59"), "N"))
    cards = spark.createDataFrame(versions, schemas.CARDS.history_ddl)
    edges = [t + timedelta(seconds=d) for _, _, a, b, _ in versions for t in (a, b) for d in (-1, 0, 1)]
    facts = [(i, rng.choice(edges + [None]), f"c{rng.randrange(7)}" if i % 9 else None, "x") for i in range(1500)]
    facts += [facts[3]] * 3 + [(1, ts("2024-01-03 00:00:00") + timedelta(milliseconds=1), "c0", None)]
    tx = spark.createDataFrame(facts, "id int, at timestamp_ntz, card_num string, effective_to string")
    expected = _bag(asof_dim_join(tx, cards, **CARRIED))
    for options in ({}, {"slot": 3_600}, {"rows_of_piece": 3}, {"slot": 1_000, "rows_of_piece": 1}):
        found = asof_carried(tx, cards, **CARRIED, **options)
        assert found.columns == [*tx.columns, "account"]
        assert _bag(found) == expected, options
    assert _bag(asof_carried(tx, cards.limit(0), **CARRIED)) == _bag(tx.selectExpr("*", "cast(null as string)"))
    assert asof_carried(tx.limit(0), cards, **CARRIED).count() == 0


def test_a_hot_key_with_3000_versions_makes_no_product(spark):
    day = ts("2024-01-01 00:00:00")
    versions = [("hot", f"v{i}", day + timedelta(seconds=20 * i), day + timedelta(seconds=20 * i + 19), "N") for i in range(3_000)]
    cards = spark.createDataFrame(versions, schemas.CARDS.history_ddl)
    at = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=(F.col("id") % 60_000).cast("decimal(18,6)"))
    tx = spark.range(90_000).select("id", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("card_num"), at.alias("at"))
    found = asof_carried(tx, cards, **CARRIED, rows_of_piece=2_000)
    hot = found.filter("card_num = 'hot'")
    assert found.count() == 90_000
    assert hot.filter(F.col("account") == F.concat(F.lit("v"), F.floor(F.col("id") % 60_000 / 20))).count() == 30_000
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # Joins are by equal keys alone: no fact meets a range of versions.
    assert all("<=" not in line and ">=" not in line for line in plan.splitlines() if "Join" in line)
