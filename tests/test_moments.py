"""Patterns over slots against plain Python over whole cards."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from decimal import Decimal

import frames
import pytest
from frames import settings

from vaultline.operators import moments
from vaultline.schemas import TRANSACTIONS_DDL

T0 = datetime(2024, 1, 1)


def random_rows(seed: int, hot: int = 400) -> list[tuple]:
    """A hot card, a few small ones and NULL cards; many equal times."""
    rng = random.Random(seed)
    rows = []
    cards = ["hot"] * hot + [rng.choice(["a", "b", None]) for _ in range(150)]
    for i, card in enumerate(cards):
        at = T0 + timedelta(minutes=rng.randrange(0, 3 * 24 * 60, 7 if rng.random() < 0.5 else 1))
        rows.append(
            (
                f"{i:05}", at, card, rng.choice(["PAYMENT", "WITHDRAW", "DEPOSIT"]),
                Decimal(rng.randrange(1, 6)), rng.choice(["REJECT", "REJECT", "SUCCESS"]),
                rng.choice(["x", "x", "x", "y", None]),
            )
        )
    return rows


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("minutes", [5, 60])
def test_two_places(spark, seed, minutes):
    rows = random_rows(seed)
    within = timedelta(minutes=minutes)
    expected = sorted(
        r[0]
        for r in rows
        if r[2] is not None and r[6] is not None
        and any(
            o[2] == r[2] and o[6] is not None and o[6] != r[6] and r[1] - within <= o[1] <= r[1]
            for o in rows
        )
    )
    tx = spark.createDataFrame(rows, TRANSACTIONS_DDL)
    found = moments.two_places(
        tx, key="card_num", ts="trans_date", place="terminal", within=minutes * 60
    )
    assert sorted(r.trans_id for r in found.collect()) == expected
    assert 0 < len(expected) < len(rows)


def by_card(rows):
    cards: dict = {}
    for row in sorted(rows, key=lambda r: (r[1], r[0])):
        cards.setdefault(row[2], []).append(row)
    return cards


@pytest.mark.parametrize("seed", [3, 4])
@pytest.mark.parametrize("n", [1, 2, 3])
def test_decreasing_chain(spark, seed, n):
    rows = random_rows(seed, hot=1_500)
    within = timedelta(hours=2)
    spending = ("PAYMENT", "WITHDRAW")
    expected = []
    for operations in by_card(rows).values():
        for i in range(n, len(operations)):
            chain = operations[i - n : i + 1]
            pairs = list(zip(chain, chain[1:], strict=False))
            if (
                chain[-1][5] == "SUCCESS"
                and all(r[5] == "REJECT" for r in chain[:-1])
                and all(r[3] in spending for r in chain)
                and all(a[1] < b[1] and a[4] > b[4] for a, b in pairs)
                and chain[0][1] >= chain[-1][1] - within
            ):
                expected.append(chain[-1][0])
    tx = spark.createDataFrame(rows, TRANSACTIONS_DDL)
    found = moments.decreasing_chain(
        tx, key="card_num", ts="trans_date", tie="trans_id", amount="amt", n=n, within=7_200
    )
    assert sorted(r.trans_id for r in found.collect()) == sorted(expected)
    assert expected or n == 3


@pytest.mark.parametrize("seed", [6, 7, 9, 10, 11, 12, 13])
def test_loose_chain(spark, seed):
    """Against the plain definition: any three attempts, and no operation that spoils them. Some seeds have few amounts,
    crowded moments, and operations without an amount, a result or a type."""
    rng = random.Random(seed)
    blank, amounts, span = (seed % 2 == 0) * 6, (6, 9, 20)[seed % 3], (900, 2_880)[seed % 4 < 2]
    rows = [
        (
            f"{i:04}", T0 + timedelta(minutes=rng.randrange(0, span)), rng.choice("ab"),
            rng.choice(["PAYMENT"] * 50 + ["DEPOSIT"] * 2 + [None] * (blank // 3)),
            rng.choice([Decimal(rng.randrange(1, amounts + 1))] * 50 + [None] * blank),
            rng.choice(["REJECT"] * 40 + ["SUCCESS"] * 8 + [None] * blank), "t",
        )
        for i in range(700)
    ]
    minutes = 40
    expected = []
    for end in rows:
        if end[3] != "PAYMENT" or end[5] != "SUCCESS" or end[4] is None:
            continue
        since = end[1] - timedelta(minutes=minutes)
        near = [r for r in rows if r[2] == end[2] and since <= r[1] < end[1]]
        tries = [r for r in near if r[3] == "PAYMENT" and r[5] == "REJECT" and r[4] is not None]

        def fits(first, second, third, end=end, near=near):
            return not any(
                first[1] < x[1] and x not in (first, second, third)
                and (
                    x[3] not in ("PAYMENT", None) or x[5] not in ("REJECT", None)
                    or x[4] is not None and (
                        x[4] < end[4] or (x[4] < second[4] and x[1] <= second[1]) or (x[4] < third[4] and x[1] <= third[1])
                    )
                )
                for x in near
            )

        if any(
            fits(a, b, c)
            for c in tries if c[4] > end[4]
            for b in tries if b[1] < c[1] and b[4] > c[4]
            for a in tries if a[1] < b[1] and a[4] > b[4]
        ):
            expected.append(end[0])
    tx = spark.createDataFrame(rows, TRANSACTIONS_DDL)
    found = moments.loose_chain(
        tx, key="card_num", ts="trans_date", amount="amt", within=minutes * 60
    )
    assert sorted(r.trans_id for r in found.collect()) == sorted(expected)
    strict = moments.decreasing_chain(
        tx, key="card_num", ts="trans_date", tie="trans_id", amount="amt", within=minutes * 60
    )
    assert expected and {r.trans_id for r in strict.collect()} <= set(expected)


@pytest.mark.parametrize("partitions", [1, 8, 200])
def test_lag_back(spark, tmp_path, partitions):
    """One slot, some, and as many as a slot for nearly each row."""
    rows = random_rows(5)
    expected = {}
    for operations in by_card(rows).values():
        for i, row in enumerate(operations):
            expected[row[0]] = tuple(
                operations[i - k][4] if i >= k else None for k in (1, 2, 3)
            )
    tx = spark.createDataFrame(rows, TRANSACTIONS_DDL)
    with settings(
        spark, spark__sql__shuffle__partitions=partitions, spark__sql__adaptive__coalescePartitions__enabled=False
    ):
        found = moments.lag_back(
            tx, key="card_num", ts="trans_date", tie="trans_id", columns=["amt"], store=str(tmp_path / "slots")
        ).collect()
    result = {r.trans_id: (r.amt_back_1, r.amt_back_2, r.amt_back_3) for r in found}
    assert result == expected


def test_slots_hold_one_row_per_moment(spark):
    """However many rows a card has in a second, windows see one."""
    tx = frames.transactions(
        spark, [(str(i), "2024-01-01 10:00:00", "c", "PAYMENT", 1, "SUCCESS", "t") for i in range(500)]
    )
    cells = moments.in_slots(
        tx.groupBy("card_num", "trans_date").agg(*moments.place_facts("terminal")),
        ts="trans_date", reach=3_600,
    )
    assert cells.count() == 1
