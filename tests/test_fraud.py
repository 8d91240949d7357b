"""The four rules on their boundaries, and the report against the rules one by one."""

from __future__ import annotations

import frames
import pytest
from frames import ts

from vaultline.plans import fraud, testbank

NOW = "2021-04-01 00:00:00"


def times(report):
    return sorted(str(row.event_dt) for row in report.collect())


def holder(spark, *, valid_to=None, passport_valid_to=None, passport="P"):
    return (
        frames.cards(spark, ("c", "a")),
        frames.accounts(spark, ("a", valid_to, "k")),
        frames.clients(spark, frames.client("k", passport, passport_valid_to)),
    )


def visits(spark, *moments, card="c"):
    return frames.transactions(
        spark, [(str(i), t, card, "PAYMENT", 1, "SUCCESS", "t") for i, t in enumerate(moments)]
    )


def test_passport_expiry_counts_the_whole_last_day(spark):
    dims = holder(spark, passport_valid_to="2021-03-01 00:00:00")
    tx = visits(spark, "2021-03-02 00:00:00", "2021-03-02 00:00:01")
    none = frames.blacklist(spark)
    report = fraud.fraud_passport(tx, *dims, none, report_dt=NOW)
    assert times(report) == ["2021-03-02 00:00:01"]


def test_passport_without_expiry_never_expires(spark):
    tx = visits(spark, "2021-03-02 00:00:00")
    other = frames.blacklist(spark, ("other", "2021-01-01 00:00:00"))
    assert times(fraud.fraud_passport(tx, *holder(spark), other, report_dt=NOW)) == []


def test_listing_must_be_earlier_and_repeats_rows(spark):
    tx = visits(spark, "2021-03-01 00:00:00", "2021-03-01 00:00:01", "2021-03-05 00:00:01")
    listed = frames.blacklist(spark, ("P", "2021-03-01 00:00:00"), ("P", "2021-03-05 00:00:00"))
    dims = holder(spark)
    report = fraud.fraud_passport(tx, *dims, listed, report_dt=NOW)
    assert times(report) == ["2021-03-01 00:00:01"] + ["2021-03-05 00:00:01"] * 2
    once = fraud.fraud_passport(tx, *dims, listed, report_dt=NOW, dedupe=True)
    assert times(once) == ["2021-03-01 00:00:01", "2021-03-05 00:00:01"]


def test_contract_end(spark):
    dims = holder(spark, valid_to="2021-03-01 00:00:00")
    tx = visits(spark, "2021-03-02 00:00:00", "2021-03-02 00:00:01")
    report = fraud.fraud_contract(tx, *dims, report_dt=NOW)
    assert times(report) == ["2021-03-02 00:00:01"]


def test_contract_end_without_client(spark):
    dims = (
        frames.cards(spark, ("c", "a")),
        frames.accounts(spark, ("a", "2021-03-01 00:00:00", "k")),
        frames.clients(spark),
    )
    row = fraud.fraud_contract(visits(spark, "2021-03-09 00:00:00"), *dims, report_dt=NOW).first()
    assert (row.passport, row.fio, row.event_type, row.report_dt) == (None, "  ", 2, ts(NOW))


def test_missing_patronymic_keeps_its_space(spark):
    dims = (
        frames.cards(spark, ("c", "a")),
        frames.accounts(spark, ("a", "2021-03-01 00:00:00", "k")),
        frames.clients(spark, frames.client("k", middle=None)),
    )
    row = fraud.fraud_contract(visits(spark, "2021-03-09 00:00:00"), *dims, report_dt=NOW).first()
    assert row.fio == "Last First "


def in_places(spark, rows):
    tx = frames.transactions(
        spark,
        [(str(i), t, c, "PAYMENT", 1, "SUCCESS", place) for i, (c, place, t) in enumerate(rows)],
    )
    places = sorted({place for _, place, _ in rows})
    terminals = frames.terminals(spark, *[(p, None if p == "nowhere" else p) for p in places])
    return tx, *holder(spark), terminals


def test_cities_trace(spark):
    rows = [
        ("4709", "Харабали", "2021-03-02 00:16:34"),
        ("4709", "Тюмень", "2021-03-02 00:28:38"),
        ("4709", "Тюмень", "2021-03-02 00:43:40"),
        ("4709", "Тюмень", "2021-03-02 00:52:34"),
        ("2979", "Истра", "2021-03-01 02:54:34"),
        ("2979", "Иркутск", "2021-03-01 03:18:45"),
        ("4311", "Нижний Новгород", "2021-03-03 01:00:13"),
        ("4311", "Москва", "2021-03-03 01:03:29"),
        ("4311", "Москва", "2021-03-03 01:31:40"),
        ("4311", "Москва", "2021-03-03 01:59:40"),
    ]
    report = fraud.fraud_cities(*in_places(spark, rows), report_dt=NOW)
    assert times(report) == sorted(rows[i][2] for i in (1, 2, 3, 5, 7, 8, 9))


@pytest.mark.parametrize(
    ("rows", "flagged"),
    [
        ([("c", "A", "2021-03-01 10:00:00"), ("c", "B", "2021-03-01 11:00:00")], 1),
        ([("c", "A", "2021-03-01 10:00:00"), ("c", "B", "2021-03-01 11:00:01")], 0),
        ([("c", "A", "2021-03-01 10:00:00"), ("c", "B", "2021-03-01 10:00:00")], 2),
        ([("c", "A", "2021-03-01 10:00:00"), ("c", "nowhere", "2021-03-01 10:30:00")], 0),
        ([(None, "A", "2021-03-01 10:00:00"), (None, "B", "2021-03-01 10:30:00")], 0),
        # across the border of a day
        ([("c", "A", "2021-03-01 23:30:00"), ("c", "B", "2021-03-02 00:30:00")], 1),
        ([("c", "A", "2021-03-01 23:30:00"), ("c", "B", "2021-03-02 00:30:01")], 0),
        # three operations in one second, two of them in one city
        ([("c", "A", "2021-03-01 10:00:00"), ("c", "A", "2021-03-01 10:00:00"),
          ("c", "B", "2021-03-01 10:00:00")], 3),
    ],
)
def test_cities_boundaries(spark, rows, flagged):
    assert fraud.fraud_cities(*in_places(spark, rows), report_dt=NOW).count() == flagged


TRACE = [
    ("4202", "2021-03-01 22:33:59", "WITHDRAW", 1000, "REJECT"),
    ("4202", "2021-03-01 22:34:58", "WITHDRAW", 900, "REJECT"),
    ("4202", "2021-03-01 22:36:01", "WITHDRAW", 800, "REJECT"),
    ("4202", "2021-03-01 22:36:38", "WITHDRAW", 700, "SUCCESS"),
    ("4709", "2021-03-02 23:59:34", "PAYMENT", 9824.3, "REJECT"),
    ("4709", "2021-03-03 00:03:49", "PAYMENT", 8824.3, "REJECT"),
    ("4709", "2021-03-03 00:07:07", "PAYMENT", 7824.3, "REJECT"),
    ("4709", "2021-03-03 00:13:21", "PAYMENT", 6824.3, "SUCCESS"),
]


def guesses(spark, rows):
    tx = frames.transactions(
        spark, [(f"{i:03}", t, c, k, a, r, "t") for i, (c, t, k, a, r) in enumerate(rows)]
    )
    return times(fraud.fraud_guessing(tx, *holder(spark), report_dt=NOW))


def test_guessing_trace(spark):
    assert guesses(spark, TRACE) == ["2021-03-01 22:36:38", "2021-03-03 00:13:21"]


def attempts(*changes, times=("10:00:00", "10:05:00", "10:10:00", "10:20:00"), amounts=(4, 3, 2, 1)):
    rows = [
        ["c", f"2021-03-01 {t}", "PAYMENT", a, "REJECT"] for t, a in zip(times, amounts, strict=True)
    ]
    rows[-1][4] = "SUCCESS"
    for row, field, value in changes:
        rows[row][field] = value
    return [tuple(row) for row in rows]


@pytest.mark.parametrize(
    ("rows", "flagged"),
    [
        (attempts(), 1),
        (attempts(times=("09:59:59", "10:05:00", "10:10:00", "10:20:00")), 0),
        (attempts(amounts=(4, 3, 3, 1)), 0),
        (attempts(amounts=(4, 3, 2, 2)), 0),
        (attempts((1, 2, "DEPOSIT")), 0),
        (attempts((0, 4, "SUCCESS")), 0),
        (attempts((3, 4, "REJECT")), 0),
        (attempts(times=("10:00:00", "10:05:00", "10:05:00", "10:20:00")), 0),
        (attempts(times=("10:00:00", "10:05:00", "10:20:00", "10:20:00")), 0),
        # a deposit between the attempts, and four attempts
        (attempts() + [("c", "2021-03-01 10:07:00", "DEPOSIT", 3, "SUCCESS")], 0),
        ([("c", "2021-03-01 09:00:00", "PAYMENT", 5, "REJECT")] + attempts(), 1),
        # the first attempt shares its second with an earlier operation
        ([("c", "2021-03-01 10:00:00", "DEPOSIT", 9, "SUCCESS")] + attempts(), 1),
        # operations without a card follow each other like those of one card
        (attempts(*[(i, 0, None) for i in range(4)]), 1),
    ],
)
def test_guessing_boundaries(spark, rows, flagged):
    assert len(guesses(spark, rows)) == flagged


def test_report_is_the_union_of_the_rules(spark):
    b = testbank.bank(spark, "/root/testdata/sf0.001")
    dims = (b.cards, b.accounts, b.clients)
    wide = dict(report_dt=NOW, n=2, within=7 * 86_400)
    parts = fraud.report_union(
        fraud.fraud_passport(b.transactions, *dims, b.blacklist, report_dt=NOW),
        fraud.fraud_contract(b.transactions, *dims, report_dt=NOW),
        fraud.fraud_cities(b.transactions, *dims, b.terminals, report_dt=NOW),
        fraud.fraud_guessing(b.transactions, *dims, **wide),
    )
    expected = sorted(map(repr, parts.collect()))
    whole = fraud.fraud_report(b.transactions, *dims, b.terminals, b.blacklist, **wide)
    assert sorted(map(repr, whole.collect())) == expected

    spans = fraud.holder_spans(*dims, b.blacklist).checkpoint()
    latest = b.transactions.groupBy().agg({"trans_date": "max"}).scalar()
    few = fraud.suspects(spans, latest)
    assert few.count() < spans.count()
    again = fraud.report_from_spans(b.transactions, b.terminals, spans, few, **wide)
    assert sorted(map(repr, again.collect())) == expected


def test_many_rows_of_one_second_are_all_reported(spark):
    """More copies than fit in one block of the repetition."""
    rows = [(str(i), "2021-03-01 10:00:00", "c", "PAYMENT", 1, "SUCCESS", "A") for i in range(2_500)]
    rows.append(("x", "2021-03-01 09:30:00", "c", "PAYMENT", 1, "SUCCESS", "B"))
    tx = frames.transactions(spark, rows)
    terminals = frames.terminals(spark, ("A", "A"), ("B", "B"))
    report = fraud.fraud_cities(tx, *holder(spark), terminals, report_dt=NOW)
    assert report.count() == 2_500
    assert {row.event_dt for row in report.collect()} == {ts("2021-03-01 10:00:00")}
