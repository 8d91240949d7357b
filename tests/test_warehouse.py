"""Days of loads and reports over a store."""

from __future__ import annotations

from datetime import datetime

import pytest
from frames import OPEN, ts
from pyspark.sql import functions as F

from vaultline import schemas
from vaultline.operators.checks import ConstraintError
from vaultline.plans.warehouse import LOADED, NOTHING_TO_LOAD, Warehouse
from vaultline.plans.workbook_fixture import workbook
from vaultline.sources.store import Overtaken, Store

HEADER = ";".join(schemas.TRANSACTION_FILE_COLUMNS)


def drop_files(folder, day, lines, terminals, listed):
    (folder / f"transactions_{day}032021.txt").write_text("\n".join([HEADER, *lines]) + "\n")
    (folder / f"terminals_{day}032021.xlsx").write_bytes(
        workbook("terminals", list(schemas.TERMINAL_FILE_COLUMNS), terminals)
    )
    (folder / f"passport_blacklist_{day}032021.xlsx").write_bytes(
        workbook("blacklist", ["date", "passport"], listed)
    )


def sources(spark, city_of_client="x", cards=("4709 ", "4710 ")):
    created = ts("2021-02-01 00:00:00")
    return {
        "accounts": spark.createDataFrame(
            [("a1", ts("2021-03-01"), "k1", created, None), ("a2", ts("2030-01-01"), "k2", created, None)],
            f"account string, valid_to timestamp_ntz, client string, {DATES}",
        ),
        "cards": spark.createDataFrame(
            [(c, f"a{i + 1} ", created, None) for i, c in enumerate(cards)],
            f"card_num string, account string, {DATES}",
        ),
        "clients": spark.createDataFrame(
            [
                (f"k{i}", "Last", "First", "", None, f"p{i}", ts("2030-01-01"), "1", created, None)
                for i in (1, 2)
            ],
            f"{schemas.CLIENTS_DDL}, {DATES}",
        ),
    }


DATES = "create_dt timestamp_ntz, update_dt timestamp_ntz"
TERMINALS = [["T1", "ATM", "north", "s"], ["T2", "POS", "south", "s"]]


def test_two_days(spark, tmp_path):
    files = tmp_path / "files"
    files.mkdir()
    store = Store(spark, str(tmp_path / "store"))
    house = Warehouse(store)
    drop_files(
        files, "01",
        ["1;2021-03-01 10:00:00;10,5;4709;PAYMENT;SUCCESS;T1", "2;2021-03-01 10:30:00;10,5;4709;PAYMENT;SUCCESS;T2"],
        TERMINALS,
        [[datetime(2021, 2, 27), "p2"], [datetime(2021, 3, 1), "p2"]],
    )
    first = house.run(sources(spark), str(files), as_of=datetime(2021, 3, 2))
    assert [o.status for o in first] == [LOADED] * 6, first
    assert [o.rows for o in first] == [2, 2, 2, 2, 2, 1]
    assert store.latest("dim_cards_hist") == (1, ts("2021-02-01"))
    assert store.latest("fact_transactions") == (1, ts("2021-03-01"))
    assert {r.effective_from for r in store.history(schemas.TERMINALS).collect()} == {ts("1900-01-01")}

    report = house.build_fraud_report(report_dt=datetime(2021, 3, 2, 1))
    assert [(str(r.event_dt), r.passport, r.fio, r.event_type) for r in report.collect()] == [
        ("2021-03-01 10:30:00", "p1", "Last First ", 3)
    ]

    # nothing new: files are missing, tables are unchanged
    idle = house.run(sources(spark), str(files), as_of=datetime(2021, 3, 2), exclude=["clients"])
    assert [o.status for o in idle] == [LOADED] * 2 + [NOTHING_TO_LOAD] * 3
    assert store.history(schemas.CARDS).count() == 2

    # the second day: a card is gone, a terminal moves, one is gone
    drop_files(
        files, "02",
        ["3;2021-03-02 10:00:00;10,5;4709;PAYMENT;SUCCESS;T1", "4;2021-03-02 12:00:00;10,5;4709;PAYMENT;SUCCESS;T2",
         "5;2021-03-02 12:00:01;1;4710;PAYMENT;SUCCESS;T2"],
        [["T1", "ATM", "east", "s"]],
        [[datetime(2021, 3, 2), "p2"]],
    )
    second = house.run(sources(spark, cards=("4709 ",)), str(files), as_of=datetime(2021, 3, 3))
    assert [o.status for o in second] == [LOADED] * 6, second
    cards = sorted(map(tuple, store.history(schemas.CARDS).collect()))
    assert cards[1:] == [
        ("4710", "a2", ts("2021-02-01"), ts("2021-03-03"), "N"),
        ("4710", "a2", ts("2021-03-03 00:00:01"), OPEN, "Y"),
    ]
    terminals = sorted(map(tuple, store.history(schemas.TERMINALS).collect()))
    assert [(t[0], t[2], str(t[4]), str(t[5]), t[6]) for t in terminals] == [
        ("T1", "east", "2021-03-02 00:00:01", "9999-12-31 00:00:00", "N"),
        ("T1", "north", "1900-01-01 00:00:00", "2021-03-02 00:00:00", "N"),
        ("T2", "south", "1900-01-01 00:00:00", "2021-03-02 00:00:00", "N"),
        ("T2", "south", "2021-03-02 00:00:01", "9999-12-31 00:00:00", "Y"),
    ]
    # an older version can still be read
    assert store.history(schemas.CARDS, 1).count() == 2

    now = datetime(2021, 3, 3, 1)
    for _again in range(2):
        report = house.build_fraud_report(report_dt=now)
        assert sorted((str(r.event_dt), r.passport, r.event_type) for r in report.collect()) == [
            ("2021-03-01 10:30:00", "p1", 3),
            ("2021-03-02 10:00:00", "p1", 2),
            ("2021-03-02 12:00:00", "p1", 2),
            ("2021-03-02 12:00:01", "p2", 1),
            ("2021-03-02 12:00:01", "p2", 1),
        ]
    meta = {r.tbl_name: r.integrated_dt for r in store.meta("fact_transactions", "dim_cards_hist").collect()}
    assert meta == {"fact_transactions": ts("2021-03-02"), "dim_cards_hist": ts("2021-02-01")}


def test_load_without_commit_is_invisible(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    stage = spark.createDataFrame([("c", "a", ts("2021-03-01"), None)], f"{schemas.CARDS_DDL}, {DATES}")
    active = stage.select("card_num")
    store.load_history(schemas.CARDS, stage, active, as_of=ts("2021-03-02"))
    assert store.history(schemas.CARDS).count() == 0
    loaded = store.load_history(schemas.CARDS, stage, active, as_of=ts("2021-03-02"))
    store.commit_history(schemas.CARDS, loaded, ts("2021-03-01"))
    assert (loaded.version, loaded.rows, store.history(schemas.CARDS).count()) == (1, 1, 1)
    with pytest.raises(Overtaken, match="version 1 is taken"):
        store.commit_history(schemas.CARDS, loaded, ts("2021-03-01"))


def test_failed_load_stops_no_other(spark, tmp_path):
    files = tmp_path / "files"
    files.mkdir()
    drop_files(files, "01", ["1;bad date;10;4709;PAYMENT;SUCCESS;T1"], TERMINALS, [])
    outcomes = Warehouse(Store(spark, str(tmp_path / "store"))).run(
        sources(spark), str(files), as_of=datetime(2021, 3, 2), exclude=["accounts", "cards", "clients"]
    )
    assert [o.status for o in outcomes] == ["failed", LOADED, LOADED]
    assert "bad date" in outcomes[0].detail
    with pytest.raises(ValueError, match="unknown entities"):
        Warehouse(Store(spark, str(tmp_path))).run({}, "", as_of=datetime(2021, 3, 2), exclude=["card"])


def test_no_file_is_nothing_to_load(spark, tmp_path):
    house = Warehouse(Store(spark, str(tmp_path / "store")))
    files = tmp_path / "files"
    files.mkdir()
    (files / "readme.txt").write_text("other")
    for load in (house.load_transactions, house.load_terminals, house.load_blacklist):
        assert load(str(files)).status == NOTHING_TO_LOAD
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            load(str(tmp_path / "missing"))


def test_a_file_in_the_ledger_is_not_loaded_again(spark, tmp_path):
    files = tmp_path / "files"
    files.mkdir()
    drop_files(files, "01", ["1;2021-03-01 10:00:00;1;c;PAYMENT;SUCCESS;T1"], TERMINALS, [])
    store = Store(spark, str(tmp_path / "store"))
    house = Warehouse(store)
    assert house.load_transactions(str(files)).status == LOADED
    # The watermark alone would take the earliest file again.
    store.commit(schemas.FACT_TRANSACTIONS, 2, ts("1800-01-01"), 0)
    assert house.load_transactions(str(files)).status == NOTHING_TO_LOAD


def test_only_the_terminal_is_required(spark, tmp_path):
    files = tmp_path / "files"
    files.mkdir()
    lines = [";2021-03-01 10:00:00;1;c;PAYMENT;SUCCESS;T1", "2;;1;c;PAYMENT;SUCCESS;T1"]
    drop_files(files, "01", lines, TERMINALS, [])
    house = Warehouse(Store(spark, str(tmp_path / "store")))
    assert house.load_transactions(str(files)).rows == 2
    drop_files(files, "02", ["3;2021-03-02 10:00:00;1;c;PAYMENT;SUCCESS;"], TERMINALS, [])
    with pytest.raises(ConstraintError, match="terminal not null: 1"):
        house.load_transactions(str(files))
    assert house.store.read_fact(schemas.FACT_TRANSACTIONS, schemas.TRANSACTIONS_DDL).count() == 2


def values(frame):
    return sorted(r.v for r in frame.collect())


def test_facts_are_visible_by_commit_and_replaced_by_load(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    rows = lambda *v: spark.createDataFrame([(i,) for i in v], "v bigint")
    first, second = datetime(2021, 3, 1), datetime(2021, 3, 2)
    store.write_loads("fact", rows(9), "2021-03-01")
    assert values(store.read_fact("fact", "v bigint")) == []
    store.append_fact("fact", rows(1, 2), load_date=first)
    store.append_fact("fact", rows(3), load_date=second)
    assert values(store.read_fact("fact", "v bigint")) == [1, 2, 3]
    store.append_fact("fact", rows(), load_date=first)
    assert values(store.read_fact("fact", "v bigint")) == [3]
    assert store.latest("fact") == (3, second)
    dated = rows(5, 6).withColumn("load_date", F.lit("2021-03-04").cast("date"))
    store.append_fact("fact", dated)
    assert values(store.read_fact("fact", "v bigint").filter("load_date = date'2021-03-04'")) == [5, 6]


def test_reports_of_one_day_stay_apart(spark, tmp_path):
    store = Store(spark, str(tmp_path))

    def report(hour, *phones):
        at = datetime(2021, 3, 1, hour)
        rows = [(at, "p", "f", phone, 1, at) for phone in phones]
        store.write_report("rep", spark.createDataFrame(rows, schemas.REPORT_DDL), at)

    def phones():
        return sorted((r.report_dt.hour, r.phone) for r in store.read_report("rep").collect())

    report(8, "a")
    report(18, "b", "c")
    assert phones() == [(8, "a"), (18, "b"), (18, "c")]
    report(18)
    assert phones() == [(8, "a")]


def test_a_broken_history_fails_before_its_commit(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    stage = spark.createDataFrame([("c", "a", ts("9999-12-31 00:00:00"), None)], f"{schemas.CARDS_DDL}, {DATES}")
    with pytest.raises(ConstraintError, match="effective_from before effective_to: 1"):
        store.load_history(schemas.CARDS, stage, stage.select("card_num"), as_of=ts("2021-03-02"))
    assert store.latest(schemas.CARDS.table)[0] == 0


@pytest.mark.parametrize(
    ("second", "broken"),
    [
        (("2021-01-01", schemas.OPEN_END), 1),  # the same version twice
        (("2021-02-01", schemas.OPEN_END), 1),  # begins before the first one ends
        (("2021-03-01", schemas.OPEN_END), 1),  # begins as the first one ends
        (("2021-03-01 00:00:01", schemas.OPEN_END), 0),
    ],
)
def test_versions_of_a_whole_history_do_not_overlap(spark, tmp_path, second, broken):
    store, dim = Store(spark, str(tmp_path)), schemas.CARDS
    spans = [("c", "2021-01-01", "2021-03-01" if second[0] != "2021-01-01" else schemas.OPEN_END), ("c", *second), ("d", *second)]
    rows = spark.createDataFrame(spans, "card_num string, effective_from string, effective_to string").select(
        "card_num", F.lit("a").alias("account_num"),
        *[F.col(name).cast("timestamp_ntz").alias(name) for name in ("effective_from", "effective_to")], F.lit("N").alias("deleted_flg"),
    )
    if broken:
        with pytest.raises(ConstraintError, match="versions of card_num apart: 1"):
            store.import_history(dim, rows, ts("2021-01-01"))
        assert store.latest(dim.table)[0] == 0
    else:
        assert store.import_history(dim, rows, ts("2021-01-01")) == 3
        assert store.compact_history(dim) == 3
