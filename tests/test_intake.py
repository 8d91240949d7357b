"""Transaction files as a stream: each once, whatever dies in between."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.errors import StreamingQueryException
from test_warehouse import HEADER

from vaultline import schemas
from vaultline.operators.checks import ConstraintError
from vaultline.plans.warehouse import NOTHING_TO_LOAD, Warehouse
from vaultline.sources.delimited import HeaderError
from vaultline.sources.store import Overtaken, Store
from vaultline.streaming.intake import TransactionIntake

FACT = schemas.FACT_TRANSACTIONS


def line(i, day, terminal="T1"):
    return f"{i};2021-03-{day:02} 10:00:00;10,5;4709 ;PAYMENT;SUCCESS;{terminal}"


def drop(folder, day, lines, header=HEADER, part=None):
    path = folder / f"transactions_{day:02}032021.txt"
    if part:
        path.mkdir(exist_ok=True)
        path = path / part
    path.write_text("\n".join([header, *lines]) + "\n")


def ids(store):
    rows = store.read_fact(FACT, schemas.TRANSACTIONS_DDL).collect()
    return sorted((r.trans_id, str(r.load_date)) for r in rows)


@pytest.fixture
def place(spark, tmp_path):
    files = tmp_path / "drop box"
    files.mkdir()
    return files, Store(spark, str(tmp_path / "store"))


def test_files_of_any_day_once(spark, place, tmp_path):
    """A missing day does not block; parts that come later, blank rows, an empty file and names with spaces and signs."""
    files, store = place
    archive = tmp_path / "archive"
    intake = TransactionIntake(store, str(files), archive=str(archive), max_files=2)
    assert intake.run() == []
    drop(files, 3, [line(1, 3), ";;;;;;", line(2, 3)])
    drop(files, 1, [line(3, 1)], part="a +%41.csv")
    drop(files, 5, [])
    versions = intake.run()
    assert versions == [1]
    assert ids(store) == [("1", "2021-03-03"), ("2", "2021-03-03"), ("3", "2021-03-01")]
    assert {r.card_num for r in store.read_fact(FACT, schemas.TRANSACTIONS_DDL).collect()} == {"4709"}
    assert store.latest(FACT) == (1, datetime(2021, 3, 3))
    assert intake.run() == []
    drop(files, 1, [line(4, 1), line(3, 1)], part="b.csv")
    assert intake.run() == [2]
    assert ids(store) == [
        ("1", "2021-03-03"), ("2", "2021-03-03"), ("3", "2021-03-01"), ("3", "2021-03-01"), ("4", "2021-03-01")
    ]
    names = {r.file_name for r in store.loaded_files(FACT).collect()}
    assert names == {
        "transactions_03032021.txt", "transactions_01032021.txt/a +%41.csv", "transactions_01032021.txt/b.csv"
    }
    assert any(path.is_file() for path in archive.rglob("transactions_*"))
    assert str(store.latest_event(FACT)) == "2021-03-03 10:00:00"


@pytest.mark.parametrize("at", ["take", "write_loads", "commit"])
def test_death_and_rerun(spark, place, monkeypatch, at):
    """The run dies after the stage, after the rows are written, or right after the commit."""
    files, store = place
    for day in (1, 2, 3):
        drop(files, day, [line(day * 10 + i, day) for i in range(5)])

    owner = TransactionIntake if at == "take" else Store
    whole = getattr(owner, at)

    def dies(*args, **options):
        whole(*args, **options)
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(owner, at, dies)
        with pytest.raises(RuntimeError, match="lost"):
            TransactionIntake(store, str(files)).run()
    assert len(ids(store)) == (15 if at == "commit" else 0)
    TransactionIntake(store, str(files)).run()
    expected = sorted((str(day * 10 + i), f"2021-03-{day:02}") for day in (1, 2, 3) for i in range(5))
    assert ids(store) == expected
    assert TransactionIntake(store, str(files)).run() == []


def test_commits_are_bounded_and_in_order_of_days(spark, place):
    files, store = place
    for day in (4, 2, 3, 1, 5):
        drop(files, day, [line(day, day)])
    assert TransactionIntake(store, str(files), max_files=2).run() == [1, 2, 3]
    commits = {r.version: r.files for r in store.commits(FACT).collect()}
    assert [[name[13:15] for name in commits[v]] for v in (1, 2, 3)] == [["01", "02"], ["03", "04"], ["05"]]


def test_loads_that_overlap_commit_a_file_once(spark, place, monkeypatch):
    """Another run commits the same files between this one's look at the ledger and its commit."""
    files, store = place
    drop(files, 1, [line(1, 1), line(2, 1)])
    other, whole = TransactionIntake(store, str(files)), Store.write_loads

    def late(self, *args, **options):
        written = whole(self, *args, **options)
        monkeypatch.setattr(Store, "write_loads", whole)
        assert other.load() == [1]
        return written

    intake = TransactionIntake(store, str(files))
    intake.take()
    monkeypatch.setattr(Store, "write_loads", late)
    with pytest.raises(Overtaken):
        intake.load()
    assert ids(store) == [("1", "2021-03-01"), ("2", "2021-03-01")]
    assert intake.load() == []


def test_with_the_daily_load(spark, place):
    """Either leaves alone what the other has taken."""
    files, store = place
    house = Warehouse(store)
    drop(files, 1, [line(1, 1)])
    drop(files, 2, [line(2, 2)], part="a.csv")
    assert house.load_transactions(str(files)).detail == "transactions_01032021.txt"
    assert house.stream_transactions(str(files)) == [2]
    assert house.load_transactions(str(files)).status == NOTHING_TO_LOAD
    assert ids(store) == [("1", "2021-03-01"), ("2", "2021-03-02")]
    drop(files, 3, [line(3, 3)])
    assert house.load_transactions(str(files)).detail == "transactions_03032021.txt"
    assert house.stream_transactions(str(files)) == []
    assert len(ids(store)) == 3


def test_broken_files_commit_nothing(spark, place):
    files, store = place
    drop(files, 1, [line(1, 1)], header=HEADER.replace("amount", "sum"))
    with pytest.raises(HeaderError):
        TransactionIntake(store, str(files)).run()
    drop(files, 1, [line(1, 1), "2;too;few"])
    with pytest.raises(StreamingQueryException):
        TransactionIntake(store, str(files)).run()
    drop(files, 1, [line(1, 1)])
    assert TransactionIntake(store, str(files)).run() == [1]
    drop(files, 2, [line(2, 2, terminal="")])
    with pytest.raises(ConstraintError, match="terminal"):
        TransactionIntake(store, str(files)).run()
    assert ids(store) == [("1", "2021-03-01")]
