"""Files, stage typing, checks and watermarks."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from frames import ts

from vaultline import schemas
from vaultline.operators import stage, watermark
from vaultline.operators.checks import ConstraintError, enforce, not_null, stage_rules
from vaultline.plans.workbook_fixture import workbook
from vaultline.sources.dated_files import file_ledger, list_dated_files, next_file
from vaultline.sources.delimited import HeaderError, scan_delimited
from vaultline.sources.tables import jdbc_table, src_incremental, staged_keys
from vaultline.sources.workbook import scan_workbook

COLUMNS = schemas.TRANSACTION_FILE_COLUMNS
HEADER = "note;terminal;transaction_id;transaction_date;amount;card_num;oper_type;oper_result"


def text_file(folder, lines, name="transactions_01032021.txt", header=HEADER):
    path = folder / name
    path.write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")
    return str(path)


def test_text_file(spark, tmp_path):
    path = text_file(
        tmp_path,
        [
            'n;A1;1;2021-03-01 00:00:01;1234,56;"4709" ;PAYMENT;SUCCESS',
            ";;;;;;;",
            "",
            "only a note;;;;;;;",
            "n;T\\2;2;2021-03-01 00:00:02;7.5;5;DEPOSIT;REJECT",
        ],
    )
    rows = scan_delimited(spark, path, COLUMNS)
    assert rows.columns == list(COLUMNS)
    staged = stage.stage_transactions(rows.filter("transaction_id is not null"))
    assert sorted(map(tuple, staged.collect())) == [
        ("1", ts("2021-03-01 00:00:01"), '"4709"', "PAYMENT", Decimal("1234.5600"), "SUCCESS", "A1"),
        ("2", ts("2021-03-01 00:00:02"), "5", "DEPOSIT", Decimal("7.5000"), "REJECT", "T\\2"),
    ]
    # a row counts as filled if any cell is, also one that is not asked for
    assert rows.count() == 3


def test_text_file_without_a_column(spark, tmp_path):
    path = text_file(tmp_path, ["n;1"], header="note;terminal")
    with pytest.raises(HeaderError, match="transaction_id"):
        scan_delimited(spark, path, COLUMNS)


def test_text_file_with_a_short_line_fails(spark, tmp_path):
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        scan_delimited(spark, text_file(tmp_path, ["n;A1;1"]), COLUMNS).collect()


def test_bad_amount_fails(spark, tmp_path):
    path = text_file(tmp_path, ["n;A1;1;2021-03-01 00:00:01;x;4709;PAYMENT;SUCCESS"])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        stage.stage_transactions(scan_delimited(spark, path, COLUMNS)).collect()


def test_workbook(spark, tmp_path):
    header = ["extra", "date", "passport"]
    rows = [
        [1, datetime(2021, 3, 1), "A & <b>"],
        [None, None, None],
        [0, None, None],
        [0.5, datetime(2021, 3, 2, 13, 45, 59), None],
        [None, datetime(2021, 3, 3), 1234],
    ]
    (tmp_path / "passport_blacklist_01032021.xlsx").write_bytes(workbook("blacklist", header, rows))
    (tmp_path / "passport_blacklist_02032021.xlsx").write_bytes(workbook("blacklist", header, rows[:1]))
    found = scan_workbook(
        spark, str(tmp_path), "blacklist", {"passport": "string", "date": "timestamp_ntz"}
    )
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(
        [
            ("A & <b>", datetime(2021, 3, 1)),
            ("A & <b>", datetime(2021, 3, 1)),
            (None, datetime(2021, 3, 2, 13, 45, 59)),
            ("1234", datetime(2021, 3, 3)),
        ],
        key=repr,
    )
    with pytest.raises(Exception, match="no sheet 'terminals'"):
        scan_workbook(spark, str(tmp_path), "terminals", ["passport"]).collect()
    with pytest.raises(Exception, match="phone"):
        scan_workbook(spark, str(tmp_path), "blacklist", ["phone"]).collect()


def test_file_choice(spark, tmp_path):
    for day in ("02", "01", "04"):
        text_file(tmp_path, [], name=f"transactions_{day}032021.txt")
    files = list_dated_files(spark, str(tmp_path), "transactions_", ".txt")

    def chosen(watermark: str):
        row = next_file(files, ts(watermark))
        return row and (row.file_name, row.file_dt)

    assert chosen("1800-01-01") == ("transactions_01032021.txt", datetime(2021, 3, 1))
    assert chosen("2021-03-01") == ("transactions_02032021.txt", datetime(2021, 3, 2))
    assert chosen("2021-03-02") is None  # the 4th has to wait for the 3rd
    assert chosen("2021-03-03") == ("transactions_04032021.txt", datetime(2021, 3, 4))
    loaded = files.filter("day(file_dt) = 1")
    assert sorted(r.file_name[13:15] for r in file_ledger(files, loaded).collect()) == ["02", "04"]


def test_misnamed_file_fails(spark, tmp_path):
    text_file(tmp_path, [], name="transactions_backup.txt")
    with pytest.raises(Exception, match="PARSE"):
        list_dated_files(spark, str(tmp_path), "transactions_", ".txt").collect()


def test_blacklist_keeps_entries_from_the_file_date_on(spark):
    rows = spark.createDataFrame(
        [("a", ts("2021-02-28")), ("b", ts("2021-03-01")), (" ", None)], "passport string, date timestamp_ntz"
    )
    kept = stage.stage_blacklist(rows, datetime(2021, 3, 1))
    assert [tuple(r) for r in kept.collect()] == [("b", ts("2021-03-01"))]


def test_padded_keys(spark):
    source = spark.createDataFrame(
        [("4709 4592 6306 2366 ", "a ", ts("2021-03-01"), None)],
        "card_num string, account string, create_dt timestamp_ntz, update_dt timestamp_ntz",
    )
    staged = stage.stage_dimension(source, schemas.CARDS).first()
    assert (staged.card_num, staged.account_num) == ("4709 4592 6306 2366", "a")
    assert staged_keys(source, "card_num", "card_num").first()[0] == staged.card_num


def test_increment_is_strictly_after_the_watermark(spark):
    rows = spark.createDataFrame(
        [(1, ts("2021-03-01"), None), (2, ts("2021-03-01"), ts("2021-03-02")), (3, ts("2021-03-03"), None)],
        "id int, create_dt timestamp_ntz, update_dt timestamp_ntz",
    )
    found = src_incremental(rows, datetime(2021, 3, 1, 0, 0, 0, 500))
    assert sorted(r.id for r in found.collect()) == [2, 3]


def test_increment_filter_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "orders")
    spark.range(10).selectExpr(
        "id", "timestamp_ntz'2021-03-01 00:00:00' as create_dt",
        "timestamp_ntz'2021-03-01 00:00:00' as update_dt", "'wide' as unused",
    ).write.parquet(path)
    found = src_incremental(spark.read.parquet(path), datetime(2021, 3, 1)).select("id")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(create_dt" in plan and "GreaterThan(update_dt" in plan
    assert "unused" not in plan


def test_jdbc_needs_its_driver(spark):
    """No database here: only that the options reach Spark's reader."""
    with pytest.raises(Exception, match="No suitable driver|driver"):
        jdbc_table(spark, "jdbc:none:x", "cards", split_by="id", lower="0", upper="9", splits=3)


def test_enforce(spark):
    rows = spark.createDataFrame(
        [("1", None, None), (None, ts("2021-03-01"), None)],
        "key string, create_dt timestamp_ntz, update_dt timestamp_ntz",
    )
    with pytest.raises(ConstraintError, match="key not null: 1, create_dt or update_dt: 1"):
        enforce(rows, stage_rules("key"))
    enforce(rows.filter("key is null"), not_null("create_dt"))


def test_watermarks(spark):
    meta = spark.createDataFrame([("bank", "t", ts("2021-03-01"))], schemas.META_DDL)

    def one(frame):
        assert frame.count() == 1
        return frame.first()[0]

    assert one(watermark.meta_get(meta, "bank", "t")) == ts("2021-03-01")
    assert one(watermark.meta_get(meta, "bank", "other")) == ts("1800-01-01")
    updates = spark.createDataFrame(
        [("bank", "t", None), ("bank", "new", None), ("bank", "u", ts("2021-03-05"))], schemas.META_DDL
    )
    assert {r.tbl_name: r.integrated_dt for r in watermark.meta_set(meta, updates).collect()} == {
        "t": ts("2021-03-01"), "new": ts("1800-01-01"), "u": ts("2021-03-05"),
    }
    staged = spark.createDataFrame(
        [("1", ts("2021-03-02"), None), ("2", ts("2021-03-02"), ts("2021-03-09"))],
        "key string, create_dt timestamp_ntz, update_dt timestamp_ntz",
    )
    alive = spark.createDataFrame([("1",)], "key string")
    current = watermark.meta_get(meta, "bank", "t")
    assert one(watermark.max_watermark(staged, alive, current, key="key")) == ts("2021-03-02")
    none = alive.filter("false")
    assert one(watermark.max_watermark(staged, none, current, key="key")) == ts("2021-03-01")
    assert one(watermark.next_snapshot_dt(meta, "bank", "t")) == ts("2021-03-02")
    assert one(watermark.next_snapshot_dt(meta, "bank", "other")) == ts("1900-01-01")


@pytest.mark.parametrize(("seen", "expected"), [("2021-03-01", None), ("2021-02-28", 1), (None, 1)])
def test_freshness(spark, seen, expected):
    meta = spark.createDataFrame(
        [("bank", table, ts("2021-03-01")) for table in watermark.REPORT_SOURCES.values()], schemas.META_DDL
    )
    columns = list(watermark.REPORT_SOURCES)
    row = ("bank", "rep", *[ts("2021-03-01")] * 5, seen and ts(seen))
    report = spark.createDataFrame(
        [row], "sch_name string, tbl_name string, " + ", ".join(f"{c} timestamp_ntz" for c in columns)
    )
    gate = watermark.freshness_gate(meta, report, "bank", "rep")
    assert [r.has_new_data for r in gate.collect()] == [expected]
    assert [r.has_new_data for r in watermark.freshness_gate(meta, report, "bank", "x").collect()] == [None]
