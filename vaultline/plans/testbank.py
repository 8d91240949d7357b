"""The driver's test tables seen as a bank.

Events are transactions, customers own one card, account and passport each, suppliers
are terminals. Histories, gaps, deletions, NULLs and blacklist entries follow from the
keys, so every table grows with its source.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.functions.columns import explode_present, whole_second

REPORT_DT = "2024-02-01 00:00:00"
LOAD_DT = "2024-02-01 00:00:00"
BEFORE_DT = "2024-01-01 00:00:00"


# Known schemas spare a look into the files before every query.
TABLE_DDL = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_DDL[name]).parquet(f"{sf_dir}/{name}.parquet")


def _versions(rows: DataFrame, *versions: str) -> DataFrame:
    """One row per version expression that is not NULL: a struct with the row's columns."""
    return explode_present(rows, "_v", *[F.expr(v) for v in versions]).select("_v.*")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier").agg(F.max("s_suppkey") + 1).scalar()
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("trans_id"),
        whole_second("ts").alias("trans_date"),
        F.expr("'C' || user_id as card_num"),
        F.expr(
            "case event_type when 'signup' then 'DEPOSIT' when 'purchase' then 'PAYMENT'"
            " else 'WITHDRAW' end as oper_type"
        ),
        F.expr("cast(value as decimal(14,4)) as amt"),
        F.expr(
            "case when event_type in ('error', 'view') then 'REJECT' else 'SUCCESS' end as oper_result"
        ),
        F.concat(F.lit("T"), F.col("event_id") % suppliers).alias("terminal"),
    )


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third card moves to the next account; some others are deleted."""
    version = (
        "named_struct('card_num', 'C' || c_custkey, 'account_num', 'A' || ({account}),"
        " 'effective_from', timestamp_ntz'{start}', 'effective_to', timestamp_ntz'{end}',"
        " 'deleted_flg', '{flag}')"
    )
    start, end = "1900-01-01 00:00:00", "9999-12-31 00:00:00"
    move, moved = "2024-01-15 00:00:00", "2024-01-15 00:00:01"
    drop, dropped = "2024-01-25 00:00:00", "2024-01-25 00:00:01"
    one = dict(account="c_custkey", start=start, end=end, flag="N")
    return _versions(
        table(spark, sf_dir, "customer").select("c_custkey"),
        "case when c_custkey % 3 = 0 then " + version.format(**{**one, "end": move})
        + " when c_custkey % 19 = 1 then " + version.format(**{**one, "end": drop})
        + " else " + version.format(**one) + " end",
        "case when c_custkey % 3 = 0 then "
        + version.format(account="c_custkey + 1", start=moved, end=end, flag="N")
        + " when c_custkey % 19 = 1 then "
        + version.format(account="c_custkey", start=dropped, end=end, flag="Y") + " end",
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth account is prolonged; every 23rd is missing."""
    version = (
        "named_struct('account_num', 'A' || c_custkey, 'valid_to',"
        " timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(c_custkey % 40 as int) + {days}),"
        " 'client', 'K' || c_custkey, 'effective_from', timestamp_ntz'{start}',"
        " 'effective_to', timestamp_ntz'{end}', 'deleted_flg', 'N')"
    )
    start, end = "1900-01-01 00:00:00", "9999-12-31 00:00:00"
    return _versions(
        table(spark, sf_dir, "customer").select("c_custkey").filter("c_custkey % 23 <> 0"),
        "case when c_custkey % 5 = 0 then "
        + version.format(days=0, start=start, end="2024-01-10 00:00:00")
        + " else " + version.format(days=0, start=start, end=end) + " end",
        "case when c_custkey % 5 = 0 then "
        + version.format(days=20, start="2024-01-10 00:00:01", end=end) + " end",
    )


def clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fourth client gets a new passport; every 29th is missing."""
    version = (
        "named_struct('client_id', 'K' || c_custkey, 'last_name', c_mktsegment,"
        " 'first_name', c_name, 'patronymic',"
        " case when c_custkey % 4 <> 0 then 'P-' || c_nationkey end,"
        " 'date_of_birth', timestamp_ntz'1970-01-01 00:00:00'"
        " + make_dt_interval(cast(c_custkey % 9999 as int)),"
        " 'passport_num', '{letter}' || c_custkey, 'passport_valid_to', {valid_to},"
        " 'phone', 'tel ' || c_custkey, 'effective_from', timestamp_ntz'{start}',"
        " 'effective_to', timestamp_ntz'{end}', 'deleted_flg', 'N')"
    )
    first = (
        "case when c_custkey % 7 <> 0 then timestamp_ntz'2024-01-01 00:00:00'"
        " + make_dt_interval(cast(c_custkey % 60 as int)) end"
    )
    start, end = "1900-01-01 00:00:00", "9999-12-31 00:00:00"
    return _versions(
        table(spark, sf_dir, "customer").filter("c_custkey % 29 <> 0"),
        "case when c_custkey % 4 = 0 then "
        + version.format(letter="P", valid_to=first, start=start, end="2024-01-20 00:00:00")
        + " else " + version.format(letter="P", valid_to=first, start=start, end=end) + " end",
        "case when c_custkey % 4 = 0 then "
        + version.format(
            letter="Q", valid_to="timestamp_ntz'2030-01-01 00:00:00'",
            start="2024-01-20 00:00:01", end=end,
        ) + " end",
    )


def terminals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The city is the nation; some have none, every fourth moves."""
    version = (
        "named_struct('terminal_id', 'T' || s_suppkey, 'terminal_type',"
        " case when s_suppkey % 2 = 0 then 'ATM' else 'POS' end, 'terminal_city',"
        " case when s_suppkey % 5 <> 4 then 'city ' || (s_nationkey + {move}) end,"
        " 'terminal_address', s_name, 'effective_from', timestamp_ntz'{start}',"
        " 'effective_to', timestamp_ntz'{end}', 'deleted_flg', 'N')"
    )
    start, end = "1900-01-01 00:00:00", "9999-12-31 00:00:00"
    return _versions(
        table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey"),
        "case when s_suppkey % 4 = 0 then "
        + version.format(move=0, start=start, end="2024-01-12 00:00:00")
        + " else " + version.format(move=0, start=start, end=end) + " end",
        "case when s_suppkey % 4 = 0 then "
        + version.format(move=1, start="2024-01-12 00:00:01", end=end) + " end",
    )


def blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 11th passport; some with a later second entry or a repeated one."""
    entry = (
        "named_struct('passport_num', 'P' || c_custkey, 'entry_dt',"
        " timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(c_custkey % 30 as int) + {days}))"
    )
    return _versions(
        table(spark, sf_dir, "customer").select("c_custkey").filter("c_custkey % 11 = 0"),
        entry.format(days=0),
        "case when c_custkey % 22 = 0 then " + entry.format(days=3) + " end",
        "case when c_custkey % 33 = 0 then " + entry.format(days=0) + " end",
    )


@dataclass(frozen=True)
class Bank:
    """The warehouse tables a report needs, in the order the rules take them."""

    transactions: DataFrame
    cards: DataFrame
    accounts: DataFrame
    clients: DataFrame
    terminals: DataFrame
    blacklist: DataFrame


def bank(spark: SparkSession, sf_dir: str) -> Bank:
    return Bank(
        transactions(spark, sf_dir),
        cards(spark, sf_dir),
        accounts(spark, sf_dir),
        clients(spark, sf_dir),
        terminals(spark, sf_dir),
        blacklist(spark, sf_dir),
    )


def history_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Client segments before a load: some keys are yet to come, some were deleted
    earlier, some are deleted and open only as 'Y'."""
    version = (
        "named_struct('client_id', 'K' || c_custkey, 'segment', c_mktsegment, 'nation', c_nationkey,"
        " 'effective_from', timestamp_ntz'{start}', 'effective_to', timestamp_ntz'{end}',"
        " 'deleted_flg', '{flag}')"
    )
    end = "9999-12-31 00:00:00"
    return _versions(
        table(spark, sf_dir, "customer")
        .select("c_custkey", "c_mktsegment", "c_nationkey")
        .filter("c_custkey % 17 <> 0"),
        "case when c_custkey % 31 = 3 then "
        + version.format(start=BEFORE_DT, end="2024-01-20 00:00:00", flag="N")
        + " else " + version.format(start=BEFORE_DT, end=end, flag="N") + " end",
        "case when c_custkey % 31 = 3 then "
        + version.format(start="2024-01-20 00:00:01", end=end, flag="Y") + " end",
    )


def snapshot_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source at the next load. Some segments change, some become NULL, some keys
    are gone, and some changes are older than the version they meet. Some keys have died since
    the extract: they hold the latest time of all and must not count."""
    return table(spark, sf_dir, "customer").filter("c_custkey % 13 <> 0").selectExpr(
        "'K' || c_custkey as client_id",
        "case when c_custkey % 5 = 0 then c_mktsegment || '*'"
        " when c_custkey % 37 = 0 then null else c_mktsegment end as segment",
        "c_nationkey as nation",
        "timestamp_ntz'2023-12-01 00:00:00' as create_dt",
        "case when c_custkey % 41 = 7 then timestamp_ntz'2024-03-01 00:00:00'"
        " when c_custkey % 35 = 0 then timestamp_ntz'2023-12-15 00:00:00'"
        " when c_custkey % 3 = 0 then null"
        " else timestamp_ntz'2024-01-31 12:00:00' end as update_dt",
    )


def active_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live keys: without those that the snapshot lacks, and without those that died since."""
    return table(spark, sf_dir, "customer").filter("c_custkey % 13 <> 0 and c_custkey % 41 <> 7").selectExpr(
        "'K' || c_custkey as client_id"
    )


def meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Watermarks: the latest event of each type stands for a table."""
    return table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("tbl_name")).agg(
        F.max("ts").alias("integrated_dt")
    ).select(F.lit("bank").alias("sch_name"), "tbl_name", "integrated_dt")
