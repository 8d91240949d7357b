"""Every operator as a query over the driver's tables, next to the SQL it must equal."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vaultline.functions.columns import (
    blank_to_null,
    clean_key,
    decimal_comma,
    deleted_flag,
    differs,
    explode_present,
    full_name,
    id_order,
    is_current,
    past_last_day,
    whole_second,
)
from vaultline.operators import blacklist as bl
from vaultline.operators import moments, scd2, watermark
from vaultline.operators.asof import asof_carried, asof_dim_join
from vaultline.operators.checks import violations
from vaultline.operators.stage import (
    blacklist_recent_filter,
    file_batch_rows,
    skip_empty_rows,
    stage_transactions,
)
from vaultline.plans import fraud, testbank
from vaultline.plans.incremental import IncrementalReport
from vaultline.plans.testbank import LOAD_DT, REPORT_DT, bank, table
from vaultline.plans.warehouse import db_stage_load
from vaultline.plans.workbook_fixture import write_workbooks
from vaultline.schemas import (
    ACCOUNTS,
    BLACKLIST_DDL,
    CARDS,
    CLIENTS,
    FACT_BLACKLIST,
    FACT_TRANSACTIONS,
    SPENDING_TYPES,
    TERMINALS,
    TRANSACTION_FILE_COLUMNS,
    TRANSACTIONS_DDL,
    ntz,
    open_end,
)
from vaultline.session import qualified, scratch_dir
from vaultline.sources.dated_files import (
    dated_names,
    earliest_file,
    file_ledger,
    list_dated_files,
    pick_next_file,
)
from vaultline.sources.delimited import header_contract, scan_delimited
from vaultline.sources.store import Store, stage_overwrite
from vaultline.sources.tables import src_active_keys, src_incremental, staged_keys
from vaultline.sources.workbook import scan_workbook
from vaultline.streaming.intake import TransactionIntake

Query = Callable[[SparkSession, str], DataFrame]

# The default chain (three rejects in 20 minutes) finds nothing in the test events, so
# the queries look for two rejects in seven days.
CHAIN, CHAIN_WITHIN = 2, 7 * 86_400
LOOSE_WITHIN = 5 * 86_400


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


CATALOGUE: dict[str, Entry] = {}


def as_text(frame: DataFrame, *columns: str) -> DataFrame:
    """Show decimals, dates, nullable integers and far-away times as text: clients hold these
    in different types, and text compares exactly."""
    return frame.withColumns({name: F.col(name).cast("string") for name in columns})


def query(name: str, sql: str | None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        CATALOGUE[name] = Entry(run, sql)
        return run

    return add


# --- the test bank in SQL ---------------------------------------------------------------

TX = """transactions AS (
  SELECT CAST(event_id AS VARCHAR) AS trans_id, date_trunc('second', ts) AS trans_date, 'C' || user_id AS card_num,
    CASE event_type WHEN 'signup' THEN 'DEPOSIT' WHEN 'purchase' THEN 'PAYMENT' ELSE 'WITHDRAW' END AS oper_type,
    CAST(value AS DECIMAL(14,4)) AS amt,
    CASE WHEN event_type IN ('error', 'view') THEN 'REJECT' ELSE 'SUCCESS' END AS oper_result,
    'T' || (event_id % (SELECT max(s_suppkey) + 1 FROM supplier)) AS terminal
  FROM events)"""

CARDS_SQL = """cards AS (
  SELECT 'C' || c_custkey AS card_num, 'A' || c_custkey AS account_num,
    TIMESTAMP '1900-01-01' AS effective_from,
    CASE WHEN c_custkey % 3 = 0 THEN TIMESTAMP '2024-01-15' WHEN c_custkey % 19 = 1 THEN TIMESTAMP '2024-01-25'
         ELSE TIMESTAMP '9999-12-31' END AS effective_to, 'N' AS deleted_flg
  FROM customer
  UNION ALL
  SELECT 'C' || c_custkey, 'A' || (c_custkey + 1), TIMESTAMP '2024-01-15 00:00:01', TIMESTAMP '9999-12-31', 'N'
  FROM customer WHERE c_custkey % 3 = 0
  UNION ALL
  SELECT 'C' || c_custkey, 'A' || c_custkey, TIMESTAMP '2024-01-25 00:00:01', TIMESTAMP '9999-12-31', 'Y'
  FROM customer WHERE c_custkey % 3 <> 0 AND c_custkey % 19 = 1)"""

ACCOUNTS_SQL = """accounts AS (
  SELECT 'A' || c_custkey AS account_num,
    TIMESTAMP '2024-01-01' + to_days(CAST(c_custkey % 40 AS INTEGER)) AS valid_to, 'K' || c_custkey AS client,
    TIMESTAMP '1900-01-01' AS effective_from,
    CASE WHEN c_custkey % 5 = 0 THEN TIMESTAMP '2024-01-10' ELSE TIMESTAMP '9999-12-31' END AS effective_to,
    'N' AS deleted_flg
  FROM customer WHERE c_custkey % 23 <> 0
  UNION ALL
  SELECT 'A' || c_custkey, TIMESTAMP '2024-01-01' + to_days(CAST(c_custkey % 40 + 20 AS INTEGER)), 'K' || c_custkey,
    TIMESTAMP '2024-01-10 00:00:01', TIMESTAMP '9999-12-31', 'N'
  FROM customer WHERE c_custkey % 23 <> 0 AND c_custkey % 5 = 0)"""

CLIENTS_SQL = """base_clients AS (
  SELECT c_custkey, 'K' || c_custkey AS client_id, c_mktsegment AS last_name, c_name AS first_name,
    CASE WHEN c_custkey % 4 <> 0 THEN 'P-' || c_nationkey END AS patronymic, 'tel ' || c_custkey AS phone
  FROM customer WHERE c_custkey % 29 <> 0),
clients AS (
  SELECT client_id, last_name, first_name, patronymic, 'P' || c_custkey AS passport_num,
    CASE WHEN c_custkey % 7 <> 0 THEN TIMESTAMP '2024-01-01' + to_days(CAST(c_custkey % 60 AS INTEGER)) END
      AS passport_valid_to, phone, TIMESTAMP '1900-01-01' AS effective_from,
    CASE WHEN c_custkey % 4 = 0 THEN TIMESTAMP '2024-01-20' ELSE TIMESTAMP '9999-12-31' END AS effective_to,
    'N' AS deleted_flg
  FROM base_clients
  UNION ALL
  SELECT client_id, last_name, first_name, patronymic, 'Q' || c_custkey, TIMESTAMP '2030-01-01', phone,
    TIMESTAMP '2024-01-20 00:00:01', TIMESTAMP '9999-12-31', 'N'
  FROM base_clients WHERE c_custkey % 4 = 0)"""

TERMINALS_SQL = """terminals AS (
  SELECT 'T' || s_suppkey AS terminal_id,
    CASE WHEN s_suppkey % 5 <> 4 THEN 'city ' || s_nationkey END AS terminal_city,
    TIMESTAMP '1900-01-01' AS effective_from,
    CASE WHEN s_suppkey % 4 = 0 THEN TIMESTAMP '2024-01-12' ELSE TIMESTAMP '9999-12-31' END AS effective_to,
    'N' AS deleted_flg
  FROM supplier
  UNION ALL
  SELECT 'T' || s_suppkey, CASE WHEN s_suppkey % 5 <> 4 THEN 'city ' || (s_nationkey + 1) END,
    TIMESTAMP '2024-01-12 00:00:01', TIMESTAMP '9999-12-31', 'N'
  FROM supplier WHERE s_suppkey % 4 = 0)"""

BLACKLIST_SQL = """blacklist AS (
  SELECT 'P' || c_custkey AS passport_num,
    TIMESTAMP '2024-01-01' + to_days(CAST(c_custkey % 30 AS INTEGER)) AS entry_dt
  FROM customer WHERE c_custkey % 11 = 0
  UNION ALL
  SELECT 'P' || c_custkey, TIMESTAMP '2024-01-01' + to_days(CAST(c_custkey % 30 + 3 AS INTEGER))
  FROM customer WHERE c_custkey % 22 = 0
  UNION ALL
  SELECT 'P' || c_custkey, TIMESTAMP '2024-01-01' + to_days(CAST(c_custkey % 30 AS INTEGER))
  FROM customer WHERE c_custkey % 33 = 0)"""

HELD_SQL = """held AS (
  SELECT t.*, c.account_num, a.client AS client_id, a.valid_to AS account_valid_to, k.last_name, k.first_name,
    k.patronymic, k.passport_num, k.passport_valid_to, k.phone,
    coalesce(k.last_name, '') || ' ' || coalesce(k.first_name, '') || ' ' || coalesce(k.patronymic, '') AS fio
  FROM transactions t
  LEFT JOIN cards c ON t.card_num = c.card_num AND c.deleted_flg = 'N'
    AND t.trans_date BETWEEN c.effective_from AND c.effective_to
  LEFT JOIN accounts a ON c.account_num = a.account_num AND a.deleted_flg = 'N'
    AND t.trans_date BETWEEN a.effective_from AND a.effective_to
  LEFT JOIN clients k ON a.client = k.client_id AND k.deleted_flg = 'N'
    AND t.trans_date BETWEEN k.effective_from AND k.effective_to)"""

LOCATED_SQL = """located AS (
  SELECT t.*, m.terminal_city AS city FROM transactions t
  LEFT JOIN terminals m ON t.terminal = m.terminal_id AND m.deleted_flg = 'N'
    AND t.trans_date BETWEEN m.effective_from AND m.effective_to)"""

NEAR_SQL = """near AS (
  SELECT * FROM located t WHERE EXISTS (
    SELECT 1 FROM located o WHERE o.card_num = t.card_num AND o.city <> t.city
      AND o.trans_date BETWEEN t.trans_date - INTERVAL 1 HOUR AND t.trans_date))"""

LAGGED_SQL = """lagged AS (
  SELECT *,
    lag(oper_type, 1) OVER w AS type_1, lag(oper_type, 2) OVER w AS type_2,
    lag(oper_result, 1) OVER w AS result_1, lag(oper_result, 2) OVER w AS result_2,
    lag(trans_date, 1) OVER w AS date_1, lag(trans_date, 2) OVER w AS date_2,
    lag(amt, 1) OVER w AS amt_1, lag(amt, 2) OVER w AS amt_2
  FROM transactions WINDOW w AS (PARTITION BY card_num ORDER BY trans_date, CAST(trans_id AS BIGINT))),
chains AS (
  SELECT trans_id, trans_date, card_num, oper_type, amt, oper_result, terminal FROM lagged
  WHERE oper_result = 'SUCCESS' AND result_1 = 'REJECT' AND result_2 = 'REJECT'
    AND oper_type IN ('PAYMENT', 'WITHDRAW') AND type_1 IN ('PAYMENT', 'WITHDRAW') AND type_2 IN ('PAYMENT', 'WITHDRAW')
    AND date_1 < trans_date AND date_2 < date_1 AND amt_1 > amt AND amt_2 > amt_1
    AND date_2 >= trans_date - INTERVAL 7 DAY)"""

REPORT_HEAD = f"""trans_date AS event_dt, passport_num AS passport, fio, phone,
  CAST({{kind}} AS SMALLINT) AS event_type, TIMESTAMP '{REPORT_DT}' AS report_dt"""

RULE_1 = f"""SELECT {REPORT_HEAD.format(kind=1)} FROM (
  SELECT h.* FROM held h
  LEFT JOIN blacklist b ON b.passport_num = h.passport_num AND b.entry_dt < h.trans_date
  WHERE b.passport_num IS NOT NULL OR h.passport_valid_to + INTERVAL 1 DAY < h.trans_date)"""
RULE_1_ONCE = f"""SELECT {REPORT_HEAD.format(kind=1)} FROM held h
  WHERE passport_valid_to + INTERVAL 1 DAY < trans_date OR EXISTS (
    SELECT 1 FROM blacklist b WHERE b.passport_num = h.passport_num AND b.entry_dt < h.trans_date)"""
RULE_2 = f"""SELECT {REPORT_HEAD.format(kind=2)} FROM held WHERE trans_date > account_valid_to + INTERVAL 1 DAY"""
RULE_3 = f"""SELECT {REPORT_HEAD.format(kind=3)} FROM held WHERE trans_id IN (SELECT trans_id FROM near)"""
RULE_4 = f"""SELECT {REPORT_HEAD.format(kind=4)} FROM held WHERE trans_id IN (SELECT trans_id FROM chains)"""


def with_tables(*parts: str, select: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + select


HOLDERS = (TX, CARDS_SQL, ACCOUNTS_SQL, CLIENTS_SQL, HELD_SQL)
PLACES = (TERMINALS_SQL, LOCATED_SQL, NEAR_SQL)
EVERYTHING = (*HOLDERS, *PLACES, BLACKLIST_SQL, LAGGED_SQL)


# --- the fraud report -------------------------------------------------------------------


@query("fraud_passport", with_tables(*HOLDERS, BLACKLIST_SQL, select=RULE_1))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bank(spark, sf_dir)
    return fraud.fraud_passport(
        b.transactions, b.cards, b.accounts, b.clients, b.blacklist, report_dt=REPORT_DT
    )


@query("fraud_contract", with_tables(*HOLDERS, select=RULE_2))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bank(spark, sf_dir)
    return fraud.fraud_contract(b.transactions, b.cards, b.accounts, b.clients, report_dt=REPORT_DT)


@query("fraud_cities", with_tables(*HOLDERS, *PLACES, select=RULE_3))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bank(spark, sf_dir)
    return fraud.fraud_cities(
        b.transactions, b.cards, b.accounts, b.clients, b.terminals, report_dt=REPORT_DT
    )


@query("fraud_guessing", with_tables(*HOLDERS, LAGGED_SQL, select=RULE_4))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bank(spark, sf_dir)
    return fraud.fraud_guessing(
        b.transactions, b.cards, b.accounts, b.clients,
        report_dt=REPORT_DT, n=CHAIN, within=CHAIN_WITHIN,
    )


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bank(spark, sf_dir)
    return fraud.fraud_report(
        b.transactions, b.cards, b.accounts, b.clients, b.terminals, b.blacklist,
        report_dt=REPORT_DT, n=CHAIN, within=CHAIN_WITHIN,
    )


def combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bank(spark, sf_dir)
    return fraud.fraud_combined(
        b.transactions, b.cards, b.accounts, b.clients, b.terminals, b.blacklist,
        report_dt=REPORT_DT, n=CHAIN, within=CHAIN_WITHIN,
    )


REPORT_SQL = "\nUNION ALL\n".join([RULE_1, RULE_2, RULE_3, RULE_4])
COMBINED_SQL = "\nUNION ALL\n".join([RULE_1_ONCE, RULE_2, RULE_3, RULE_4])
query("fraud_report", with_tables(*EVERYTHING, select=REPORT_SQL))(report)
query("fraud_combined", with_tables(*EVERYTHING, select=COMBINED_SQL))(combined)


@query("report_incremental", with_tables(*EVERYTHING, select=REPORT_SQL))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report after three days of loads: first the facts up to the 12th with histories and blacklist as they were
    known then, and a day of wrong facts; then all histories and entries, facts up to the 21st and the wrong day again, empty; then the other facts.
    Each time only what the loads touch is computed."""
    b = bank(spark, sf_dir)
    store = Store(spark, scratch_dir(spark, "store"))
    incremental = IncrementalReport(store, n=CHAIN, within=CHAIN_WITHIN)
    dated = stage_overwrite(b.transactions.withColumn("load_date", F.to_date("trans_date")), scratch_dir(spark, "facts"))
    known, wrong = datetime(2024, 1, 12), datetime(2024, 1, 31)

    def as_known(history: DataFrame) -> DataFrame:
        """The versions that had begun by then, the last of them still open."""
        later = F.col("effective_to") >= ntz(known)
        return history.filter(F.col("effective_from") < ntz(known)).withColumn(
            "effective_to", F.when(later, open_end()).otherwise(F.col("effective_to"))
        )

    def load(first: str, last: str) -> None:
        days = dated.filter(F.col("load_date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
        store.append_fact(FACT_TRANSACTIONS, days, event="trans_date")

    histories = {CARDS: b.cards, ACCOUNTS: b.accounts, CLIENTS: b.clients, TERMINALS: b.terminals}
    for dim, rows in histories.items():
        store.import_history(dim, as_known(rows), known)
    store.append_fact(FACT_BLACKLIST, b.blacklist.filter(F.col("entry_dt") < ntz(known)), load_date=known)
    load("2024-01-01", "2024-01-12")
    doubtful = b.transactions.filter("oper_type = 'PAYMENT'")
    store.append_fact(FACT_TRANSACTIONS, doubtful, load_date=wrong, event="trans_date")
    incremental.refresh()
    for dim, rows in histories.items():
        store.import_history(dim, rows, known)
    store.append_fact(FACT_BLACKLIST, b.blacklist, load_date=known)
    load("2024-01-13", "2024-01-21")
    store.append_fact(FACT_TRANSACTIONS, doubtful.filter("false"), load_date=wrong, event="trans_date")
    incremental.refresh()
    load("2024-01-22", "2024-12-31")
    incremental.refresh()
    return incremental.report(datetime.fromisoformat(REPORT_DT))


def each_rule(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The four rules as reports of their own."""
    b = bank(spark, sf_dir)
    holders = (b.transactions, b.cards, b.accounts, b.clients)
    return [
        fraud.fraud_passport(*holders, b.blacklist, report_dt=REPORT_DT),
        fraud.fraud_contract(*holders, report_dt=REPORT_DT),
        fraud.fraud_cities(*holders, b.terminals, report_dt=REPORT_DT),
        fraud.fraud_guessing(*holders, report_dt=REPORT_DT, n=CHAIN, within=CHAIN_WITHIN),
    ]


@query("report_union", with_tables(*EVERYTHING, select=REPORT_SQL))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fraud.report_union(*each_rule(spark, sf_dir))


@query(
    "row_counts",
    with_tables(
        *EVERYTHING, f"report AS ({REPORT_SQL})",
        select="SELECT event_type, count(*) AS report_rows FROM report GROUP BY event_type",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(spark, sf_dir).groupBy("event_type").agg(F.count(F.lit(1)).alias("report_rows"))


@query(
    "union_all_constants",
    with_tables(
        *EVERYTHING, f"report AS ({COMBINED_SQL})",
        "kinds AS (SELECT 1 AS event_type UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4)",
        select="""SELECT k.event_type, count(r.event_type) AS hits FROM kinds k
  LEFT JOIN report r ON r.event_type = k.event_type GROUP BY k.event_type""",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per rule, also for a rule without hits."""
    kinds = [fraud.PASSPORT, fraud.CONTRACT, fraud.CITIES, fraud.GUESSING]
    counts = combined(spark, sf_dir).agg(
        *[F.count_if(F.col("event_type") == kind).alias(f"kind_{kind}") for kind in kinds]
    )
    rows = F.array(
        *[F.struct(F.lit(k).alias("event_type"), F.col(f"kind_{k}").alias("hits")) for k in kinds]
    )
    return counts.select(F.explode(rows).alias("_row")).select("_row.*")


@query(
    "ordered_trace",
    with_tables(
        *HOLDERS, *PLACES,
        select="""SELECT h.client_id, h.passport_num, h.card_num, l.city, h.trans_date, h.terminal, h.trans_id
  FROM held h JOIN located l USING (trans_id) WHERE trans_id IN (SELECT trans_id FROM near)
  ORDER BY h.passport_num, h.card_num, h.trans_date""",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bank(spark, sf_dir)
    near = moments.two_places(
        fraud.locate(b.transactions, b.terminals),
        key="card_num", ts="trans_date", place="city_code",
    )
    return fraud.asof_chain(near, b.cards, b.accounts, b.clients).select(
        "client_id", "passport_num", "card_num", "city", "trans_date", "terminal", "trans_id"
    ).orderBy("passport_num", "card_num", "trans_date")


# --- joins of the report ----------------------------------------------------------------


ASOF_SQL = with_tables(
    TX, CARDS_SQL,
    select="""SELECT t.trans_id, t.trans_date, t.card_num, c.account_num FROM transactions t
  LEFT JOIN cards c ON t.card_num = c.card_num AND c.deleted_flg = 'N'
    AND t.trans_date BETWEEN c.effective_from AND c.effective_to""",
)


@query("asof_dim_join", ASOF_SQL)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return asof_dim_join(
        testbank.transactions(spark, sf_dir).select("trans_id", "trans_date", "card_num"),
        testbank.cards(spark, sf_dir),
        fact_key="card_num", dim_key="card_num", ts="trans_date", attrs=["account_num"],
    )


@query("asof_carried", ASOF_SQL)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by versions carried into slots of time, for keys with very many versions."""
    return asof_carried(
        testbank.transactions(spark, sf_dir).select("trans_id", "trans_date", "card_num"),
        testbank.cards(spark, sf_dir),
        fact_key="card_num", dim_key="card_num", ts="trans_date", attrs=["account_num"],
    )


@query(
    "asof_chain",
    with_tables(
        *HOLDERS,
        select="""SELECT trans_id, card_num, account_num, client_id, account_valid_to, last_name, first_name,
  patronymic, passport_num, passport_valid_to, phone FROM held""",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bank(spark, sf_dir)
    return fraud.asof_chain(
        b.transactions.select("trans_id", "trans_date", "card_num"), b.cards, b.accounts, b.clients
    ).drop("trans_date")


def _held(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bank(spark, sf_dir)
    return fraud.asof_chain(
        b.transactions.select("trans_id", "trans_date", "card_num"), b.cards, b.accounts, b.clients
    ).select("trans_id", "trans_date", "passport_num")


@query(
    "blacklist_join",
    with_tables(
        *HOLDERS, BLACKLIST_SQL,
        select="""SELECT h.trans_id, h.trans_date, h.passport_num, b.entry_dt FROM held h
  LEFT JOIN blacklist b ON b.passport_num = h.passport_num AND b.entry_dt < h.trans_date""",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bl.blacklist_join(
        _held(spark, sf_dir), testbank.blacklist(spark, sf_dir), passport="passport_num", ts="trans_date"
    )


@query(
    "blacklist_exists",
    with_tables(
        *HOLDERS, BLACKLIST_SQL,
        select="""SELECT trans_id, trans_date, passport_num FROM held h
  WHERE EXISTS (SELECT 1 FROM blacklist b WHERE b.passport_num = h.passport_num)""",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bl.blacklist_exists(
        _held(spark, sf_dir), testbank.blacklist(spark, sf_dir), passport="passport_num"
    )


@query(
    "near_time_exists",
    with_tables(TX, *PLACES, select="SELECT trans_id, card_num, trans_date, city FROM near"),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    located = fraud.locate(testbank.transactions(spark, sf_dir), testbank.terminals(spark, sf_dir))
    return moments.two_places(
        located.select("trans_id", "card_num", "trans_date", "city", "city_code"),
        key="card_num", ts="trans_date", place="city_code", store=scratch_dir(spark, "flagged"),
    ).drop("city_code")


def _of_hit(card: str, date: str) -> Column:
    """A transaction is of the card and time of a hit. Its id alone would not do: ids such as 7 and 007 are one number."""
    return (F.col("card_num") == F.col(card)) & (F.col("trans_date") == F.col(date))


def _renamed_ends(ends: DataFrame) -> DataFrame:
    return ends.select(F.col("card_num").alias("end_card"), F.col("trans_date").alias("end_date"), "end_order")


@query(
    "rule_pivot_join",
    with_tables(
        *EVERYTHING,
        "first_kind AS (SELECT 1 AS event_type)", "second_kind AS (SELECT 2 AS event_type)",
        "third_kind AS (SELECT trans_id, 3 AS event_type FROM near)",
        "fourth_kind AS (SELECT trans_id, 4 AS event_type FROM chains)",
        "listed AS (SELECT passport_num, min(entry_dt) AS first_dt FROM blacklist GROUP BY passport_num)",
        "kinds AS (SELECT 1 AS event_type UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4)",
        select="""SELECT h.trans_id, k.event_type FROM held h
  LEFT JOIN listed l ON l.passport_num = h.passport_num
  LEFT JOIN first_kind f ON h.passport_valid_to + INTERVAL 1 DAY < h.trans_date OR l.first_dt < h.trans_date
  LEFT JOIN second_kind s ON h.trans_date > h.account_valid_to + INTERVAL 1 DAY
  LEFT JOIN third_kind t ON t.trans_id = h.trans_id
  LEFT JOIN fourth_kind g ON g.trans_id = h.trans_id
  JOIN kinds k ON k.event_type IN (f.event_type, s.event_type, t.event_type, g.event_type)""",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per transaction and rule that holds, by flags instead of joins to constants."""
    b = bank(spark, sf_dir)
    near = moments.two_places(
        fraud.locate(b.transactions, b.terminals), key="card_num", ts="trans_date", place="city_code"
    ).select(F.col("trans_id").alias("near_id"), F.col("card_num").alias("near_card"), F.col("trans_date").alias("near_date"))
    ends = moments.chain_ends(b.transactions, **CHAIN_OPTIONS)
    held = (
        fraud.at_time(
            b.transactions.select("trans_id", "trans_date", "card_num"),
            fraud.holder_spans(b.cards, b.accounts, b.clients, b.blacklist),
        )
        .join(near, _of_hit("near_card", "near_date") & (F.col("trans_id") == F.col("near_id")), "left")
        .join(_renamed_ends(ends), _of_hit("end_card", "end_date") & (id_order("trans_id") == F.col("end_order")), "left")
    )
    passport = past_last_day("passport_valid_to", "trans_date") | F.col("entries").isNotNull()
    return explode_present(
        held,
        "event_type",
        F.when(passport, fraud.PASSPORT),
        F.when(past_last_day("account_valid_to", "trans_date"), fraud.CONTRACT),
        F.when(F.col("near_id").isNotNull(), fraud.CITIES),
        F.when(F.col("end_order").isNotNull(), fraud.GUESSING),
    ).select("trans_id", "event_type")


CHAIN_OPTIONS = dict(
    key="card_num", ts="trans_date", tie="trans_id", amount="amt", n=CHAIN, within=CHAIN_WITHIN
)


@query(
    "rule4_key_join",
    with_tables(
        TX, LAGGED_SQL,
        select="""SELECT t.trans_id, CAST(f.event_type AS VARCHAR) AS event_type FROM transactions t
  LEFT JOIN (SELECT trans_id, 4 AS event_type FROM chains) f ON f.trans_id = t.trans_id""",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = testbank.transactions(spark, sf_dir)
    hits = _renamed_ends(moments.chain_ends(tx, **CHAIN_OPTIONS)).withColumn("event_type", F.lit(fraud.GUESSING))
    hits = stage_overwrite(hits, scratch_dir(spark, "ends"))
    ends = _of_hit("end_card", "end_date") & (id_order("trans_id") == F.col("end_order"))
    flagged = tx.select("trans_id", "card_num", "trans_date").join(hits, ends, "left")
    return as_text(flagged.select("trans_id", "event_type"), "event_type")


# The default chain over the same events, with 15 days in the place of one: minutes apart at most.
DENSE_TX = TX.replace(
    "date_trunc('second', ts) AS trans_date",
    "TIMESTAMP '2024-01-01' + to_seconds(epoch(ts)::BIGINT % 86400 // 60) AS trans_date",
)
STEP = "lag({0}, {1}) OVER w AS {0}_{1}"
DEFAULT_CHAIN_SQL = f"""stepped AS (
  SELECT *, {', '.join(STEP.format(c, k) for c in ('oper_type', 'oper_result', 'trans_date', 'amt') for k in (1, 2, 3))}
  FROM transactions WINDOW w AS (PARTITION BY card_num ORDER BY trans_date, CAST(trans_id AS BIGINT))),
default_chains AS (
  SELECT trans_id, card_num, trans_date FROM stepped
  WHERE oper_result = 'SUCCESS' AND oper_type IN ('PAYMENT', 'WITHDRAW')
    AND {' AND '.join(f"oper_result_{k} = 'REJECT' AND oper_type_{k} IN ('PAYMENT', 'WITHDRAW')" for k in (1, 2, 3))}
    AND trans_date_1 < trans_date AND trans_date_2 < trans_date_1 AND trans_date_3 < trans_date_2
    AND amt_1 > amt AND amt_2 > amt_1 AND amt_3 > amt_2 AND trans_date_3 >= trans_date - INTERVAL 20 MINUTE)"""


@query(
    "decreasing_chain_defaults",
    with_tables(DENSE_TX, DEFAULT_CHAIN_SQL, select="SELECT trans_id, card_num, trans_date FROM default_chains"),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three rejects in 20 minutes, over events whose times are pressed into some minutes."""
    second = F.unix_seconds(F.col("ts").cast("timestamp")) % 86_400
    pressed = table(spark, sf_dir, "events").select("event_id", F.floor(second / 60).cast("int").alias("pressed"))
    pressed = pressed.select(F.col("event_id").cast("string").alias("trans_id"), "pressed")
    start = ntz("2024-01-01 00:00:00")
    tx = testbank.transactions(spark, sf_dir).join(pressed, "trans_id").withColumn(
        "trans_date", start + F.make_dt_interval(secs=F.col("pressed"))
    )
    return moments.decreasing_chain(
        tx.drop("pressed"), key="card_num", ts="trans_date", tie="trans_id", amount="amt"
    ).select("trans_id", "card_num", "trans_date")


@query(
    "decreasing_chain",
    with_tables(
        TX, LAGGED_SQL,
        select="""SELECT trans_id, trans_date, card_num, oper_type, CAST(amt AS VARCHAR) AS amt, oper_result,
  terminal FROM chains""",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text(
        moments.decreasing_chain(
            testbank.transactions(spark, sf_dir), store=scratch_dir(spark, "ends"), **CHAIN_OPTIONS
        ),
        "amt",
    )


@query(
    "lag_three_back",
    with_tables(
        TX,
        select="SELECT trans_id, card_num, trans_date, "
        + ", ".join(
            f"{'CAST(' * (c == 'amt')}lag({c}, {k}) OVER w{' AS VARCHAR)' * (c == 'amt')} AS {c}_back_{k}"
            for c in ("oper_type", "oper_result", "trans_date", "amt") for k in (1, 2, 3)
        )
        + " FROM transactions WINDOW w AS (PARTITION BY card_num ORDER BY trans_date, CAST(trans_id AS BIGINT))",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["oper_type", "oper_result", "trans_date", "amt"]
    lagged = moments.lag_back(
        testbank.transactions(spark, sf_dir), key="card_num", ts="trans_date", tie="trans_id",
        columns=columns, store=scratch_dir(spark, "slots"),
    ).drop("oper_type", "oper_result", "amt", "terminal")
    return as_text(lagged, "amt_back_1", "amt_back_2", "amt_back_3")


@query(
    "chain_exists_selfjoin",
    with_tables(
        TX,
        """operations AS (
  SELECT trans_id, card_num, trans_date AS at, amt, oper_type IN ('PAYMENT', 'WITHDRAW') AS counted,
    oper_result = 'REJECT' AS rejected FROM transactions)""",
        """attempts AS (SELECT * FROM operations WHERE counted AND rejected)""",
        """chains_of_three AS (
  SELECT p.card_num, p.at AS begun, q.at AS middle, q.amt AS middle_amt, r.at AS final, r.amt AS final_amt
  FROM attempts p
  JOIN attempts q ON q.card_num = p.card_num AND q.at > p.at AND q.amt < p.amt AND q.at <= p.at + INTERVAL 5 DAY
  JOIN attempts r ON r.card_num = p.card_num AND r.at > q.at AND r.amt < q.amt AND r.at <= p.at + INTERVAL 5 DAY)""",
        select="""SELECT DISTINCT e.trans_id FROM operations e JOIN chains_of_three k
    ON k.card_num = e.card_num AND e.at > k.final AND e.at <= k.begun + INTERVAL 5 DAY AND e.amt < k.final_amt
  WHERE e.counted AND NOT e.rejected AND NOT EXISTS (
    SELECT 1 FROM operations between_them
    WHERE between_them.card_num = e.card_num AND between_them.at > k.begun AND between_them.at < e.at AND CASE
      WHEN NOT (counted AND rejected) OR between_them.amt < e.amt THEN TRUE
      WHEN between_them.at <= k.middle THEN between_them.amt < k.middle_amt
      WHEN between_them.at <= k.final THEN between_them.amt < k.final_amt
      ELSE FALSE END)""",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return moments.loose_chain(
        testbank.transactions(spark, sf_dir), key="card_num", ts="trans_date", amount="amt",
        within=LOOSE_WITHIN,
    ).select("trans_id")


# --- history loads ----------------------------------------------------------------------

KEY, TRACKED = "client_id", ("segment", "nation")

SCD2_SQL = f"""history AS (
  SELECT 'K' || c_custkey AS client_id, c_mktsegment AS segment, c_nationkey AS nation,
    TIMESTAMP '2024-01-01' AS effective_from,
    CASE WHEN c_custkey % 31 = 3 THEN TIMESTAMP '2024-01-20' ELSE TIMESTAMP '9999-12-31' END AS effective_to,
    'N' AS deleted_flg
  FROM customer WHERE c_custkey % 17 <> 0
  UNION ALL
  SELECT 'K' || c_custkey, c_mktsegment, c_nationkey, TIMESTAMP '2024-01-20 00:00:01', TIMESTAMP '9999-12-31', 'Y'
  FROM customer WHERE c_custkey % 17 <> 0 AND c_custkey % 31 = 3),
stage AS (
  SELECT 'K' || c_custkey AS client_id,
    CASE WHEN c_custkey % 5 = 0 THEN c_mktsegment || '*' WHEN c_custkey % 37 = 0 THEN NULL ELSE c_mktsegment END AS segment,
    c_nationkey AS nation, TIMESTAMP '2023-12-01' AS create_dt,
    CASE WHEN c_custkey % 41 = 7 THEN TIMESTAMP '2024-03-01'
         WHEN c_custkey % 35 = 0 THEN TIMESTAMP '2023-12-15' WHEN c_custkey % 3 = 0 THEN NULL
         ELSE TIMESTAMP '2024-01-31 12:00:00' END AS update_dt
  FROM customer WHERE c_custkey % 13 <> 0),
active AS (
  SELECT 'K' || c_custkey AS client_id FROM customer WHERE c_custkey % 13 <> 0 AND c_custkey % 41 <> 7),
gone AS (
  SELECT h.client_id, h.segment, h.nation, TIMESTAMP '{LOAD_DT}' AS create_dt, TIMESTAMP '{LOAD_DT}' AS update_dt
  FROM history h LEFT JOIN active a ON a.client_id = h.client_id
  WHERE a.client_id IS NULL AND h.deleted_flg = 'N' AND h.effective_to = TIMESTAMP '9999-12-31'),
changes AS (
  SELECT client_id, segment, nation, coalesce(update_dt, create_dt) AS at, 'N' AS flag FROM stage
  WHERE client_id IN (SELECT client_id FROM active)
  UNION ALL
  SELECT client_id, segment, nation, update_dt, 'Y' FROM gone),
closed AS (
  SELECT h.client_id, h.segment, h.nation, h.effective_from,
    CASE WHEN h.deleted_flg = 'N' AND h.effective_to = TIMESTAMP '9999-12-31' AND h.effective_from < c.at
      AND (c.flag = 'Y' OR h.segment IS DISTINCT FROM c.segment OR h.nation IS DISTINCT FROM c.nation)
      THEN c.at ELSE h.effective_to END AS effective_to, h.deleted_flg
  FROM history h LEFT JOIN changes c ON c.client_id = h.client_id),
inserted AS (
  SELECT c.client_id, c.segment, c.nation, c.at AS effective_from, TIMESTAMP '9999-12-31' AS effective_to, 'N' AS deleted_flg
  FROM changes c WHERE NOT EXISTS (SELECT 1 FROM history h WHERE h.client_id = c.client_id AND h.deleted_flg = 'N')),
merged AS (SELECT * FROM closed UNION ALL SELECT * FROM inserted),
reopened AS (
  SELECT c.client_id, c.segment, c.nation, c.at + INTERVAL 1 SECOND AS effective_from,
    TIMESTAMP '9999-12-31' AS effective_to, c.flag AS deleted_flg
  FROM changes c WHERE NOT EXISTS (SELECT 1 FROM merged m WHERE m.client_id = c.client_id
    AND m.deleted_flg = 'N' AND m.effective_to = TIMESTAMP '9999-12-31'))"""

VERSION_SQL = """client_id, segment, nation, effective_from,
  CAST(effective_to AS VARCHAR) AS effective_to, deleted_flg"""


def _shown(versions: DataFrame) -> DataFrame:
    return as_text(versions, "effective_to")


def _before(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testbank.history_before(spark, sf_dir)


def _scd2_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    history = _before(spark, sf_dir)
    changes = scd2.scd2_changes(
        history, testbank.snapshot_after(spark, sf_dir), testbank.active_after(spark, sf_dir),
        key=KEY, tracked=TRACKED, as_of=LOAD_DT,
    )
    return history, changes


@query("scd2_extract_deleted", with_tables(SCD2_SQL, select="SELECT * FROM gone"))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.scd2_extract_deleted(
        _before(spark, sf_dir), testbank.active_after(spark, sf_dir),
        key=KEY, tracked=TRACKED, as_of=LOAD_DT,
    )


@query("scd2_close", with_tables(SCD2_SQL, select=f"SELECT {VERSION_SQL} FROM closed"))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    history, changes = _scd2_inputs(spark, sf_dir)
    return _shown(scd2.scd2_close(history, changes, key=KEY, tracked=TRACKED))


@query("scd2_insert_new", with_tables(SCD2_SQL, select=f"SELECT {VERSION_SQL} FROM inserted"))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    history, changes = _scd2_inputs(spark, sf_dir)
    return _shown(scd2.scd2_insert_new(history, changes, key=KEY, tracked=TRACKED))


@query("scd2_reopen", with_tables(SCD2_SQL, select=f"SELECT {VERSION_SQL} FROM reopened"))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    history, changes = _scd2_inputs(spark, sf_dir)
    merged = scd2.scd2_merge(history, changes, key=KEY, tracked=TRACKED)
    return _shown(scd2.scd2_reopen(merged, changes, key=KEY, tracked=TRACKED))


@query(
    "scd2_load",
    with_tables(
        SCD2_SQL,
        select=f"SELECT {VERSION_SQL} FROM merged UNION ALL SELECT {VERSION_SQL} FROM reopened",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(
        scd2.scd2_load(
            _before(spark, sf_dir), testbank.snapshot_after(spark, sf_dir),
            testbank.active_after(spark, sf_dir), key=KEY, tracked=TRACKED, as_of=LOAD_DT,
        )
    )


@query(
    "merge_match",
    with_tables(
        SCD2_SQL,
        select="""SELECT client_id, flag AS deleted_flg, EXISTS (SELECT 1 FROM history h
    WHERE h.client_id = c.client_id AND h.deleted_flg = 'N') AS matched FROM changes c""",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    history, changes = _scd2_inputs(spark, sf_dir)
    return scd2.merge_match(history, changes, key=KEY).select(KEY, "deleted_flg", "matched")


@query(
    "active_flag_join",
    with_tables(
        SCD2_SQL,
        select="""SELECT h.client_id, CASE WHEN a.client_id IS NOT NULL THEN 'N' ELSE 'Y' END AS deleted_flg
  FROM history h LEFT JOIN active a ON a.client_id = h.client_id WHERE h.deleted_flg = 'N'""",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    extract = _before(spark, sf_dir).filter("deleted_flg = 'N'").select(KEY)
    return scd2.active_flag_join(extract, testbank.active_after(spark, sf_dir), key=KEY)


@query(
    "deleted_anti_join",
    with_tables(
        SCD2_SQL,
        select=f"""SELECT {VERSION_SQL} FROM history h WHERE deleted_flg = 'N'
  AND effective_to = TIMESTAMP '9999-12-31' AND client_id NOT IN (SELECT client_id FROM active)""",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(
        scd2.deleted_anti_join(_before(spark, sf_dir), testbank.active_after(spark, sf_dir), key=KEY)
    )


@query(
    "reopen_anti_join",
    with_tables(
        SCD2_SQL,
        select="""SELECT client_id, segment, nation FROM stage s WHERE NOT EXISTS (SELECT 1 FROM history h
  WHERE h.client_id = s.client_id AND h.deleted_flg = 'N' AND h.effective_to = TIMESTAMP '9999-12-31')""",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.reopen_anti_join(
        _before(spark, sf_dir), testbank.snapshot_after(spark, sf_dir).select(KEY, *TRACKED), key=KEY
    )


@query(
    "live_in_subquery",
    with_tables(
        SCD2_SQL,
        select="""SELECT client_id, segment FROM history
  WHERE deleted_flg = 'N' AND client_id IN (SELECT client_id FROM active)""",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    extract = _before(spark, sf_dir).filter("deleted_flg = 'N'").select(KEY, "segment")
    return scd2.live_in_subquery(extract, testbank.active_after(spark, sf_dir), key=KEY)


@query(
    "open_version_filter",
    with_tables(
        SCD2_SQL,
        select="""SELECT client_id, segment FROM history
  WHERE deleted_flg = 'N' AND effective_to = TIMESTAMP '9999-12-31'""",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _before(spark, sf_dir).filter(is_current()).select(KEY, "segment")


# --- watermarks -------------------------------------------------------------------------

META_SQL = "meta AS (SELECT 'bank' AS sch_name, event_type AS tbl_name, max(ts) AS integrated_dt FROM events GROUP BY event_type)"


@query(
    "meta_get",
    with_tables(
        META_SQL,
        select="""SELECT 'purchase' AS tbl_name, coalesce(max(integrated_dt), TIMESTAMP '1800-01-01') AS integrated_dt
  FROM meta WHERE sch_name = 'bank' AND tbl_name = 'purchase'
  UNION ALL
  SELECT 'refund', coalesce(max(integrated_dt), TIMESTAMP '1800-01-01')
  FROM meta WHERE sch_name = 'bank' AND tbl_name = 'refund'""",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = testbank.meta(spark, sf_dir)
    found, missing = (
        watermark.meta_get(meta, "bank", name).select(F.lit(name).alias("tbl_name"), "integrated_dt")
        for name in ("purchase", "refund")
    )
    return found.unionByName(missing)


@query(
    "meta_set",
    with_tables(
        META_SQL,
        """updates AS (
  SELECT 'bank' AS sch_name, CASE WHEN event_type = 'click' THEN 'new ' ELSE '' END || event_type AS tbl_name,
    CASE WHEN event_type IN ('view', 'click') THEN NULL ELSE max(ts) + INTERVAL 1 DAY END AS integrated_dt
  FROM events WHERE event_type <> 'error' GROUP BY event_type)""",
        select="""SELECT coalesce(m.sch_name, u.sch_name) AS sch_name, coalesce(m.tbl_name, u.tbl_name) AS tbl_name,
  coalesce(u.integrated_dt, m.integrated_dt, TIMESTAMP '1800-01-01') AS integrated_dt
  FROM meta m FULL JOIN updates u ON m.sch_name = u.sch_name AND m.tbl_name = u.tbl_name""",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = testbank.meta(spark, sf_dir)
    updates = meta.filter("tbl_name <> 'error'").selectExpr(
        "sch_name",
        "case when tbl_name = 'click' then 'new click' else tbl_name end as tbl_name",
        "case when tbl_name not in ('view', 'click') then integrated_dt + interval 1 day end as integrated_dt",
    )
    return watermark.meta_set(meta, updates)


@query(
    "max_watermark",
    with_tables(
        SCD2_SQL, META_SQL,
        select="""SELECT coalesce((SELECT max(coalesce(update_dt, create_dt)) FROM stage
    WHERE client_id IN (SELECT client_id FROM active)),
  (SELECT max(integrated_dt) FROM meta WHERE tbl_name = 'view'), TIMESTAMP '1800-01-01') AS integrated_dt""",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return watermark.max_watermark(
        testbank.snapshot_after(spark, sf_dir), testbank.active_after(spark, sf_dir),
        watermark.meta_get(testbank.meta(spark, sf_dir), "bank", "view"), key=KEY,
    )


@query(
    "scalar_max_subquery",
    with_tables(
        META_SQL,
        select="""SELECT s.s_suppkey, coalesce((SELECT max(date_trunc('second', integrated_dt)) + INTERVAL 1 DAY FROM meta
  WHERE sch_name = 'bank' AND tbl_name = 'view'), TIMESTAMP '1900-01-01') AS effective_dt FROM supplier s""",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    effective = watermark.next_snapshot_dt(testbank.meta(spark, sf_dir), "bank", "view")
    return table(spark, sf_dir, "supplier").select("s_suppkey", effective.scalar().alias("effective_dt"))


@query(
    "freshness_gate",
    """WITH meta AS (
  SELECT CASE event_type WHEN 'view' THEN 'dim_accounts_hist' WHEN 'click' THEN 'dim_cards_hist'
    WHEN 'purchase' THEN 'dim_clients_hist' WHEN 'signup' THEN 'dim_terminals_hist' ELSE 'fact_transactions' END AS tbl_name,
    max(ts) AS integrated_dt FROM events GROUP BY event_type),
latest AS (SELECT max(ts) AS dt FROM events),
seen AS (SELECT 'fresh' AS report, dt FROM latest UNION ALL SELECT 'stale', dt - INTERVAL 1 DAY FROM latest)
SELECT report, CAST(max(CASE WHEN coalesce(m.integrated_dt, TIMESTAMP '1800-01-01') > s.dt THEN 1 END) AS VARCHAR) AS has_new_data
FROM seen s LEFT JOIN meta m ON TRUE GROUP BY report""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report that saw everything, and one that saw nothing of the last day."""
    events = table(spark, sf_dir, "events")
    name = F.expr(
        "case event_type when 'view' then 'dim_accounts_hist' when 'click' then 'dim_cards_hist'"
        " when 'purchase' then 'dim_clients_hist' when 'signup' then 'dim_terminals_hist'"
        " else 'fact_transactions' end"
    )
    meta = events.groupBy(name.alias("tbl_name")).agg(F.max("ts").alias("integrated_dt")).select(
        F.lit("bank").alias("sch_name"), "tbl_name", "integrated_dt"
    )
    latest = events.agg(F.max("ts").alias("dt"))

    def gate(report_name: str, lag: str) -> DataFrame:
        seen = latest.select(
            F.lit("bank").alias("sch_name"), F.lit(report_name).alias("tbl_name"),
            *[F.expr(f"dt - {lag}").alias(column) for column in watermark.REPORT_SOURCES],
        )
        return watermark.freshness_gate(meta, seen, "bank", report_name).select(
            F.lit(report_name).alias("report"), "has_new_data"
        )

    return as_text(
        gate("fresh", "interval 0 day").unionByName(gate("stale", "interval 1 day")), "has_new_data"
    )


# --- sources and stage ------------------------------------------------------------------


@query(
    "src_incremental",
    """WITH dated AS (SELECT o_orderkey, o_custkey, o_orderdate,
    CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate + INTERVAL 400 DAY END AS changed FROM orders)
SELECT o_orderkey, o_custkey, o_orderdate FROM dated
WHERE o_orderdate > TIMESTAMP '1997-06-30 12:00:00' OR changed > TIMESTAMP '1997-06-30 12:00:00'""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders created or changed since; every third was changed later, the others never."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_custkey", "o_orderdate",
        "case when o_orderkey % 3 = 0 then o_orderdate + interval 400 day end as changed",
    )
    return src_incremental(
        orders, "1997-06-30 12:00:00.5", created="o_orderdate", updated="changed"
    ).drop("changed")


@query("src_active_keys", "SELECT DISTINCT o_custkey FROM orders")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src_active_keys(table(spark, sf_dir, "orders"), "o_custkey")


@query(
    "active_key_stage_insert",
    "SELECT DISTINCT 'C' || o_custkey AS card_num FROM orders WHERE o_custkey % 50 <> 0",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Padded, repeated and blank keys."""
    padded = table(spark, sf_dir, "orders").selectExpr(
        "case when o_custkey % 50 = 0 then '   ' else rpad('C' || o_custkey, 20, ' ') end as card"
    )
    return staged_keys(padded, "card", "card_num")


@query(
    "db_stage_load",
    """WITH source AS (SELECT c_custkey, 'K' || c_custkey AS client_id, c_name, c_mktsegment,
    TIMESTAMP '2024-01-01' + to_days(CAST(c_custkey % 30 AS INTEGER)) AS create_dt,
    CASE WHEN c_custkey % 3 = 0 THEN TIMESTAMP '2024-01-01' + to_days(CAST(c_custkey % 60 AS INTEGER)) END AS update_dt
  FROM customer)
SELECT s.client_id AS live_key, i.client_id, i.c_mktsegment AS last_name, i.c_name AS first_name, i.create_dt, i.update_dt
FROM source s LEFT JOIN (SELECT * FROM source WHERE create_dt > TIMESTAMP '2024-01-20'
  OR update_dt > TIMESTAMP '2024-01-20') i ON i.client_id = s.client_id""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = table(spark, sf_dir, "customer").selectExpr(
        "rpad('K' || c_custkey, 20, ' ') as client_id",
        "c_mktsegment as last_name",
        "c_name as first_name",
        "'' as patronymic",
        "cast(null as timestamp_ntz) as date_of_birth",
        "'P' || c_custkey as passport_num",
        "cast(null as timestamp_ntz) as passport_valid_to",
        "'' as phone",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(c_custkey % 30 as int)) as create_dt",
        "case when c_custkey % 3 = 0 then timestamp_ntz'2024-01-01 00:00:00'"
        " + make_dt_interval(cast(c_custkey % 60 as int)) end as update_dt",
    )
    increment, keys = db_stage_load(source, CLIENTS, datetime(2024, 1, 20))
    return keys.select(F.col("client_id").alias("live_key")).join(
        increment, F.col("live_key") == F.col("client_id"), "left"
    ).select("live_key", "client_id", "last_name", "first_name", "create_dt", "update_dt")


FILE_SQL = """file AS (
  SELECT event_id AS transaction_id, CAST(date_trunc('second', ts) AS VARCHAR) AS transaction_date,
    replace(CAST(CAST(value AS DECIMAL(14,2)) AS VARCHAR), '.', ',') AS amount, 'C' || user_id AS card_num,
    event_type AS oper_type, CASE WHEN event_type = 'error' THEN 'REJECT' ELSE 'SUCCESS' END AS oper_result,
    'T' || (event_id % 10) AS terminal, CAST(ts AS DATE) AS day, event_id
  FROM events)"""


def _file_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as the text cells of transaction files, in another column order, with an
    extra column; every hundredth row is blank."""
    events = table(spark, sf_dir, "events").withColumn("second", whole_second("ts"))
    cells = events.selectExpr(
        "event_id",
        "to_date(ts) as day",
        "'\"quoted\"' as note",
        "cast(event_id as string) as transaction_id",
        "cast(second as string) as transaction_date",
        "replace(cast(cast(value as decimal(14,2)) as string), '.', ',') as amount",
        "event_type as oper_type",
        "case when event_type = 'error' then 'REJECT' else 'SUCCESS' end as oper_result",
        "'T' || event_id % 10 as terminal",
        "'C' || user_id as card_num",
    )
    blank = F.col("event_id") % 100 == 0
    text = [name for name in cells.columns if name not in ("event_id", "day")]
    return cells.select(
        "event_id", "day", *[F.when(~blank, F.col(name)).alias(name) for name in text]
    )


def _write_files(rows: DataFrame, path: str) -> None:
    rows.write.csv(path, sep=";", header=True, quote="", nullValue="", emptyValue="")


@query(
    "scan_delimited",
    with_tables(
        FILE_SQL,
        select="""SELECT CAST(transaction_id AS VARCHAR) AS transaction_id, transaction_date, amount, card_num,
  oper_type, oper_result, terminal FROM file WHERE event_id % 100 <> 0""",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "delimited")
    _write_files(_file_rows(spark, sf_dir).drop("event_id", "day"), path)
    return scan_delimited(spark, path, TRANSACTION_FILE_COLUMNS)


@query(
    "decimal_comma",
    with_tables(
        FILE_SQL,
        select="""SELECT transaction_id, CAST(CAST(replace(amount, ',', '.') AS DECIMAL(14,4)) AS VARCHAR) AS amt
  FROM file WHERE event_id % 100 <> 0""",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _file_rows(spark, sf_dir).filter(F.col("transaction_id").isNotNull())
    typed = rows.select(
        F.col("event_id").alias("transaction_id"), decimal_comma("amount").alias("amt")
    )
    return as_text(typed, "amt")


@query(
    "skip_empty_rows",
    with_tables(FILE_SQL, select="SELECT CAST(day AS VARCHAR) AS day, count(*) AS kept FROM file WHERE event_id % 100 <> 0 GROUP BY day"),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _file_rows(spark, sf_dir)
    days = rows.select("event_id", "day").withColumnRenamed("event_id", "transaction_id")
    kept = skip_empty_rows(rows.drop("event_id", "day")).select(
        F.col("transaction_id").cast("bigint").alias("transaction_id")
    )
    counts = kept.join(days, "transaction_id").groupBy("day").agg(F.count(F.lit(1)).alias("kept"))
    return as_text(counts, "day")


@query(
    "stage_insert_typed",
    with_tables(
        FILE_SQL,
        select="""SELECT CAST(transaction_id AS VARCHAR) AS trans_id, CAST(transaction_date AS TIMESTAMP) AS trans_date,
  card_num, oper_type, CAST(CAST(replace(amount, ',', '.') AS DECIMAL(14,4)) AS VARCHAR) AS amt, oper_result, terminal
  FROM file WHERE event_id % 100 <> 0""",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _file_rows(spark, sf_dir).drop("event_id", "day", "note")
    return as_text(stage_transactions(skip_empty_rows(cells)), "amt")


@query(
    "header_contract",
    with_tables(
        FILE_SQL,
        select="SELECT oper_type, oper_result, count(*) AS file_rows FROM file WHERE event_id % 100 <> 0 GROUP BY ALL",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _file_rows(spark, sf_dir)
    header_contract(rows.columns, TRANSACTION_FILE_COLUMNS, "events")
    return (
        skip_empty_rows(rows.select(*TRANSACTION_FILE_COLUMNS))
        .groupBy("oper_type", "oper_result")
        .agg(F.count(F.lit(1)).alias("file_rows"))
    )


@query(
    "scan_workbook",
    """SELECT 'P' || user_id AS passport, date_trunc('second', ts) AS date,
  CASE WHEN event_id % 10 <> 0 THEN event_type || ' & <co>' END AS note FROM events""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("date", whole_second("ts"))
    rows = events.selectExpr(
        "case when event_id % 10 <> 0 then event_type || ' & <co>' end as note",
        "event_id as extra",
        "'P' || user_id as passport",
        "date",
    )
    folder = qualified(spark, scratch_dir(spark, "workbooks"))
    write_workbooks(rows.repartition("extra"), "blacklist", folder).count()
    return scan_workbook(
        spark, folder, "blacklist", {"passport": "string", "date": "timestamp_ntz", "note": "string"}
    )


@query(
    "file_batch_rows",
    with_tables(
        FILE_SQL,
        select="""SELECT CAST(transaction_id AS VARCHAR) AS trans_id, upper(oper_type) AS oper_type,
  CAST(CAST(replace(amount, ',', '.') AS DECIMAL(14,4)) AS VARCHAR) AS amt
  FROM file WHERE event_id % 100 <> 0 AND oper_type <> 'view' AND card_num NOT LIKE '%7'""",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file's rows through a validator and converters of columns."""
    path = scratch_dir(spark, "delimited")
    _write_files(_file_rows(spark, sf_dir).drop("event_id", "day"), path)
    rows = file_batch_rows(
        scan_delimited(spark, path, TRANSACTION_FILE_COLUMNS),
        valid=(F.col("oper_type") != "view") & ~F.col("card_num").endswith("7"),
        converted={
            "trans_id": F.col("transaction_id"),
            "oper_type": F.upper("oper_type"),
            "amt": decimal_comma("amount"),
        },
    )
    return as_text(rows, "amt")


DAYS_SQL = "days AS (SELECT DISTINCT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS file_dt FROM events)"
FILE_NAME_SQL = "'transactions_' || strftime(file_dt, '%d%m%Y') || '.txt' AS file_name, file_dt"


def _drop_name(day: str = "day") -> Column:
    return F.concat(F.lit("transactions_"), F.date_format(day, "ddMMyyyy"), F.lit(".txt"))


def _named_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "events").select(F.to_date("ts").alias("day")).distinct()
    paths = days.select(F.concat(F.lit("/drops/"), _drop_name()).alias("path"))
    return dated_names(paths, "transactions_", ".txt")


@query(
    "pick_next_file",
    with_tables(
        DAYS_SQL,
        select=f"""SELECT {FILE_NAME_SQL}, 'next' AS choice FROM days
  WHERE file_dt = (SELECT min(file_dt) FROM days) + INTERVAL 3 DAY
  UNION ALL
  SELECT {FILE_NAME_SQL}, 'first' FROM days WHERE file_dt = (SELECT min(file_dt) FROM days)""",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as one drop per day, then listed; one more day follows the third."""
    folder = scratch_dir(spark, "drops")
    rows = _file_rows(spark, sf_dir).withColumn("drop", _drop_name()).drop("event_id", "day")
    rows.write.partitionBy("drop").csv(folder, sep=";", header=True, quote="", nullValue="", emptyValue="")
    files = list_dated_files(spark, folder, "transactions_", ".txt")
    days = table(spark, sf_dir, "events").agg(F.min(F.to_date("ts")).cast("timestamp_ntz").alias("dt"))
    third = days.selectExpr("dt + interval 2 day as integrated_dt")
    never = days.select(ntz("1800-01-01 00:00:00").alias("integrated_dt"))
    return (
        pick_next_file(files, third).withColumn("choice", F.lit("next"))
        .unionByName(pick_next_file(files, never).withColumn("choice", F.lit("first")))
        .drop("path")
    )


@query(
    "earliest_file",
    with_tables(
        DAYS_SQL, select=f"SELECT {FILE_NAME_SQL} FROM days WHERE file_dt = (SELECT min(file_dt) FROM days)"
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return earliest_file(_named_drops(spark, sf_dir)).drop("path")


@query(
    "file_ledger",
    with_tables(DAYS_SQL, select=f"SELECT {FILE_NAME_SQL} FROM days WHERE file_dt > (SELECT min(file_dt) FROM days)"),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger is in the commits of a store; a load that died before its commit is not in it."""
    drops, store = _named_drops(spark, sf_dir), Store(spark, scratch_dir(spark, "store"))
    first = drops.agg(F.min("file_dt")).first()[0]
    store.append_fact("fact", spark.range(1), load_date=first, file_name=f"transactions_{first:%d%m%Y}.txt")
    store.write_loads("fact", spark.range(1), "never committed")
    return file_ledger(drops, store.commits("fact")).drop("path")


@query(
    "file_intake",
    with_tables(
        FILE_SQL,
        select="""SELECT CAST(transaction_id AS VARCHAR) AS trans_id, CAST(transaction_date AS TIMESTAMP) AS trans_date,
  card_num, oper_type, CAST(CAST(replace(amount, ',', '.') AS DECIMAL(14,4)) AS VARCHAR) AS amt, oper_result, terminal,
  CAST(day AS VARCHAR) AS load_date FROM file WHERE event_id % 100 <> 0""",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as drops of a day, of which parts come later, taken as a stream that archives them; the
    first run dies before its commit."""
    folder, store = scratch_dir(spark, "drops"), Store(spark, scratch_dir(spark, "store"))
    rows = _file_rows(spark, sf_dir).withColumn("drop", _drop_name()).hint("rebalance", "drop")
    for wave in (F.col("event_id") % 3 < 2, F.col("event_id") % 3 == 2):
        rows.filter(wave).drop("event_id", "day").write.mode("append").partitionBy("drop").csv(
            folder, sep=";", header=True, quote="", nullValue="", emptyValue=""
        )
        intake = TransactionIntake(store, folder, table="fact", archive=f"{folder}-taken")
        intake.take()  # A run that dies here leaves its files to the next.
        intake.run()
    return as_text(store.read_fact("fact", TRANSACTIONS_DDL), "amt", "load_date")


@query(
    "constraints",
    with_tables(
        TX,
        select="""SELECT 'amt above one' AS constraint_name, count(*) FILTER (NOT (amt > 1)) AS violations FROM transactions
  UNION ALL
  SELECT 'oper_result known', count(*) FILTER (NOT (oper_result IN ('SUCCESS'))) FROM transactions
  UNION ALL
  SELECT 'trans_id not null', count(*) FILTER (trans_id IS NULL) FROM transactions""",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return violations(
        testbank.transactions(spark, sf_dir),
        {
            "amt above one": F.col("amt") > 1,
            "oper_result known": F.col("oper_result").isin("SUCCESS"),
            "trans_id not null": F.col("trans_id").isNotNull(),
        },
    )


@query("load_row_count", with_tables(TX, select="SELECT 'transactions' AS entity, count(*) AS loaded FROM transactions"))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows counted while they are written, not by a second pass."""
    seen = Observation()
    stage_overwrite(
        testbank.transactions(spark, sf_dir).observe(seen, F.count(F.lit(1)).alias("rows")),
        scratch_dir(spark, "stage"),
    )
    return spark.range(1).select(
        F.lit("transactions").alias("entity"), F.lit(seen.get["rows"]).cast("bigint").alias("loaded")
    )


# --- sinks ------------------------------------------------------------------------------


@query("stage_overwrite", with_tables(TX, select="SELECT trans_id, card_num, CAST(amt AS VARCHAR) AS amt FROM transactions WHERE oper_type = 'PAYMENT'"))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "stage")
    tx = testbank.transactions(spark, sf_dir).select("trans_id", "card_num", "amt", "oper_type")
    stage_overwrite(tx, path)
    return as_text(stage_overwrite(tx.filter("oper_type = 'PAYMENT'").drop("oper_type"), path), "amt")


@query(
    "fact_append_transactions",
    with_tables(
        TX,
        select="""SELECT trans_id, trans_date, card_num, oper_type, CAST(amt AS VARCHAR) AS amt, oper_result,
  terminal, CAST(CAST(trans_date AS DATE) AS VARCHAR) AS load_date FROM transactions""",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days at once and the later half again; a day of wrong rows that was then found to be
    empty, and a load that died before its commit."""
    store = Store(spark, scratch_dir(spark, "store"))
    tx = testbank.transactions(spark, sf_dir)
    dated = tx.withColumn("load_date", F.to_date("trans_date"))
    store.append_fact("fact", dated)
    store.append_fact("fact", dated.filter("load_date >= date'2024-01-16'"))
    wrong = datetime(2023, 1, 1)
    store.append_fact("fact", tx.filter("oper_type = 'DEPOSIT'"), load_date=wrong)
    store.append_fact("fact", tx.filter("false"), load_date=wrong)
    store.write_loads("fact", tx, "2024-01-20")
    return as_text(store.read_fact("fact", TRANSACTIONS_DDL), "amt", "load_date")


@query(
    "fact_append_blacklist",
    with_tables(BLACKLIST_SQL, select="SELECT passport_num, entry_dt, '2024-01-31' AS load_date FROM blacklist"),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loaded twice for the same day, and once more without a commit."""
    store = Store(spark, scratch_dir(spark, "store"))
    listed = testbank.blacklist(spark, sf_dir)
    for _again in range(2):
        store.append_fact("fact", listed, load_date=datetime(2024, 1, 31))
    store.write_loads("fact", listed, "2024-01-30")
    return as_text(store.read_fact("fact", BLACKLIST_DDL), "load_date")


@query(
    "report_sink",
    with_tables(
        *EVERYTHING,
        f"report AS ({REPORT_SQL})",
        select=f"""SELECT * FROM report
  UNION ALL
  SELECT * REPLACE (TIMESTAMP '{REPORT_DT}' + INTERVAL 8 HOUR AS report_dt) FROM report WHERE event_type = 2""",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two reports of one day stay both; of one built again the later counts, also if it is empty, and
    one that died before its commit does not."""
    store, table_name = Store(spark, scratch_dir(spark, "store")), "report"
    # Each rule is computed once, however often it is written.
    rules = [stage_overwrite(rule, scratch_dir(spark, "rule")) for rule in each_rule(spark, sf_dir)]
    first = datetime.fromisoformat(REPORT_DT)

    def at(rows: DataFrame, report_dt: datetime) -> DataFrame:
        return rows.withColumn("report_dt", ntz(report_dt))

    second, third = first.replace(hour=8), first.replace(hour=18)
    store.write_report(table_name, rules[1], first)
    store.write_report(table_name, at(rules[1], second), second)
    store.write_report(table_name, at(rules[1], third), third)
    store.write_report(table_name, fraud.report_union(*rules), first)
    store.write_report(table_name, at(rules[1], third).filter("false"), third)
    store.write_loads(table_name, rules[0], "never committed")
    return store.read_report(table_name)


# --- expressions ------------------------------------------------------------------------


@query(
    "project_full_name",
    """SELECT c_custkey, c_mktsegment || ' ' || c_name || ' ' ||
  coalesce(CASE WHEN c_custkey % 4 <> 0 THEN 'P-' || c_nationkey END, '') AS fio FROM customer""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    middle = F.when(F.col("c_custkey") % 4 != 0, F.concat(F.lit("P-"), F.col("c_nationkey")))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", full_name("c_mktsegment", "c_name", middle).alias("fio")
    )


@query(
    "null_safe_diff",
    """WITH pairs AS (SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS a,
    CASE WHEN c_custkey % 5 <> 0 THEN 'BUILDING' END AS b FROM customer)
SELECT c_custkey FROM pairs WHERE a <> b OR (a IS NULL AND b IS NOT NULL) OR (a IS NOT NULL AND b IS NULL)""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment"))
    new = F.when(F.col("c_custkey") % 5 != 0, F.lit("BUILDING"))
    return table(spark, sf_dir, "customer").filter(differs([(old, new)])).select("c_custkey")


@query(
    "key_trim",
    "SELECT c_custkey, CASE WHEN c_custkey % 10 <> 0 THEN 'C' || c_custkey END AS card_num FROM customer",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.when(F.col("c_custkey") % 10 == 0, F.lit("    ")).otherwise(
        F.rpad(F.concat(F.lit("C"), F.col("c_custkey")), 20, " ")
    )
    return table(spark, sf_dir, "customer").select("c_custkey", clean_key(padded).alias("card_num"))


@query(
    "deleted_flag_case",
    """SELECT c.c_custkey, CASE WHEN o.o_custkey IS NOT NULL THEN 'N' ELSE 'Y' END AS deleted_flg
FROM customer c LEFT JOIN (SELECT DISTINCT o_custkey FROM orders) o ON o.o_custkey = c.c_custkey""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    live = src_active_keys(table(spark, sf_dir, "orders"), "o_custkey")
    return table(spark, sf_dir, "customer").join(
        live, F.col("c_custkey") == F.col("o_custkey"), "left"
    ).select("c_custkey", deleted_flag(F.col("o_custkey")).alias("deleted_flg"))


@query(
    "expiry_plus_day",
    """SELECT event_id FROM events
WHERE TIMESTAMP '2024-01-01' + to_days(CAST(user_id % 30 AS INTEGER)) + INTERVAL 1 DAY < ts""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid_to = F.expr(
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(user_id % 30 as int))"
    )
    return table(spark, sf_dir, "events").filter(past_last_day(valid_to, "ts")).select("event_id")


@query(
    "between_inclusive",
    "SELECT o_orderkey FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-12-31'",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = F.col("o_orderdate").between(ntz("1996-01-01 00:00:00"), ntz("1996-12-31 00:00:00"))
    return table(spark, sf_dir, "orders").filter(dates).select("o_orderkey")


@query(
    "status_in_list",
    with_tables(TX, select="SELECT trans_id, oper_type FROM transactions WHERE oper_type IN ('PAYMENT', 'WITHDRAW')"),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = testbank.transactions(spark, sf_dir)
    return tx.filter(F.col("oper_type").isin(*SPENDING_TYPES)).select("trans_id", "oper_type")


@query(
    "blacklist_recent_filter",
    with_tables(BLACKLIST_SQL, select="SELECT * FROM blacklist WHERE entry_dt >= TIMESTAMP '2024-01-15'"),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blacklist_recent_filter(
        testbank.blacklist(spark, sf_dir), "2024-01-15 00:00:00", date="entry_dt"
    )


@query(
    "blank_to_null",
    "SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN event_type END AS event_type FROM events",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("event_id") % 4 == 0, F.lit("")).otherwise(F.col("event_type"))
    return table(spark, sf_dir, "events").select("event_id", blank_to_null(text).alias("event_type"))
