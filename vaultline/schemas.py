"""Fixed values of the data model: sentinels, column lists, dimension descriptions.

All times are ``timestamp_ntz`` in whole seconds, so no session time zone can shift
them. Column expressions are built by functions since they need a running session.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
OPEN_END = "9999-12-31 00:00:00"  # end of a version that is still valid
NEVER_LOADED = "1800-01-01 00:00:00"  # watermark of a table that was never loaded
FIRST_SNAPSHOT = "1900-01-01 00:00:00"  # start of the versions of the first full snapshot
INITIAL_BEFORE = datetime(2010, 1, 1)  # a watermark before this means: take the oldest file
BEGINNING = "0001-01-01 00:00:00"  # earlier than any version

SPENDING_TYPES = ("PAYMENT", "WITHDRAW")
ACCEPTED = "SUCCESS"
REJECTED = "REJECT"

REPORT_COLUMNS = ("event_dt", "passport", "fio", "phone", "event_type", "report_dt")
VERSION_COLUMNS = ("effective_from", "effective_to", "deleted_flg")

TRANSACTION_FILE_COLUMNS = (
    "transaction_id",
    "transaction_date",
    "amount",
    "card_num",
    "oper_type",
    "oper_result",
    "terminal",
)
TERMINAL_FILE_COLUMNS = ("terminal_id", "terminal_type", "terminal_city", "terminal_address")
BLACKLIST_FILE_COLUMNS = ("passport", "date")

TRANSACTIONS_DDL = (
    "trans_id string, trans_date timestamp_ntz, card_num string, oper_type string, "
    "amt decimal(14,4), oper_result string, terminal string"
)
BLACKLIST_DDL = "passport_num string, entry_dt timestamp_ntz"
META_DDL = "sch_name string, tbl_name string, integrated_dt timestamp_ntz"
ACCOUNTS_DDL = "account_num string, valid_to timestamp_ntz, client string"
CARDS_DDL = "card_num string, account_num string"
CLIENTS_DDL = (
    "client_id string, last_name string, first_name string, patronymic string, "
    "date_of_birth timestamp_ntz, passport_num string, passport_valid_to timestamp_ntz, phone string"
)
TERMINALS_DDL = (
    "terminal_id string, terminal_type string, terminal_city string, terminal_address string"
)
VERSIONS_DDL = "effective_from timestamp_ntz, effective_to timestamp_ntz, deleted_flg string"
REPORT_DDL = (
    "event_dt timestamp_ntz, passport string, fio string, phone string, "
    "event_type smallint, report_dt timestamp_ntz"
)


def ntz(value: str | datetime) -> Column:
    """A ``timestamp_ntz`` literal."""
    text = value.strftime("%Y-%m-%d %H:%M:%S.%f") if isinstance(value, datetime) else value
    return F.lit(text).cast("timestamp_ntz")


def open_end() -> Column:
    return ntz(OPEN_END)


@dataclass(frozen=True)
class Dimension:
    """A history table: its key, the columns whose change makes a new version, and
    how the source calls those columns."""

    table: str
    key: str
    tracked: tuple[str, ...]
    ddl: str
    source_names: tuple[tuple[str, str], ...] = ()

    @property
    def columns(self) -> list[str]:
        return [self.key, *self.tracked, *VERSION_COLUMNS]

    @property
    def history_ddl(self) -> str:
        return f"{self.ddl}, {VERSIONS_DDL}"

    def source_name(self, column: str) -> str:
        return dict(self.source_names).get(column, column)


ACCOUNTS = Dimension(
    "dim_accounts_hist",
    "account_num",
    ("valid_to", "client"),
    ACCOUNTS_DDL,
    (("account_num", "account"),),
)
CARDS = Dimension(
    "dim_cards_hist", "card_num", ("account_num",), CARDS_DDL, (("account_num", "account"),)
)
CLIENTS = Dimension(
    "dim_clients_hist",
    "client_id",
    (
        "last_name",
        "first_name",
        "patronymic",
        "date_of_birth",
        "passport_num",
        "passport_valid_to",
        "phone",
    ),
    CLIENTS_DDL,
)
TERMINALS = Dimension(
    "dim_terminals_hist",
    "terminal_id",
    ("terminal_type", "terminal_city", "terminal_address"),
    TERMINALS_DDL,
)
FACT_TRANSACTIONS = "fact_transactions"
FACT_BLACKLIST = "fact_passport_blacklist"
FRAUD_REPORT = "rep_fraud"
