"""The daily loads and the report, over a ``Store``.

Each load stages, checks, writes and commits one table. A load that finds nothing to do
says so and changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from contextlib import suppress
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.operators.checks import enforce, not_null, stage_rules
from vaultline.operators.stage import (
    stage_blacklist,
    stage_dimension,
    stage_snapshot,
    stage_transactions,
)
from vaultline.operators.watermark import max_watermark, next_snapshot_at
from vaultline.plans.fraud import holder_spans, report_from_spans, suspects
from vaultline.plans.incremental import IncrementalReport
from vaultline.schemas import (
    ACCOUNTS,
    BLACKLIST_DDL,
    BLACKLIST_FILE_COLUMNS,
    CARDS,
    CLIENTS,
    FACT_BLACKLIST,
    FACT_TRANSACTIONS,
    FRAUD_REPORT,
    TERMINAL_FILE_COLUMNS,
    TERMINALS,
    TRANSACTION_FILE_COLUMNS,
    TRANSACTIONS_DDL,
    Dimension,
    ntz,
)
from vaultline.sources.dated_files import file_ledger, list_dated_files, next_file
from vaultline.sources.delimited import scan_delimited
from vaultline.sources.store import TRIES, Overtaken, Store, new_attempt, stage_overwrite
from vaultline.sources.tables import src_incremental, staged_keys
from vaultline.sources.workbook import scan_workbook
from vaultline.streaming.intake import TransactionIntake

LOADED, NOTHING_TO_LOAD = "loaded", "nothing to load"


@dataclass(frozen=True)
class Outcome:
    """What a load did. ``detail`` names the file or the reason."""

    entity: str
    status: str
    rows: int = 0
    detail: str = ""


def db_stage_load(
    source: DataFrame, dim: Dimension, watermark: datetime
) -> tuple[DataFrame, DataFrame]:
    """Stage rows changed since the watermark, and all live keys."""
    increment = stage_dimension(src_incremental(source, watermark), dim)
    return increment, staged_keys(source, dim.source_name(dim.key), dim.key)


class Warehouse:
    """Loads into and reports from the tables of one store."""

    def __init__(self, store: Store, compact_after: int = 50):
        """A history is compacted once its latest version is read from more than ``compact_after`` loads."""
        self.store = store
        self.compact_after = compact_after
        self.spark = store.spark

    def _staged(self, rows: DataFrame, table: str) -> DataFrame:
        """Keep a stage in the store: it is read by the check, the load and the watermark,
        and the source may move on in between. Each has a folder of its own, so loads may overlap."""
        return stage_overwrite(rows, self.store.path(table, "stages", f"attempt={new_attempt()}"))

    def _until_committed(self, load: Callable[[], Outcome]) -> Outcome:
        """Do a load again, from its source on, as long as other loads of the table commit first."""
        for _try in range(TRIES - 1):
            try:
                return load()
            except Overtaken:
                continue
        return load()

    def _new_files(self, table: str, folder: str, prefix: str, suffix: str) -> DataFrame:
        """The drops that no committed load of the table has taken."""
        files = self.store.loaded_files(table).select(F.substring_index("file_name", "/", 1).alias("file_name"))
        return file_ledger(list_dated_files(self.spark, folder, prefix, suffix), files)

    def _compact(self, dim: Dimension) -> None:
        """Compact a history that is due; if another load commits meanwhile, a later one will do it."""
        if self.store.loads_since_compaction(dim) >= self.compact_after:
            with suppress(Overtaken):
                self.store.compact_history(dim)

    def load_bank_table(self, dim: Dimension, source: DataFrame, *, as_of: datetime) -> Outcome:
        """Accounts, cards or clients from the bank's table."""
        return self._until_committed(lambda: self._load_bank_table(dim, source, as_of))

    def _load_bank_table(self, dim: Dimension, source: DataFrame, as_of: datetime) -> Outcome:
        _, watermark = self.store.latest(dim.table)
        increment, keys = db_stage_load(source, dim, watermark)
        stage = self._staged(increment, dim.table)
        active = self._staged(keys, dim.table)
        enforce(stage, stage_rules(dim.key))
        loaded = self.store.load_history(dim, stage, active, as_of=as_of)
        one = self.spark.range(1).select(ntz(watermark).alias("integrated_dt"))
        latest = max_watermark(stage, active, one, key=dim.key).first().integrated_dt
        self.store.commit_history(dim, loaded, latest)
        self._compact(dim)
        return Outcome(dim.table, LOADED, loaded.rows)

    def load_terminals(self, folder: str) -> Outcome:
        """The next full snapshot of terminals. What it lacks is deleted."""
        return self._until_committed(lambda: self._load_terminals(folder))

    def _load_terminals(self, folder: str) -> Outcome:
        files = self._new_files(TERMINALS.table, folder, "terminals_", ".xlsx")
        _, watermark = self.store.latest(TERMINALS.table)
        file = next_file(files, watermark)
        if file is None:
            return Outcome(TERMINALS.table, NOTHING_TO_LOAD, detail=f"after {watermark}")
        effective = next_snapshot_at(watermark)
        rows = scan_workbook(self.spark, file.path, "terminals", TERMINAL_FILE_COLUMNS)
        stage = self._staged(stage_snapshot(rows, TERMINALS, effective), TERMINALS.table)
        enforce(stage, not_null(TERMINALS.key))
        active = stage.select(TERMINALS.key)
        loaded = self.store.load_history(TERMINALS, stage, active, as_of=effective)
        self.store.commit_history(TERMINALS, loaded, file.file_dt, file.file_name)
        self._compact(TERMINALS)
        return Outcome(TERMINALS.table, LOADED, loaded.rows, file.file_name)

    def load_transactions(self, folder: str) -> Outcome:
        """The next day of transactions."""
        return self._until_committed(
            lambda: self._load_fact(
                FACT_TRANSACTIONS,
                self._new_files(FACT_TRANSACTIONS, folder, "transactions_", ".txt"),
                lambda file: stage_transactions(
                    scan_delimited(self.spark, file.path, TRANSACTION_FILE_COLUMNS)
                ),
                ("terminal",),
                "trans_date",
            )
        )

    def stream_transactions(self, folder: str, archive: str | None = None, **options) -> list[int]:
        """All new transaction files of any day, as a stream; gives the versions committed. Takes the options of ``TransactionIntake``."""
        return TransactionIntake(self.store, folder, archive=archive, **options).run()

    def load_blacklist(self, folder: str) -> Outcome:
        """The next passport blacklist; entries dated before the file are left out."""
        columns = dict(zip(BLACKLIST_FILE_COLUMNS, ("string", "timestamp_ntz"), strict=True))
        return self._until_committed(
            lambda: self._load_fact(
                FACT_BLACKLIST,
                self._new_files(FACT_BLACKLIST, folder, "passport_blacklist_", ".xlsx"),
                lambda file: stage_blacklist(
                    scan_workbook(self.spark, file.path, "blacklist", columns), file.file_dt
                ),
                ("passport_num",),
                "entry_dt",
            )
        )

    def _load_fact(
        self,
        table: str,
        files: DataFrame,
        read: Callable[..., DataFrame],
        required: Iterable[str],
        event: str,
    ) -> Outcome:
        _, watermark = self.store.latest(table)
        file = next_file(files, watermark)
        if file is None:
            return Outcome(table, NOTHING_TO_LOAD, detail=f"after {watermark}")
        stage = self._staged(read(file), table)
        enforce(stage, not_null(*required))
        rows = self.store.append_fact(table, stage, load_date=file.file_dt, file_name=file.file_name, event=event)
        return Outcome(table, LOADED, rows, file.file_name)

    def build_fraud_report(self, *, report_dt: datetime) -> DataFrame:
        """Build, write and return the report of ``report_dt`` over all facts.

        Holder spans and suspects are stored first: far smaller than the transactions, and
        once stored their sizes are known when the joins of the transactions are planned.
        """
        store, table = self.store, FRAUD_REPORT
        tx = store.read_fact(FACT_TRANSACTIONS, TRANSACTIONS_DDL)
        blacklist = store.read_fact(FACT_BLACKLIST, BLACKLIST_DDL)
        spans = stage_overwrite(
            holder_spans(
                store.history(CARDS), store.history(ACCOUNTS), store.history(CLIENTS), blacklist
            ),
            store.path(table, "spans"),
        )
        known = store.latest_event(FACT_TRANSACTIONS)
        latest = ntz(known) if known else tx.agg(F.max("trans_date")).scalar()
        suspect_spans = stage_overwrite(suspects(spans, latest), store.path(table, "suspects"))
        report = report_from_spans(
            tx, store.history(TERMINALS), spans, suspect_spans, report_dt=report_dt
        )
        store.write_report(table, report, report_dt)
        return store.read_report(table).filter(F.col("report_dt") == ntz(report_dt))

    def refresh_fraud_report(self, *, report_dt: datetime) -> DataFrame:
        """The same report, of which only what loads since the last refresh touch is computed."""
        incremental = IncrementalReport(self.store)
        incremental.refresh()
        return incremental.report(report_dt)

    def run(
        self,
        sources: Mapping[str, DataFrame],
        folder: str,
        *,
        as_of: datetime,
        exclude: Iterable[str] = (),
    ) -> list[Outcome]:
        """All loads in order, without the excluded ones. One that fails stops no other."""
        loads: dict[str, Callable[[], Outcome]] = {
            "accounts": lambda: self.load_bank_table(ACCOUNTS, sources["accounts"], as_of=as_of),
            "cards": lambda: self.load_bank_table(CARDS, sources["cards"], as_of=as_of),
            "clients": lambda: self.load_bank_table(CLIENTS, sources["clients"], as_of=as_of),
            "transactions": lambda: self.load_transactions(folder),
            "terminals": lambda: self.load_terminals(folder),
            "blacklist": lambda: self.load_blacklist(folder),
        }
        unknown = set(exclude) - set(loads)
        if unknown:
            raise ValueError(f"unknown entities: {sorted(unknown)}")
        outcomes = []
        for entity, load in loads.items():
            if entity in exclude:
                continue
            try:
                outcomes.append(load())
            except Exception as error:  # noqa: BLE001 - reported, the next load still runs
                outcomes.append(Outcome(entity, "failed", detail=str(error)))
        return outcomes
