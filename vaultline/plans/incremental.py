"""The fraud report kept up to date: only what later loads touch is computed again.

The state is a table of hits by the day of the event, with the card of each. A refresh compares the versions of
all inputs with those the state was built from and finds

* the days that new, replaced or emptied loads of transactions reach, by the times in their commits;
* the cards whose holder was another for some time (changed cards, accounts, clients and blacklist entries all
  show in the spans of holders), and the cards that used a terminal while its city was another.

Those days are computed for all cards, the other touched days for the touched cards alone, from the loads
whose events lie there or at most one reach before. Their days are written anew and committed at once, with the versions of the
inputs. A report is the state with the time of the report.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.functions.columns import seconds
from vaultline.operators.asof import without_gaps
from vaultline.operators.moments import HOUR
from vaultline.plans.fraud import CLIENT_ATTRS, holder_spans, report_from_spans, suspects
from vaultline.schemas import (
    ACCOUNTS,
    BEGINNING,
    BLACKLIST_DDL,
    CARDS,
    CLIENTS,
    FACT_BLACKLIST,
    FACT_TRANSACTIONS,
    REPORT_COLUMNS,
    TERMINALS,
    TRANSACTIONS_DDL,
    ntz,
    open_end,
)
from vaultline.sources.store import TRIES, Overtaken, Store, new_attempt, stage_overwrite

STATE = "rep_fraud_days"
STATE_DDL = (
    "event_dt timestamp_ntz, card_num string, passport string, fio string, phone string, event_type smallint"
)
HISTORIES = (CARDS, ACCOUNTS, CLIENTS, TERMINALS)
FACTS = (FACT_TRANSACTIONS, FACT_BLACKLIST)
# What a report shows of a holder or decides by.
HOLDER_ATTRS = ("account_valid_to", *CLIENT_ATTRS, "entries")


@dataclass(frozen=True)
class Refresh:
    """What a refresh has done: days computed for all cards, days for touched cards only, and loads of facts read."""

    version: int
    whole_days: tuple[str, ...] = ()
    part_days: tuple[str, ...] = ()
    loads: tuple[str, ...] = ()


def changed_spans(old: DataFrame, new: DataFrame, *, key: str, attrs: Sequence[str]) -> DataFrame:
    """(key, changed_from, changed_to): the times at which ``attrs`` of a key differ between two sets of versions.

    Both have ``effective_from`` and ``effective_to``; no version at all differs from one with values. Versions that both sets have are
    left out first, so only changed keys meet, each with its few changed versions.
    """
    columns = [key, "effective_from", "effective_to", *attrs]
    sides = [old.select(*columns), new.select(*columns)]
    # The other's key with NULLs for all time stands for a key that only one set has.
    differing = [sides[0].subtract(sides[1]), sides[1].subtract(sides[0])]
    gapless = []
    for side in (0, 1):
        own = differing[side].withColumn("deleted_flg", F.lit("N"))
        lone = differing[1 - side].select(key).distinct().join(differing[side].select(key).distinct(), key, "left_anti")
        whole = lone.select(
            F.col(key).alias("_span_key"), ntz(BEGINNING).alias("_span_from"), open_end().alias("_span_to"),
            *[F.lit(None).cast(old.schema[name].dataType).alias(name) for name in attrs],
        )
        gapless.append(without_gaps(own, key=key, attrs=attrs).unionByName(whole))
    before = gapless[0].toDF("_key", "_from", "_to", *[f"_old_{name}" for name in attrs])
    after = gapless[1]
    meet = (F.col("_key") == F.col("_span_key")) & (F.col("_from") <= F.col("_span_to")) & (F.col("_span_from") <= F.col("_to"))
    same = F.lit(True)
    for name in attrs:
        same &= F.col(f"_old_{name}").eqNullSafe(F.col(name))
    return before.join(after, meet).filter(~same).select(
        F.col("_key").alias(key),
        F.greatest("_from", "_span_from").alias("changed_from"),
        F.least("_to", "_span_to").alias("changed_to"),
    )


def _days(first: datetime, last: datetime) -> set[date]:
    return {first.date() + timedelta(n) for n in range((last.date() - first.date()).days + 1)}


def _on_days(time: Column, days: Sequence[str], reach: int = 0) -> Column:
    """Whether a time is on one of the days, or at most ``reach`` seconds before one."""
    near = F.to_date(time).cast("string").isin(list(days))
    return near | F.to_date(time + seconds(reach)).cast("string").isin(list(days)) if reach else near


class IncrementalReport:
    """Refreshes and reads the state of one store."""

    def __init__(self, store: Store, *, n: int = 3, within: int = 1_200):
        self.store, self.spark = store, store.spark
        self.options = {"n": n, "within": within}
        self.reach = max(HOUR, within)

    def report(self, report_dt: datetime) -> DataFrame:
        """The whole report as of the last refresh."""
        rows = self.store.read_loads(STATE, STATE_DDL).withColumn("report_dt", ntz(report_dt))
        return rows.select(*REPORT_COLUMNS)

    def refresh(self) -> Refresh:
        """Bring the state up to the latest versions of all inputs. Without news nothing is read or written.

        Two refreshes that overlap do not harm: the one that commits later finds its version taken and starts over.
        """
        for _try in range(TRIES):
            try:
                return self._refresh()
            except Overtaken:
                continue
        raise Overtaken(f"{STATE}: overtaken {TRIES} times")

    def _state(self) -> tuple[int, dict[str, int], str | None]:
        row = self.store.commits(STATE).orderBy(F.desc("version")).select("version", "inputs", "attempt").first()
        return (row.version, dict(row.inputs), row.attempt) if row else (0, {}, None)

    def _refresh(self) -> Refresh:
        store = self.store
        version, old, state_attempt = self._state()
        new = {table: store.latest(table)[0] for table in (*FACTS, *(dim.table for dim in HISTORIES))}
        if new == old:
            return Refresh(version)
        attempt = new_attempt()
        terminals = store.history(TERMINALS, new[TERMINALS.table])
        spans = self._spans(new, old, attempt, state_attempt)
        known = store.visible_loads(FACT_TRANSACTIONS, new[FACT_TRANSACTIONS]).select("load", "first", "last").collect()
        known = [row for row in known if row["first"]]
        whole = self._days_of_loads(old.get(FACT_TRANSACTIONS, 0), new[FACT_TRANSACTIONS])
        touched, part = None, set()
        if version and known:
            first, last = min(r["first"] for r in known), max(r["last"] for r in known)
            touched = self._touched(old, new, spans, terminals, state_attempt, attempt, first, last)
            day = F.explode(F.sequence(F.to_date("first"), F.to_date("last")))
            part = {row["day"] for row in touched.select(day.alias("day")).distinct().collect()} - whole
        whole_days, part_days = sorted(map(str, whole)), sorted(map(str, part))
        loads = sorted(
            r["load"] for r in known
            if _days(r["first"], r["last"] + timedelta(seconds=self.reach)) & (whole | part)
        )
        latest = max((r["last"] for r in known), default=None)
        rows = self._hits(new, spans, terminals, touched, whole_days, part_days, loads, latest, first_build=not version)
        written = store.write_loads(STATE, rows.withColumn("load", F.to_date("event_dt").cast("string")), attempt=attempt)
        # A day without hits counts, too: it replaces the hits it had.
        days = sorted({*whole_days, *part_days, *written.loads})
        _, watermark = store.latest(FACT_TRANSACTIONS)
        store.commit(STATE, version + 1, watermark, written.rows, loads=days, attempt=attempt, inputs=new)
        return Refresh(version + 1, tuple(whole_days), tuple(part_days), tuple(loads))

    def _spans(self, new: dict[str, int], old: dict[str, int], attempt: str, state_attempt: str | None) -> DataFrame:
        """The spans of holders, stored: they are read several times here, and once more by the next refresh."""
        store, inputs = self.store, (CARDS.table, ACCOUNTS.table, CLIENTS.table, FACT_BLACKLIST)
        blacklist = store.read_loads(FACT_BLACKLIST, BLACKLIST_DDL, version=new[FACT_BLACKLIST])
        spans = holder_spans(*[store.history(dim, new[dim.table]) for dim in (CARDS, ACCOUNTS, CLIENTS)], blacklist)
        if state_attempt and all(new[table] == old[table] for table in inputs):
            spans = self.spark.read.schema(spans.schema).parquet(store.path(STATE, "spans", f"attempt={state_attempt}"))
        return stage_overwrite(spans, store.path(STATE, "spans", f"attempt={attempt}"))

    def _days_of_loads(self, old: int, new: int) -> set[date]:
        """The days that the events of loads since ``old`` reach: of the new rows, and of those they replace."""
        commits = self.store.commits(FACT_TRANSACTIONS).filter(F.col("version") <= new)
        later = commits.filter(F.col("version") > old)
        unknown = later.filter((F.size("events") == 0) & (F.col("rows_written") > 0))
        if not unknown.isEmpty():
            raise ValueError(f"{FACT_TRANSACTIONS}: loads must be appended with event='trans_date'")
        loads = later.select(F.explode("loads").alias("load")).distinct()
        replaced = self.store.visible_loads(FACT_TRANSACTIONS, old).join(F.broadcast(loads), "load", "left_semi")
        ranges = later.select(F.inline("events")).select("first", "last").union(replaced.select("first", "last"))
        days: set[date] = set()
        for row in ranges.filter("first is not null").distinct().collect():
            days |= _days(row["first"], row["last"] + timedelta(seconds=self.reach))
        return days

    def _touched(
        self, old: dict[str, int], new: dict[str, int], spans: DataFrame, terminals: DataFrame,
        state_attempt: str, attempt: str, first: datetime, last: datetime,
    ) -> DataFrame:
        """(card_num, first, last): the times of cards at which holder or place are other than before, among those with facts."""
        store = self.store
        before = self.spark.read.schema(spans.schema).parquet(store.path(STATE, "spans", f"attempt={state_attempt}"))
        cards = changed_spans(before, spans, key="card_num", attrs=HOLDER_ATTRS)
        cards = cards.select("card_num", F.col("changed_from").alias("first"), F.col("changed_to").alias("last"))
        places = [h.filter("deleted_flg = 'N'") for h in (store.history(TERMINALS, old[TERMINALS.table]), terminals)]
        moved = changed_spans(*places, key=TERMINALS.key, attrs=("terminal_city",))
        moved = stage_overwrite(moved, store.path(STATE, "moved", f"attempt={attempt}"))
        earliest = moved.agg(F.min("changed_from")).first()[0]
        if earliest is not None:
            facts = self._facts(new, F.col("last") >= ntz(max(earliest, first)))
            used = (F.col("terminal") == F.col(TERMINALS.key)) & F.col("trans_date").between(F.col("changed_from"), F.col("changed_to"))
            at = facts.join(moved, used).select(
                "card_num", F.col("trans_date").alias("first"), (F.col("trans_date") + seconds(self.reach)).alias("last")
            )
            cards = cards.union(at.groupBy("card_num", F.to_date("first").alias("_day")).agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("_day"))
        inside = cards.filter("card_num is not null").select(
            "card_num", F.greatest("first", ntz(first)).alias("first"), F.least("last", ntz(last)).alias("last")
        )
        return stage_overwrite(inside.filter("first <= last"), store.path(STATE, "touched", f"attempt={attempt}"))

    def _facts(self, new: dict[str, int], only: Column) -> DataFrame:
        return self.store.read_loads(FACT_TRANSACTIONS, TRANSACTIONS_DDL, only, version=new[FACT_TRANSACTIONS]).drop("load")

    def _hits(
        self, new: dict[str, int], spans: DataFrame, terminals: DataFrame, touched: DataFrame | None,
        whole_days: list[str], part_days: list[str], loads: list[str], latest_event: datetime | None, first_build: bool,
    ) -> DataFrame:
        """The hits of all days that are written anew, with their cards."""
        tx = self._facts(new, F.col("load").isin(loads))
        kept = None
        if not first_build:
            needed = _on_days(F.col("trans_date"), whole_days, self.reach)
            rows = tx.filter(needed)
            if part_days:
                cards = touched.select("card_num").distinct()
                others = tx.filter(~needed & _on_days(F.col("trans_date"), part_days, self.reach))
                rows = rows.union(others.join(cards, "card_num", "left_semi").select(*tx.columns))
                kept = self.store.read_loads(STATE, STATE_DDL, F.col("load").isin(part_days)).drop("load")
                kept = kept.join(cards, "card_num", "left_anti")
            tx = rows
        latest = ntz(latest_event) if latest_event else ntz(BEGINNING)
        hits = report_from_spans(
            tx, terminals, spans, suspects(spans, latest), report_dt="1800-01-01 00:00:00", keep=("card_num",), **self.options
        )
        hits = hits.select(*[name.split()[0] for name in STATE_DDL.split(", ")])
        if not first_build:
            own = _on_days(F.col("event_dt"), whole_days)
            if part_days:
                touched_hits = hits.filter(_on_days(F.col("event_dt"), part_days)).join(
                    touched.select("card_num").distinct(), "card_num", "left_semi"
                )
                hits = hits.filter(own).union(touched_hits.select(*hits.columns)).union(kept.select(*hits.columns))
            else:
                hits = hits.filter(own)
        return hits
