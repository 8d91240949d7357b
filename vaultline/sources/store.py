"""Warehouse tables as Parquet folders.

Every load writes a folder of its own attempt, which no other load ever writes to, and becomes visible with its commit: a small
file, named by the next version, that is created only if the name is free. It names the folder and
also holds the new watermark, so both change at once. Of two loads that overlap one gets the
version; the other finds it taken. A load of a fact or a report then takes the next version, as it does not depend on the one before; a load of a
history was computed from a state that is no longer the latest, so it fails with :class:`Overtaken` and must be
done again. A load that dies leaves a folder without a commit, which readers ignore and :meth:`Store.vacuum` removes.

A history is kept as versions: the current rows are written anew by each load, the
settled rows (closed or deleted) are only ever added to. Both are partitions, so reading
a version prunes the rest. The files are bucketed by key, so a load shuffles the stage but neither the current rows nor the keys of
the settled ones. :meth:`Store.compact_history` writes all rows as one version, from which later ones count.

Facts and reports are kept by load: the day of a file, the time of a report. Of a load that
was done again the latest committed version counts, also if it is empty.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from vaultline.functions.columns import is_current
from vaultline.operators.checks import ConstraintError, history_rules
from vaultline.operators.scd2 import scd2_touched
from vaultline.schemas import NEVER_LOADED, REPORT_DDL, Dimension
from vaultline.session import create_once, exists, remove_older

COMMITS_DDL = (
    "sch_name string, tbl_name string, integrated_dt timestamp_ntz, rows_written bigint, "
    "file_name string, files array<string>, loads array<string>, version int, attempt string, base int, "
    "events array<struct<load:string,first:timestamp_ntz,last:timestamp_ntz>>, inputs map<string,int>"
)
# How often a load that meets others is tried.
TRIES = 20


class Overtaken(RuntimeError):
    """Another load has committed first; this one must be done again from the new state."""


class Written(NamedTuple):
    """Rows of a load that are written but not yet visible."""

    attempt: str
    rows: int
    loads: list[str]
    # Per load the earliest and latest time of its events, if they were asked for.
    events: list[tuple[str, str, str]]


class Loaded(NamedTuple):
    """The next version of a history, written but not yet visible, and the version its settled rows count from."""

    version: int
    rows: int
    attempt: str
    base: int


def new_attempt() -> str:
    return f"a{uuid.uuid4().hex}"


def stage_overwrite(rows: DataFrame, path: str) -> DataFrame:
    """Replace a stage table and read it back."""
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _read_or_empty(spark: SparkSession, ddl: str, path: str) -> DataFrame:
    if exists(spark, path):
        return spark.read.schema(ddl).parquet(path)
    return spark.createDataFrame([], ddl)


class Store:
    """The tables of a warehouse below one folder."""

    def __init__(self, spark: SparkSession, root: str, sch_name: str = "bank"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.sch_name = sch_name

    def path(self, table: str, *parts: str) -> str:
        return "/".join([self.root, table, *parts])

    # commits and watermarks

    def commits(self, table: str) -> DataFrame:
        """One row per load of the table."""
        path = self.path(table, "commits")
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], COMMITS_DDL)
        return self.spark.read.schema(COMMITS_DDL).json(path)

    def meta(self, *tables: str) -> DataFrame:
        """The watermark table: schema, table and time of the latest load."""
        frames = [self.commits(table) for table in tables]
        rows = frames[0]
        for frame in frames[1:]:
            rows = rows.unionByName(frame)
        return rows.groupBy("sch_name", "tbl_name").agg(
            F.max_by("integrated_dt", "version").alias("integrated_dt")
        )

    def latest(self, table: str) -> tuple[int, datetime]:
        """Version and watermark of the latest load; 0 and 1800-01-01 before the first."""
        row = self.commits(table).agg(
            F.max("version").alias("version"),
            F.max_by("integrated_dt", "version").alias("integrated_dt"),
        ).first()
        if row.version is None:
            return 0, datetime.fromisoformat(NEVER_LOADED)
        return row.version, row.integrated_dt

    def commit(
        self,
        table: str,
        version: int,
        watermark: datetime,
        rows_written: int,
        file_name: str | None = None,
        loads: Sequence[str] = (),
        *,
        files: Sequence[str] = (),
        attempt: str | None = None,
        base: int = 1,
        events: Sequence[tuple[str, str, str]] = (),
        inputs: Mapping[str, int] | None = None,
    ) -> None:
        """Make the rows of an attempt visible as a version. Fails if another load has taken that number."""
        row = {
            "sch_name": self.sch_name,
            "tbl_name": table,
            "integrated_dt": f"{watermark:%Y-%m-%dT%H:%M:%S.%f}",
            "rows_written": rows_written,
            "file_name": file_name,
            "files": list(files),
            "loads": list(loads),
            "version": version,
            "attempt": attempt,
            "base": base,
            "events": [dict(zip(("load", "first", "last"), event, strict=True)) for event in events],
            "inputs": dict(inputs or {}),
        }
        if not create_once(self.spark, self.path(table, "commits", f"{version:010d}.json"), json.dumps(row) + "\n"):
            raise Overtaken(f"{table}: version {version} is taken")

    def _commit_next(
        self, table: str, written: Written, watermark: datetime | None, file_name: str | None = None
    ) -> int:
        """Commit rows that do not depend on earlier ones, under the next version that is free."""
        for _try in range(TRIES):
            version, latest = self.latest(table)
            if file_name and not self.commits(table).filter(F.col("file_name") == file_name).isEmpty() and _try:
                raise Overtaken(f"{table}: {file_name} has been loaded meanwhile")
            try:
                self.commit(
                    table, version + 1, max(latest, watermark or latest), written.rows, file_name, written.loads,
                    attempt=written.attempt, events=written.events,
                )
            except Overtaken:
                continue
            return version + 1
        raise Overtaken(f"{table}: no free version in {TRIES} tries")

    def loaded_files(self, table: str) -> DataFrame:
        """The ledger: ``file_name`` of each file that a commit names."""
        commits = self.commits(table)
        return (
            commits.select("file_name").filter(F.col("file_name").isNotNull())
            .unionByName(commits.select(F.explode("files").alias("file_name")))
            .distinct()
        )

    def commit_files(self, table: str, written: Written, watermark: datetime, files: Sequence[str]) -> int:
        """Commit rows of some files under the next free version, unless another commit names one of the files: then :class:`Overtaken`."""
        for _try in range(TRIES):
            version, latest = self.latest(table)
            if not self.loaded_files(table).filter(F.col("file_name").isin(list(files))).isEmpty():
                raise Overtaken(f"{table}: some of {len(files)} files have been loaded meanwhile")
            try:
                self.commit(
                    table, version + 1, max(latest, watermark), written.rows, loads=written.loads, files=files,
                    attempt=written.attempt, events=written.events,
                )
            except Overtaken:
                continue
            return version + 1
        raise Overtaken(f"{table}: no free version in {TRIES} tries")

    def vacuum(self, table: str, before: datetime) -> list[str]:
        """Remove what attempts have written that no commit names, if it was not changed since ``before``.

        Loads that are still running must have begun later. Gives the names of the folders.
        """
        kept = {f"attempt={row.attempt}" for row in self.commits(table).select("attempt").collect()}
        return [
            name
            for part in ("rows", "stages", "spans", "moved", "touched")
            for name in remove_older(self.spark, self.path(table, part), kept, before)
        ]

    # facts and reports

    def write_loads(
        self,
        table: str,
        rows: DataFrame,
        load: str | None = None,
        event: str | None = None,
        attempt: str | None = None,
    ) -> Written:
        """Write rows of a fact or report: one load, or several by the column ``load``.

        Not visible before a commit. ``event`` names a time column whose range per load
        the commit shall hold. Several loads are first brought together by load, so no task writes a small file
        for each; Spark splits a load that is too large for one task.
        """
        attempt = attempt or new_attempt()
        rows = rows.hint("rebalance", "load") if load is None else rows.withColumn("load", F.lit(load))
        path = self.path(table, "rows", f"attempt={attempt}")
        seen = Observation()
        range_of = [F.min(event).cast("string"), F.max(event).cast("string")] if event else [F.lit(None), F.lit(None)]
        counted = [F.count(F.lit(1)).alias("rows")]
        if load is not None and event:
            counted += [range_of[0].alias("first"), range_of[1].alias("last")]
        rows.observe(seen, *counted).write.partitionBy("load").parquet(path)
        loads, events, counts = [load], [], seen.get
        if load is None:
            written = self.spark.read.schema(rows.schema).parquet(path)
            found = written.groupBy("load").agg(range_of[0].alias("first"), range_of[1].alias("last")).collect()
            loads = sorted(row["load"] for row in found)
            events = sorted(tuple(row) for row in found if row["first"])
        elif counts.get("first"):
            events = [(load, counts["first"], counts["last"])]
        return Written(attempt, counts["rows"], loads, events)

    def visible_loads(self, table: str, version: int | None = None) -> DataFrame:
        """(load, attempt, version, first, last) of each load: its latest committed version, or the latest up to ``version``."""
        commits = self.commits(table)
        commits = commits if version is None else commits.filter(F.col("version") <= version)
        loads = commits.select("version", "attempt", "events", F.explode("loads").alias("load"))
        latest = loads.groupBy("load").agg(
            F.max("version").alias("version"), F.max_by(F.struct("attempt", "events"), "version").alias("_of")
        )
        event = F.get(F.filter("_of.events", lambda e: e["load"] == F.col("load")), 0)
        return latest.select(
            "load", "_of.attempt", "version", event["first"].alias("first"), event["last"].alias("last")
        )

    def latest_event(self, table: str) -> datetime | None:
        """The latest time of all events that can be read, from the commits; None if they do not hold it for every load."""
        unknown = self.commits(table).filter((F.size("events") == 0) & (F.col("rows_written") > 0))
        return self.visible_loads(table).agg(F.max("last")).first()[0] if unknown.isEmpty() else None

    def read_loads(
        self, table: str, ddl: str, only: Column | None = None, version: int | None = None
    ) -> DataFrame:
        """The rows of the latest committed version of each load, with their ``load``; of some loads by a condition on
        the columns of :meth:`visible_loads`."""
        visible = self.visible_loads(table, version)
        visible = (visible if only is None else visible.filter(only)).select("attempt", "load")
        rows = _read_or_empty(self.spark, f"{ddl}, attempt string, load string", self.path(table, "rows"))
        return rows.join(visible, ["attempt", "load"], "left_semi").drop("attempt")

    def append_fact(
        self,
        table: str,
        rows: DataFrame,
        *,
        load_date: datetime | None = None,
        watermark: datetime | None = None,
        file_name: str | None = None,
        event: str | None = None,
    ) -> int:
        """Add the rows of a day, or of several with the column ``load_date``, and commit them.

        A day that was loaded before is replaced, by nothing if there are no rows. A file that another load has committed since this one
        began makes it fail with :class:`Overtaken`.
        """
        if load_date is None:
            load, rows = None, rows.withColumn("load", F.col("load_date").cast("string")).drop("load_date")
        else:
            load = f"{load_date:%Y-%m-%d}"
        written = self.write_loads(table, rows, load, event)
        self._commit_next(table, written, watermark or load_date, file_name)
        return written.rows

    def read_fact(self, table: str, ddl: str) -> DataFrame:
        rows = self.read_loads(table, ddl)
        return rows.withColumn("load_date", F.col("load").cast("date")).drop("load")

    def write_report(self, table: str, report: DataFrame, report_dt: datetime) -> int:
        """Write and commit the report of a time; one built again for it replaces the earlier one."""
        written = self.write_loads(table, report, f"{report_dt:%Y-%m-%d %H:%M:%S.%f}")
        self._commit_next(table, written, report_dt)
        return written.rows

    def read_report(self, table: str) -> DataFrame:
        return self.read_loads(table, REPORT_DDL).drop("load")

    # histories

    def history(self, dim: Dimension, version: int | None = None) -> DataFrame:
        """The history as of a version, the latest one by default."""
        if version is None:
            version, _ = self.latest(dim.table)
        return self._rows(dim, version)[0].select(*dim.columns)

    def _table(self, dim: Dimension) -> str:
        """The catalogue's name of the history's files, bucketed by key; made where the catalogue does not know it yet."""
        path = self.path(dim.table, "rows")
        name = f"history_{hashlib.sha256(path.encode()).hexdigest()[:32]}"
        buckets = self._buckets(dim)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({dim.history_ddl}, attempt STRING, part STRING) USING parquet "
            f"PARTITIONED BY (attempt, part) CLUSTERED BY ({dim.key}) SORTED BY ({dim.key}) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
        return name

    def _buckets(self, dim: Dimension) -> int:
        """The number of buckets of a history: fixed when it is first written, in a file that is created once."""
        path = self.path(dim.table, "buckets", "number.json")
        own = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        if create_once(self.spark, path, json.dumps({"buckets": own}) + "\n"):
            return own
        return self.spark.read.schema("buckets int").json(path).first().buckets

    def _rows(self, dim: Dimension, version: int) -> tuple[DataFrame, int]:
        """The rows of a version, with their part, and the version they count from. The filter is on partitions only.

        The driver sees one row per load since the history was compacted.
        """
        commits = self.commits(dim.table)
        base = F.lit(commits.filter(F.col("version") == version).agg(F.max("base")).first()[0] or 1)
        of = commits.filter(F.col("version").between(base, F.lit(version))).select("version", "attempt", "base").collect()
        parts = [(row.attempt, "settled") for row in of] + [(row.attempt, "current") for row in of if row.version == version]
        there = [(a, p) for a, p in parts if exists(self.spark, self.path(dim.table, "rows", f"attempt={a}", f"part={p}"))]
        if not there:
            return self.spark.createDataFrame([], f"{dim.history_ddl}, part string"), 1
        name = self._table(dim)
        added = " ".join(f"PARTITION (attempt = '{a}', part = '{p}')" for a, p in there)
        self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {added}")
        settled = F.col("attempt").isin([a for a, p in there if p == "settled"]) & (F.col("part") == "settled")
        current = F.col("attempt").isin([a for a, p in there if p == "current"]) & (F.col("part") == "current")
        return self.spark.table(name).filter(current | settled), next((r.base for r in of if r.version == version), 1)

    def _write_history(self, dim: Dimension, rows: DataFrame, *, whole: bool = False) -> tuple[str, int]:
        """Write rows by part and bucket under a new attempt. The constraints of a history are counted as its rows are
        written; one that is broken fails the load.

        Of a ``whole`` history each version is also held against the one before it of its key: a version that is there twice or
        begins before the other has ended is counted. The same shuffle brings the rows together by key. A load needs no
        such test: its stage has each key once, and it adds a version only behind the one that it closes.
        """
        attempt, seen = new_attempt(), Observation()
        rules = history_rules(dim.key)
        if whole:
            ordered = Window.partitionBy(dim.key).orderBy("effective_from", "effective_to")
            rows = rows.withColumn("_ended", F.lag("effective_to").over(ordered))
            rules[f"versions of {dim.key} apart"] = F.col("_ended") < F.col("effective_from")
        counted = rows.observe(
            seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(~rule).alias(name) for name, rule in rules.items()]
        )
        part = F.when(is_current(), F.lit("current")).otherwise(F.lit("settled"))
        counted.select(*dim.columns, F.lit(attempt).alias("attempt"), part.alias("part")).write.insertInto(self._table(dim))
        counts = seen.get
        rows_written = counts.pop("rows")
        if broken := [f"{name}: {n}" for name, n in counts.items() if n]:
            raise ConstraintError(", ".join(broken))
        return attempt, rows_written

    def load_history(
        self, dim: Dimension, stage: DataFrame, active: DataFrame, *, as_of: datetime | str
    ) -> Loaded:
        """Write the next version of a history. Not visible before :meth:`commit_history`.

        Reads the current rows, and of the settled rows only the keys.
        """
        version, _ = self.latest(dim.table)
        rows, base = self._rows(dim, version)
        touched = scd2_touched(
            rows.filter(F.col("part") == "current"),
            rows.filter((F.col("part") == "settled") & (F.col("deleted_flg") == "N")).select(dim.key),
            stage,
            active,
            key=dim.key,
            tracked=dim.tracked,
            as_of=as_of,
        )
        attempt, rows_written = self._write_history(dim, touched)
        return Loaded(version + 1, rows_written, attempt, base)

    def commit_history(
        self, dim: Dimension, loaded: Loaded, watermark: datetime, file_name: str | None = None
    ) -> None:
        """Make a version visible, unless another load has committed since it was computed: then :class:`Overtaken`."""
        self.commit(
            dim.table, loaded.version, watermark, loaded.rows, file_name, attempt=loaded.attempt, base=loaded.base
        )

    def import_history(self, dim: Dimension, rows: DataFrame, watermark: datetime) -> int:
        """Commit a whole history, as it is, as the next version. It replaces what was there."""
        version, _ = self.latest(dim.table)
        attempt, count = self._write_history(dim, rows.select(*dim.columns), whole=True)
        self.commit_history(dim, Loaded(version + 1, count, attempt, version + 1), watermark)
        return count

    def compact_history(self, dim: Dimension) -> int:
        """Write the latest state as one version, brought together by key, so that later versions read its files alone.

        The rows stay the same, and so do older versions. A load that commits meanwhile makes this fail with :class:`Overtaken`.
        """
        version, watermark = self.latest(dim.table)
        attempt, count = self._write_history(dim, self.history(dim, version), whole=True)
        self.commit_history(dim, Loaded(version + 1, count, attempt, version + 1), watermark)
        return count

    def loads_since_compaction(self, dim: Dimension) -> int:
        """How many versions the latest one is read from."""
        row = self.commits(dim.table).agg(F.max_by(F.col("version") - F.col("base"), "version").alias("n")).first()
        return row.n or 0
