"""Watermarks: up to which time each table is loaded."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.functions.columns import whole_second
from vaultline.schemas import (
    ACCOUNTS,
    CARDS,
    CLIENTS,
    FACT_BLACKLIST,
    FACT_TRANSACTIONS,
    FIRST_SNAPSHOT,
    NEVER_LOADED,
    TERMINALS,
    ntz,
)

META_KEY = ("sch_name", "tbl_name")

# Report watermark column -> table whose watermark it remembers.
REPORT_SOURCES = {
    "acc_integrated_dt": ACCOUNTS.table,
    "card_integrated_dt": CARDS.table,
    "client_integrated_dt": CLIENTS.table,
    "passport_bl_integrated_dt": FACT_BLACKLIST,
    "term_integrated_dt": TERMINALS.table,
    "tran_integrated_dt": FACT_TRANSACTIONS,
}


def meta_get(meta: DataFrame, sch_name: str, tbl_name: str) -> DataFrame:
    """One row: the watermark of a table, 1800-01-01 if it was never loaded."""
    return meta.filter(
        (F.col("sch_name") == sch_name) & (F.col("tbl_name") == tbl_name)
    ).agg(F.coalesce(F.max("integrated_dt"), ntz(NEVER_LOADED)).alias("integrated_dt"))


def meta_set(meta: DataFrame, updates: DataFrame) -> DataFrame:
    """Upsert by schema and table. A NULL time keeps the old one, or 1800-01-01 if new."""
    new = updates.select(*META_KEY, F.col("integrated_dt").alias("_new_dt"))
    return meta.join(new, list(META_KEY), "full_outer").select(
        *META_KEY,
        F.coalesce("_new_dt", "integrated_dt", ntz(NEVER_LOADED)).alias("integrated_dt"),
    )


def max_watermark(
    stage: DataFrame, active: DataFrame, current: DataFrame, *, key: str
) -> DataFrame:
    """One row: the latest change among live stage rows, else the current watermark.

    ``current`` is one row with ``integrated_dt``, as ``meta_get`` gives. Deletions do
    not count: their time is the time of the load.
    """
    live = stage.join(active.select(key), key, "left_semi")
    latest = live.agg(F.max(F.coalesce("update_dt", "create_dt")).alias("_latest"))
    return latest.select(
        F.coalesce("_latest", current.select("integrated_dt").scalar(), ntz(NEVER_LOADED)).alias(
            "integrated_dt"
        )
    )


def next_snapshot_dt(meta: DataFrame, sch_name: str, tbl_name: str) -> DataFrame:
    """One row: when the next full snapshot takes effect, 1900-01-01 for the first one."""
    return meta.filter(
        (F.col("sch_name") == sch_name) & (F.col("tbl_name") == tbl_name)
    ).agg(
        F.coalesce(
            whole_second(F.max("integrated_dt")) + F.make_dt_interval(days=F.lit(1)),
            ntz(FIRST_SNAPSHOT),
        ).alias("effective_dt")
    )


def next_snapshot_at(watermark: datetime) -> datetime:
    """The same for a watermark already on the driver."""
    if watermark <= datetime.fromisoformat(NEVER_LOADED):
        return datetime.fromisoformat(FIRST_SNAPSHOT)
    return watermark.replace(microsecond=0) + timedelta(days=1)


def freshness_gate(
    meta: DataFrame, report_meta: DataFrame, sch_name: str, report_name: str
) -> DataFrame:
    """One row ``has_new_data``: 1 if any source of the report moved since, else NULL.

    The six columns of the report's row become rows, joined to the watermarks by table.
    """
    seen = F.array(
        *[
            F.struct(F.lit(table).alias("tbl_name"), F.col(column).alias("seen_dt"))
            for column, table in REPORT_SOURCES.items()
        ]
    )
    report = (
        report_meta.filter((F.col("sch_name") == sch_name) & (F.col("tbl_name") == report_name))
        .select(F.explode(seen).alias("_seen"))
        .select("_seen.*")
    )
    sources = (
        meta.filter(F.col("sch_name") == sch_name)
        .groupBy("tbl_name")
        .agg(F.max("integrated_dt").alias("integrated_dt"))
    )
    newer = F.coalesce("seen_dt", ntz(NEVER_LOADED)) < F.coalesce("integrated_dt", ntz(NEVER_LOADED))
    return report.join(sources, "tbl_name", "left").agg(
        F.max(F.when(newer, 1)).alias("has_new_data")
    )
