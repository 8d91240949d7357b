"""Slowly changing dimensions: close, insert, reopen, delete.

History rows are ``key, tracked..., effective_from, effective_to, deleted_flg``. Stage
rows are ``key, tracked..., create_dt, update_dt``. Parquet has no MERGE, so every step
is a join that yields the next rows, and a load ends in a new snapshot.

``scd2_load`` does a whole load in one pass. The four steps are also there one by one.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.functions.columns import (
    deleted_flag,
    differs,
    explode_present,
    is_current,
    seconds,
)
from vaultline.schemas import VERSION_COLUMNS, ntz, open_end


def changed_at() -> Column:
    """When a stage row took effect. A row that was never updated has its creation time."""
    return F.coalesce("update_dt", "create_dt")


def require_unique(rows: DataFrame, key: str) -> DataFrame:
    """The same rows; the job fails if a key is there twice.

    The check is part of the plan: an aggregate on the key, whose partitioning and order
    the joins on the key go on to use. Repeats meet before the shuffle.
    """
    message = F.concat(F.lit("key twice in the stage: "), F.col(key).cast("string"))
    return (
        rows.groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("_copies"),
            F.first(F.struct(*[name for name in rows.columns if name != key])).alias("_row"),
        )
        .filter(F.when(F.col("_copies") > 1, F.raise_error(message)).otherwise(F.lit(True)))
        .select(key, "_row.*")
    )


def live_keys(active: DataFrame, key: str) -> DataFrame:
    return active.select(key).filter(F.col(key).isNotNull()).distinct()


def active_flag_join(stage: DataFrame, active: DataFrame, *, key: str) -> DataFrame:
    """Stage rows with ``deleted_flg``: 'N' if the key is live, else 'Y'."""
    keys = live_keys(active, key).withColumn("_live", F.lit(True))
    return (
        stage.join(keys, key, "left")
        .withColumn("deleted_flg", deleted_flag(F.col("_live")))
        .select(*stage.columns, "deleted_flg")
    )


def scd2_extract_deleted(
    history: DataFrame,
    active: DataFrame,
    *,
    key: str,
    tracked: Sequence[str],
    as_of: datetime | str,
) -> DataFrame:
    """Current versions whose key is no longer live, shaped like stage rows of ``as_of``."""
    return (
        history.filter(is_current())
        .join(live_keys(active, key), key, "left_anti")
        .select(key, *tracked, ntz(as_of).alias("create_dt"), ntz(as_of).alias("update_dt"))
    )


def scd2_changes(
    history: DataFrame,
    stage: DataFrame,
    active: DataFrame,
    *,
    key: str,
    tracked: Sequence[str],
    as_of: datetime | str,
) -> DataFrame:
    """What a load applies: stage rows of live keys ('N') and deleted keys ('Y')."""
    live = (
        stage.join(live_keys(active, key), key, "left_semi")
        .select(key, *tracked, "create_dt", "update_dt")
        .withColumn("_live", F.lit(True))
    )
    gone = scd2_extract_deleted(history, active, key=key, tracked=tracked, as_of=as_of)
    # No key is in both. Joining them instead of a union keeps the plan free of a union of
    # two sides that are already partitioned by the key: some Spark versions mistake
    # its partitions for those of one side.
    either = live.alias("live").join(gone.alias("gone"), key, "full_outer")

    def pick(name: str) -> Column:
        return F.when(F.col("_live"), F.col(f"live.{name}")).otherwise(F.col(f"gone.{name}")).alias(name)

    return either.select(
        key,
        *[pick(name) for name in (*tracked, "create_dt", "update_dt")],
        F.when(F.col("_live"), F.lit("N")).otherwise(F.lit("Y")).alias("deleted_flg"),
    )


def scd2_close(
    history: DataFrame, changes: DataFrame, *, key: str, tracked: Sequence[str]
) -> DataFrame:
    """All history rows; a current version ends at the change if it is older and differs."""
    return _merge(history, changes, key=key, tracked=tracked, how="left")


def scd2_merge(
    history: DataFrame, changes: DataFrame, *, key: str, tracked: Sequence[str]
) -> DataFrame:
    """Closing and inserting in one: what MERGE would leave, from one join."""
    return _merge(history, changes, key=key, tracked=tracked, how="full_outer")


def _merge(
    history: DataFrame, changes: DataFrame, *, key: str, tracked: Sequence[str], how: str
) -> DataFrame:
    incoming = changes.select(
        F.col(key).alias("_new_key"),
        changed_at().alias("_at"),
        (F.col("deleted_flg") == "Y").alias("_gone"),
        *[F.col(name).alias(f"_new_{name}") for name in tracked],
    )
    old = history.select(key, *tracked, *VERSION_COLUMNS)
    matches = (F.col(key) == F.col("_new_key")) & (F.col("deleted_flg") == "N")
    changed = F.col("_gone") | differs((F.col(name), F.col(f"_new_{name}")) for name in tracked)
    closes = (
        F.col("_at").isNotNull()
        & is_current()
        & (F.col("effective_from") < F.col("_at"))
        & changed
    )
    new = F.col(key).isNull()

    def pick(inserted: Column, kept: Column, name: str) -> Column:
        return F.when(new, inserted).otherwise(kept).alias(name)

    return old.join(incoming, matches, how).select(
        F.coalesce(key, "_new_key").alias(key),
        *[pick(F.col(f"_new_{name}"), F.col(name), name) for name in tracked],
        pick(F.col("_at"), F.col("effective_from"), "effective_from"),
        pick(
            open_end(),
            F.when(closes, F.col("_at")).otherwise(F.col("effective_to")),
            "effective_to",
        ),
        pick(F.lit("N"), F.col("deleted_flg"), "deleted_flg"),
    )


def scd2_insert_new(
    history: DataFrame, changes: DataFrame, *, key: str, tracked: Sequence[str]
) -> DataFrame:
    """First versions: keys that never had a version with flag 'N', open or closed."""
    known = history.filter(F.col("deleted_flg") == "N").select(key)
    return changes.join(known, key, "left_anti").select(
        key,
        *tracked,
        changed_at().alias("effective_from"),
        open_end().alias("effective_to"),
        F.lit("N").alias("deleted_flg"),
    )


def scd2_reopen(
    history: DataFrame, changes: DataFrame, *, key: str, tracked: Sequence[str]
) -> DataFrame:
    """Next versions, one second after the change, for keys without a current version.

    ``history`` is the state after closing and inserting. A deleted key gets a version
    with flag 'Y'.
    """
    current = history.filter(is_current()).select(key)
    return changes.join(current, key, "left_anti").select(
        key,
        *tracked,
        (changed_at() + seconds(1)).alias("effective_from"),
        open_end().alias("effective_to"),
        "deleted_flg",
    )


def scd2_touched(
    current: DataFrame,
    known: DataFrame,
    stage: DataFrame,
    active: DataFrame,
    *,
    key: str,
    tracked: Sequence[str],
    as_of: datetime | str,
) -> DataFrame:
    """The next state of the current versions, with the versions closed or added on the way.

    ``current`` holds the current versions, one per key. ``known`` holds the keys (repeats
    allowed) of the other versions with flag 'N'; it tells a new key from a returning one.

    All inputs are shuffled once, on the key, and every join runs on that partitioning.
    """
    staged = require_unique(
        stage.filter(F.col(key).isNotNull()).select(
            key,
            changed_at().alias("_at"),
            F.lit(True).alias("_staged"),
            *[F.col(name).alias(f"_new_{name}") for name in tracked],
        ),
        key,
    )
    incoming = (
        live_keys(active, key)
        .join(staged, key, "left")
        .join(known.select(key).distinct().withColumn("_known", F.lit(True)), key, "left")
        .withColumnRenamed(key, "_new_key")
    )
    pairs = current.select(key, *tracked, *VERSION_COLUMNS).join(
        incoming, F.col(key) == F.col("_new_key"), "full_outer"
    )

    gone = F.col("_new_key").isNull()
    staged_row = F.coalesce(F.col("_staged"), F.lit(False))
    at = F.when(gone, ntz(as_of)).otherwise(F.col("_at"))
    changed = gone | (
        staged_row & differs((F.col(name), F.col(f"_new_{name}")) for name in tracked)
    )
    had_current = F.col(key).isNotNull()
    closes = F.coalesce(had_current & changed & (F.col("effective_from") < at), F.lit(False))
    added = staged_row & ~had_current

    def version(values: Sequence[Column], start: Column, end: Column, flag: Column) -> Column:
        names = [key, *tracked, *VERSION_COLUMNS]
        return F.struct(
            *[value.alias(name) for name, value in zip(names, [*values, start, end, flag], strict=True)]
        )

    def value(name: str) -> Column:
        return F.when(gone, F.col(name)).otherwise(F.col(f"_new_{name}"))

    kept = version(
        [F.col(name) for name in (key, *tracked)],
        F.col("effective_from"),
        F.when(closes, at).otherwise(F.col("effective_to")),
        F.col("deleted_flg"),
    )
    first = added & F.col("_known").isNull()
    following = version(
        [F.coalesce(key, "_new_key"), *[value(name) for name in tracked]],
        F.when(first, at).otherwise(at + seconds(1)),
        open_end(),
        F.when(gone, F.lit("Y")).otherwise(F.lit("N")),
    )
    return explode_present(
        pairs, "_version", F.when(had_current, kept), F.when(closes | added, following)
    ).select("_version.*")


def scd2_load(
    history: DataFrame,
    stage: DataFrame,
    active: DataFrame,
    *,
    key: str,
    tracked: Sequence[str],
    as_of: datetime | str,
) -> DataFrame:
    """The next history after one load of ``stage`` with ``active`` as the live keys.

    Gives what extracting deletions, closing, inserting and reopening in turn give.
    Versions that are not current pass through untouched.
    """
    settled = history.filter(~is_current()).select(key, *tracked, *VERSION_COLUMNS)
    touched = scd2_touched(
        history.filter(is_current()),
        settled.filter(F.col("deleted_flg") == "N").select(key),
        stage,
        active,
        key=key,
        tracked=tracked,
        as_of=as_of,
    )
    return settled.unionByName(touched)


def merge_match(history: DataFrame, changes: DataFrame, *, key: str) -> DataFrame:
    """Changes with ``matched``: whether the key ever had a version with flag 'N'."""
    known = history.filter(F.col("deleted_flg") == "N").select(key).distinct()
    return changes.join(known.withColumn("_known", F.lit(True)), key, "left").select(
        *changes.columns, F.col("_known").isNotNull().alias("matched")
    )


def deleted_anti_join(history: DataFrame, active: DataFrame, *, key: str) -> DataFrame:
    """Current versions of keys that are no longer live."""
    return history.filter(is_current()).join(live_keys(active, key), key, "left_anti").select(
        *history.columns
    )


def reopen_anti_join(history: DataFrame, stage: DataFrame, *, key: str) -> DataFrame:
    """Stage rows whose key has no current version."""
    current = history.filter(is_current()).select(key)
    return stage.join(current, key, "left_anti").select(*stage.columns)


def live_in_subquery(stage: DataFrame, active: DataFrame, *, key: str) -> DataFrame:
    """Stage rows whose key is live."""
    return stage.join(active.select(key), key, "left_semi").select(*stage.columns)
