"""Transactions against the passport blacklist, which may repeat a passport."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultline.functions.columns import seconds
from vaultline.schemas import open_end


def blacklist_join(tx: DataFrame, blacklist: DataFrame, *, passport: str, ts: str) -> DataFrame:
    """One row per transaction and earlier entry of its passport; others keep NULL."""
    entries = blacklist.select(
        F.col("passport_num").alias("_entry_passport"), F.col("entry_dt").alias("entry_dt")
    )
    earlier = (tx[passport] == F.col("_entry_passport")) & (F.col("entry_dt") < tx[ts])
    return tx.join(entries, earlier, "left").drop("_entry_passport")


def blacklist_exists(tx: DataFrame, blacklist: DataFrame, *, passport: str) -> DataFrame:
    """Transactions whose passport was ever listed, whatever the date."""
    listed = blacklist.select(F.col("passport_num").alias(passport))
    return tx.join(listed, passport, "left_semi").select(*tx.columns)


def entry_counts(blacklist: DataFrame) -> DataFrame:
    """How many entries a passport has had, as spans of time.

    Entries are counted per passport and time first, so the running sum sees one row
    per distinct entry time, however often it repeats.
    """
    ordered = Window.partitionBy("passport_num").orderBy("entry_dt")
    return (
        blacklist.filter(F.col("passport_num").isNotNull() & F.col("entry_dt").isNotNull())
        .groupBy("passport_num", "entry_dt")
        .agg(F.count(F.lit(1)).alias("_entries"))
        .select(
            "passport_num",
            (F.col("entry_dt") + seconds(1)).alias("listed_from"),
            F.coalesce(F.lead("entry_dt").over(ordered), open_end()).alias("listed_to"),
            F.sum("_entries").over(ordered).alias("entries"),
        )
    )
