"""Source tables of the bank: increments since a watermark, and the live keys."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.functions.columns import clean_key
from vaultline.schemas import ntz


def jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    split_by: str | None = None,
    lower: str | None = None,
    upper: str | None = None,
    splits: int = 1,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A database table. With ``split_by``, that many tasks read ranges of that column.

    Credentials and driver come from the caller in ``options``. Filters and column
    selections on the result are pushed to the database.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    reader = reader.option("preferTimestampNTZ", "true").option("fetchsize", "10000")
    if split_by:
        reader = (
            reader.option("partitionColumn", split_by)
            .option("lowerBound", str(lower))
            .option("upperBound", str(upper))
            .option("numPartitions", str(splits))
        )
    for name, value in (options or {}).items():
        reader = reader.option(name, value)
    return reader.load()


def src_incremental(
    source: DataFrame,
    watermark: datetime | str,
    *,
    created: str = "create_dt",
    updated: str = "update_dt",
) -> DataFrame:
    """Rows created or updated after the watermark. The filter reaches the scan.

    Source times have whole seconds, so the fraction of the watermark is dropped.
    """
    if isinstance(watermark, str):
        watermark = datetime.fromisoformat(watermark)
    bound = ntz(watermark.replace(microsecond=0))
    return source.filter((F.col(created) > bound) | (F.col(updated) > bound))


def src_active_keys(source: DataFrame, key: str, alias: str | None = None) -> DataFrame:
    """The distinct keys that exist now; reads the key column only."""
    return source.select(F.col(key).alias(alias or key)).distinct()


def staged_keys(source: DataFrame, key: str, alias: str) -> DataFrame:
    """The live keys as the stage keeps them: trimmed, distinct, no NULL."""
    return (
        source.select(clean_key(F.col(key).cast("string")).alias(alias))
        .filter(F.col(alias).isNotNull())
        .distinct()
    )
