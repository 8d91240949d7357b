"""Daily drops: files, or folders of part files, whose name holds the date."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.schemas import INITIAL_BEFORE, ntz
from vaultline.session import any_match

NAME_DATE_FORMAT = "ddMMyyyy"


def list_dated_files(spark: SparkSession, folder: str, prefix: str, suffix: str) -> DataFrame:
    """Drops named ``<prefix>DDMMYYYY<suffix>``: path, name and date. Contents are not read.

    A folder without such drops gives no rows; a missing folder fails. A name that matches but
    holds no date fails, so a misnamed drop is not lost.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    some = any_match(spark, f"{folder}/*{prefix}*{suffix}")
    found = files.load(f"{folder}/*{prefix}*{suffix}") if some else files.load(folder).filter(F.lit(False))
    return dated_names(found.select("path"), prefix, suffix)


def dated_names(paths: DataFrame, prefix: str, suffix: str) -> DataFrame:
    name = f"{re.escape(prefix)}[^/]*{re.escape(suffix)}"
    date = f"{re.escape(prefix)}([^/]*){re.escape(suffix)}"
    return (
        paths.select(F.regexp_extract("path", f"^(.*?{name})(/.*)?$", 1).alias("path"))
        .distinct()
        .select(
            "path",
            F.regexp_extract("path", f"({name})$", 1).alias("file_name"),
            F.to_timestamp_ntz(
                F.regexp_extract("path", f"{date}$", 1), F.lit(NAME_DATE_FORMAT)
            ).alias("file_dt"),
        )
    )


def earliest_file(files: DataFrame) -> DataFrame:
    """At most one row: the drop with the smallest date."""
    return files.agg(
        F.min_by(F.struct("path", "file_name", "file_dt"), "file_dt").alias("_file")
    ).filter(F.col("_file").isNotNull()).select("_file.*")


def pick_next_file(files: DataFrame, watermark: DataFrame) -> DataFrame:
    """At most one row: the drop of the day after the watermark, or the earliest one if
    nothing was loaded yet. A missing day blocks the days after it.

    ``watermark`` is one row with ``integrated_dt``.
    """
    last = watermark.select("integrated_dt").scalar()
    next_day = last + F.make_dt_interval(days=F.lit(1))
    return earliest_file(files.filter((last < ntz(INITIAL_BEFORE)) | (F.col("file_dt") == next_day)))


def next_file(files: DataFrame, watermark: datetime):
    """The same for a watermark on the driver; the row itself or None."""
    one = files.sparkSession.range(1).select(ntz(watermark).alias("integrated_dt"))
    return pick_next_file(files, one).first()


def file_ledger(files: DataFrame, loaded: DataFrame) -> DataFrame:
    """Drops that are not in the ledger of loaded ones, so nothing is loaded twice."""
    return files.join(loaded.select("file_name"), "file_name", "left_anti").select(*files.columns)
