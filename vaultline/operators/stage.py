"""Typing and cleaning at the stage boundary. After it, no blank, padding or fraction
of a second is left, so no later join has to trim or round."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.functions.columns import (
    blank_to_null,
    clean_key,
    decimal_comma,
    parse_second,
    whole_second,
)
from vaultline.schemas import Dimension, ntz

# Columns that hold keys, whatever the table: they come from blank-padded types.
PADDED = ("account_num", "card_num", "client", "client_id", "terminal_id")


def skip_empty_rows(rows: DataFrame) -> DataFrame:
    """Drop rows without any value: every cell is NULL, empty or a numeric zero."""
    filled = F.lit(False)
    for field in rows.schema.fields:
        cell = F.col(f"`{field.name}`")
        if field.dataType.typeName() == "string":
            filled = filled | F.coalesce(cell != "", F.lit(False))
        elif hasattr(field.dataType, "precision") or field.dataType.typeName() in (
            "byte", "short", "integer", "long", "float", "double",
        ):
            filled = filled | F.coalesce(cell != 0, F.lit(False))
        else:
            filled = filled | cell.isNotNull()
    return rows.filter(filled)


def file_batch_rows(
    rows: DataFrame, *, valid: Column | None = None, converted: Mapping[str, Column] | None = None
) -> DataFrame:
    """The rows of a file on their way to the stage: blank ones skipped, then only those for which
    ``valid`` holds, then the ``converted`` columns by name (all as they are by default)."""
    kept = skip_empty_rows(rows)
    if valid is not None:
        kept = kept.filter(valid)
    return kept if converted is None else kept.select(*[value.alias(name) for name, value in converted.items()])


def _typed(name: str, target: str, source: Column, source_type: str) -> Column:
    if target == "timestamp_ntz":
        value = parse_second(source) if source_type == "string" else whole_second(source.cast(target))
    elif target == "string":
        value = clean_key(source.cast(target)) if name in PADDED else blank_to_null(source.cast(target))
    else:
        value = source.cast(target)
    return value.alias(name)


def stage_dimension(source: DataFrame, dim: Dimension) -> DataFrame:
    """A source extract as stage rows: warehouse names and types, dates where it has them."""
    types = dict(source.dtypes)
    columns = [part.strip().split(" ", 1) for part in dim.ddl.split(", ")]
    dates = [name for name in ("create_dt", "update_dt") if name in types]
    typed = []
    for name, target in [*columns, *[(date, "timestamp_ntz") for date in dates]]:
        source_name = dim.source_name(name)
        typed.append(_typed(name, target, F.col(source_name), types[source_name]))
    return source.select(*typed)


def stage_snapshot(rows: DataFrame, dim: Dimension, effective: datetime | str) -> DataFrame:
    """A full snapshot without dates of its own: everything changed at ``effective``."""
    return stage_dimension(rows, dim).select(
        "*", ntz(effective).alias("create_dt"), ntz(effective).alias("update_dt")
    )


def stage_transactions(rows: DataFrame, *kept: Column | str) -> DataFrame:
    """Text cells of a transaction file as fact columns, with the ``kept`` columns as they are."""
    return rows.select(
        blank_to_null("transaction_id").alias("trans_id"),
        parse_second("transaction_date").alias("trans_date"),
        clean_key("card_num").alias("card_num"),
        blank_to_null("oper_type").alias("oper_type"),
        decimal_comma("amount").alias("amt"),
        blank_to_null("oper_result").alias("oper_result"),
        clean_key("terminal").alias("terminal"),
        *kept,
    )


def blacklist_recent_filter(rows: DataFrame, file_dt: datetime | str, *, date: str = "date") -> DataFrame:
    """Blacklist files repeat older entries; keep those dated on or after the file's date."""
    return rows.filter(F.col(date) >= ntz(file_dt))


def stage_blacklist(rows: DataFrame, file_dt: datetime | str) -> DataFrame:
    return blacklist_recent_filter(rows, file_dt).select(
        blank_to_null("passport").alias("passport_num"), whole_second("date").alias("entry_dt")
    )
