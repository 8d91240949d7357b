"""Column expressions shared by the operators. All of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.schemas import BEGINNING, ntz, open_end

SECOND_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def blank_to_null(value: Column | str) -> Column:
    """The source database keeps no empty strings: they are NULL."""
    return F.nullif(_col(value), F.lit(""))


def clean_key(value: Column | str) -> Column:
    """Keys come from blank-padded columns; trim once here, never in a join."""
    return blank_to_null(F.trim(_col(value)))


def full_name(*parts: Column | str) -> Column:
    """Parts joined by single spaces; a missing part is empty, its space stays."""
    pieces: list[Column] = []
    for part in parts:
        if pieces:
            pieces.append(F.lit(" "))
        pieces.append(F.coalesce(_col(part), F.lit("")))
    return F.concat(*pieces)


def decimal_comma(value: Column | str, precision: int = 14, scale: int = 4) -> Column:
    """``'1234,56'`` or ``'1234.56'`` as a decimal; anything else fails the load."""
    return F.replace(_col(value), F.lit(","), F.lit(".")).cast(f"decimal({precision},{scale})")


def parse_second(value: Column | str) -> Column:
    return F.to_timestamp_ntz(_col(value), F.lit(SECOND_FORMAT))


def seconds_since_beginning(value: Column | str) -> Column:
    """Whole seconds since year 1 of a ``timestamp_ntz``: never negative, free of time zones."""
    return (_col(value) - ntz(BEGINNING)).cast("bigint")


def whole_second(value: Column | str) -> Column:
    """Drop the fraction of a second without leaving ``timestamp_ntz``.

    ``date_trunc`` would go through the session time zone and move times that fall
    into a clock change. Counting in whole numbers is also far cheaper than decimals.
    """
    return ntz(BEGINNING) + seconds(1) * seconds_since_beginning(value)


def seconds(count: int) -> Column:
    return F.make_dt_interval(secs=F.lit(count).cast("decimal(18,6)"))


def past_last_day(valid_to: Column | str, ts: Column | str) -> Column:
    """Valid through the whole last day: only a time more than a day later is too late."""
    return _col(valid_to) + F.make_dt_interval(days=F.lit(1)) < _col(ts)


def differs(pairs: Iterable[tuple[Column, Column]]) -> Column:
    """True if any pair differs, where NULL equals only NULL. Never NULL itself."""
    result = F.lit(False)
    for left, right in pairs:
        result = result | ~left.eqNullSafe(right)
    return result


def deleted_flag(live: Column) -> Column:
    return F.when(live.isNotNull(), F.lit("N")).otherwise(F.lit("Y"))


def id_order(name: str) -> Column:
    """A fixed-width number that orders ids: by value if they are numbers, else by hash.

    Extremes by such a number are aggregated on a hash table, those by text only by sorting.
    """
    number = F.col(name).try_cast("decimal(38,0)")
    return F.coalesce(number, F.xxhash64(name).cast("decimal(38,0)"))


def is_current() -> Column:
    """The open, not deleted version of a key. Never NULL, so it can be negated."""
    return F.coalesce(
        (F.col("deleted_flg") == "N") & (F.col("effective_to") == open_end()), F.lit(False)
    )


def explode_present(rows: DataFrame, name: str, *options: Column) -> DataFrame:
    """One row per option that is not NULL, in the new column ``name``.

    Exploding first and filtering then keeps all of it in generated code, which dropping
    the NULLs from the array would not.
    """
    exploded = rows.select("*", F.explode(F.array(*options)).alias(name))
    return exploded.filter(F.col(name).isNotNull())
