"""Delimited text with a header line, no quoting."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

from vaultline.operators.stage import skip_empty_rows


class HeaderError(ValueError):
    """A file lacks an expected column."""


def header_contract(found: Iterable[str], expected: Sequence[str], where: str) -> None:
    """Raise unless every expected column is there. Order and extra columns do not matter."""
    found = list(found)
    missing = [name for name in expected if name not in found]
    if missing:
        raise HeaderError(f"{where}: columns {missing} not in header {found}")


def text_options(sep: str) -> dict[str, object]:
    """How such text is read: quotes and backslashes are ordinary characters, a line with a wrong
    number of cells fails, and so does a file whose header is not that of the others."""
    return {"sep": sep, "header": True, "quote": "", "escape": "", "inferSchema": False, "enforceSchema": False, "mode": "FAILFAST"}


def scan_delimited(
    spark: SparkSession, path: str, columns: Sequence[str], *, sep: str = ";"
) -> DataFrame:
    """The expected columns as text, rows without any value skipped.

    ``path`` is one dated file, or a folder of files with the same header. Quotes and
    backslashes are ordinary characters; a line with a wrong number of cells fails.
    """
    rows = spark.read.options(**text_options(sep)).csv(path)
    header_contract(rows.columns, columns, path)
    return skip_empty_rows(rows).select(*[f"`{name}`" for name in columns])
