"""Table constraints as expectations, counted in one pass over the rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class ConstraintError(ValueError):
    """A batch breaks a constraint of its table."""


def not_null(*names: str) -> dict[str, Column]:
    return {f"{name} not null": F.col(name).isNotNull() for name in names}


def history_rules(key: str) -> dict[str, Column]:
    return {
        **not_null(key, "effective_from", "effective_to", "deleted_flg"),
        "deleted_flg is Y or N": F.col("deleted_flg").isin("Y", "N"),
        "effective_from before effective_to": F.col("effective_from") < F.col("effective_to"),
    }


def stage_rules(key: str) -> dict[str, Column]:
    return {
        **not_null(key),
        "create_dt or update_dt": F.col("create_dt").isNotNull() | F.col("update_dt").isNotNull(),
    }


def violations(rows: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row per rule: ``constraint_name`` and how many rows break it.

    As in SQL, a rule that is NULL for a row is not broken by it.
    """
    counts = rows.agg(
        *[F.count_if(~rule).alias(f"rule_{i}") for i, rule in enumerate(rules.values())]
    )
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("constraint_name"), F.col(f"rule_{i}").alias("violations"))
            for i, name in enumerate(rules)
        ]
    )
    return counts.select(F.explode(pairs).alias("_pair")).select("_pair.*")


def duplicate_keys(rows: DataFrame, *keys: str) -> DataFrame:
    """Keys that break a primary key, with their number of rows."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def enforce(rows: DataFrame, rules: Mapping[str, Column]) -> None:
    """Raise if any row breaks a rule. Only the counts come to the driver."""
    broken = violations(rows, rules).filter("violations > 0").collect()
    if broken:
        details = ", ".join(f"{row.constraint_name}: {row.violations}" for row in broken)
        raise ConstraintError(details)
