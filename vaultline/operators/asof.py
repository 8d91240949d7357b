"""Joins of facts to the dimension version valid at the time of the fact.

A key has at most two new versions per load, so the history side of these joins
has no hot keys. The fact side may: there the join relies on adaptive execution,
which splits the partition of a hot key and reads the matching history rows once per
split. Whether a history is small enough to broadcast is also left to Spark, which
measures it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultline.functions.columns import explode_present, seconds, seconds_since_beginning
from vaultline.schemas import BEGINNING, ntz, open_end


def _renames(columns: Mapping[str, str] | Sequence[str]) -> dict[str, str]:
    return dict(columns) if isinstance(columns, Mapping) else {name: name for name in columns}


def asof_dim_join(
    fact: DataFrame,
    dim: DataFrame,
    *,
    fact_key: str,
    dim_key: str,
    ts: str,
    attrs: Mapping[str, str] | Sequence[str],
    how: str = "left",
) -> DataFrame:
    """Add the attributes of the not deleted version valid at ``ts``.

    Both ends of a version count. A fact without a version keeps NULL attributes.
    ``attrs`` may rename: ``{"valid_to": "account_valid_to"}``.
    """
    versions = dim.filter(F.col("deleted_flg") == "N").select(
        F.col(dim_key).alias("_version_key"),
        F.col("effective_from").alias("_version_from"),
        F.col("effective_to").alias("_version_to"),
        *[F.col(name).alias(alias) for name, alias in _renames(attrs).items()],
    )
    matches = (fact[fact_key] == F.col("_version_key")) & fact[ts].between(
        F.col("_version_from"), F.col("_version_to")
    )
    return fact.join(versions, matches, how).drop("_version_key", "_version_from", "_version_to")


def asof_carried(
    fact: DataFrame,
    dim: DataFrame,
    *,
    fact_key: str,
    dim_key: str,
    ts: str,
    attrs: Mapping[str, str] | Sequence[str],
    slot: int = 86_400,
    rows_of_piece: int = 1_000_000,
) -> DataFrame:
    """What ``asof_dim_join`` gives, for keys with very many versions: no fact is compared with more than one version.

    The not deleted versions of a key must not overlap. Time is cut into slots of ``slot`` seconds. Facts are first counted by key and slot; of
    those, one window per key carries the version that is open when the slot begins. Then the carried version, the
    versions that start inside the slot and the facts are one stream, in which a second window keeps the last version that has started; it
    counts if it has not ended. A slot of a hot key is dealt into pieces of about ``rows_of_piece``
    facts, each with the few versions of the slot, so no window sees more.

    Facts without a key or time keep NULL attributes, as do those without a version. Repeated facts stay; an empty history
    gives NULLs. Columns of facts that begin with ``_asof`` are not allowed.
    """
    names = _renames(attrs)
    at = F.floor(seconds_since_beginning(ts) / F.lit(slot))
    value = F.struct(
        F.col("effective_to").alias("_asof_to"), *[F.col(name).alias(alias) for name, alias in names.items()]
    )
    versions = dim.filter((F.col("deleted_flg") == "N") & F.col(dim_key).isNotNull()).select(
        F.col(dim_key).alias("_asof_key"), F.col("effective_from").alias("_asof_time"), value.alias("_asof_version")
    )
    placed = fact.filter(F.col(fact_key).isNotNull() & F.col(ts).isNotNull()).withColumn("_asof_slot", at)
    slots = placed.groupBy(F.col(fact_key).alias("_asof_key"), "_asof_slot").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(rows_of_piece)).alias("_asof_pieces")
    )

    # Per key: its versions and the beginnings of its slots; a version that starts with a slot is inside it.
    begins = ntz(BEGINNING) + F.make_dt_interval(secs=(F.col("_asof_slot") * slot).cast("decimal(18,6)"))
    marks = slots.withColumn("_asof_time", begins)
    both = versions.unionByName(marks, allowMissingColumns=True)
    order = Window.partitionBy("_asof_key").orderBy("_asof_time", F.col("_asof_slot").isNull())
    last = F.last("_asof_version", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    carried = both.withColumn("_asof_carried", last).filter(F.col("_asof_slot").isNotNull()).select(
        "_asof_key", "_asof_slot", "_asof_pieces", (F.col("_asof_time") - seconds(1)).alias("_asof_time"),
        F.col("_asof_carried").alias("_asof_version"),
    )
    starts = versions.withColumn("_asof_slot", F.floor(seconds_since_beginning("_asof_time") / F.lit(slot)))
    starts = starts.join(slots, ["_asof_key", "_asof_slot"])
    piece = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_asof_pieces") - 1)).alias("_asof_piece")
    opened = carried.filter(F.col("_asof_version").isNotNull()).unionByName(starts.select(*carried.columns))
    opened = opened.select("_asof_key", "_asof_slot", piece, "_asof_time", "_asof_version", F.lit(False).alias("_asof_fact"))

    crowded = slots.filter(F.col("_asof_pieces") > 1).withColumnsRenamed({"_asof_key": "_asof_hot", "_asof_slot": "_asof_in"})
    hot = (F.col(fact_key) == F.col("_asof_hot")) & (F.col("_asof_slot") == F.col("_asof_in"))
    whole = F.struct(*[fact[f"`{name}`"] for name in fact.columns])
    own = F.pmod(F.xxhash64(whole), F.coalesce("_asof_pieces", F.lit(1).cast("bigint")))
    stream = placed.join(crowded, hot, "left").select(
        F.col(fact_key).alias("_asof_key"), "_asof_slot", own.alias("_asof_piece"), F.col(ts).alias("_asof_time"),
        F.lit(True).alias("_asof_fact"), whole.alias("_asof_row"),
    )
    stream = stream.unionByName(opened, allowMissingColumns=True)
    order = Window.partitionBy("_asof_key", "_asof_slot", "_asof_piece").orderBy("_asof_time", "_asof_fact")
    last = F.last("_asof_version", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    found = stream.withColumn("_asof_last", last).filter("_asof_fact")
    valid = F.col("_asof_last._asof_to") >= F.col("_asof_time")
    found = found.select("_asof_row.*", *[F.when(valid, F.col(f"_asof_last.{name}")).alias(name) for name in names.values()])
    nowhere = fact.filter(F.col(fact_key).isNull() | F.col(ts).isNull())
    return found.unionByName(
        nowhere.select("*", *[F.lit(None).cast(found.schema[name].dataType).alias(name) for name in names.values()])
    )


def _span(present: bool, start: Column, end: Column) -> Column:
    return F.struct(
        F.lit(present).alias("present"), start.alias("span_from"), end.alias("span_to")
    )


def without_gaps(
    dim: DataFrame, *, key: str, attrs: Mapping[str, str] | Sequence[str]
) -> DataFrame:
    """The not deleted versions plus rows with NULL attributes for the times between them.

    The spans of a key then cover all time, so an inner match on key and overlap
    never loses any part of the other side.
    """
    names = _renames(attrs)
    ordered = Window.partitionBy("_span_key").orderBy("effective_from", "effective_to")
    versions = (
        dim.filter((F.col("deleted_flg") == "N") & F.col(key).isNotNull())
        .select(
            F.col(key).alias("_span_key"),
            "effective_from",
            "effective_to",
            *[F.col(name).alias(alias) for name, alias in names.items()],
        )
        .select(
            "*",
            F.max("effective_to")
            .over(ordered.rowsBetween(Window.unboundedPreceding, -1))
            .alias("_covered"),
            F.lead("_span_key").over(ordered).isNull().alias("_last"),
        )
    )
    gap_from = F.coalesce(F.col("_covered") + seconds(1), ntz(BEGINNING))
    reach = F.greatest(F.col("_covered"), F.col("effective_to"))
    before = F.when(
        gap_from < F.col("effective_from"),
        _span(False, gap_from, F.col("effective_from") - seconds(1)),
    )
    itself = _span(True, F.col("effective_from"), F.col("effective_to"))
    after = F.when(
        F.col("_last") & (reach < open_end()), _span(False, reach + seconds(1), open_end())
    )
    return explode_present(versions, "_span", before, itself, after).select(
        "_span_key",
        F.col("_span.span_from").alias("_span_from"),
        F.col("_span.span_to").alias("_span_to"),
        *[F.when(F.col("_span.present"), F.col(name)).alias(name) for name in names.values()],
    )


def overlay(
    base: DataFrame,
    dim: DataFrame,
    *,
    base_key: str,
    dim_key: str,
    attrs: Mapping[str, str] | Sequence[str],
) -> DataFrame:
    """Cut the spans of ``base`` where the versions of ``dim`` change and add ``attrs``.

    Looking up ``base`` at some time and then ``dim`` at the same time gives what one
    lookup in the result gives. So a chain of dimensions is joined among themselves,
    at the size of the dimensions, and the facts are joined (and shuffled) only once.
    """
    spans = without_gaps(dim, key=dim_key, attrs=attrs)
    overlap = (
        (base[base_key] == F.col("_span_key"))
        & (base["effective_from"] <= F.col("_span_to"))
        & (F.col("_span_from") <= base["effective_to"])
    )
    kept = [name for name in base.columns if name not in ("effective_from", "effective_to")]
    return base.join(spans, overlap, "left").select(
        *kept,
        F.greatest("effective_from", "_span_from").alias("effective_from"),
        F.least("effective_to", "_span_to").alias("effective_to"),
        *_renames(attrs).values(),
    )
