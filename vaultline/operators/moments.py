"""Patterns in the order of one card's operations.

One card may hold a large part of all rows, so a window over the raw rows of a card is
no option. Both patterns only look a fixed time back and only need a few values per
moment (distinct time of a card). So:

1. rows are aggregated to one row per card and moment, before the shuffle;
2. moments are cut into slots of time, each slot also receiving the moments of the
   slot before it that are still in reach;
3. windows run per card and slot, which holds at most one row per second.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from vaultline.functions.columns import explode_present, id_order, seconds, seconds_since_beginning
from vaultline.schemas import ACCEPTED, REJECTED, SPENDING_TYPES

DAY = 86_400
HOUR = 3_600
MINUTE = 60


def in_slots(rows: DataFrame, *, ts: str, reach: int, width: int = DAY) -> DataFrame:
    """Give each row its slot (``_slot``), and a copy for the next one if within reach.

    ``_home`` is false for the copies.
    """
    width = max(width, reach)
    slot = F.floor(seconds_since_beginning(ts) / F.lit(width))
    late = seconds_since_beginning(ts) >= (slot + 1) * width - reach
    return explode_present(rows, "_slot", slot, F.when(late, slot + 1)).withColumn(
        "_home", F.col("_slot") == slot
    )


def _slot_window(key: str, ts: str) -> WindowSpec:
    return Window.partitionBy(key, "_slot").orderBy(ts)


def place_facts(place: Column | str) -> list[Column]:
    """Per moment: the extreme places (equal if there is one) and the rows with a place."""
    return [
        F.min(place).alias("_low_place"),
        F.max(place).alias("_high_place"),
        F.count(place).alias("_placed"),
    ]


def attempt_facts(
    *,
    tie: str,
    amount: str,
    oper_type: str,
    oper_result: str,
    types: Sequence[str] = SPENDING_TYPES,
) -> list[Column]:
    """Per moment: the number of operations and the first and last one.

    ``tie`` is the id that orders operations of the same moment (see ``id_order``). Rejected and
    accepted count only for the given operation types.
    """
    order = id_order(tie)
    counted = F.col(oper_type).isin(*types)
    accepted = F.coalesce(counted & (F.col(oper_result) == ACCEPTED), F.lit(False))
    rejected = F.coalesce(counted & (F.col(oper_result) == REJECTED), F.lit(False))
    return [
        F.count(F.lit(1)).alias("_operations"),
        F.min(order).alias("_first_tie"),
        F.min_by(accepted, order).alias("_first_accepted"),
        F.min_by(amount, order).alias("_first_amount"),
        F.max_by(rejected, order).alias("_last_rejected"),
        F.max_by(amount, order).alias("_last_amount"),
    ]


def with_two_places(moments: DataFrame, *, key: str, ts: str, within: int = HOUR) -> DataFrame:
    """Add ``two_places``: another place was used at, or at most ``within`` before, the moment.

    Instead of comparing all moments of a frame, carry forward the time of the last
    moment that differs from the current run of equal places: one pass per slot.
    """
    ordered = _slot_window(key, ts)
    low, high = F.col("_low_place"), F.col("_high_place")
    before = F.last(
        F.when(low.isNotNull(), F.struct(low.alias("low"), high.alias("high"), F.col(ts).alias("at"))),
        ignorenulls=True,
    ).over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    run_starts = low.isNotNull() & (
        (F.col("_before.low") != F.col("_before.high")) | (F.col("_before.low") != low)
    )
    other_at = F.last(F.when(run_starts, F.col("_before.at")), ignorenulls=True).over(
        ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    near = (low != high) | (F.col("_other_at") >= F.col(ts) - seconds(within))
    return moments.select("*", before.alias("_before")).select("*", other_at.alias("_other_at")).select(
        *moments.columns,
        F.coalesce(F.col(key).isNotNull() & low.isNotNull() & near, F.lit(False)).alias("two_places"),
    )


def with_decreasing_chain(
    moments: DataFrame, *, key: str, ts: str, n: int = 3, within: int = 1_200
) -> DataFrame:
    """Add ``chain_end``: an accepted operation right after ``n`` rejected ones, with falling
    amounts, rising times and all of it inside ``within``.

    Times must rise strictly, so the operation must be the first of its moment, those in
    the middle the only ones of theirs and the first attempt the last of its own.
    """
    ordered = _slot_window(key, ts)
    earlier = F.struct(
        F.col(ts).alias("at"),
        F.col("_operations").alias("operations"),
        F.col("_last_rejected").alias("rejected"),
        F.col("_last_amount").alias("amount"),
    )
    attempts = [F.lag(earlier, back).over(ordered).alias(f"_back_{back}") for back in range(1, n + 1)]
    tests = [F.col("_first_accepted"), F.col(f"_back_{n}.at") >= F.col(ts) - seconds(within)]
    later_amount = F.col("_first_amount")
    for back in range(1, n + 1):
        tests.append(F.col(f"_back_{back}.rejected"))
        tests.append(F.col(f"_back_{back}.amount") > later_amount)
        later_amount = F.col(f"_back_{back}.amount")
        if back < n:
            tests.append(F.col(f"_back_{back}.operations") == 1)
    ends = reduce(lambda left, right: left & right, tests)
    return moments.select("*", *attempts).select(
        *moments.columns, F.coalesce(ends, F.lit(False)).alias("chain_end")
    )


def _stored(few: DataFrame, store: str | None) -> DataFrame:
    """Few rows, written to ``store`` if there is one: then Spark knows their size when it plans
    the join with all rows, and if that allows a broadcast, those are not shuffled again."""
    if store is None:
        return few
    few.write.mode("overwrite").parquet(store)
    return few.sparkSession.read.schema(few.schema).parquet(store)


def two_places(
    tx: DataFrame,
    *,
    key: str,
    ts: str,
    place: str,
    within: int = HOUR,
    width: int = DAY,
    store: str | None = None,
) -> DataFrame:
    """The rows that have a place and, at most ``within`` earlier, one with another place.

    ``store`` is a folder for the flagged moments, which are few.
    """
    placed = tx.filter(F.col(key).isNotNull() & F.col(place).isNotNull())
    moments = placed.groupBy(key, ts).agg(*place_facts(place))
    flagged = (
        with_two_places(in_slots(moments, ts=ts, reach=within, width=width), key=key, ts=ts, within=within)
        .filter(F.col("_home") & F.col("two_places"))
        .select(key, ts)
    )
    return placed.join(_stored(flagged, store), [key, ts], "left_semi").select(*tx.columns)


def chain_ends(
    tx: DataFrame,
    *,
    key: str,
    ts: str,
    tie: str,
    amount: str,
    oper_type: str = "oper_type",
    oper_result: str = "oper_result",
    n: int = 3,
    within: int = 1_200,
    types: Sequence[str] = SPENDING_TYPES,
    width: int = DAY,
) -> DataFrame:
    """Key, time and ``end_order`` of the operations that end a chain of ``n`` rejected attempts
    (see ``with_decreasing_chain``). ``end_order`` is the ``id_order`` of their ``tie``."""
    moments = tx.groupBy(key, ts).agg(
        *attempt_facts(
            tie=tie, amount=amount, oper_type=oper_type, oper_result=oper_result, types=types
        )
    )
    slots = in_slots(moments, ts=ts, reach=within, width=width)
    return (
        with_decreasing_chain(slots, key=key, ts=ts, n=n, within=within)
        .filter(F.col("_home") & F.col("chain_end"))
        .select(key, ts, F.col("_first_tie").alias("end_order"))
    )


def decreasing_chain(
    tx: DataFrame, *, key: str, ts: str, tie: str, store: str | None = None, **options
) -> DataFrame:
    """The rows that end a chain; takes the options of ``chain_ends``.

    ``store`` is a folder for the ends of chains, which are few.
    """
    ends = chain_ends(tx, key=key, ts=ts, tie=tie, **options).select(
        F.col(key).alias("_key"), F.col(ts).alias("_ts"), "end_order"
    )
    ends = _stored(ends, store)
    same = F.col("_key").eqNullSafe(tx[key]) & (F.col("_ts") == tx[ts]) & (F.col("end_order") == id_order(tie))
    return tx.join(ends, same, "left_semi")


def in_equal_slots(rows: DataFrame, *by: str, store: str) -> DataFrame:
    """Number the rows (``_slot``) by ranges of about equal size in the order of ``by``.

    The ranges come from a sample of all rows, so a key, and a second of a key, that holds many
    rows lies in many slots; only rows that are equal in all of ``by`` share one. They are
    written to ``store``, as another sample could cut them elsewhere.
    """
    ranged = rows.repartitionByRange(*by).withColumn("_slot", F.spark_partition_id())
    return _stored(ranged, store)


def lag_back(
    tx: DataFrame,
    *,
    key: str,
    ts: str,
    tie: str,
    columns: Sequence[str],
    store: str,
    n: int = 3,
) -> DataFrame:
    """Add ``{column}_back_{k}``: the value of the key's k-th operation before, k = 1..n.

    There is no time limit here, so each slot receives the last ``n`` operations of the
    slots before it. These come from a summary with one row per key and slot. A window over
    operations sees one slot, and the one over the summary as many rows as there are slots, however
    much of all rows a key holds and however close in time. ``store`` is a folder for the
    operations by slot.
    """
    tx = in_equal_slots(tx.withColumn("_order", id_order(tie)), key, ts, "_order", store=store)
    carried_columns = list(dict.fromkeys([ts, "_order", *columns]))
    ordered = Window.partitionBy(key, "_slot").orderBy(ts, "_order")
    tails = (
        tx.select(key, "_slot", *carried_columns)
        .withColumn("_more", F.lead(F.lit(True), n).over(ordered))
        .filter(F.col("_more").isNull())
        .groupBy(key, "_slot")
        .agg(F.sort_array(F.collect_list(F.struct(*carried_columns))).alias("_tail"))
    )
    by_slot = Window.partitionBy(key).orderBy("_slot")
    nothing = F.slice("_tail", 1, 0)
    before = F.concat(
        *[F.coalesce(F.lag("_tail", back).over(by_slot), nothing) for back in range(n, 0, -1)]
    )
    carried = (
        tails.withColumn("_before", before)
        .withColumn(
            "_before", F.slice("_before", F.greatest(F.size("_before") - n + 1, F.lit(1)), F.lit(n))
        )
        .select(key, "_slot", F.explode("_before").alias("_entry"))
        .select(key, "_slot", "_entry.*", F.lit(False).alias("_home"))
    )
    rows = tx.withColumn("_home", F.lit(True)).unionByName(carried, allowMissingColumns=True)
    lagged = [
        F.lag(column, back).over(ordered).alias(f"{column}_back_{back}")
        for column in columns
        for back in range(1, n + 1)
    ]
    return rows.select("*", *lagged).filter("_home").drop("_home", "_slot", "_order")


def _with_nearest(
    rows: DataFrame, *, key: str, candidate: Column, upper: Column, level: Column, carried: Column
) -> DataFrame:
    """Add what ``_nearest_above`` needs to find, before each moment, the latest candidate above some bound.

    ``_last`` is the latest candidate before the moment, ``_gap_low`` and ``_gap_spoiled`` sum up what lies between, and ``_above`` is
    the candidate before the run of equal ones that ends with ``_last``, if nothing in between undercuts or spoils
    the run. ``level`` is the amount of a candidate whose moment holds no other, else NULL. Each is a running value: one
    pass per slot, no row looks back over a frame. All windows share one partitioning and order, so a task sorts its rows
    once: what starts anew with each candidate is an extreme of pairs that begin with the number of candidates passed.
    """
    ordered = Window.partitionBy(key, "_slot").orderBy("_second")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    known = [name for name in rows.columns if name not in ("_last", "_passed", "_gap_low", "_gap_spoiled", "_above")]
    facts = F.struct(upper.alias("upper"), level.alias("level"), carried.alias("carried"))
    rows = rows.select(
        *known,
        F.last(F.when(candidate, facts), ignorenulls=True).over(before).alias("_last"),
        F.coalesce(F.count(F.when(candidate, True)).over(before), F.lit(0)).alias("_passed"),
    )
    # A moment without an amount is never the least one of its gap.
    lows = F.min(F.struct((-F.col("_passed")).alias("passed"), F.col("_low").isNull().alias("none"), F.col("_low").alias("low")))
    spoilers = F.max(F.struct(F.col("_passed").alias("passed"), F.col("_spoils").alias("spoils")))
    low, spoiler = lows.over(before), spoilers.over(before)
    rows = rows.select(
        "*",
        F.when(low["passed"] == -F.col("_passed"), low["low"]).alias("_gap_low"),
        F.coalesce((spoiler["passed"] == F.col("_passed")) & spoiler["spoils"], F.lit(False)).alias("_gap_spoiled"),
    )
    begins = F.coalesce(level != F.col("_last.level"), F.lit(True))
    broken = F.col("_gap_spoiled") | F.coalesce(F.col("_gap_low") < level, F.lit(False))
    turn = F.when(candidate & (begins | broken), F.struct(F.when(~broken, F.col("_last")).alias("at")))
    return rows.select("*", F.last(turn, ignorenulls=True).over(before)["at"].alias("_above"))


def _nearest_above(bound: Column) -> Column:
    """``carried`` of the latest candidate above ``bound``, if no moment after it undercuts the bound or spoils; else NULL.

    That candidate is the latest one of all, or the latest one is equal to the bound and this is the one before its run; any other
    would undercut.
    """
    clean = ~F.col("_gap_spoiled") & F.coalesce(F.col("_gap_low") >= bound, F.lit(True))
    return F.when(clean & (F.col("_last.upper") > bound), F.col("_last.carried")).when(
        clean & (F.col("_last.level") == bound) & (F.col("_above.upper") > bound), F.col("_above.carried")
    )


def loose_chain(
    tx: DataFrame,
    *,
    key: str,
    ts: str,
    amount: str,
    oper_type: str = "oper_type",
    oper_result: str = "oper_result",
    within: int = 1_200,
    types: Sequence[str] = SPENDING_TYPES,
    width: int = DAY,
) -> DataFrame:
    """Accepted operations after three rejected ones with falling amounts, where other
    operations may lie in between.

    Those must be rejected too and must not undercut what follows them: of all operations
    after the first attempt, none up to an attempt is smaller than it, none at all is smaller
    than the accepted one, and none is of another kind.

    An attempt can be the next one of a chain if the latest larger attempt before it is not
    older than the latest operation that spoils it. Taking the latest one never loses a
    chain: any chain through an older one also fits the later one, and starts no later. So every moment
    carries the start of its latest chain of two, then of three; whether that is in time is asked at the end.
    """
    counted, result, value = F.col(oper_type).isin(*types), F.col(oper_result), F.col(amount)
    attempt = counted & (result == REJECTED)
    accepted = counted & (result == ACCEPTED)
    spoils = F.coalesce(~counted, F.lit(False)) | F.coalesce(result != REJECTED, F.lit(False))
    moments = tx.filter(F.col(key).isNotNull() & F.col(ts).isNotNull()).groupBy(key, ts).agg(
        F.max(spoils).alias("_spoils"),
        F.min(amount).alias("_low"),
        F.min(F.when(attempt, value)).alias("_attempt_low"),
        F.max(F.when(attempt, value)).alias("_attempt_high"),
        F.coalesce(F.max(accepted), F.lit(False)).alias("_accepted"),
    )
    rows = in_slots(moments, ts=ts, reach=within, width=width).withColumn(
        "_second", seconds_since_beginning(ts)
    )
    low, high = F.col("_attempt_low"), F.col("_attempt_high")
    is_attempt = ~F.col("_spoils") & (low == F.col("_low"))
    rows = _with_nearest(
        rows, key=key, candidate=high.isNotNull(), upper=high,
        level=F.when(~F.col("_spoils") & (high == F.col("_low")), high), carried=F.col("_second"),
    )
    for start in ("_start_2", "_start_3"):
        rows = rows.withColumn(start, F.when(is_attempt, _nearest_above(low)))
        rows = _with_nearest(
            rows, key=key, candidate=F.col(start).isNotNull(), upper=low, level=low, carried=F.col(start)
        )
    in_time = F.col("_second") - within
    started = F.greatest("_last.carried", "_above.carried") >= in_time
    facts = ["_second", "_gap_low", "_gap_spoiled", "_last", "_above"]
    rows = rows.filter(F.col("_home") & F.col("_accepted") & started).select(
        F.col(key).alias("_key"), F.col(ts).alias("_ts"), *facts
    )
    ends = tx.filter(accepted).join(rows, (F.col("_key") == tx[key]) & (F.col("_ts") == tx[ts]))
    return ends.filter(_nearest_above(value) >= in_time).select(*tx.columns)
