"""One card holds a third of all rows: joins are split, windows stay small."""

from __future__ import annotations

import pytest
from frames import settings
from pyspark.sql import functions as F

from vaultline.functions.columns import id_order
from vaultline.operators import moments
from vaultline.operators.asof import asof_dim_join
from vaultline.plans import fraud, testbank

SF_DIR = "/root/testdata/sf0.1"

SMALL_PARTITIONS = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "50KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "50KB",
    "spark__sql__adaptive__coalescePartitions__enabled": "false",
}


def hot_transactions(spark):
    """Every third transaction belongs to one card. Spread over several files' worth of tasks,
    since a hot partition is split between the tasks that wrote it."""
    hot = F.when(F.col("trans_id") % 3 == 0, F.lit("C7")).otherwise(F.col("card_num"))
    return testbank.transactions(spark, SF_DIR).withColumn("card_num", hot).repartition(16, "trans_id")


def executed(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("join", ["holders", "dimension"])
def test_hot_card_is_split(spark, join):
    tx = hot_transactions(spark)
    b = testbank.bank(spark, SF_DIR)

    def joined():
        if join == "holders":
            return fraud.at_time(
                tx.select("trans_id", "trans_date", "card_num"),
                fraud.holder_spans(b.cards, b.accounts, b.clients, b.blacklist),
            ).select("trans_id", "phone")
        return asof_dim_join(
            tx, b.cards, fact_key="card_num", dim_key="card_num", ts="trans_date", attrs=["account_num"]
        ).select("trans_id", "account_num")

    expected = sorted(map(tuple, joined().collect()))
    with settings(spark, **SMALL_PARTITIONS):
        result = joined()
        assert sorted(map(tuple, result.collect())) == expected
        assert "SortMergeJoin(skew=true)" in executed(result)


def test_windows_of_a_hot_card_are_cut(spark):
    tx = fraud.locate(hot_transactions(spark), testbank.terminals(spark, SF_DIR))
    cells = moments.in_slots(
        tx.groupBy("card_num", "trans_date").agg(*moments.place_facts("city_code")),
        ts="trans_date", reach=3_600,
    )
    total = cells.count()
    largest = cells.groupBy("card_num", "_slot").count().agg(F.max("count")).first()[0]
    assert largest < total / 60  # a third of the rows, over 30 days
    assert total < tx.count() * 1.1  # few copies


def test_a_hot_second_is_one_row(spark):
    tx = hot_transactions(spark).withColumn(
        "trans_date",
        F.when(F.col("card_num") == "C7", F.expr("timestamp_ntz'2024-01-15 12:00:00'")).otherwise(
            F.col("trans_date")
        ),
    )
    seen = tx.groupBy("card_num", "trans_date").agg(*moments.place_facts("amt"))
    assert seen.filter("card_num = 'C7'").count() == 1
    plan = executed(seen)
    assert "partial_min" in plan and "partial_count" in plan
    assert "SortAggregate" not in plan


def test_rule_4_of_real_types_is_a_hash_aggregate(spark):
    tx = hot_transactions(spark)
    assert dict(tx.dtypes)["trans_id"] == "string"
    facts = moments.attempt_facts(tie="trans_id", amount="amt", oper_type="oper_type", oper_result="oper_result")
    seen = tx.groupBy("card_num", "trans_date").agg(*facts)
    seen.collect()
    plan = executed(seen)
    assert "SortAggregate" not in plan
    assert "partial_min_by" in plan
    ends = moments.chain_ends(tx, key="card_num", ts="trans_date", tie="trans_id", amount="amt")
    assert "SortAggregate" not in executed(ends)


def test_holders_of_one_passport_need_no_shuffle_of_their_transactions(spark):
    """A third of the cards belong to one listed passport, and some clients have none."""
    b = testbank.bank(spark, SF_DIR)
    one = F.when(F.expr("cast(substr(client_id, 2) as int) % 3 = 0"), F.lit("P22")).otherwise(F.col("passport_num"))
    clients = b.clients.withColumn("passport_num", F.when(F.rand(1) > 0.05, one))
    clients = clients.checkpoint()
    holders = (b.transactions, b.cards, b.accounts, clients)
    with settings(spark, **SMALL_PARTITIONS):
        report = fraud.fraud_passport(*holders, b.blacklist, report_dt=testbank.REPORT_DT)
        hits = report.groupBy("passport").count().collect()
        facts = fraud.fraud_passport(*holders, b.blacklist, report_dt=testbank.REPORT_DT, dedupe=True)
        facts.collect()
        shuffles = [line for line in executed(facts).splitlines() if "Exchange hashpartitioning(passport_num" in line]
    counts = {row["passport"]: row["count"] for row in hits}
    held = fraud.asof_chain(*holders).select("trans_date", "passport_num", "passport_valid_to")
    listed = held.join(b.blacklist, "passport_num").filter("entry_dt < trans_date").groupBy("passport_num").count()
    expected = {row["passport_num"]: row["count"] for row in listed.collect()}
    assert counts["P22"] >= expected["P22"] > 0
    assert all(counts[passport] >= n for passport, n in expected.items())
    # Of spans and of entries only: both are dimensions.
    assert all("trans_date" not in line for line in shuffles)


def test_a_hot_second_is_written_by_many_tasks(spark):
    rows = spark.createDataFrame([("c", 200_000)], "card string, copies bigint")
    with settings(spark, **SMALL_PARTITIONS):
        written = fraud._repeat(rows, "copies").select("card", F.spark_partition_id().alias("task"))
        tasks = written.groupBy("task").count().collect()
    assert sum(row["count"] for row in tasks) == 200_000
    assert len(tasks) > 1


@pytest.mark.parametrize("span", ["days", "minute", "second"])
def test_lag_windows_of_a_hot_card_are_cut(spark, tmp_path, span):
    """A third of all rows are one card's: over days, all in one minute, all in one second."""
    second = {"days": None, "minute": F.col("trans_id").cast("int") % 60, "second": F.lit(7)}[span]
    tx = hot_transactions(spark).select("trans_id", "card_num", "trans_date", "amt")
    if second is not None:
        pressed = F.expr("timestamp_ntz'2024-01-15 12:00:00'") + F.make_dt_interval(secs=second)
        tx = tx.withColumn("trans_date", F.when(F.col("card_num") == "C7", pressed).otherwise(F.col("trans_date")))
    options = {**SMALL_PARTITIONS, "spark__sql__shuffle__partitions": "32"}
    with settings(spark, **options):
        slots = moments.in_equal_slots(
            tx.withColumn("_order", id_order("trans_id")), "card_num", "trans_date", "_order",
            store=str(tmp_path / "slots"),
        )
        largest = slots.groupBy("card_num", "_slot").count().agg(F.max("count")).first()[0]
        assert largest < slots.count() / 32 * 2
        lagged = moments.lag_back(
            tx, key="card_num", ts="trans_date", tie="trans_id", columns=["amt"], n=1, store=str(tmp_path / "lagged")
        )
        hot = lagged.filter("card_num = 'C7'").select("trans_date", "trans_id", "amt", "amt_back_1").collect()
    assert len(hot) > tx.count() / 4
    hot.sort(key=lambda r: (r.trans_date, int(r.trans_id)))
    assert [r.amt_back_1 for r in hot] == [None, *[r.amt for r in hot[:-1]]]


def test_loose_chains_of_a_hot_card_hold_no_arrays(spark):
    """A card with an operation each second: windows carry running values, none gathers a frame."""
    tx = spark.range(60_000).select(
        F.col("id").cast("string").alias("trans_id"),
        (F.expr("timestamp_ntz'2024-01-15 00:00:00'") + F.make_dt_interval(secs=F.col("id"))).alias("trans_date"),
        F.lit("C7").alias("card_num"), F.lit("PAYMENT").alias("oper_type"),
        F.expr("cast(case when id % 1200 = 1199 then 1 else 5 - floor(id % 1200 / 300) end as decimal(14,4))").alias("amt"),
        F.when(F.col("id") % 1200 == 1199, "SUCCESS").otherwise("REJECT").alias("oper_result"),
        F.lit("T").alias("terminal"),
    )
    found = moments.loose_chain(tx, key="card_num", ts="trans_date", amount="amt")
    assert {int(r.trans_id) for r in found.collect()} == set(range(1199, 60_000, 1200))
    assert "collect_list" not in executed(found)


def test_loose_chains_sort_the_moments_once(spark):
    """Each sort of a task holds all its rows, so the windows share one."""
    tx = hot_transactions(spark).select("trans_id", "card_num", "trans_date", "oper_type", "amt", "oper_result", "terminal")
    found = moments.loose_chain(tx, key="card_num", ts="trans_date", amount="amt", within=5 * 86_400)
    lines = executed(found).splitlines()
    assert sum("Window [" in line for line in lines) > 1
    assert sum("Sort [" in line and "_slot" in line for line in lines) == 1
