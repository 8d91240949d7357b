from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from vaultline.llm.common import running_sums, shuffle_key
from vaultline.llm.mixing import fair_mix, mixed_documents, source_targets


def targets(spark, sizes):
    frame = spark.createDataFrame(sizes, "source string, source_size bigint")
    return {r["source"]: r["target"] for r in source_targets(frame).collect()}


def test_targets_share_by_weight(spark):
    assert targets(spark, [("a", 500), ("b", 200), ("c", 100)]) == {"a": 500, "b": 200, "c": 100}


def test_targets_stop_and_reshare(spark):
    got = targets(spark, [("a", 10), ("b", 1000), ("c", 1000), (None, 90)])
    assert got["a"] == 30
    assert got[None] == 270
    assert got["b"] == pytest.approx(1800 * 2 / 3)
    assert sum(got.values()) == pytest.approx(2100)


def test_targets_of_nothing(spark):
    assert targets(spark, []) == {}
    assert targets(spark, [("a", 0), (None, 0)]) == {"a": 0, None: 0}


def test_mix_takes_near_the_targets(spark, docs):
    rows = docs(*((i, "w " * (i % 50), ["a", "b", "c", None][min(3, i % 7)]) for i in range(3000)))
    mix = fair_mix(rows).cache()
    assert mix.count() == 3000
    assert mix.filter("copies > 3 or copies < 0").count() == 0
    assert mix.filter("size = 0 and copies > 0").count() == 0
    sums = mix.groupBy("source_size", "target").agg(F.sum(F.col("size") * F.col("copies")).alias("taken")).collect()
    assert sum(r["source_size"] for r in sums) >= sum(r["taken"] for r in sums)
    for r in sums:
        assert abs(r["taken"] - r["target"]) <= 2 * 50
    again = fair_mix(rows.repartition(7))
    assert mix.exceptAll(again).count() == 0


def test_nulls_empty_and_repeated_rows(docs):
    mix = fair_mix(docs((1, None, None), (2, "a b", "s"), (2, "a b", "s"), (None, "c", "s")))
    rows = sorted(((r["doc_id"], r["size"], r["source_size"]) for r in mix.collect()), key=str)
    assert rows == sorted([(1, 0, 0), (2, 2, 5), (2, 2, 5), (None, 1, 5)], key=str)
    assert fair_mix(docs((1, None), (2, ""))).agg(F.sum("copies")).first()[0] == 0
    assert fair_mix(docs((1, "a")).limit(0)).count() == 0


def test_mixed_documents_repeat_rows(docs):
    rows = docs(*((i, "w " * 10, "a" if i < 20 else "b") for i in range(200)), (5, "w " * 10, "a"), (None, "w", None))
    mixed = mixed_documents(rows)
    assert mixed.columns == rows.columns
    taken = fair_mix(rows).groupBy("doc_id").agg(F.sum("copies").alias("n")).filter("n > 0")
    counts = mixed.groupBy("doc_id").agg(F.count("*").alias("n"))
    assert taken.exceptAll(counts).count() == counts.exceptAll(taken).count() == 0
    assert mixed_documents(rows.limit(0)).count() == 0


def test_running_sums_equal_a_plain_loop(spark):
    rows = [(i, ["x", None, "y"][min(2, i % 9)], i % 5) for i in range(2500)]
    frame = spark.createDataFrame(rows, "id bigint, g string, v bigint").withColumn("key", shuffle_key(F.col("id")))
    got = running_sums(frame, ["g"], "key", ["id"], "v", 2500).collect()
    assert len(got) == 2500
    sums = {}
    for r in sorted(got, key=lambda r: (r["key"], r["id"])):
        assert r["before"] == sums.get(r["g"], 0)
        sums[r["g"]] = r["before"] + r["v"]
