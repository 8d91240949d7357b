from __future__ import annotations

from pyspark.sql import functions as F

from vaultline.llm.exact_dedup import DigestIndex, exact_dedup, kept_documents


def verdicts(frame):
    return sorted((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in frame.collect())


def test_largest_id_stays_and_null_is_empty(docs):
    found = exact_dedup(docs((1, "a"), (2, "a "), (3, "a"), (4, None), (5, "")))
    assert verdicts(found) == [(1, 3, 2, False), (2, 2, 1, True), (3, 3, 2, True), (4, 5, 2, False), (5, 5, 2, True)]


def test_repeated_rows_and_null_ids(docs):
    found = exact_dedup(docs((7, "a"), (7, "a"), (None, "a"), (None, "b"), (None, "b")))
    rows = [(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in found.collect()]
    assert sorted(rows, key=str) == sorted(
        [(7, 7, 3, True), (7, 7, 3, False), (None, 7, 3, False), (None, None, 2, True), (None, None, 2, False)], key=str
    )


def test_empty_table(docs):
    assert exact_dedup(docs((1, "a")).limit(0)).count() == 0
    assert kept_documents(docs((1, "a")).limit(0)).count() == 0


def test_later_batches_lose_against_the_index(spark, docs):
    index = DigestIndex(spark, buckets=4)
    assert verdicts(index.add(docs((1, "a"), (2, "b"), (3, "b")))) == [(1, 1, 1, True), (2, 3, 2, False), (3, 3, 2, True)]
    assert verdicts(index.add(docs((9, "b"), (8, "c")))) == [(8, 8, 1, True), (9, 3, 3, False)]
    assert verdicts(index.add(docs((10, "c")))) == [(10, 8, 2, False)]
    assert index.rows().count() == 3
    assert index.rows().select("digest").distinct().count() == 3


def test_the_index_is_not_shuffled(spark, docs):
    index = DigestIndex(spark, buckets=4)
    index.add(docs((1, "a"), (2, "b")))
    batch = spark.createDataFrame([(bytearray(b"x"),)], "digest binary").repartition(4, "digest")
    plan = batch.join(index.rows().hint("merge"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
    assert plan.count("Exchange") == 1


def test_a_kept_index_opens_again(spark, docs, tmp_path):
    name = "digests_opened_again"
    DigestIndex(spark, name, str(tmp_path / name), buckets=2).add(docs((1, "a")))
    again = DigestIndex(spark, name, str(tmp_path / name), buckets=2)
    assert verdicts(again.add(docs((2, "a")))) == [(2, 1, 2, False)]
    spark.sql(f"drop table {name}")


def test_kept_documents_keep_their_columns(docs):
    rows = docs((1, "a"), (2, "a"), (3, None), (3, None), (3, "c"))
    kept = kept_documents(rows)
    assert kept.columns == rows.columns
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect() if r["text"]) == [(2, "a"), (3, "c")]
    assert kept.filter(F.col("text").isNull()).count() == 1


def test_many_copies(spark, docs):
    rows = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("text")
    )
    found = exact_dedup(rows)
    assert found.filter("kept").count() == 2001
    assert found.filter("group_size = 1000").count() == 1000


def test_a_batch_that_runs_again_keeps_the_same(spark, docs):
    index = DigestIndex(spark, buckets=4)
    index.add(docs((1, "a"), (2, "b")), batch="day-1")
    later = docs((5, "b"), (6, "c"), (7, "c"), (8, None))
    first = verdicts(index.add(later, batch="day-2"))
    assert first == [(5, 2, 2, False), (6, 7, 2, False), (7, 7, 2, True), (8, 8, 1, True)]
    assert verdicts(index.add(later, batch="day-2")) == first
    assert index.rows().count() == index.rows().select("digest").distinct().count() == 4
    assert verdicts(index.add(docs((9, "c"), (10, "")), batch="day-3")) == [(9, 7, 3, False), (10, 8, 2, False)]
    index.drop()


def test_two_batches_equal_one(spark, docs):
    rows = [(i, f"t{i % 7}" if i % 3 else None) for i in range(60)] + [(None, "t1"), (None, "n"), (59, "t4"), (59, "t4")]
    groups = {}
    for i, text in rows:
        groups.setdefault(text or "", []).append(i)
    tables = spark.catalog.listTables()
    expected = []
    for own in groups.values():
        best = max((i for i in own if i is not None), default=None)
        first = True
        for i in own:
            expected.append((i, best, len(own), i == best and first))
            first = first and i != best
    assert sorted(map(str, verdicts_of(exact_dedup(docs(*rows))))) == sorted(map(str, expected))
    assert len(spark.catalog.listTables()) == len(tables)


def test_text_ids_and_long_texts(spark):
    rows = spark.createDataFrame([("a", "x " * 500_000), ("b", "x " * 500_000), (None, "x")], "doc_id string, text string")
    assert sorted(map(str, verdicts_of(exact_dedup(rows)))) == ["('a', 'b', 2, False)", "('b', 'b', 2, True)", "(None, None, 1, True)"]


def verdicts_of(frame):
    return [(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in frame.collect()]
