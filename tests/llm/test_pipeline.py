from __future__ import annotations

from collections import Counter

import corpus_pipeline
import pytest

from vaultline.llm.common import materialise
from vaultline.llm.exact_dedup import exact_dedup
from vaultline.llm.simhash import simhash_dedup

SF_DIR = "/root/testdata/sf0.001"


def test_stages_work_on_what_the_one_before_kept(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = materialise(stage(spark, docs, SF_DIR), name)
        seen[name] = docs
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
            assert docs.select("doc_id").exceptAll(before.select("doc_id")).count() == 0 or name == "source_mixing"
    assert exact_dedup(seen["exact_dedup"]).filter("group_size > 1").count() == 0
    left = simhash_dedup(seen["simhash_dedup"], width=3)
    assert left.filter("doc_id <> component_id").count() == 0
    copies = Counter(r["doc_id"] for r in seen["source_mixing"].select("doc_id").collect())
    assert max(copies.values()) <= 3
    packed = Counter(r["doc_id"] for r in docs.filter("piece = 0").select("doc_id").collect())
    assert packed == copies


@pytest.mark.parametrize("stage", range(len(corpus_pipeline.STAGES)))
def test_empty_tables_and_odd_rows(spark, stage):
    name, run = corpus_pipeline.STAGES[stage]
    frame = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert run(spark, frame.limit(0), SF_DIR).count() == 0
    odd = [(None, None, None, None, None), (1, None, "en", None, None), (2, "", "en", "a", 0), (2, "", "en", "a", 0), (3, "a b c", None, "b", 5)]
    found = run(spark, spark.createDataFrame(odd, frame.schema), SF_DIR)
    assert found.count() > 0
    if stage < len(corpus_pipeline.STAGES) - 1:
        assert found.columns == frame.columns
