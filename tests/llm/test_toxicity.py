from __future__ import annotations

import random
import zlib

import pytest

from vaultline.llm.toxicity import Lexicon, Matcher, clean_documents, evidence, fold, held_out, learn, logistic, phrases, scores, select

WORDS = [a + b for a in ("ba", "ke", "li", "mo", "nu", "pa") for b in ("rad", "sen", "tol", "vim", "xer")]


def test_fold():
    assert fold("M0R0N, іdіоt! Vequé\nb@d") == " moron  idiot  veque bad "
    assert fold("sc\u200bum ﬁne") == " scum fine "
    assert fold("a $5 !! b!g") == " a  s    big "
    assert fold("") == "  "


def test_evidence_points_to_toxic_documents_only():
    assert evidence(10, 0, 20, 100) > evidence(5, 0, 20, 100) > 0
    assert evidence(2, 10, 20, 100) == evidence(0, 0, 20, 100) == 0


def test_select_leaves_out_what_a_better_entry_covers():
    rows = [(" vequ", 40, 0), (" vequai", 20, 0), (" veq", 40, 30), (" idiot ", 30, 0), (" rare", 2, 0), (" the ", 60, 500)]
    assert list(select(rows, 60, 500)) == [" vequ", " idiot "]


def test_matcher_exceptions_and_length():
    matcher = Matcher({" scum": 4.0, " fool ": 3.0}, (" pond scum ",))
    assert [h[2] for h in matcher.hits(fold("scummy pond scum, fool fools"))] == [4.0, 3.0]
    assert matcher.raw(fold("scum")) > matcher.raw(fold("scum" + " word" * 5000)) > 0
    assert Matcher({}).hits(" scum ") == []
    text = fold("old pond scum here")
    assert phrases(text, Matcher({" scum": 1.0}).hits(text)) == {" pond scum ", " scum here "}


def test_logistic_orders_and_stays_finite():
    slope, intercept = logistic([(0.0, 0)] * 90 + [(9.0, 1)] * 10)
    assert 0 < slope < 10
    assert intercept < 0 < intercept + 9 * slope
    assert logistic([(0.0, 0)] * 5)[0] == 0


def corpus(spark, n=900):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(n):
        words = rng.choices(WORDS, k=rng.randrange(5, 200))
        toxic = i % 6 == 0
        for _ in range(3 if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["grobnak", "Zulfid!", "grobnaks"]))
        if i % 10 == 5:
            words += ["the", "zulfid", "bird"]  # a phrase that is fine
        rows.append((i, " ".join(words), "s", "x"))
        labels.append((i, int(toxic), 0))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxic string, fold string")
    return docs, spark.createDataFrame(labels, "doc_id bigint, toxic int, quality int")


def test_learns_held_out_rows(spark):
    docs, labels = corpus(spark)
    lexicon = learn(docs, labels)
    assert any(entry.startswith(" grobn") for entry in lexicon.entries)
    got = scores(docs, lexicon).join(labels, "doc_id").withColumn("held_out", held_out()).collect()
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in range(900) if zlib.crc32(str(i).encode()) % 3 == 1}
    assert sum((r["score"] >= 0.7) == bool(r["toxic"]) for r in held) / len(held) > 0.95
    assert learn(docs.repartition(5), labels.repartition(3)) == lexicon


def test_held_out_labels_are_never_read(spark):
    docs, labels = corpus(spark, 300)
    from pyspark.sql import functions as F

    other = labels.withColumn("toxic", F.when(held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert learn(docs, labels) == learn(docs, other)


def test_nulls_empty_texts_and_no_labels(spark, docs):
    lexicon = Lexicon({" scum": 5.0}, (), 1.0, -2.0)
    rows = docs((1, None), (2, ""), (3, "SCUM"), (None, "fine"), (3, "SCUM"))
    got = sorted(((r["doc_id"], round(r["score"], 3)) for r in scores(rows, lexicon).collect()), key=str)
    assert got == sorted([(1, 0.119), (2, 0.119), (3, 0.952), (3, 0.952), (None, 0.119)], key=str)
    kept = clean_documents(rows, lexicon)
    assert kept.columns == rows.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "None"]
    no = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert learn(rows, no).entries == {}
    assert scores(rows, learn(rows, no)).first()["score"] == pytest.approx(0.5)
    assert scores(rows.limit(0), lexicon).count() == clean_documents(rows.limit(0), lexicon).count() == 0
