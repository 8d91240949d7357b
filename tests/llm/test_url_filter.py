from __future__ import annotations

from urllib.parse import urlsplit

from vaultline.llm.url_filter import fit, host_of, judged_urls, path_of, rule_for

from pyspark.sql import functions as F  # noqa: I001


def judged(spark, *urls, **options):
    rows = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id bigint, url string, rule string, host string")
    return [tuple(r)[1:] for r in judged_urls(rows, **options).orderBy("page_id").collect()]


def test_host_path_and_rules(spark):
    got = judged(
        spark,
        "http://WWW.Example.com/en/1?a=/b",
        "https://a.b.example.com/en/x#y",
        "https://example.com/EN/",
        "https://xexample.com/en/",
        "https://a.net/es/1",
        "https://net/fr/",
        "https://a.com",
        "https://a.com?x=://b.net/es/",
        "no scheme example.com/en/",
        None,
        "",
        "x://É.org\n/p\n#",
    )
    assert [row[:3] for row in got] == [
        ("www.example.com", "/en/1", "www.example.com/en/"),
        ("a.b.example.com", "/en/x", "example.com/en/"),
        ("example.com", "/EN/", "com/"),
        ("xexample.com", "/en/", "com/"),
        ("a.net", "/es/1", "net/es/"),
        ("net", "/fr/", "net/fr/"),
        ("a.com", "", None),
        ("a.com", "", None),
        ("", "", None),
        ("", "", None),
        ("", "", None),
        ("É.org\n", "/p\n", None),
    ]
    assert [row[3] for row in got[:6]] == ["allow", "block", "allow", "allow", "block", "block"]
    assert {row[3] for row in got} == {"allow", "block"}


def test_longest_rule_wins_in_any_order(spark):
    rules = (("block", "a.com/x/"), ("allow", "com/"), ("block", "com/x/y/z/"))
    rule, verdict = rule_for(F.lit("a.com"), F.lit("/x/y/z/1"), rules)
    assert tuple(spark.range(1).select(rule, verdict).first()) == ("com/x/y/z/", "block")


def test_the_regression_learns_from_a_table(spark):
    bad = [(f"https://h{i}.casino-win.org/play/{i}", "block") for i in range(60)]
    good = [(f"https://h{i}.museum.org/art/{i}", "allow") for i in range(60)]
    labelled = spark.createDataFrame(bad + good, "url string, verdict string")
    got = judged(spark, "https://new.casino-win.org/play/a", "https://new.museum.org/art/a", labelled=labelled)
    assert [row[3] for row in got] == ["block", "allow"]
    again = judged(spark, "https://new.casino-win.org/play/a", "https://new.museum.org/art/a", labelled=labelled.repartition(5))
    assert got == again


def test_one_verdict_or_no_labels(spark):
    none = spark.createDataFrame([], "url string, verdict string")
    one = spark.createDataFrame([("http://a.org/", "block")], "url string, verdict string")
    assert judged(spark, "http://a.org/", labelled=none)[0][3] == "allow"
    assert judged(spark, "http://a.org/", labelled=one)[0][3] == "block"
    assert judged_urls(spark.createDataFrame([], "page_id bigint, url string")).count() == 0


def test_only_spark_functions_run(spark):
    rows = spark.createDataFrame([(1, "http://a.com/"), (2, "http://a.net/es/")], "page_id bigint, url string")
    plan = judged_urls(rows)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    assert "Arrow" not in plan
    assert "Exchange" not in plan


def test_hosts_agree_with_the_standard_library(spark):
    urls = ["http://a.b/c", "https://A.b:80/c?d#e", "ftp://x", "http://x/y//z"]
    for url, row in zip(urls, judged(spark, *urls), strict=True):
        parts = urlsplit(url)
        assert row[:2] == (parts.netloc.lower(), parts.path)


def test_copies_do_not_fill_the_sample(spark):
    """Two URLs crawled many times, differing in the query alone; the limit has room for all different ones, not for copies."""
    urls = [f"https://a.com/good{i % 2}?q={i}" for i in range(60)]
    urls += [f"https://b.net/es/bad{i}" for i in range(8)]
    rows = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    split = rows.select(host_of("url").alias("host"), path_of("url").alias("path"))
    split = split.withColumn("verdict", rule_for(F.col("host"), F.col("path"))[1]).filter("verdict is not null")
    model = fit(split, limit=10)
    assert not isinstance(model, str)
    assert model.summary.predictions.select("host", "path").distinct().count() == 10
