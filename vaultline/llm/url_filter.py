"""URL rules, and a logistic regression on hashed character n-grams for the URLs that no rule fits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.llm.common import materialise

# (verdict, host and path a URL must fit)
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
# Labelled URLs the regression is fitted on, at most; the first different ones by hash.
LABELLED = 5000
FEATURES = 1 << 12
GRAMS = (2, 3, 4)


def host_of(url: str) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: str) -> Column:
    """After the host to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict; null if none does.

    A rule fits its host and all subdomains if the path starts with the rule's path.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda item: len(item[1])):
        own_host, slash, own_path = text.partition("/")
        fits = ((host == own_host) | host.endswith("." + own_host)) & path.startswith(slash + own_path)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def _grams(part: Column, mark: str, n: int) -> Column:
    starts = F.sequence(F.lit(1), F.greatest(F.length(part) - (n - 1), F.lit(1)))
    return F.transform(starts, lambda i: F.concat(F.lit(mark), F.substring(part, i, F.lit(n))))


def grams(host: Column, path: Column) -> Column:
    """Character n-grams of the host and of the path, each marked by where it comes from."""
    return F.concat(*(_grams(part, mark, n) for mark, part in (("h", host), ("p", path)) for n in GRAMS))


def hasher() -> HashingTF:
    return HashingTF(numFeatures=FEATURES, binary=True, inputCol="grams", outputCol="features")


def fit(labelled: DataFrame, limit: int = LABELLED) -> LogisticRegressionModel | str:
    """A regression for ``block``, or the verdict of all if there is one only.

    ``labelled`` has host, path and verdict; of its distinct rows at most ``limit``, the first by hash, are used, so
    a URL that is there many times, or with many query strings, counts once for each of its verdicts.
    """
    sample = labelled.select("host", "path", (F.col("verdict") == "block").cast("double").alias("label")).distinct()
    sample = sample.orderBy(F.xxhash64("host", "path"), "host", "path", "label").limit(limit)
    sample = materialise(sample, "labelled-urls").coalesce(1)
    verdicts = [row["label"] for row in sample.select("label").distinct().limit(2).collect()]
    if len(verdicts) < 2:
        return "block" if verdicts == [1.0] else "allow"
    rows = hasher().transform(sample.withColumn("grams", grams(F.col("host"), F.col("path"))))
    return LogisticRegression(maxIter=50, regParam=0.01).fit(rows)


def judged_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, labelled: DataFrame | None = None, limit: int = LABELLED
) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of ``pages``: the rule's verdict, else the regression's.

    ``labelled`` is a small table (url, verdict) to learn from; without it the URLs that a rule decides
    are taken. If it knows one verdict only, that is everyone's; if it is empty, the others are allowed. A null URL
    or one without ``://`` has an empty host and path, fits no rule and is judged like any other. Rows may repeat;
    each gets its row. Only SQL functions and Spark's own learning run; no page is shuffled, only
    the hosts and paths to learn from are, to take each once.
    """
    split = pages.select("page_id", host_of("url").alias("host"), path_of("url").alias("path"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    ruled = split.withColumns({"rule": rule, "ruled": verdict})
    if labelled is None:
        known = ruled.filter("rule is not null").select("host", "path", F.col("ruled").alias("verdict"))
    else:
        known = labelled.select(host_of("url").alias("host"), path_of("url").alias("path"), "verdict")
    model = fit(known, limit)
    if isinstance(model, str):
        learned = ruled.withColumn("learned", F.lit(model))
    else:
        hashed = hasher().transform(ruled.withColumn("grams", grams(F.col("host"), F.col("path"))))
        learned = model.transform(hashed).withColumn("learned", F.when(F.col("prediction") == 1, "block").otherwise("allow"))
    return learned.select("page_id", "host", "path", "rule", F.coalesce("ruled", "learned").alias("verdict"))
