"""The dealt operators as queries over the driver's tables, next to equal SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.llm import toxicity
from vaultline.llm.common import WORD, text_of
from vaultline.llm.curve_packing import curve_packing
from vaultline.llm.exact_dedup import exact_dedup
from vaultline.llm.mixing import fair_mix
from vaultline.llm.packing import packed_documents
from vaultline.llm.periodic_runs import periodic_runs
from vaultline.llm.pq_dedup import embedding_dedup
from vaultline.llm.simhash import simhash_dedup
from vaultline.llm.spelling_variants import letter_runs, spelling_variants, word_counts
from vaultline.llm.substring_dedup import substring_dedup
from vaultline.llm.token_counts import token_counts
from vaultline.llm.url_filter import judged_urls
from vaultline.llm.warc import archived_pages

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies of whole texts; the largest id of each group stays."""
    found = exact_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


SQL["op1_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""


@query
def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints of three-word shingles and their components."""
    found = simhash_dedup(table(spark, sf_dir, "documents"), width=3)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


@query
def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources mixed to weights 5, 2, 1 by virtual finish times, three epochs at most."""
    mix = fair_mix(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


SQL["op6_source_mixing"] = r"""
WITH docs AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '-')) AS key,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
  FROM documents),
weighted AS (
  SELECT source, source_size, 3 * source_size AS cap,
    CASE row_number() OVER (ORDER BY source NULLS LAST) % 3 WHEN 1 THEN 5 WHEN 2 THEN 2 ELSE 1 END AS weight
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source)),
leveled AS (
  SELECT *, row_number() OVER by_ratio AS place,
    CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER (by_ratio ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
      AS DOUBLE) / sum(weight) OVER (by_ratio ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted WINDOW by_ratio AS (ORDER BY cap / weight, source NULLS LAST)),
targets AS (
  SELECT source, source_size, least(CAST(cap AS DOUBLE), weight * (
    SELECT level FROM leveled WHERE level <= cap / weight ORDER BY place LIMIT 1)) AS target
  FROM leveled),
queued AS (
  SELECT doc_id, source, key, size,
    sum(size) OVER (PARTITION BY source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) AS upto
  FROM docs WHERE size > 0),
turns AS (
  SELECT q.doc_id, q.source, q.key, q.size, CAST(q.upto + epoch * t.source_size AS DOUBLE) / t.target AS finish
  FROM queued AS q JOIN targets AS t ON q.source IS NOT DISTINCT FROM t.source
  CROSS JOIN (VALUES (0), (1), (2)) AS z(epoch)),
totals AS (
  SELECT doc_id, size, sum(size) OVER (ORDER BY finish, source NULLS LAST, key, doc_id ROWS UNBOUNDED PRECEDING) AS total
  FROM turns),
taken AS (
  SELECT doc_id, CAST(sum(size) AS BIGINT) AS taken FROM totals
  WHERE total <= (SELECT sum(size) FROM docs) GROUP BY doc_id)
SELECT d.doc_id, d.size, t.source_size, t.target, coalesce(k.taken, 0) AS taken
FROM docs AS d JOIN targets AS t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN taken AS k ON k.doc_id = d.doc_id"""


@query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of whole texts, and which exceed 4096."""
    counts = token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 4096)


@query
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed into sequences of 2048 tokens."""
    return packed_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to dictionary-compressed archives and read back."""
    found = archived_pages(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL["op9_warc"] = """
WITH sized AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM sized)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND first < page_id THEN first END AS refers_to
FROM firsts"""


@query
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL judged by rules, else by the regression."""
    return judged_urls(table(spark, sf_dir, "pages"))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of whole texts by a lexicon learned from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    lexicon = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int")
    return toxicity.scores(docs, lexicon).select(
        "doc_id", toxicity.held_out().alias("held_out"), "score", predicted.alias("predicted")
    )


@query
def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of one label with a cosine of at least 0.98: number of links and components."""
    return embedding_dedup(table(spark, sf_dir, "embeddings"))


SQL["op2_embedding_dedup"] = """
WITH RECURSIVE valid AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM valid AS a JOIN valid AS b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reached AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT r.a, l.b FROM reached AS r JOIN links AS l ON r.b = l.a),
components AS (SELECT a, min(b) AS component_id FROM reached GROUP BY a)
SELECT e.vec_id, (SELECT count(*) FROM links AS l WHERE l.a = e.vec_id) AS n_links, c.component_id,
  e.vec_id = c.component_id AS kept
FROM embeddings AS e JOIN components AS c ON c.a = e.vec_id"""


@query
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words covered by a window of 20 that also starts earlier are removed."""
    found = substring_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


SQL["op5_substring_dedup"] = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
  SELECT doc_id, start, sha256(array_to_string(words[start : start + 19], ' ')) AS sequence
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS start FROM docs)),
later AS (
  SELECT doc_id, start FROM (
    SELECT doc_id, start, row_number() OVER (PARTITION BY sequence ORDER BY doc_id, start) AS place FROM windows)
  WHERE place > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(start, start + 20)) AS place FROM later),
removed AS (SELECT doc_id, list(place) AS places FROM gone GROUP BY doc_id),
kept AS (
  SELECT d.doc_id, d.words, coalesce(r.places, []) AS places FROM docs AS d LEFT JOIN removed AS r ON r.doc_id = d.doc_id),
left_words AS (
  SELECT k.doc_id, string_agg(k.words[i.place], ' ' ORDER BY i.place) AS text
  FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS place FROM kept) AS i
  JOIN kept AS k ON k.doc_id = i.doc_id
  WHERE NOT EXISTS (SELECT 1 FROM gone AS g WHERE g.doc_id = i.doc_id AND g.place = i.place)
  GROUP BY k.doc_id)
SELECT k.doc_id, len(k.words) AS n_words, len(k.places) AS n_removed, sha256(coalesce(l.text, '')) AS kept_sha256
FROM kept AS k LEFT JOIN left_words AS l ON l.doc_id = k.doc_id"""


def with_repeats(docs: DataFrame) -> DataFrame:
    """Every tenth document, by the checksum of its id, repeats a stretch of its words up to its end; the rest stays as it is."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    g = F.floor(h / 10)
    words = docs.select("doc_id", "text", F.when(h % 10 == 0, F.regexp_extract_all(text_of("text"), F.lit(WORD), F.lit(0))).alias("words"))
    n = F.size("words")
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    repeated = F.flatten(F.array_repeat(F.slice("words", a + 1, p), F.ceil((n - a) / p).cast("int")))
    changed = F.array_join(F.slice(F.concat(F.slice("words", F.lit(1), a), repeated), F.lit(1), n), " ")
    return words.select("doc_id", F.when(n > 0, changed).otherwise(F.col("text")).alias("text"))


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of words with at least four periods, the strongest of them, and the texts without the repeats."""
    found = periodic_runs(with_repeats(table(spark, sf_dir, "documents")))
    runs = F.col("runs")
    stronger = lambda best, x: x["length"] * best["period"] > best["length"] * x["period"]
    best = F.aggregate(runs, F.get(runs, 0), lambda best, x: F.when(stronger(best, x), x).otherwise(best))
    line = F.transform(runs, lambda x: F.concat(x["start"], F.lit(","), x["length"], F.lit(","), x["period"], F.lit("\n")))
    found = found.select("doc_id", "collapsed", "runs", best.alias("best"))
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def with_slips(words: DataFrame) -> DataFrame:
    """Some words of some documents, by the checksum of both, lose a letter."""
    h = F.crc32(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "word"))
    at = (h % F.char_length("word")).cast("int")
    shorter = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.char_length("word")))
    return words.select(F.when(h % 199 == 0, shorter).otherwise(F.col("word")).alias("word"))


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of at least six letters and five occurrences, and the more frequent forms they may be variants of."""
    return spelling_variants(word_counts(with_slips(letter_runs(table(spark, sf_dir, "documents")))))


# DuckDB has no CRC-32: the usual table of 256 numbers, then one step per byte. Levenshtein there counts bytes, so neighbours are
# found by deleting code points: one of the longer word, or one at the same place of both.
SQL["op13_spelling_variants"] = r"""
WITH RECURSIVE steps AS (
  SELECT i AS byte, CAST(i AS BIGINT) AS c, 0 AS k FROM range(256) AS r(i)
  UNION ALL
  SELECT byte, CASE WHEN c % 2 = 1 THEN xor(c // 2, CAST(3988292384 AS BIGINT)) ELSE c // 2 END, k + 1 FROM steps WHERE k < 8),
crc AS (SELECT list(c ORDER BY byte) AS t FROM steps WHERE k = 8),
runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM (
    SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents)),
hashed AS (
  SELECT run, times, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bytes),
      lambda c, b : xor(c // 256, t[xor(c % 256, b) + 1])), CAST(4294967295 AS BIGINT)) AS h
  FROM (
    SELECT run, times, list_transform(range(0, len(code), 2), lambda i : CAST('0x' || code[i + 1 : i + 2] AS BIGINT)) AS bytes
    FROM (
      SELECT run, hex(concat(doc_id, ':', run)) AS code, times FROM (
        SELECT doc_id, run, count(*) AS times FROM runs GROUP BY doc_id, run))), crc),
counts AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN left(run, h % len(run)) || substr(run, h % len(run) + 2) ELSE run END AS word, times
    FROM hashed)
  WHERE len(word) >= 6 GROUP BY word HAVING sum(times) >= 5),
shorter AS (
  SELECT word, place, left(word, place - 1) || substr(word, place + 1) AS rest
  FROM (SELECT word, unnest(range(1, len(word) + 1)) AS place FROM counts)),
near AS (
  SELECT a.word, b.word AS other FROM shorter AS a JOIN shorter AS b
    ON a.rest = b.rest AND a.place = b.place AND a.word <> b.word AND len(a.word) = len(b.word)
  UNION SELECT s.word, c.word FROM shorter AS s JOIN counts AS c ON s.rest = c.word
  UNION SELECT c.word, s.word FROM shorter AS s JOIN counts AS c ON s.rest = c.word),
ranked AS (
  SELECT n.word, n.other, c.n AS other_n, count(*) OVER (PARTITION BY n.word) AS n_near,
    row_number() OVER (PARTITION BY n.word ORDER BY c.n DESC, n.other) AS place
  FROM near AS n JOIN counts AS c ON c.word = n.other),
forms AS (
  SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near,
    CASE WHEN r.other_n >= 5 * w.n THEN r.other END AS form, CASE WHEN r.other_n >= 5 * w.n THEN r.other_n END AS form_n
  FROM counts AS w LEFT JOIN ranked AS r ON r.word = w.word AND r.place = 1),
followed AS (
  SELECT word, word AS root, 0 AS step FROM forms
  UNION ALL
  SELECT f.word, g.form, step + 1 FROM followed AS f JOIN forms AS g ON g.word = f.root WHERE g.form IS NOT NULL),
roots AS (SELECT word, max_by(root, step) AS root FROM followed GROUP BY word)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n FROM forms AS f JOIN roots AS r ON r.word = f.word"""


@query
def op11_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed into sequences of 2048 tokens along a Hilbert curve."""
    return curve_packing(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
