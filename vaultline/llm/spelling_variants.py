"""Spelling variants: words that differ by one code point, grouped under their most frequent form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.llm.common import materialise
from vaultline.llm.components import compressed

LETTERS = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# How many times as frequent as a word its form must be.
RATIO = 5
# Pairs that one chunk may bring together; a chunk with more is joined by what is left of the words, too.
PAIRS_OF_CHUNK = 10_000
# Stands for the chunk in what is left of a word; takes part in no word.
CUT = "\x00"


def letter_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, word): the maximal runs of letters of whole texts, only A-Z lower-cased. Null texts have none."""
    run = F.col("run")
    runs = docs.select(
        F.col(id_column).alias("doc_id"), F.explode(F.regexp_extract_all(F.col(text_column), F.lit(LETTERS), F.lit(0))).alias("run")
    )
    # Lower case of ASCII is a fast path; other letters must stay.
    lower = F.when(F.octet_length(run) == F.char_length(run), F.lower(run)).otherwise(F.translate(run, UPPER, LOWER))
    return runs.select("doc_id", lower.alias("word"))


def word_counts(words: DataFrame, min_length: int = 6, min_count: int = 5) -> DataFrame:
    """(word, n) of the words of at least so many code points and occurrences. Counted before the shuffle."""
    long = words.filter(F.char_length("word") >= min_length)
    return long.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)


def _entry(word: Column, length: Column, chunk: int, start: Column, size: Column) -> Column:
    """The key of a piece of ``word`` as chunk of words of a length, and the word without the piece."""
    key = F.concat_ws(":", length, F.lit(chunk), F.substring(word, start + 1, size))
    rest = F.concat(F.substring(word, F.lit(1), start), F.lit(CUT), F.substring(word, start + size + 1, F.char_length(word)))
    return F.struct(key.alias("key"), rest.alias("rest"))


def _places(length: Column) -> list[tuple[int, Column, Column]]:
    """The two chunks (number, start, size) of words of a length: their halves."""
    half = F.floor(length / 2).cast("int")
    return [(0, F.lit(0), half), (1, half, length - half)]


def chunks_of(words: DataFrame) -> DataFrame:
    """(word, key, rest) of the two disjoint chunks of each word."""
    word, length = F.col("word"), F.char_length("word")
    entries = [_entry(word, length, *place) for place in _places(length)]
    return words.select("word", F.inline(F.array(*entries)))


def grams_of(words: DataFrame) -> DataFrame:
    """(word, key, rest) of the grams of each word that lie within one step of a chunk of words of about its length."""
    word, own = F.col("word"), F.char_length("word")
    entries = []
    for longer in (-1, 0, 1):
        length = own + longer
        for chunk, start, size in _places(length):
            for shift in (-1, 0, 1):
                fits = (length >= 0) & (start + shift >= 0) & (start + shift + size <= own)
                entries.append(F.when(fits, _entry(word, length, chunk, start + shift, size)))
    return words.select("word", F.inline(F.array_compact(F.array(*entries))))


def _shortened(rest: Column) -> Column:
    """What is left of a word, and that with one code point deleted."""
    at = F.sequence(F.lit(1), F.char_length(rest))
    less = F.transform(at, lambda i: F.concat(F.substring(rest, F.lit(1), i - 1), F.substring(rest, i + 1, F.char_length(rest))))
    return F.array_distinct(F.concat(F.array(rest), less))


def near_words(words: DataFrame, pairs_of_chunk: int = PAIRS_OF_CHUNK) -> DataFrame:
    """All pairs (a, b), a < b, of distinct words that differ by one inserted, deleted or replaced code point.

    Asymmetric chunks: of a pair, ``a`` gives two disjoint chunks, its halves, and ``b`` all grams as long as them at
    their places or one step beside. One edit lies in one half at most, so the other half of ``a`` is a gram of
    ``b``, moved by at most one. Pairs that meet are verified by their distance.

    A chunk that would bring together more than ``pairs_of_chunk`` pairs is joined by the rest of the words, too: outside
    the chunk they differ by the one edit, so both reach the same text by deleting at most one code point there. At most some
    (alphabet x length) distinct words reach a text, so such a group is small however many words share the chunk, and no pair is lost.
    """
    words = materialise(words.select("word").filter("word is not null").distinct(), "words")
    chunks, grams = chunks_of(words), grams_of(words)
    met = chunks.groupBy("key").agg(F.count("*").alias("x")).join(grams.groupBy("key").agg(F.count("*").alias("y")), "key")
    crowded = met.filter(F.col("x") * F.col("y") > pairs_of_chunk).select("key", F.lit(True).alias("crowded"))
    crowded = materialise(crowded, "crowded")

    def entered(entries: DataFrame) -> DataFrame:
        marked = entries.join(crowded, "key", "left")
        variants = F.when(F.col("crowded"), _shortened(F.col("rest"))).otherwise(F.array(F.lit("")))
        return marked.select("word", "key", F.explode(variants).alias("variant"))

    a, b = entered(chunks).withColumnRenamed("word", "a"), entered(grams).withColumnRenamed("word", "b")
    pairs = a.join(b, ["key", "variant"]).filter("a < b").select("a", "b")
    return pairs.filter(F.levenshtein("a", "b", 1) == 1).distinct()


def spelling_variants(counts: DataFrame, ratio: int = RATIO, pairs_of_chunk: int = PAIRS_OF_CHUNK) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each word of ``counts`` (word, n), whose words are distinct.

    ``n_near`` is the number of words that differ by one code point. The most frequent of them (of several
    the first in the order of code points) is the ``form`` if it is at least ``ratio`` times as
    frequent as the word, else null; ``root`` follows forms to the last. Counts grow by ``ratio`` with each step, so chains are short.
    Null words are left out; other columns are ignored; an empty table gives no rows.
    """
    counts = materialise(counts.select("word", "n").filter("word is not null"), "counts")
    pairs = materialise(near_words(counts, pairs_of_chunk), "near")
    near = pairs.toDF("word", "other").union(pairs.select("b", "a"))
    near = near.join(counts.toDF("other", "other_n"), "other")
    best = near.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best")
    )
    enough = -F.col("best.less") >= ratio * F.col("n")
    found = counts.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(enough, F.col("best.other")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n"),
    )
    found = materialise(found, "forms")
    steps = found.filter("form is not null").select(F.col("word").alias("node"), F.col("form").alias("parent"))
    roots = compressed(steps).toDF("word", "root")
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
