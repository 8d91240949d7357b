"""Toxicity by a weighted lexicon that is learned from labels and matched by Aho-Corasick."""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.llm.common import materialise, none_per_worker

THRESHOLD = 0.7
# Labelled rows the lexicon is learned from, at most; the first by hash of the id.
SAMPLE = 12_000
# Entries at most, best first, and what an entry needs: toxic documents and evidence (G squared).
ENTRIES = 1000
CANDIDATES = 20_000
LEAST_TOXIC = 3
EVIDENCE = 14.0
# Entries that toxic documents have less than e^2 times as often say too little.
LIGHTEST = 2.0
# Lengths of word beginnings that may become an entry; whole words may be of any length.
STEMS = range(4, 9)
HEAVIEST = 6.0
# Characters from which on the length lowers the score.
LONG = 6000
# A phrase around an entry that this many clean documents have, and no toxic one, is an exception.
EXCEPTION = 3

# Characters that look like Latin letters, and digits that stand for letters.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "һ": "h", "і": "i", "ї": "i", "ј": "j", "к": "k",
    "ӏ": "l", "м": "m", "н": "h", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "у": "y", "ԝ": "w", "х": "x",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u",
    "χ": "x", "ω": "w", "ı": "i", "ł": "l", "ø": "o", "đ": "d",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g"}
SIGNS = {"@": "a", "$": "s", "!": "i"}

_TABLE = {ord(k): v for k, v in (HOMOGLYPHS | DIGITS).items()}
_TABLE |= {c: None for c in range(0x300, 0x370)}  # accents, once they stand alone
_TABLE |= {c: " " for c in range(128) if not chr(c).isalnum()}
_TABLE |= {ord(c): " " for c in "«»„“”‘’–—…¡¿·。，、   　"}
_TABLE |= {ord(c): None for c in "​‌‍⁠﻿­"}
_INNER = re.compile(r"(?<=[^\W_])[@$!](?=[^\W_])")


def fold(text: str) -> str:
    """Lower case without accents, homoglyphs and digits for letters; spaces between words and around."""
    text = text.lower()
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text)
    if "@" in text or "$" in text or "!" in text:
        text = _INNER.sub(lambda found: SIGNS[found[0]], text)
    return f" {text.translate(_TABLE)} "


def features(folded: str) -> set[str]:
    """Possible entries: each word with a space on both sides, and its beginnings with one before."""
    words = set(folded.split())
    return {f" {word} " for word in words} | {f" {word[:n]}" for word in words for n in STEMS if len(word) >= n}


def sketch(folded: str) -> int:
    """The smallest hash of three-word shingles; near copies mostly share it."""
    words = folded.split()
    shingles = zip(words, words[1:], words[2:], strict=False) if len(words) > 3 else [words]
    return min(xxhash.xxh64_intdigest(" ".join(s)) for s in shingles) >> 1


def evidence(toxic: int, clean: int, all_toxic: int, all_clean: int) -> float:
    """G squared of an entry's documents against the classes; 0 if it is not a sign of toxic ones."""
    n, total = toxic + clean, all_toxic + all_clean
    if not n or toxic * total <= n * all_toxic:
        return 0.0
    cells = ((toxic, n, all_toxic), (clean, n, all_clean))
    cells += ((all_toxic - toxic, total - n, all_toxic), (all_clean - clean, total - n, all_clean))
    return 2 * sum(seen * math.log(seen * total / (row * column)) for seen, row, column in cells if seen)


def select(rows: Iterable[tuple[str, int, int]], all_toxic: int, all_clean: int) -> dict[str, float]:
    """Entries and weights from (entry, toxic documents, clean documents), best first.

    An entry that begins or continues a better one is left out, so a word counts once.
    """
    scored = [(evidence(t, c, all_toxic, all_clean), entry, t, c) for entry, t, c in rows if t >= LEAST_TOXIC]
    scored = [row for row in scored if row[0] >= EVIDENCE]
    scored.sort(key=lambda row: (-row[0], row[1].endswith(" "), -len(row[1]), row[1]))
    chosen: dict[str, float] = {}
    begun: set[str] = set()
    for _, entry, t, c in scored:
        if len(chosen) == ENTRIES:
            break
        if entry in begun or any(entry[:n] in chosen for n in range(2, len(entry))):
            continue
        odds = math.log((t + 0.5) / (all_toxic + 1)) - math.log((c + 0.5) / (all_clean + 1))
        if odds < LIGHTEST:
            continue
        chosen[entry] = min(HEAVIEST, odds)
        begun.update(entry[:n] for n in range(2, len(entry) + 1))
    return chosen


class Matcher:
    """Finds entries and exceptions in one pass over a folded text."""

    def __init__(self, entries: dict[str, float], exceptions: Iterable[str] = ()) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for entry, weight in entries.items():
            self.automaton.add_word(entry, (len(entry), weight))
        for phrase in exceptions:
            self.automaton.add_word(phrase, (len(phrase), None))
        self.empty = not entries
        if not self.empty:
            self.automaton.make_automaton()

    def hits(self, folded: str) -> list[tuple[int, int, float]]:
        """(start, end, weight) of the entries that lie in no exception."""
        if self.empty:
            return []
        found = [(end + 1 - size, end + 1, weight) for end, (size, weight) in self.automaton.iter(folded)]
        spans = [(start, end) for start, end, weight in found if weight is None]
        found = [hit for hit in found if hit[2] is not None]
        return [hit for hit in found if not any(a <= hit[0] and hit[1] <= b for a, b in spans)] if spans else found

    def raw(self, folded: str) -> float:
        """The weights that were hit, lowered for long texts."""
        return sum(hit[2] for hit in self.hits(folded)) / math.sqrt(1 + len(folded) / LONG)


def phrases(folded: str, hits: list[tuple[int, int, float]]) -> set[str]:
    """The word of each hit with the word before it, and with the one after it."""
    found: set[str] = set()
    for start, end, _ in hits:
        stop = folded.find(" ", end - 1 if folded[end - 1] == " " else end)
        word = folded[start + 1 : stop]
        before, after = folded[max(0, start - 100) : start].split(), folded[stop : stop + 100].split()
        found.update([f" {before[-1]} {word} "] if before and folded[start - 1 : start] != " " else [])
        found.update([f" {word} {after[0]} "] if after and folded[stop + 1 : stop + 2] != " " else [])
    return found


def logistic(pairs: list[tuple[float, int]]) -> tuple[float, float]:
    """Slope and intercept of a lightly held-back logistic regression on one number."""
    slope = 0.0
    n, ones = len(pairs), sum(y for _, y in pairs)
    intercept = math.log((ones + 1) / (n - ones + 1))
    for _ in range(50):
        g0, g1, h00, h01, h11 = 0.0, -0.05 * slope, 1e-6, 0.0, 0.05
        for x, y in pairs:
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, intercept + slope * x))))
            g0, g1 = g0 + y - p, g1 + (y - p) * x
            w = p * (1 - p)
            h00, h01, h11 = h00 + w, h01 + w * x, h11 + w * x * x
        det = h00 * h11 - h01 * h01
        if det <= 0:
            break
        step0, step1 = (h11 * g0 - h01 * g1) / det, (h00 * g1 - h01 * g0) / det
        intercept, slope = intercept + max(-2.0, min(2.0, step0)), slope + max(-1.0, min(1.0, step1))
        if abs(step0) + abs(step1) < 1e-7:
            break
    return max(0.0, slope), intercept


@dataclass(frozen=True)
class Lexicon:
    entries: dict[str, float]
    exceptions: tuple[str, ...]
    slope: float
    intercept: float

    def scorer(self):
        matcher, slope, intercept = Matcher(self.entries, self.exceptions), self.slope, self.intercept

        def score(text: str | None) -> float:
            raw = matcher.raw(fold(text)) if text else 0.0
            return 1 / (1 + math.exp(-max(-30.0, min(30.0, intercept + slope * raw))))

        return score


def held_out(id_column: str = "doc_id"):
    """Rows that nothing is learned from; a null id is not one of them."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 3 == 1, F.lit(False))


def _per_text(frame: DataFrame, run, schema: str) -> DataFrame:
    """Rows that ``run`` makes of the batches of (text, toxic, fold), as lists of tuples."""

    def batches(items: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none_per_worker()
        names = [part.split()[0] for part in schema.split(", ")]
        for rows in run((zip(*(c.to_pylist() for c in b.columns), strict=True) for b in items)):
            columns = list(zip(*rows, strict=True)) or [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], names)

    types = {"string": pa.string(), "bigint": pa.int64(), "double": pa.float64(), "array<string>": pa.list_(pa.string())}
    kinds = [types[part.split()[1]] for part in schema.split(", ")]
    return frame.mapInArrow(batches, schema)


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Lexicon:
    """Learn entries, weights, exceptions and the scale of the score from labelled documents.

    ``labels`` has doc_id and toxic (0, 1 or null); held-out ids are left out. At most ``sample`` labelled rows are
    used, the first by hash of the id; near copies among them count once. Counting is a job over those texts;
    only entries with enough evidence, at most ``CANDIDATES``, and a pair of numbers per sampled row come to the driver. The scale is
    fitted on scores by entries of the other half. Without both classes the score is their smoothed share.
    """
    known = labels.filter(~held_out() & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("bigint").alias("toxic"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).withColumnRenamed("doc_id", "label_id")
    known = materialise(known, "labelled")
    texts = docs.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("label_id"))
    fold_of = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(2)).alias("fold")
    texts = materialise(texts.select(F.coalesce("text", F.lit("")).alias("text"), "toxic", fold_of, "doc_id"), "texts")

    def sketches(batches):
        for rows in batches:
            yield [(doc, sketch(fold(text))) for text, _, _, doc in rows]

    first = _per_text(texts, sketches, "first_id bigint, sketch bigint")
    first = materialise(first.groupBy("sketch").agg(F.min("first_id").alias("first_id")).select("first_id"), "firsts")
    texts = texts.join(F.broadcast(first), F.col("doc_id") == F.col("first_id"), "left_semi").select("text", "toxic", "fold")
    texts = materialise(texts.distinct(), "distinct")
    totals = {(r["toxic"], r["fold"]): r["n"] for r in texts.groupBy("toxic", "fold").agg(F.count("*").alias("n")).collect()}
    sums = {y: sum(n for (toxic, _), n in totals.items() if toxic == y) for y in (0, 1)}
    if not sums[0] or not sums[1]:
        return Lexicon({}, (), 0.0, math.log((sums[1] + 1) / (sums[0] + 1)))

    def counted(batches):
        seen: Counter[tuple[str, int, int]] = Counter()
        for rows in batches:
            for text, toxic, part in rows:
                seen.update((entry, toxic, part) for entry in features(fold(text)))
        yield [(*key, n) for key, n in seen.items()]

    counts = _per_text(texts, counted, "entry string, toxic bigint, fold bigint, n bigint").groupBy("entry")
    cell = {(y, f): F.sum(F.when((F.col("toxic") == y) & (F.col("fold") == f), F.col("n"))) for y in (0, 1) for f in (0, 1)}
    counts = counts.agg(*(F.coalesce(c, F.lit(0)).alias(f"n{y}{f}") for (y, f), c in cell.items()))
    toxic, clean = F.col("n10") + F.col("n11"), F.col("n00") + F.col("n01")
    counts = counts.filter((toxic >= LEAST_TOXIC) & (toxic * sums[0] > clean * sums[1]))
    best = counts.orderBy((toxic * sums[0] / (clean * sums[1] + 1) * toxic).desc(), "entry").limit(CANDIDATES).collect()
    halves = [
        select(((r["entry"], r[f"n1{f}"], r[f"n0{f}"]) for r in best), totals.get((1, f), 0), totals.get((0, f), 0))
        for f in (0, 1)
    ]
    entries = select(((r["entry"], r["n10"] + r["n11"], r["n00"] + r["n01"]) for r in best), sums[1], sums[0])

    def judged(batches):
        matchers, whole = [Matcher(half) for half in halves], Matcher(entries)
        for rows in batches:
            out = []
            for text, y, part in rows:
                folded = fold(text)
                out.append((y, matchers[1 - part].raw(folded), sorted(phrases(folded, whole.hits(folded)))))
            yield out

    judged_rows = materialise(_per_text(texts, judged, "toxic bigint, raw double, phrases array<string>"), "judged")
    around = judged_rows.select(F.explode("phrases").alias("phrase"), "toxic").groupBy("phrase")
    around = around.agg(F.sum("toxic").alias("toxic"), F.count("*").alias("n"))
    exceptions = around.filter((F.col("toxic") == 0) & (F.col("n") >= EXCEPTION)).orderBy(F.desc("n"), "phrase").limit(ENTRIES)
    pairs = sorted((r["raw"], r["toxic"]) for r in judged_rows.select("raw", "toxic").collect())
    slope, intercept = logistic(pairs)
    return Lexicon(entries, tuple(r["phrase"] for r in exceptions.collect()), slope, intercept)


def scores(docs: DataFrame, lexicon: Lexicon, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, score) of every row over its whole text, without a shuffle. Null and empty texts hit nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none_per_worker()
        score = lexicon.scorer()
        for batch in batches:
            found = [score(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], ["doc_id", "score"])

    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")


def clean_documents(docs: DataFrame, lexicon: Lexicon, threshold: float = THRESHOLD, text_column: str = "text") -> DataFrame:
    """The rows, with all their columns, whose score is below the threshold."""
    at = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none_per_worker()
        score = lexicon.scorer()
        for batch in batches:
            found = pa.array([score(text.as_py()) for text in batch.column(at)], pa.float64())
            yield batch.filter(pc.less(found, threshold))

    return docs.mapInArrow(run, docs.schema)
