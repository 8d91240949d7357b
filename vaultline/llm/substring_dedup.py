"""Removal of word passages that occur earlier in the corpus, by level-wise doubling."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultline.llm.common import materialise, text_of

WINDOW = 20
# Length of the first level; it is doubled until the window is reached.
FIRST = 10
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """128 bits of each word, as two columns."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), "<u8").reshape(-1, 2)


def window_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of every run of ``length`` words, put together from runs of half the length."""
    if length == 1:
        return hashes
    half = length // 2
    left = window_hashes(hashes, half)
    shift = np.uint64(pow(int(MULTIPLIER), half, 1 << 64))
    double = left[: len(left) - half] * shift + left[half:]
    return double if length % 2 == 0 else double[: len(double) - 1] * MULTIPLIER + hashes[length - 1 :]


def mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(32))
    values = values * MULTIPLIER
    return values ^ (values >> np.uint64(29))


def sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """The least or largest of every ``width`` neighbours; ``best`` is numpy's minimum or maximum."""
    size = 1
    while 2 * size <= width:
        values, size = best(values[: len(values) - size], values[size:]), 2 * size
    rest = width - size
    return best(values[: len(values) - rest], values[rest:]) if rest else values


class Windows:
    """The windows of one document, each represented at a level by the least hash among its shorter runs.

    Equal windows have equal representatives, so a window can only be repeated if its representative is. A
    representative serves all neighbouring windows that share it: some 2 in 12 runs have to be looked at.
    """

    def __init__(self, hashes: np.ndarray, length: int, window: int) -> None:
        self.values = mixed(window_hashes(hashes[:, 0], length))
        self.width = window - length + 1
        self.least = sliding(self.values, self.width, np.minimum)

    def representatives(self, windows: np.ndarray | None = None) -> np.ndarray:
        """Where the representatives start, of all windows or of those marked."""
        least = self.least if windows is None else np.where(windows, self.least, 0)
        around = np.pad(least, self.width - 1)
        return np.flatnonzero(sliding(around, self.width, np.maximum) == self.values)

    def marked(self, repeated: np.ndarray) -> np.ndarray:
        """For each window whether its representative is among those that start at ``repeated``."""
        values = np.full(len(self.values), TOP)
        repeated = repeated[repeated < len(values)]
        values[repeated] = self.values[repeated]
        return sliding(values, self.width, np.minimum) == self.least


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def _packed(docs: DataFrame) -> DataFrame:
    """(doc_id, packed): texts compressed, as they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            packed = [packer.compress((text.as_py() or "").encode("utf-8", "surrogatepass")) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], ["doc_id", "packed"])

    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, packed binary")


def _unpacked(packed: bytes) -> list[bytes]:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(packed).split()


def _level(docs: DataFrame, marks: DataFrame | None, length: int, before: int, window: int) -> DataFrame:
    """(doc_id, places): where the representatives start that occur more than once at this level.

    ``marks`` has the places of the level before; only windows that those left are looked at. A batch of rows
    sends each hash once: what repeats inside the batch is known there already, and no hash is more rows than there
    are batches.
    """

    extends = marks is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for at, item in enumerate(batch.column(1)):
                words = _unpacked(item.as_py()) if extends else _words(item.as_py())
                if len(words) < window:
                    continue
                hashes = word_hashes(words)
                left = None
                if extends:
                    left = Windows(hashes, before, window).marked(np.asarray(batch.column(2)[at].as_py(), np.int64))
                level = Windows(hashes, length, window)
                places = level.representatives(left)
                rows.append((level.values[places], np.full(len(places), at), places))
            if not rows:
                continue
            values, docs_at, places = (np.concatenate(part) for part in zip(*rows, strict=True))
            _, first, number = np.unique(values, return_index=True, return_inverse=True)[:3]
            times = np.bincount(number)
            repeated = times[number] > 1
            # Besides the places, one witness of each hash that repeats here, for the other batches.
            witness = first[times > 1]
            order = np.concatenate([np.arange(len(values)), witness])
            known = np.concatenate([repeated, np.zeros(len(witness), bool)])
            place = np.concatenate([places, np.full(len(witness), -1)])
            arrays = [
                pa.array(values[order].view(np.int64)),
                batch.column(0).take(pa.array(docs_at[order])),
                pa.array(place.astype(np.int32)),
                pa.array(known),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["hash", "doc_id", "place", "known"])

    source = docs if marks is None else docs.join(marks, "doc_id").select("doc_id", "packed", "places")
    id_type = source.schema["doc_id"].dataType.simpleString()
    found = source.mapInArrow(run, f"hash bigint, doc_id {id_type}, place int, known boolean")
    # All rows pass one shuffle; those that are known to repeat go to places of their own.
    key = F.when(F.col("known"), F.xxhash64("hash", "doc_id", "place")).otherwise(F.col("hash"))
    met = Window.partitionBy(key, "known")
    found = found.withColumn("met", F.count("*").over(met))
    found = found.filter("place >= 0 and (known or met > 1)")
    return found.groupBy("doc_id").agg(F.collect_list("place").alias("places"))


def _firsts(docs: DataFrame, marks: DataFrame, length: int, window: int) -> DataFrame:
    """(doc_id, firsts): of the windows still left, where those start that occur nowhere earlier."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, item in enumerate(batch.column(1)):
                hashes = word_hashes(_unpacked(item.as_py()))
                if len(hashes) < window:
                    continue
                left = Windows(hashes, length, window).marked(np.asarray(batch.column(2)[at].as_py(), np.int64))
                starts = np.flatnonzero(left)
                one, two = (window_hashes(hashes[:, i], window)[starts] for i in (0, 1))
                order = np.lexsort((starts, two, one))
                new = np.ones(len(order), bool)
                new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
                order = order[new]  # of equal windows of this document the first alone
                arrays = [
                    pa.array(one[order].view(np.int64)),
                    pa.array(two[order].view(np.int64)),
                    batch.column(0).take(pa.array(np.full(len(order), at))),
                    pa.array(starts[order].astype(np.int32)),
                ]
                yield pa.RecordBatch.from_arrays(arrays, ["one", "two", "doc_id", "start"])

    source = docs.join(marks.filter("not copy and places is not null"), "doc_id").select("doc_id", "packed", "places")
    id_type = source.schema["doc_id"].dataType.simpleString()
    found = source.mapInArrow(run, f"one bigint, two bigint, doc_id {id_type}, start int").groupBy("one", "two")
    found = found.agg(F.min("doc_id").alias("doc_id"), F.min_by("start", "doc_id").alias("start"))
    return found.groupBy("doc_id").agg(F.collect_list("start").alias("firsts"))


def _copies(docs: DataFrame) -> DataFrame:
    """(doc_id) of documents whose whole text a smaller id has, too."""
    rows = docs.select("doc_id", F.unhex(F.sha2(text_of("text"), 256)).alias("digest"))
    rows = materialise(rows.groupBy("doc_id").agg(F.min("digest").alias("digest"), F.max("digest").alias("last")), "digests")
    groups = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).filter("n > 1")
    groups = materialise(groups.select("digest", "first"), "groups")
    return rows.filter("digest = last").join(groups, "digest").filter("doc_id > first").select("doc_id")


def substring_dedup(
    docs: DataFrame,
    window: int = WINDOW,
    first: int = FIRST,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(doc_id, text, n_words, n_removed) of every row: the text without words that an earlier passage covers.

    A window is ``window`` consecutive words of a document. All words of a window go whose word sequence also starts
    earlier: in a document with a smaller id, or before in the same one. What stays is joined by single spaces.

    Runs of ``first`` words, some in every window, that occur once are dropped, what is left is extended to runs of
    twice that length, and so on; at the length of the window, each of those that still are candidates is
    kept at its first place alone. The first level hashes to 64 bits, the last to 128. Whole copies are told apart before, so
    only one of each group enters the last level. Texts are shuffled by id, compressed.

    Null texts have no words. Rows without an id neither remove nor lose anything. Rows that share an id count as
    one document: what is the first place in one of them stays in all. An empty table gives no rows.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    named = rows.filter("doc_id is not null")
    length = window
    while length % 2 == 0 and length // 2 >= first:
        length //= 2
    places = materialise(_level(named, None, length, length, window), "places")
    packed = _packed(rows)
    while 2 * length < window:
        places = materialise(_level(packed, places, 2 * length, length, window), "places")
        length *= 2
    copies = _copies(named).withColumn("copy", F.lit(True))
    marks = places.join(copies, "doc_id", "full").withColumn("copy", F.coalesce("copy", F.lit(False)))
    marks = materialise(marks, "marks")
    firsts = materialise(_firsts(packed, marks, length, window), "firsts")
    marks = marks.join(firsts, "doc_id", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, totals, removed = [], [], []
            for item, where, copy, kept_at in zip(*(batch.column(i) for i in range(1, 5)), strict=True):
                words = _unpacked(item.as_py())
                gone = np.zeros(len(words), bool)
                if len(words) >= window and copy.as_py():
                    gone[:] = True
                elif len(words) >= window and where.is_valid:
                    hashes = word_hashes(words)
                    later = Windows(hashes, length, window).marked(np.asarray(where.as_py(), np.int64))
                    stay = np.asarray(kept_at.as_py() or [], np.int64)
                    later[stay[stay < len(later)]] = False
                    steps = np.zeros(len(words) + 1, np.int64)
                    starts = np.flatnonzero(later)
                    steps[starts] += 1
                    steps[starts + window] -= 1
                    gone = np.cumsum(steps)[:-1] > 0
                kept = words if not gone.any() else [words[i] for i in np.flatnonzero(~gone)]
                texts.append(b" ".join(kept).decode("utf-8", "surrogatepass"))
                totals.append(len(words))
                removed.append(int(gone.sum()))
            arrays = [batch.column(0), pa.array(texts, pa.string())]
            arrays += [pa.array(totals, pa.int64()), pa.array(removed, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "text", "n_words", "n_removed"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    joined = packed.join(marks, "doc_id", "left").select("doc_id", "packed", "places", "copy", "firsts")
    return joined.mapInArrow(run, f"doc_id {id_type}, text string, n_words bigint, n_removed bigint")
