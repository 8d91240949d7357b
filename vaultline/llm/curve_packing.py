"""Packing of documents along a space-filling curve, so that documents of a sequence resemble each other."""

from __future__ import annotations

import itertools
import json
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultline.llm.common import bytes_of_signs, materialise, per_worker

CAPACITY = 2048
# The id after the last token of each document.
END = 1
LAST = END.to_bytes(4, "little")
# Entries of the hashed vector of a document, dimensions it is projected to, and bits of the curve per dimension.
ENTRIES = 1024
DIMENSIONS = 4
BITS = 15
SEED = 11
# Units whose ids a worker remembers, so that frequent words are encoded once.
REMEMBERED = 500_000
# Text and units in one call: bounds what a task holds besides.
BATCH_BYTES = 1 << 20
BATCH_UNITS = 4096
# A space that does not follow a character that is no white space for sure.
UNSAFE = re.compile(r"(?:^|[^!-~À-ɏЀ-ӿ一-鿿]) ")
# A place before a space that does.
BOUNDARY = re.compile(r"(?<=[!-~À-ɏЀ-ӿ一-鿿])(?= )")
# Marks of ASCII; behind letters they are words of their own.
MARKS = "".join(c for c in map(chr, range(0x21, 0x7F)) if not c.isalnum())
# Letters that every version of the tables of Unicode knows: with a space in front one word of the tokenizer's pattern.
LETTERS = re.compile(r"[A-Za-zÀ-ÖØ-öø-ɏ]+")
# Multiplier of a hash: 2^32 over the golden ratio.
ODD = np.uint32(0x9E3779B1)


class ByteEncoder:
    """Token ids of texts for a byte-level tokenizer that never joins a character with white space after it.

    A text is cut before each space that follows another character. No token crosses such a place: the
    pattern of words takes white space only in front of a word or alone, and special tokens have none inside. So units
    that were met before are looked up, and a very long text is many small calls. Other tokenizers get whole texts.

    New units of letters alone are one word each, whose ids follow from the vocabulary. Many of them are encoded in one call of a
    library that is faster at this, made from the same vocabulary; the ids that begin with a space show where
    each unit starts. All else goes through the tokenizer itself.
    """

    def __init__(self, tokenizer_file: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        words, added = self.tokenizer.pre_tokenizer, self.tokenizer.get_added_tokens_decoder().values()
        self.splits = (
            self.tokenizer.normalizer is None
            and isinstance(words, ByteLevel) and words.use_regex and not words.add_prefix_space
            and not any(re.search(r"\s", t.content) or t.lstrip or t.rstrip or t.single_word for t in added)
        )
        self.known: dict[str, bytes] = {}
        self.spaced: dict[str, bytes] = {}
        self.words, self.opens = _merger(json.loads(self.tokenizer.to_str())["model"]) if self.splits else (None, None)

    def _word_ids(self, words: list[str]) -> Iterator[bytes]:
        """The ids of each of the words, which are letters alone, with a space in front."""
        for start in range(0, len(words), BATCH_UNITS):
            some = words[start : start + BATCH_UNITS]
            ids = np.array(self.words.encode_ordinary(" ".join(["", *some])), "<u4")
            at = (4 * np.flatnonzero(self.opens[ids])).tolist()
            if len(at) != len(some):
                raise ValueError("a word does not begin with one space")
            packed = ids.tobytes()
            yield from map(packed.__getitem__, map(slice, at, [*at[1:], len(packed)]))

    def _ids(self, texts: list[str]) -> Iterator[bytes]:
        for start in range(0, len(texts), BATCH_UNITS):
            for item in self.tokenizer.encode_batch_fast(texts[start : start + BATCH_UNITS], add_special_tokens=False):
                ids = item.ids
                yield struct.pack(f"<{len(ids)}I", *ids)

    def _learn(self, lone: set[str], behind: list[str]) -> tuple[set[str], set[str]]:
        """Remember the ids of units, and of parts with a space in front; gives what was not known before of either."""
        known, spaced = self.known, self.spaced
        rest, words, others = set(), set(), set()
        # Units and parts that end with marks, and their stems: each is looked up alone.
        marked = {unit: stem for unit in lone if (stem := unit.rstrip(MARKS)) != unit and stem.removeprefix(" ").isalpha()}
        rest.update(lone.difference(marked))
        ends: dict[str, str] = {}
        for part in behind:
            if part.isalpha() and (part.isascii() or LETTERS.fullmatch(part)):
                words.add(part)
            elif (stem := part.rstrip(MARKS)) != part and stem.isalpha():
                ends[part] = stem
            else:
                others.add(part)
        for stem in ends.values():
            if stem not in spaced:
                (words if stem.isascii() or LETTERS.fullmatch(stem) else others).add(stem)
        stems = {*marked.values(), *(unit[len(stem) :] for some in (marked, ends) for unit, stem in some.items())}
        rest.update(unit for unit in stems if unit not in known)
        if not self.words:
            others |= words
            words = set()
        for own, units, ids in ((known, list(rest), self._ids), (spaced, list(words), self._word_ids)):
            own.update(zip(units, ids(units), strict=True))
        spaced.update(zip(others, self._ids([" " + part for part in others]), strict=True))
        for own, some in ((known, marked), (spaced, ends)):
            own.update((unit, own[stem] + known[unit[len(stem) :]]) for unit, stem in some.items())
        return rest.union(marked), words.union(others, ends)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, little-endian, four bytes each."""
        if not self.splits:
            return list(self._ids(texts))
        known, spaced = self.known, self.spaced
        # Most texts are parts with one space between: Arrow splits and numbers them, and each distinct one is looked up once, without
        # its space. The first part of a text has none; the units of other texts are looked up one by one.
        column = pa.array(texts, pa.large_string())
        unsafe = pc.match_substring_regex(column, UNSAFE.pattern)
        cut = {i: BOUNDARY.split(texts[i]) for i in np.flatnonzero(unsafe.to_numpy(zero_copy_only=False)).tolist()}
        split = pc.split_pattern(pc.if_else(unsafe, pa.scalar("", pa.large_string()), column), " ")
        at = split.offsets.to_numpy()
        numbered = split.values.dictionary_encode()
        index = numbered.indices.to_numpy().astype(np.int64)
        heads = split.values.take(pa.array(at[:-1])).to_pylist()
        distinct = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        follows = np.ones(len(index), bool)
        follows[at[:-1]] = False
        used = np.bincount(index[follows], minlength=len(distinct)) > 0
        lone = set(heads).union(*cut.values()).difference(known)
        behind = [part for part in itertools.compress(distinct, used.tolist()) if part not in spaced]
        new_known, new_spaced = self._learn(lone, behind)
        found = list(map(spaced.get, distinct, itertools.repeat(b"")))  # those that only begin texts may be missing, and are not used
        found += [b"".join(map(known.__getitem__, cut[i])) if i in cut else known[head] for i, head in enumerate(heads)]
        index[at[:-1]] = np.arange(len(distinct), len(found))
        ends = np.cumsum([0, *map(len, found)], dtype=np.int64)
        ids = pa.Array.from_buffers(pa.large_binary(), len(found), [None, *map(pa.py_buffer, (ends, b"".join(found)))])
        _, starts, packed = ids.take(pa.array(index)).buffers()
        places = np.frombuffer(starts, np.int64)[at].tolist()
        if len(known) + len(spaced) > REMEMBERED:  # frequent units came first; the new ones are rare
            for unit in new_known:
                del known[unit]
            for part in new_spaced:
                del spaced[part]
        return [packed[start:end].to_pybytes() for start, end in itertools.pairwise(places)] if texts else []


def _merger(model: dict[str, object]):
    """A second library's encoder of words with the merges of a byte-level model, and which ids begin with a space.

    That library merges the pair whose result has the lowest id. It is only taken if the ids of the model are in the order of its merges; else None.
    """
    import tiktoken
    from tokenizers.pre_tokenizers import ByteLevel

    byte_of, vocabulary = bytes_of_signs(), model["vocab"]
    merged = ["".join(pair) for pair in (m.split(" ") if isinstance(m, str) else m for m in model["merges"])]
    ordered = [vocabulary[token] for token in merged]
    if set(byte_of) != set(ByteLevel.alphabet()) or any(a >= b for a, b in itertools.pairwise([255, *ordered])):
        return None, None
    tokens = [*byte_of, *merged]
    ranks = {bytes(byte_of[c] for c in token): vocabulary[token] for token in tokens}
    opens = np.zeros(max(ranks.values()) + 1, bool)
    opens[[rank for token, rank in ranks.items() if token[:1] == b" "]] = True
    return tiktoken.Encoding("words", pat_str=r" ?\p{L}+", mergeable_ranks=ranks, special_tokens={}), opens


def projection(entries: int = ENTRIES, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Random signs, the same on every machine: each entry's direction in the space of few dimensions."""
    return np.random.RandomState(SEED).choice([-1.0, 1.0], (entries, dimensions))


def slots_of(vocabulary: int, entries: int = ENTRIES) -> np.ndarray:
    """The entry of the hashed vector that each token id falls in."""
    ids = np.arange(vocabulary, dtype=np.uint32)
    return ((ids * ODD) >> np.uint32(32 - (entries - 1).bit_length())).astype(np.intp)


def hashed_vector(ids: np.ndarray, slots: np.ndarray, entries: int = ENTRIES) -> np.ndarray:
    """Counts of the tokens by the hash of their id, damped by the root, of length 1; zero without tokens."""
    # The squares of roots are the counts, which add up to the number of tokens.
    return np.sqrt(np.bincount(slots[ids], minlength=entries) / max(1, len(ids)))


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The places on the Hilbert curve of points (rows) with coordinates in [0, 2^bits).

    From the highest bit to the lowest, each dimension's bit mirrors or swaps the lower bits of the
    first dimension and its own, so that every cell's part of the curve begins where the last one ended. What remains is a
    Gray code over the dimensions, whose rank is read off bit by bit.
    """
    x = points.astype(np.int64).T.copy()
    dimensions = len(x)
    for level in range(bits - 1, 0, -1):
        lower = (1 << level) - 1
        for d in range(dimensions):
            mirrored = (x[d] >> level & 1).astype(bool)
            swapped = np.where(mirrored, 0, (x[0] ^ x[d]) & lower)
            x[0] ^= np.where(mirrored, lower, swapped)
            x[d] ^= swapped
    keys = np.zeros(x.shape[1], np.int64)
    parity = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, -1, -1):
        for d in range(dimensions):
            parity ^= x[d] >> level & 1
            keys = keys << 1 | parity
    return keys


def curve_keys(vectors: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Hilbert keys of projected vectors. Their coordinates are about normal; the logistic curve spreads them evenly."""
    even = 1 / (1 + np.exp(-1.702 * vectors))
    return hilbert_keys(np.minimum((even * (1 << bits)).astype(np.int64), (1 << bits) - 1), bits)


def encoded_documents(docs: DataFrame, tokenizer_file: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(row_id, doc_id, curve, doc_tokens, ids) of every row, without a shuffle.

    ``row_id`` is the number of the task and of the row in it, so it is only fixed once the rows are written. ``ids`` are
    those of the whole text and the end, compact: two bytes each if all ids fit.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = per_worker(f"bytes {tokenizer_file}", lambda: ByteEncoder(tokenizer_file))
        narrow = _narrow(encoder.tokenizer.get_vocab_size())
        directions, slots = projection(), slots_of(encoder.tokenizer.get_vocab_size())
        row_id = TaskContext.get().partitionId() << 40

        def encoded(doc_ids: pa.Array, texts: list[str]) -> pa.RecordBatch:
            nonlocal row_id
            ids = [np.frombuffer(found + LAST, "<u4") for found in encoder.encode(texts)]
            keys = curve_keys(np.array([hashed_vector(own[:-1], slots) for own in ids]) @ directions)
            arrays = [pa.array(np.arange(row_id, row_id + len(ids))), doc_ids, pa.array(keys)]
            arrays += [pa.array(list(map(len, ids)), pa.int64()), pa.array([own.astype(narrow).tobytes() for own in ids], pa.binary())]
            row_id += len(ids)
            return pa.RecordBatch.from_arrays(arrays, ["row_id", "doc_id", "curve", "doc_tokens", "ids"])

        for batch in batches:
            group: list[str] = []
            first, size = 0, 0
            for value in batch.column(1):
                group.append(value.as_py() or "")
                size += len(group[-1])
                if size >= BATCH_BYTES:
                    yield encoded(batch.column(0).slice(first, len(group)), group)
                    first, group, size = first + len(group), [], 0
            if group:
                yield encoded(batch.column(0).slice(first, len(group)), group)

    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"row_id bigint, doc_id {id_type}, curve bigint, doc_tokens bigint, ids binary")


def _narrow(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def starts_along_the_curve(encoded: DataFrame) -> DataFrame:
    """(row_id, from): the tokens of all documents that come before on the curve.

    Rows are range-sorted by curve and row, so copies of one text, which share a place on the curve, are dealt over tasks, too. A window
    adds up each range, a second one the sums of the ranges.
    """
    ranges = int(encoded.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    light = encoded.select("row_id", "curve", "doc_tokens").repartitionByRange(ranges, "curve", "row_id")
    light = materialise(light.withColumn("range", F.spark_partition_id()), "curve")
    sums = light.groupBy("range").agg(F.sum("doc_tokens").alias("tokens"))
    # One row per range.
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("range", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("range").orderBy("curve", "row_id").rowsBetween(Window.unboundedPreceding, -1)
    inner = light.select("row_id", "range", F.coalesce(F.sum("doc_tokens").over(inside), F.lit(0)).alias("inner"))
    return inner.join(F.broadcast(sums), "range").select("row_id", (F.col("base") + F.col("inner")).alias("from"))


def tail_cuts(total: int, capacity: int) -> list[int]:
    """Where the sequences after the last full one begin, and the total: parts of powers of two, which need no padding."""
    rest = total % capacity
    cuts, at = [], total - rest
    for bit in range(rest.bit_length() - 1, -1, -1):
        if rest >> bit & 1:
            cuts.append(at)
            at += 1 << bit
    return [*cuts, total] if cuts else [total]


def pieces_of(start: int, tokens: int, tail: list[int], capacity: int) -> Iterator[tuple[int, int, int, int]]:
    """(start, length, sequence, offset) of the pieces of a document whose tokens begin at ``start`` of the whole."""
    at, end = start, start + tokens
    while at < end:
        if at < tail[0]:
            sequence, first = at // capacity, at - at % capacity
            close = first + capacity
        else:
            part = max(i for i, cut in enumerate(tail[:-1]) if cut <= at)
            sequence, first, close = tail[0] // capacity + part, tail[part], tail[part + 1]
        stop = min(end, close)
        yield at - start, stop - at, sequence, at - first
        at = stop


def curve_packing(
    docs: DataFrame,
    tokenizer_file: str,
    capacity: int = CAPACITY,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset): all documents, in sequences along the curve.

    A document is the ids of its text and the end id. Its hashed vector is projected to a few dimensions; the documents
    are put in the order of the Hilbert curve through that space, one after the other, and cut every
    ``capacity`` tokens. So a sequence holds documents that are near each other, all sequences are full, and what is left at
    the end is cut into parts of powers of two, at most one of each: nothing is padded.

    A null or empty text is the end id alone. Ids may be null or repeat; each row is packed. Of other columns none is
    used. An empty table gives no rows. ``tokenizer_file`` must be at that path on every executor.
    """
    encoded = materialise(encoded_documents(docs, tokenizer_file, id_column, text_column), "encoded")
    total = encoded.agg(F.sum("doc_tokens")).first()[0] or 0
    tail = tail_cuts(total, capacity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_worker(f"bytes {tokenizer_file}", lambda: ByteEncoder(tokenizer_file))
        narrow = _narrow(encoder.tokenizer.get_vocab_size())
        for batch in batches:
            rows = []
            starts, tokens, packed = batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3)
            for i, (start, n) in enumerate(zip(starts, tokens, strict=True)):
                ids = memoryview(np.frombuffer(packed[i].as_buffer(), narrow).astype("<u4")).cast("B")
                for at, length, sequence, offset in pieces_of(start, n, tail, capacity):
                    rows.append((i, at, length, zlib.crc32(ids[4 * at : 4 * (at + length)]), n, sequence, offset))
            if rows:
                at, *columns = zip(*rows, strict=True)
                arrays = [batch.column(0).take(pa.array(at)), *(pa.array(values, pa.int64()) for values in columns)]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
                yield pa.RecordBatch.from_arrays(arrays, names)

    starts = materialise(starts_along_the_curve(encoded), "starts")
    placed = encoded.select("row_id", "doc_id", "doc_tokens", "ids").join(starts.hint("shuffle_hash"), "row_id")
    id_type = encoded.schema["doc_id"].dataType.simpleString()
    names = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    return placed.select("doc_id", "from", "doc_tokens", "ids").mapInArrow(
        run, f"doc_id {id_type}, " + ", ".join(f"{name} bigint" for name in names)
    )
