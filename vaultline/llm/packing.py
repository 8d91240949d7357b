"""Best-fit packing of documents into sequences of a fixed number of tokens."""

from __future__ import annotations

import json
import os
import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator
from functools import reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultline.llm.common import bytes_of_signs, materialise, per_worker, running_sums, shuffle_key

CAPACITY = 2048
# The id after the last token of each document, as its four bytes.
END = bytes(4)
# Words whose ids a worker remembers, so that frequent words are encoded once.
REMEMBERED = 300_000
# Text and words in one call: bounds what a task holds besides.
BATCH_BYTES = 1 << 20
BATCH_WORDS = 4096
# Marks of ASCII.
MARKS = "".join(c for c in map(chr, range(0x21, 0x7F)) if not c.isalnum())
# Latin letters that every version of the tables of Unicode knows and that neither folding nor composing changes.
LATIN = "".join(c for c in map(chr, range(0x250)) if c.isalpha() and c == c.lower() and (c.isascii() or c >= "\xc0"))
FOLDED = re.compile(f"[{LATIN}]+")

# The normaliser and the pattern of words that words may be encoded apart with.
NORMALIZER = r'Sequence(normalizers=[NFC(), Replace(pattern=Regex("\s+"), content=" "), Lowercase()])'
PATTERN = r"""Split(pattern=Regex("'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"), behavior=Removed, invert=True)"""
WORDS_APART = f"Sequence(pretokenizers=[{PATTERN}, ByteLevel(add_prefix_space=False, trim_offsets=True, use_regex=False)])"

PIECES = "piece int, start bigint, length bigint, ids_crc32 bigint"


class Encoder:
    """Token ids of texts, as bytes, for tokenizers that treat words apart.

    White space of ASCII separates words; a tokenizer that is known to drop it and to merge nothing across it encodes each
    word once, any other gets whole texts. Upper-case A-Z are folded before words are looked up, as the tokenizer folds them anyway; only a text
    that may spell a special token stays as it is. Arrow splits the texts and numbers their words, so Python sees a word once a call.

    New words of Latin letters that nothing folds go through a library that is faster at this, made from the same vocabulary; all
    else goes through the tokenizer itself.
    """

    def __init__(self, tokenizer_file: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.by_word = (repr(self.tokenizer.normalizer), repr(self.tokenizer.pre_tokenizer)) == (NORMALIZER, WORDS_APART)
        self.known: dict[str, bytes] = {}
        self.words, self.closes = _merger(json.loads(self.tokenizer.to_str())["model"]) if self.by_word else (None, None)

    def _ids(self, texts: list[str]) -> Iterator[bytes]:
        for start in range(0, len(texts), BATCH_WORDS):
            for item in self.tokenizer.encode_batch_fast(texts[start : start + BATCH_WORDS], add_special_tokens=False):
                ids = item.ids
                yield struct.pack(f"<{len(ids)}I", *ids)

    def _word_ids(self, words: list[str]) -> Iterator[bytes]:
        """The ids of each of the words, which are letters alone that are folded already."""
        for start in range(0, len(words), BATCH_WORDS):
            some = words[start : start + BATCH_WORDS]
            ids = np.array(self.words.encode_ordinary(" ".join([*some, ""])), "<u4")
            ends = (4 * np.flatnonzero(self.closes[ids]) + 4).tolist()
            if len(ends) != len(some):
                raise ValueError("a word does not end with one space")
            packed = ids.tobytes()
            yield from map(packed.__getitem__, map(slice, [0, *ends], ends))

    def _learn(self, new: list[str]) -> set[str]:
        """Remember the ids of the words; gives what was not known before."""
        known, folded = self.known, FOLDED.fullmatch
        words, others = set(), set()
        # Marks after letters are tokens of their own; so both are looked up alone.
        ends: dict[str, tuple[str, str]] = {}
        for word in new:
            if folded(word):
                words.add(word)
                continue
            stem = word.rstrip(MARKS)
            if stem and len(stem) < len(word) and only_letters(stem):
                ends[word] = stem, word[len(stem) :]
            else:
                others.add(word)
        for stem, marks in ends.values():
            if stem not in known:
                (words if folded(stem) else others).add(stem)
            if marks not in known:
                others.add(marks)
        if not self.words:
            others |= words
            words = set()
        for some, ids in ((list(words), self._word_ids), (list(others), self._ids)):
            known.update(zip(some, ids(some), strict=True))
        known.update((word, known[stem] + known[marks]) for word, (stem, marks) in ends.items())
        return words.union(others, ends)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, little-endian, four bytes each."""
        if not self.by_word:
            return list(self._ids(texts))
        known = self.known
        column = pa.array(texts, pa.large_string())
        folded = pc.if_else(pc.match_substring(column, "<|"), column, pc.ascii_lower(column))
        words = pc.ascii_split_whitespace(folded)
        numbered = words.values.dictionary_encode()
        distinct = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        new = self._learn([word for word in distinct if word not in known])
        encoded = [b""] * len(texts)
        if distinct:
            found = list(map(known.__getitem__, distinct))
            ends = np.cumsum([0, *map(len, found)], dtype=np.int64)
            ids = pa.Array.from_buffers(pa.large_binary(), len(found), [None, *map(pa.py_buffer, (ends, b"".join(found)))])
            _, starts, packed = ids.take(numbered.indices).buffers()
            at = np.frombuffer(starts, np.int64)[words.offsets.to_numpy()].tolist()
            encoded = [packed[start:end].to_pybytes() for start, end in pairwise(at)]
        if len(known) > REMEMBERED:  # frequent words came first; the new ones are rare
            for word in new:
                del known[word]
        return encoded


def _merger(model: dict[str, object]):
    """A second library's encoder of words with the merges of a model whose words end with a sign, and which ids have the sign.

    That library merges the pair whose result has the lowest id. A space behind each word is the sign; as a byte with the sign has a lower id than what
    merges, the two are joined first. It is only taken if the ids of the model are in this order; else None.
    """
    import tiktoken
    from tokenizers.pre_tokenizers import ByteLevel

    vocabulary, sign, byte_of = model["vocab"], model["end_of_word_suffix"], bytes_of_signs()
    merged = ["".join(pair) for pair in (m.split(" ") if isinstance(m, str) else m for m in model["merges"])]
    closed = sorted((c + sign for c in byte_of), key=vocabulary.get) if sign and set(byte_of) == set(ByteLevel.alphabet()) else []
    if not closed or not {*byte_of, *closed, *merged} <= vocabulary.keys():
        return None, None
    ordered = [vocabulary[token] for token in (*closed, *merged)]
    if max(vocabulary[c] for c in byte_of) >= ordered[0] or any(a >= b for a, b in pairwise(ordered)):
        return None, None
    space = next(c for c, byte in byte_of.items() if byte == 0x20)
    ranks = {}
    for token in (*byte_of, *closed, *merged):
        letters = token.removesuffix(sign)
        if space in letters and token not in (space, space + sign):
            return None, None
        ranks[bytes(byte_of[c] for c in letters) + b" " * token.endswith(sign)] = vocabulary[token]
    closes = np.zeros(max(ranks.values()) + 1, bool)
    closes[[rank for token, rank in ranks.items() if token[-1:] == b" " and len(token) > 1]] = True
    return tiktoken.Encoding("words", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={}), closes


def only_letters(stem: str) -> bool:
    """Whether a stem is letters alone, as it is and once it is normalised; a mark of its own would join the marks behind it."""
    if stem.isascii() or FOLDED.fullmatch(stem):
        return stem.isalpha()
    return stem.isalpha() and all(unicodedata.category(c)[0] == "L" for c in unicodedata.normalize("NFC", stem).lower())


def cut(ids: bytes, capacity: int) -> Iterator[tuple[int, int, int, int]]:
    """(piece, start, length, crc32 of the ids' bytes); all pieces but the last are full."""
    width = 4 * capacity
    for piece, start in enumerate(range(0, len(ids), width)):
        part = ids[start : start + width]
        yield piece, start // 4, len(part) // 4, zlib.crc32(part)


def token_pieces(
    docs: DataFrame,
    tokenizer_file: str,
    capacity: int = CAPACITY,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of the pieces of every row, without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_worker(f"encoder {tokenizer_file}", lambda: Encoder(tokenizer_file))

        def pieces_of(ids: pa.Array, texts: list[str]) -> pa.RecordBatch:
            rows = [(i, *piece) for i, text in enumerate(encoder.encode(texts)) for piece in cut(text + END, capacity)]
            at, piece, start, length, crc = zip(*rows, strict=True)
            arrays = [ids.take(pa.array(at)), pa.array(piece, pa.int32())]
            arrays += [pa.array(values, pa.int64()) for values in (start, length, crc)]
            return pa.RecordBatch.from_arrays(arrays, ["doc_id", "piece", "start", "length", "ids_crc32"])

        for batch in batches:
            group: list[str] = []
            first, size = 0, 0
            for value in batch.column(1):
                group.append(value.as_py() or "")
                size += len(group[-1])
                if size >= BATCH_BYTES:
                    yield pieces_of(batch.column(0).slice(first, len(group)), group)
                    first, group, size = first + len(group), [], 0
            if group:
                yield pieces_of(batch.column(0).slice(first, len(group)), group)

    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {PIECES}")


STATE = ("kind", "size", "first", "number", "per", "sequence", "offset")


def state_row(kind: Column | str, size, first, number, per=0, sequence=0, offset=0) -> Column:
    """A row of the state of the rounds, as a struct: ``number`` gaps or pieces of one size from ``first`` on, or a run."""
    values = [F.lit(value).cast("bigint") for value in (size, first, number, per, sequence, offset)]
    return F.struct(*[value.alias(name) for name, value in zip(STATE, (F.lit(kind), *values), strict=True)])


def fitted(state: DataFrame, low: int, high: int, capacity: int) -> DataFrame:
    """One round: the pieces of ``low`` < length <= ``high`` are matched with gaps; gaps, pieces and new runs after it.

    ``gap`` rows are ``number`` sequences from ``first`` on with ``size`` free tokens, ``piece`` rows the ranks of a length that
    have no place yet. A gap offers as many slots as pieces of length ``high`` fit into it, at least one. Two sweeps over gaps
    and lengths: from the largest down, a piece for which no slot is left loses, the last ranks of a length first; from the
    smallest up, each winner takes its successor, the least slot that holds it, or if shorter ones have that, the next one
    free. ``run`` rows say where ranks go: from rank ``first`` on, ``per`` each to ``number`` sequences from ``sequence`` on,
    the first at ``offset``.
    """
    is_gap = F.col("kind") == "gap"
    active = (F.col("size") > low) & (is_gap | (F.col("size") <= high))
    slots = F.when(is_gap, F.greatest(F.floor(F.col("size") / high), F.lit(1))).otherwise(1).cast("bigint")
    # One task: the rows are counts of sizes, see best_fit_rounds.
    swept = state.filter("kind <> 'run'").coalesce(1).withColumn("slots", slots)
    swept = swept.withColumn("n", F.when(active, F.col("number") * F.col("slots")).otherwise(0))
    start, here, before = Window.unboundedPreceding, Window.currentRow, -1
    down = Window.orderBy(F.desc("size"), "kind", "first")
    swept = swept.withColumn("level", F.sum(F.when(is_gap, F.col("n")).otherwise(-F.col("n"))).over(down.rowsBetween(start, here)))
    lost = [-F.least(F.min("level").over(down.rowsBetween(start, end)), F.lit(0)) for end in (here, before)]
    swept = swept.withColumn("m", F.col("n") - F.when(is_gap, 0).otherwise(lost[0] - lost[1]))
    up = Window.orderBy("size", F.desc("kind"), "first")
    sums = [F.coalesce(F.sum(F.when(side, F.col("m"))).over(up.rowsBetween(start, before)), F.lit(0)) for side in (is_gap, ~is_gap)]
    swept = swept.withColumns({"slots_below": sums[0], "won_below": sums[1]})
    ahead = F.max(F.when(~is_gap & (F.col("m") > 0), F.col("slots_below") - F.col("won_below"))).over(up.rowsBetween(start, here))
    swept = swept.withColumn("from", F.when(is_gap, F.col("slots_below")).otherwise(F.col("won_below") + ahead))
    # From one start to the next, slots of one row go to ranks of one length, or stay free.
    ordered = Window.partitionBy(F.col("m") > 0).orderBy("from", "kind")
    until = ordered.rowsBetween(start, here)
    span = (F.col("from") + F.col("m")).alias("to")
    owner = F.last(F.when(is_gap, F.struct("first", "from", "size", "slots", span)), ignorenulls=True).over(until)
    asker = F.last(F.when(~is_gap, F.struct("first", "from", "size", span)), ignorenulls=True).over(until)
    swept = swept.select("*", owner.alias("owner"), asker.alias("asker"), F.lead("from").over(ordered).alias("next"))
    live = (F.col("m") > 0) & F.col("owner").isNotNull()
    swept = swept.withColumn("next", F.least("next", "owner.to"))
    taken = F.when(live & F.col("asker").isNotNull(), F.greatest(F.least("next", "asker.to"), "from")).otherwise(F.col("from"))
    swept = swept.withColumns({name: c - F.col("owner.from") for name, c in (("a", F.col("from")), ("b", taken), ("c", F.col("next")))})
    # Slots a to b of a row are the rest of a sequence, whole sequences, and the start of one; b to c stay free.
    a, b, t = F.col("a"), F.col("b"), F.col("owner.slots")
    ends = F.least(F.ceil(a / t) * t, b)
    starts = F.greatest(F.floor(b / t) * t, ends)
    rank = F.col("asker.first") + F.col("from") - F.col("asker.from") - a
    gap = F.col("owner.size").alias("gap")

    def part(x: Column, y: Column, whole: bool) -> Column:
        number, per = (F.floor((y - x) / t), t) if whole else (F.lit(1), y - x)
        sequence = F.col("owner.first") + F.floor(x / t)
        row = state_row("run", F.col("asker.size"), rank + x, F.when(live & (x < y), number).otherwise(0), per, sequence, x)
        return F.struct(row.alias("row"), gap)

    free = F.ceil(b / t)
    hole = state_row("gap", F.col("owner.size"), F.col("owner.first") + free, F.when(live, F.floor(F.col("c") / t) - free).otherwise(0))
    kept = F.when(is_gap & active, 0).otherwise(F.col("number") - F.col("m"))
    rest = state_row(F.col("kind"), F.col("size"), F.col("first") + F.col("m"), kept)
    rows = [F.struct(row.alias("row"), gap) for row in (rest, hole)]
    parts = swept.select(F.inline(F.array(*rows, part(a, ends, False), part(ends, starts, True), part(starts, b, False))))
    parts = parts.filter("row.number > 0").select("row.*", "gap")
    # Parts of one sequence lie one behind the other; so far ``offset`` is the slot.
    inside = Window.partitionBy("kind", "sequence").orderBy("offset")
    used = F.col("per") * F.col("size")
    filled = F.sum(used).over(inside.rowsBetween(start, here))
    parts = parts.select("*", filled.alias("filled"), F.lead("kind").over(inside).isNull().alias("last"))
    is_run = F.col("kind") == "run"
    offset = F.when(is_run, capacity - F.col("gap") + F.col("filled") - used).otherwise(0)
    row = state_row(*[F.col(name) for name in STATE[:-1]], offset)
    left = F.when(is_run & F.col("last"), F.col("gap") - F.col("filled")).otherwise(0)
    return parts.select(F.inline(F.array(row, state_row("gap", left, F.col("sequence"), F.col("number"))))).filter("size > 0")


def best_fit_rounds(lengths: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Runs (size, first, number, per, sequence, offset; see :func:`fitted`) that place all pieces of (length, number).

    Pieces of one length are alike, and so are gaps of one size, so each round of matches works on counts: a row per length, and a row per
    gap size and stretch of sequences, whose number depends on ``capacity`` and the rounds, not on the number of
    documents. Each round is written, so it is not done again. It begins with as many empty sequences as the tokens need at least. Lengths of the upper half
    come first, then the next half, and so on; of each, rounds go on until all have a place or no gap holds the shortest one, and
    then as many sequences are opened as the rest needs at least. The driver sees a row per half.
    """
    spark = lengths.sparkSession
    halves = [capacity >> k for k in range(capacity.bit_length())]
    half = sum((F.when(F.col("size") <= high, 1).otherwise(0) for high in halves[1:]), F.lit(0))
    opened = -(-(lengths.agg(F.sum(F.col("length") * F.col("number")).alias("n")).first()["n"] or 0) // capacity)
    state = lengths.select(state_row("piece", F.col("length"), 0, F.col("number")).alias("row")).select("row.*")

    def empty(first: int, number: int) -> DataFrame:
        return spark.range(1).select(state_row("gap", capacity, first, number).alias("row")).select("row.*")

    state = materialise(state.unionByName(empty(0, opened)).filter("number > 0").coalesce(1), "round")
    rounds = [state]
    while True:
        of = F.when(F.col("kind") == "piece", half).otherwise(-1).alias("half")
        sums = state.filter("kind <> 'run'").coalesce(1).groupBy(of).agg(
            F.sum("number").alias("n"), F.sum(F.col("size") * F.col("number")).alias("tokens"),
            F.min("size").alias("least"), F.max("size").alias("most"),
        )
        found = {row["half"]: row for row in sums.collect()}
        widest = found.pop(-1)["most"] if -1 in found else 0
        if not found:
            break
        at = min(found)
        high, left = halves[at], found[at]
        if widest < left["least"]:
            more = max(-(-left["tokens"] // capacity), -(-left["n"] // (capacity // left["least"])))
            state = state.filter("kind <> 'run'").unionByName(empty(opened, more))
            opened += more
        state = materialise(fitted(state, high // 2, high, capacity), "round")
        rounds.append(state)
    return reduce(DataFrame.unionByName, rounds).filter("kind = 'run'").drop("kind")


def best_fit_packing(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows (doc_id, piece, start, length, ids_crc32).

    Lengths are matched with gaps in rounds (:func:`best_fit_rounds`); a distributed rank inside each length, cut into bins
    so that no task sees a whole length, then gives each piece its place. The runs that are broadcast depend on
    ``capacity`` and the number of rounds.

    Every sequence is filled from 0 without gaps and holds at most ``capacity`` tokens. Pieces that are equal in all
    columns are packed each; an empty table gives no rows.
    """
    lengths = materialise(pieces.groupBy("length").agg(F.count("*").alias("number")), "lengths")
    rows = lengths.agg(F.sum("number").alias("n")).first()["n"] or 0
    runs = materialise(best_fit_rounds(lengths, capacity).coalesce(1), "runs")
    keyed = pieces.withColumn("key", shuffle_key(F.col("doc_id"), F.col("piece"))).withColumn("one", F.lit(1))
    ranked = running_sums(keyed, ["length"], "key", ["doc_id", "piece"], "one", rows)
    at = F.col("before") - F.col("first")
    inside = (F.col("length") == F.col("size")) & (at >= 0) & (at < F.col("per") * F.col("number"))
    placed = ranked.join(F.broadcast(runs), inside)
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("sequence") + F.floor(at / F.col("per"))).alias("sequence_id"),
        (F.col("offset") + at % F.col("per") * F.col("length")).alias("offset"),
    )


def packed_documents(
    docs: DataFrame,
    tokenizer_file: str,
    capacity: int = CAPACITY,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The places of the pieces of all documents in as few sequences as best-fit finds.

    A document is its token ids and one id 0 after them, so a null or empty text is that id alone. Documents
    longer than ``capacity`` are cut into full pieces and a last one. Ids may be null or repeat; each row is
    packed.
    """
    pieces = materialise(token_pieces(docs, tokenizer_file, capacity, id_column, text_column), "pieces")
    return best_fit_packing(pieces, capacity)
