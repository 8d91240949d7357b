"""Stretches of text that repeat with a period: runs of words, found by a dictionary of basic factors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.llm.common import none_per_worker

MIN_LENGTH = 6
MIN_POWERS = 4
# Words that are searched at a time; a longer text is searched alone.
BATCH_WORDS = 1 << 18
# Words compared first when a run is extended; doubled as long as they agree.
FIRST_STEP = 16

RUNS = "runs array<struct<start:bigint,length:bigint,period:bigint>>"


def _extended(names: np.ndarray, start: int, end: int, period: int, low: int, high: int) -> tuple[int, int]:
    """Extend [start, end) as far as words one period apart are equal, inside [low, high)."""
    size = FIRST_STEP
    while start > low:
        part = min(size, start - low)
        differ = np.flatnonzero(names[start - part : start] != names[start - part + period : start + period])
        if len(differ):
            start -= part - 1 - int(differ[-1])
            break
        start, size = start - part, 2 * size
    size = FIRST_STEP
    while end < high:
        part = min(size, high - end)
        differ = np.flatnonzero(names[end : end + part] != names[end - period : end - period + part])
        if len(differ):
            end += int(differ[0])
            break
        end, size = end + part, 2 * size
    return start, end


def runs_of(
    words: np.ndarray, bounds: np.ndarray, min_length: int = MIN_LENGTH, min_powers: int = MIN_POWERS
) -> list[tuple[int, int, int]]:
    """The runs (start, length, period) of several texts, sorted; starts count from the first text's first word.

    ``words`` holds the numbers of the words of all texts, one text after the other, and text i ends at
    ``bounds[i]``. A run is at least ``min_length`` words and ``min_powers`` periods long.

    The dictionary names the factors (stretches of words) of length 1, 2, 4, ...: a name is
    made of the names of the two halves. Factors that occur once in their text are forgotten, so in ordinary text
    little is left after a few levels. Per level, three successive occurrences of a
    factor at equal distances of at most twice its length are an arithmetic progression and propose
    their distance as a period. Proposals of one period that touch are one; it is extended by comparing words, and what lies
    inside an extended stretch is not extended again.

    Every run is found: let L be the least power of two that is not below the smallest period q. A factor of length L inside
    the run recurs exactly q later, as anything nearer would give a smaller period; and
    2q + L < 4q words of the run cover three occurrences. What is proposed has no smaller period either, as then
    the factor would recur sooner.
    """
    if min_powers < 4:
        raise ValueError("runs of fewer than four periods may lack a progression")
    total = len(words)
    text_of = np.repeat(np.arange(len(bounds)), np.diff(bounds, prepend=0))
    first = np.concatenate([[0], bounds])
    longest = int(np.diff(first).max(initial=0))
    found: set[tuple[int, int, int]] = set()
    at = np.arange(total)
    # Words of different texts differ, and a factor over the end of a text occurs once.
    names = text_of * (int(words.max(initial=0)) + 1) + words
    plain = names
    partner = np.full(total, -1, np.int64)
    size = 1
    while len(at) and 2 * size <= longest:
        order = np.argsort(names, kind="stable")
        sorted_at, sorted_names = at[order], names[order]
        same = sorted_names[1:] == sorted_names[:-1]
        gap = np.where(same, sorted_at[1:] - sorted_at[:-1], 0)
        steady = (gap[1:] == gap[:-1]) & (gap[1:] > 0) & (gap[1:] <= 2 * size)
        _collect(found, plain, sorted_at[:-2][steady], gap[:-1][steady], size, text_of, first, min_length, min_powers)
        again = np.zeros(len(at), bool)
        again[1:] |= same
        again[:-1] |= same
        ranks = np.concatenate([[0], np.cumsum(~same)])
        names = np.empty(len(at), np.int64)
        names[order] = ranks
        repeated = np.empty(len(at), bool)
        repeated[order] = again
        at, names = at[repeated], names[repeated]
        partner[at] = names
        inside = at + size < total
        other = np.full(len(at), -1, np.int64)
        other[inside] = partner[at[inside] + size]
        partner[at] = -1
        both = other >= 0
        at, names = at[both], names[both] * total + other[both]
        size *= 2
    return sorted(found)


def _collect(
    found: set[tuple[int, int, int]],
    names: np.ndarray,
    starts: np.ndarray,
    periods: np.ndarray,
    size: int,
    text_of: np.ndarray,
    first: np.ndarray,
    min_length: int,
    min_powers: int,
) -> None:
    """Join the progressions of one level, extend them and add the runs that are long enough."""
    if not len(starts):
        return
    order = np.lexsort((starts, periods))
    starts, periods = starts[order], periods[order]
    # Words at [start, start + covered) equal those one period later: all occurrences, unless there are gaps between them.
    covered = size + np.where(periods <= size, periods, 0)
    apart = (periods[1:] != periods[:-1]) | (starts[1:] > starts[:-1] + covered[:-1])
    opens = np.flatnonzero(np.concatenate([[True], apart]))
    closes = np.concatenate([opens[1:], [len(starts)]]) - 1
    last, done = 0, 0
    for opened, closed in zip(opens.tolist(), closes.tolist(), strict=True):
        period, start = int(periods[opened]), int(starts[opened])
        if period == last and start + period < done:
            continue  # inside the stretch that was extended just before
        text = int(text_of[start])
        end = int(starts[closed] + covered[closed]) + period
        start, end = _extended(names, start, end, period, int(first[text]), int(first[text + 1]))
        last, done = period, end
        if end - start >= max(min_length, min_powers * period):
            found.add((start, end - start, period))


def _judged(texts: list[list[bytes]], min_length: int, min_powers: int) -> Iterator[tuple[list[tuple[int, int, int]], bytes]]:
    """Of each text its runs, and the words that no run repeats, joined by one space."""
    numbers: dict[bytes, int] = {}
    words = np.array([numbers.setdefault(word, len(numbers)) for text in texts for word in text], np.int64)
    bounds = np.cumsum([len(text) for text in texts])
    runs = runs_of(words, bounds, min_length, min_powers)
    at = 0
    for text, end in zip(texts, bounds.tolist(), strict=True):
        first, own = end - len(text), []
        while at < len(runs) and runs[at][0] < end:
            start, length, period = runs[at]
            own.append((start - first, length, period))
            at += 1
        if own:
            dropped = np.zeros(len(text), bool)
            for start, length, period in own:
                dropped[start + period : start + length] = True
            text = [word for word, gone in zip(text, dropped.tolist(), strict=True) if not gone]
        yield own, b" ".join(text)


def periodic_runs(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_length: int = MIN_LENGTH,
    min_powers: int = MIN_POWERS,
) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row, over whole texts, without a shuffle.

    Words are split at white space of ASCII. ``runs`` holds (start, length, period) of each run in order of start and
    period: a stretch of words, numbered from 0, with its smallest period that cannot be extended, at least
    ``min_length`` words and ``min_powers`` periods long (four at least). ``collapsed`` is the text without the words that
    a run contains after its first period, joined by one space.

    Null texts count as empty: no words, no runs, an empty text. Ids may be null or repeat; each row gets its
    row. Other columns are ignored; an empty table gives no rows. A task holds one batch of words, or one text if that is longer.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none_per_worker()

        def judged(ids: pa.Array, texts: list[list[bytes]]) -> pa.RecordBatch:
            runs, collapsed = zip(*_judged(texts, min_length, min_powers), strict=True)
            offsets = pa.array(np.cumsum([0, *map(len, runs)]), pa.int32())
            flat = np.array([run for own in runs for run in own], np.int64).reshape(-1, 3)
            fields = [pa.array(flat[:, i]) for i in range(3)]
            lists = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(fields, ["start", "length", "period"]))
            sizes = pa.array(list(map(len, texts)), pa.int64())
            kept = pa.array(collapsed, pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([ids, sizes, lists, kept], ["doc_id", "n_words", "runs", "collapsed"])

        for batch in batches:
            group: list[list[bytes]] = []
            first, size = 0, 0
            for value in batch.column(1):
                group.append((value.as_py() or "").encode("utf-8").split())
                size += len(group[-1])
                if size >= BATCH_WORDS:
                    yield judged(batch.column(0).slice(first, len(group)), group)
                    first, group, size = first + len(group), [], 0
            if group:
                yield judged(batch.column(0).slice(first, len(group)), group)

    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {id_type}, n_words bigint, {RUNS}, collapsed string")
