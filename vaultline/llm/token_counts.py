"""Token counts of whole texts."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.llm.common import per_worker

# Bytes of text in one call of the library.
BATCH_BYTES = 1 << 20
# Counts of units that a worker remembers, so that frequent words are encoded once.
REMEMBERED = 400_000
SPACE = "▁"


def splits_before_spaces(pieces: list[str]) -> bool:
    """Whether no piece has a space after another character.

    Then no merge can cross such a place, so a text may be cut there: the parts have the same tokens.
    """
    return not any(SPACE in piece.lstrip(SPACE) for piece in pieces)


def units(text: str) -> Iterator[str]:
    """Cut a text before each run of spaces that follows another character.

    Every unit but the first drops one space, as the library puts one before each text. The library's own sign
    for a space is one.
    """
    if SPACE in text:
        text = text.replace(SPACE, " ")
    parts = text.split(" ")
    if all(parts):
        yield from parts
        return
    for found in re.finditer(r" *[^ ]+| +", text):
        yield found[0] if found.start() == 0 else found[0][1:]


class Counter:
    """Counts tokens of texts with a SentencePiece model, without begin and end tokens."""

    def __init__(self, model_file: str, batch_bytes: int = BATCH_BYTES) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        # A normaliser that joins or drops spaces would make units depend on each other.
        kept = self.model.encode("a  b ", out_type=str) == ["▁a", SPACE, "▁b", SPACE]
        self.splits = splits_before_spaces(pieces) and kept
        self.batch_bytes = batch_bytes
        # The unit that is one space alone has lost it and would count as no text.
        self.known: dict[str, int] = {}

    def _encode(self, texts: list[str]) -> Iterator[int]:
        """Token numbers of texts, encoded in batches of about the same number of bytes."""
        batch: list[str] = []
        size = 0
        for text in texts:
            batch.append(text)
            size += len(text) + 16
            if size >= self.batch_bytes:
                yield from map(len, self.model.encode(batch, num_threads=1))
                batch, size = [], 0
        if batch:
            yield from map(len, self.model.encode(batch, num_threads=1))

    def counts(self, texts: list[str]) -> list[int]:
        if not self.splits:
            return list(self._encode(texts))
        known = self.known
        new = [unit for unit in {unit for text in texts for unit in units(text)} if unit not in known]
        known.update(zip(new, self._encode(new), strict=True))
        known[""] = len(self.model.encode(" a")) - len(self.model.encode("a"))
        counts = [sum(map(known.__getitem__, units(text))) if text else 0 for text in texts]
        if len(known) > REMEMBERED:  # frequent units came first; the new ones are rare
            for unit in new:
                del known[unit]
        return counts


def token_counts(docs: DataFrame, model_file: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row, over whole texts, without a shuffle.

    Only lengths leave the tasks. Texts are cut at places no token can cross, so a long one is many small
    calls, and units that were met before are looked up. Null texts count as empty: 0 bytes, 0
    tokens. Ids may be null or repeat; each row gets its row. ``model_file`` must be at that path on
    every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = per_worker(f"counter {model_file}", lambda: Counter(model_file))
        for batch in batches:
            counts: list[int] = []
            group: list[str] = []
            size = 0
            for value in batch.column(2):
                group.append(value.as_py() or "")
                size += len(group[-1])
                if size >= 4 * BATCH_BYTES:
                    counts += counter.counts(group)
                    group, size = [], 0
            counts += counter.counts(group)
            arrays = [batch.column(0), batch.column(1), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_bytes", "n_tokens"])

    size = F.coalesce(F.octet_length(text_column), F.lit(0)).cast("bigint")
    rows = docs.select(F.col(id_column).alias("doc_id"), size.alias("n_bytes"), F.col(text_column).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {id_type}, n_bytes bigint, n_tokens bigint")
