"""Near-duplicates by SimHash fingerprints that differ in few bits."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.llm.common import materialise, none_per_worker
from vaultline.llm.components import connected_components

SEED = 42
# Shingles hashed at a time: bounds the memory a very long text takes.
CHUNK = 1 << 16
# Every other bit: the lower bits of the segments of two bits.
LOWER = 0x5555555555555555


def bit_counts(digests: bytes) -> np.ndarray:
    """How many of the 8-byte digests have each of the 64 bits set, highest bit first."""
    bits = np.unpackbits(np.frombuffer(digests, np.uint8)).view(np.uint64).reshape(-1, 8)
    # Eight counts of a byte each add up in one word, and 255 rows cannot overflow them.
    partial = np.add.reduceat(bits, np.arange(0, len(bits), 255), axis=0)
    return partial.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)


def fingerprint(text: str | None, width: int = 3) -> int:
    """The SimHash of a text as a signed 64-bit number: a bit is set if over half the shingles set it.

    A-Z are lower-cased; words are split at white space of ASCII. Fewer words than
    ``width`` are one shingle; no words give zero. Shingles are hashed by XXH64 with seed 42.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    total = max(1, len(words) - width + 1)
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_digest
    for start in range(0, total, CHUNK):
        part = words[start : start + CHUNK + width - 1]
        shingles = zip(*(part[i:] for i in range(width)), strict=False) if len(words) >= width else [part]
        counts += bit_counts(b"".join([digest(b" ".join(s), SEED) for s in shingles]))
    return int.from_bytes(np.packbits(2 * counts > total).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, width: int = 3, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of every row, over whole texts, without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none_per_worker()
        for batch in batches:
            prints = pa.array([fingerprint(text.as_py(), width) for text in batch.column(1)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), prints], ["doc_id", "fingerprint"])

    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fingerprint bigint")


def segment_counts(fp: Column) -> Column:
    """Bit counts of the 32 segments of two bits, two bits each: a point of the grid {0, 1, 2}^32."""
    low, high = fp.bitwiseAND(F.lit(LOWER)), F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(LOWER))
    return low.bitwiseXOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))


def _around(fp: Column) -> Column:
    """The fingerprint and those that differ from it in one bit."""
    flips = [fp.bitwiseXOR(F.shiftleft(F.lit(1).cast("bigint"), b)) for b in range(64)]
    return F.array(fp, *flips)


def fingerprint_links(points: DataFrame) -> DataFrame:
    """Links (a, b) of ids, enough to connect all fingerprints that differ in at most two bits.

    ``points`` has a ``fingerprint`` per row, each once, and its ``id``.

    Bit counts of segments are the embedding: the Manhattan distance of two points is at most the
    number of differing bits. Two points within two steps both lie within one step of some
    cell, so each fingerprint enters its own cell and the up to 48 next to it, and
    only cells with two fingerprints remain: the lower bound. Those are verified
    exactly: inside a cell, fingerprints that reach the same 64-bit value by at most one flip differ in at
    most two bits, and any two that do share such a value, whose cell both have entered. At most 65
    fingerprints reach a value, so they are linked to the smallest id among them; the pairs of
    a large group are never formed.
    """
    fp = F.col("fingerprint")
    # A point becomes up to 49 rows, so the points are dealt over all tasks first.
    tasks = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = points.repartition(tasks, "fingerprint").select("fingerprint", F.explode(F.array_distinct(F.transform(_around(fp), segment_counts))).alias("cell"))
    crowded = cells.groupBy("cell").agg(F.min("fingerprint").alias("low"), F.max("fingerprint").alias("high"))
    crowded = materialise(crowded.filter("low < high").select("cell"), "crowded")
    entered = materialise(cells.join(crowded, "cell"), "entered")
    reached = entered.join(points, "fingerprint").select("id", "cell", F.explode(_around(fp)).alias("value"))
    reached = reached.filter(segment_counts(F.col("value")) == F.col("cell")).select("id", "value")
    met = reached.groupBy("value").agg(F.collect_set("id").alias("ids")).filter(F.size("ids") > 1)
    return met.select(F.array_min("ids").alias("a"), F.explode("ids").alias("b")).filter("a < b").distinct()


def simhash_dedup(docs: DataFrame, width: int = 3, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row; fingerprints link at two or fewer differing bits.

    Fingerprints are signed 64-bit numbers, ``component_id`` the smallest id reachable over
    links, the own one included. Equal fingerprints are one point, so copies cost nothing. Null texts
    count as empty and have fingerprint zero, which links like any other. Rows without an id get the
    component of their fingerprints, null if no row with an id has them. Repeated rows each get a row.
    Other columns are ignored; an empty table gives no rows.
    """
    prints = materialise(fingerprints(docs, width, id_column, text_column), "fingerprints")
    points = materialise(prints.groupBy("fingerprint").agg(F.min("doc_id").cast("bigint").alias("id")), "points")
    found = connected_components(fingerprint_links(points.filter("id is not null")))
    groups = points.join(found, points["id"] == found["node"], "left")
    groups = materialise(groups.select("fingerprint", F.coalesce("component", "id").alias("component_id")), "groups")
    return prints.join(groups, "fingerprint").select("doc_id", "fingerprint", "component_id")


def kept_documents(docs: DataFrame, width: int = 3, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents that stay, with all their columns: of each component the one with the smallest id.

    Rows with that id all stay, and so do rows without an id, which cannot be told apart.
    """
    found = simhash_dedup(docs, width, id_column, text_column)
    dropped = found.filter("doc_id <> component_id").select(F.col("doc_id").alias("_dropped")).distinct()
    dropped = materialise(dropped, "dropped")
    return docs.join(dropped, docs[id_column] == dropped["_dropped"], "left_anti")
