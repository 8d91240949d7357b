"""Near-duplicates of embeddings by product quantisation."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.llm.common import materialise
from vaultline.llm.components import connected_components

SIMILARITY = 0.98
# Vectors that the lists and codes are fitted on, at most; the first by hash.
SAMPLE = 20_000
LISTS = 256
PARTS = 16
CODES = 64
# Rows of one block of a list, stored and asked: bounds what a task holds.
STORED, ASKED = 1024, 2048
# Room for rounding in the bounds that rule candidates out.
SLACK = 1e-5


def kmeans(points: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Centres of a plain k-means that starts from evenly spaced points."""
    centres = points[np.linspace(0, len(points) - 1, min(k, len(points))).astype(int)].copy()
    for _ in range(rounds):
        near = nearest(points, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        sizes = np.bincount(near, minlength=len(centres))
        centres[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return centres


def squared(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum(0, (points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1))


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return squared(points, centres).argmin(1)


@dataclass(frozen=True)
class Quantiser:
    """Coarse centres, and for each of the parts of a residual its codebook."""

    centres: np.ndarray
    books: list[np.ndarray]

    @property
    def size(self) -> int:
        return self.centres.shape[1]

    def parts(self, vectors: np.ndarray) -> list[np.ndarray]:
        return np.array_split(vectors, len(self.books), axis=1)

    def encode(self, units: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the residuals, and how far each vector is from what its code stands for."""
        residuals = units - self.centres[lists]
        codes = np.stack([nearest(p, b) for p, b in zip(self.parts(residuals), self.books, strict=True)], 1)
        decoded = np.concatenate([b[codes[:, i]] for i, b in enumerate(self.books)], axis=1)
        return codes.astype(np.uint8), np.sqrt(((residuals - decoded) ** 2).sum(1))

    def tables(self, units: np.ndarray, at: int) -> list[np.ndarray]:
        """Squared distances of queries to every code of each part, in the list ``at``."""
        return [squared(p, b) for p, b in zip(self.parts(units - self.centres[at]), self.books, strict=True)]

    def probes(self, units: np.ndarray, reach: float) -> list[np.ndarray]:
        """The lists that may hold a vector within ``reach`` of each query, its own one among them.

        A partner that lies in another list is beyond the plane halfway between both centres, so
        only lists whose plane is within reach are needed, and no link is lost.
        """
        gaps = squared(units, self.centres)
        own = gaps.argmin(1)
        between = np.sqrt(squared(self.centres, self.centres))[own]
        within = gaps - gaps[np.arange(len(units)), own][:, None] <= 2 * reach * between + SLACK
        within[np.arange(len(units)), own] = True
        return [np.flatnonzero(row) for row in within]


def fit(units: np.ndarray, lists: int, parts: int = PARTS, codes: int = CODES) -> Quantiser:
    centres = kmeans(units, lists)
    residuals = units - centres[nearest(units, centres)]
    books = [kmeans(p, codes) for p in np.array_split(residuals, min(parts, units.shape[1]), axis=1)]
    return Quantiser(centres, books)


def as_units(vectors: np.ndarray) -> np.ndarray:
    largest = np.abs(vectors).max(axis=1, keepdims=True)
    scaled = vectors / largest  # so that squares of huge or tiny components stay in range
    return scaled / np.sqrt((scaled**2).sum(1, keepdims=True))


def forest(left: np.ndarray, right: np.ndarray, n_left: int, n_right: int) -> tuple[np.ndarray, np.ndarray]:
    """Of links between two sides, one per node that keeps all that are connected so: (node, head); right nodes follow left ones."""
    ends = np.concatenate([left, right + n_left])
    other = np.concatenate([right + n_left, left])
    head = np.arange(n_left + n_right)
    while True:
        lower = head.copy()
        np.minimum.at(lower, ends, head[other])
        lower = lower[lower]
        if (lower == head).all():
            break
        head = lower
    nodes = np.flatnonzero(head != np.arange(len(head)))
    return nodes, head[nodes]


def _block(quantiser: Quantiser | None, similarity: float):
    """Links of one block of a list: counts per asked vector, and enough links to connect them."""
    reach = math.sqrt(max(0.0, 2 - 2 * similarity))

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        asked, stored = rows[~rows["stored"]], rows[rows["stored"]]
        none = pd.DataFrame({"id": [], "n": [], "to": []}).astype("int64")
        if asked.empty or stored.empty:
            return none
        a, s = (np.stack(side["embedding"].to_numpy()).astype(np.float64) for side in (asked, stored))
        a, s = as_units(a), as_units(s)
        at = int(key[2])
        if at < 0 or quantiser is None:  # lists of vectors of an unusual length have no codes
            pairs = np.nonzero(np.ones((len(a), len(s)), bool))
        else:
            codes = np.stack([np.frombuffer(c, np.uint8) for c in stored["codes"]])
            tables = quantiser.tables(a, at)
            far = sum(table[:, codes[:, i]] for i, table in enumerate(tables))
            # A stored vector is at most its own coding error nearer than its code says.
            pairs = np.nonzero(far <= (reach + stored["error"].to_numpy() + SLACK) ** 2 + SLACK)
        cosine = np.einsum("ij,ij->i", a[pairs[0]], s[pairs[1]])
        ids, to = asked["id"].to_numpy(np.int64), stored["id"].to_numpy(np.int64)
        linked = (cosine >= similarity) & (ids[pairs[0]] != to[pairs[1]])
        left, right = pairs[0][linked], pairs[1][linked]
        if not len(left):
            return none
        n = np.bincount(left, weights=stored["copies"].to_numpy(np.float64)[right], minlength=len(ids)).astype(np.int64)
        some = np.flatnonzero(n)
        nodes, heads = forest(left, right, len(ids), len(to))
        names = np.concatenate([ids, to])
        counts = pd.DataFrame({"id": ids[some], "n": n[some], "to": ids[some]})
        links = pd.DataFrame({"id": names[nodes], "n": np.zeros(len(nodes), np.int64), "to": names[heads]})
        return pd.concat([counts, links[links["id"] != links["to"]]])

    return run


def embedding_links(classes: DataFrame, similarity: float = SIMILARITY, lists: int | None = None) -> DataFrame:
    """(id, n, to): parts of the number of vectors each class links to (n), and links (to) that connect the classes.

    ``classes`` has id (bigint), label, embedding and copies. Each vector is stored in the inverted list of its
    nearest centre, as a product code of its residual, and asks every list that may hold a partner.
    In a list, table lookups rule out what is too far by any coding error, and the rest is compared by exact cosine. A list of
    a label is cut into blocks of bounded size on both sides, so a hot list is many tasks.
    """
    rows = classes.count()
    if lists is None:
        lists = max(1, min(LISTS, math.isqrt(rows) // 4))
    sizes = classes.groupBy(F.size("embedding").alias("n")).agg(F.count("*").alias("rows"))
    usual = sizes.orderBy(F.desc("rows"), "n").first()
    usual = usual["n"] if usual else 0
    sample = classes.filter(F.size("embedding") == usual).orderBy(F.xxhash64("id"), "id").limit(SAMPLE)
    sample = sample.select("embedding").toPandas()["embedding"]
    quantiser = fit(as_units(np.stack(sample.to_numpy()).astype(np.float64)), lists) if len(sample) else None
    reach = math.sqrt(max(0.0, 2 - 2 * similarity))

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch.reset_index(drop=True)
            regular = batch["embedding"].map(len) == usual
            batch["list"], batch["error"], batch["codes"] = -1, 0.0, b""
            batch["probes"] = [[-1]] * len(batch)
            if regular.any() and quantiser is not None:
                units = as_units(np.stack(batch.loc[regular, "embedding"].to_numpy()).astype(np.float64))
                own = nearest(units, quantiser.centres)
                codes, errors = quantiser.encode(units, own)
                places = np.flatnonzero(regular)
                batch.loc[places, "list"], batch.loc[places, "error"] = own, errors
                batch["codes"] = batch["codes"].astype(object)
                for place, code, probe in zip(places, codes, quantiser.probes(units, reach), strict=True):
                    batch.at[place, "codes"], batch.at[place, "probes"] = code.tobytes(), probe.tolist()
            batch["width"] = batch["embedding"].map(len)
            yield batch[["id", "label", "width", "embedding", "copies", "list", "error", "codes", "probes"]]

    label = classes.schema["label"].dataType.simpleString()
    vector = classes.schema["embedding"].dataType.simpleString()
    schema = f"id bigint, label {label}, width int, embedding {vector}, copies bigint, list int, error double, codes binary"
    coded = materialise(classes.select("id", "label", "embedding", "copies").mapInPandas(assign, f"{schema}, probes array<int>"), "coded")

    key = ["label", "width", "list"]
    stored_n = coded.groupBy(*key).agg(F.count("*").alias("stored_n"))
    asks = coded.select("label", "width", F.explode("probes").alias("list"))
    asked_n = asks.groupBy(*key).agg(F.count("*").alias("asked_n"))
    cells = stored_n.join(asked_n, key).select(
        *key,
        F.ceil(F.col("stored_n") / STORED).cast("int").alias("stored_blocks"),
        F.ceil(F.col("asked_n") / ASKED).cast("int").alias("asked_blocks"),
    )
    cells = materialise(cells, "cells")
    own, other = F.col("stored_blocks"), F.col("asked_blocks")
    spread = F.xxhash64("id")

    def dealt(frame: DataFrame, mine, theirs, names: tuple[str, str]) -> DataFrame:
        frame = frame.join(cells, key).withColumn(names[0], F.pmod(spread, mine).cast("int"))
        return frame.withColumn(names[1], F.explode(F.sequence(F.lit(0), theirs - 1)))

    plain = coded.withColumn("stored", F.lit(True)).drop("probes")
    asking = coded.withColumn("list", F.explode("probes")).drop("probes").withColumns(
        {"stored": F.lit(False), "codes": F.lit(None).cast("binary")}
    )
    columns = [*key, "s", "a", "stored", "id", "embedding", "copies", "error", "codes"]
    blocks = dealt(plain, own, other, ("s", "a")).select(*columns)
    blocks = blocks.union(dealt(asking, other, own, ("a", "s")).select(*columns))
    return blocks.groupBy(*key, "s", "a").applyInPandas(_block(quantiser, similarity), "id bigint, n bigint, to bigint")


def embedding_dedup(vectors: DataFrame, similarity: float = SIMILARITY, lists: int | None = None) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row (vec_id, embedding, label).

    Vectors link if their labels are equal and their cosine, in double precision, is at least ``similarity``. Those with a null
    label, and vectors that are null, empty, zero or hold null or non-finite components, link with nothing, nor do
    vectors of different lengths. Equal vectors of a label are one class: their links are counted by the
    number of copies and pairs of copies are never formed. ``component_id`` is the smallest id
    reachable over links, the own one included. Repeated rows are vectors of their own that
    link to each other. Rows without an id link with nothing and get no component.
    """
    good = F.size("embedding") > 0
    good &= ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good &= F.exists("embedding", lambda x: x != 0)
    valid = F.coalesce(good, F.lit(False)) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    rows = vectors.select("vec_id", "label", "embedding", valid.alias("valid"))
    digest = F.sha2(F.to_json(F.struct(F.transform("embedding", lambda x: x + F.lit(0.0)).alias("e"))), 256)
    rows = rows.withColumn("digest", F.when(F.col("valid"), digest))
    # One row per label and vector; its smallest id stands for the copies.
    classes = rows.filter("valid").groupBy("label", "digest").agg(
        F.min("vec_id").cast("bigint").alias("id"), F.count("*").alias("copies"), F.min("embedding").alias("embedding")
    )
    classes = materialise(classes, "classes")
    links = materialise(embedding_links(classes.select("id", "label", "embedding", "copies"), similarity, lists), "links")
    found = connected_components(links.filter("id <> to").select("id", "to"))
    counts = links.groupBy("id").agg(F.sum("n").alias("n")).withColumnRenamed("id", "count_id")
    judged = classes.join(counts, F.col("id") == F.col("count_id"), "left").join(found, F.col("id") == F.col("node"), "left")
    judged = judged.select(
        F.col("label").alias("class_label"), F.col("digest").alias("class_digest"),
        (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("component", "id").alias("class_component"),
    )
    judged = materialise(judged, "judged")
    same = (F.col("label") == F.col("class_label")) & (F.col("digest") == F.col("class_digest"))
    component = F.coalesce("class_component", "vec_id")
    return rows.join(judged, same, "left").select(
        "vec_id",
        F.coalesce("links", F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"),
    )
