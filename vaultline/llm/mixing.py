"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultline.llm.common import WORD, materialise, running_sums, shuffle_key, text_of

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
# Virtual time after which nothing is queued; targets are met at time 1.
HORIZON = 2


def source_targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target) from one row (source, source_size) per source.

    Sources in code point order, null last, take the weights in turn and share all sizes by them. A target
    stops at ``max_epochs`` times the source's size, and what is above is shared anew. With the
    sources ordered by size over weight, those that stop come first: the level at which the others
    share is found by running sums. The windows hold one row per source, never documents.
    """
    turn = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*(F.lit(w).cast("bigint") for w in weights)), turn % len(weights) + 1)
    ranked = sources.withColumn("weight", weight).withColumn("cap", F.col("source_size") * max_epochs)
    ranked = ranked.withColumn("ratio", F.col("cap") / F.col("weight"))
    order = Window.orderBy("ratio", F.col("source").isNull(), "source")
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    ranked = ranked.withColumn("level", left / F.sum("weight").over(rest)).withColumn("at", F.row_number().over(order))
    free = F.when(F.col("level") <= F.col("ratio"), F.col("at"))
    level = F.min_by(F.when(free.isNotNull(), F.col("level")), free).over(everything)
    return ranked.select("source", "source_size", F.least(F.col("cap").cast("double"), level * F.col("weight")).alias("target"))


def fair_mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """How often the mix takes each document: one row per row of ``docs``.

    Columns: ``doc_id``, ``size`` (words), ``source_size``, ``target`` (words the source shall give) and ``copies``
    (0 to ``max_epochs``). The documents of a source are shuffled by a hash of their id and queued over and over;
    each gets a virtual finish time, the words of its source up to its end over the source's target.
    Over all sources the queue is ranged by finish time and cut where the total of all sizes is
    reached: the sums of narrow ranges of time show the range in which it ends, and only that one is sorted.

    Null sources are a source of their own; null texts have size 0. Documents of size 0 are never taken. Repeated
    rows are documents of their own. No words at all give targets of 0; an empty table gives no rows.
    Only expressions, windows and joins of Spark are used.
    """
    words = F.regexp_count(text_of(text_column), F.lit(WORD)).cast("bigint")
    sized = docs.select(F.col(id_column).alias("doc_id"), F.col(source_column).alias("source"), words.alias("size"))
    sized = materialise(sized.withColumn("key", shuffle_key(F.col("doc_id"))), "sizes")
    sources = materialise(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    targets = materialise(source_targets(sources, weights, max_epochs), "targets")
    rows = sized.count()
    queued = running_sums(sized.filter("size > 0"), ["source"], "key", ["doc_id"], "size", rows)
    same = queued["source"].eqNullSafe(targets["source"])
    queued = materialise(queued.join(targets, same).drop(targets["source"]), "queue")

    def finish(epoch: Column) -> Column:
        return (F.col("before") + F.col("size") + epoch * F.col("source_size")) / F.col("target")

    ranges = max(1, math.isqrt(rows))

    def range_of(epoch: Column) -> Column:
        return F.floor(F.least(finish(epoch), F.lit(float(HORIZON))) * ranges).cast("bigint")

    epochs = [F.lit(e).cast("bigint") for e in range(max_epochs)]
    every = queued.withColumn("epoch", F.explode(F.array(*epochs))).withColumn("range", range_of(F.col("epoch")))
    in_time = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    sums = every.filter(F.col("range") < HORIZON * ranges).groupBy("range").agg(F.sum("size").alias("size"))
    ends = sums.withColumn("end", F.sum("size").over(in_time))
    budget = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    cut = ends.filter(F.col("end") > budget).agg(F.min("range"), F.min_by(F.col("end") - F.col("size"), "range")).first()
    last, start = cut if cut[0] is not None else (HORIZON * ranges, budget)

    order = Window.orderBy(finish(F.col("epoch")), F.col("source").isNull(), "source", "key", "doc_id")
    total = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) + F.lit(start)
    edge = every.filter((F.col("range") == last) & (F.col("range") < HORIZON * ranges)).withColumn("total", total)
    edge = edge.filter(F.col("total") <= budget).groupBy("source", "before").agg(F.count("*").alias("more"))
    edge = materialise(edge.toDF("edge_source", "edge_before", "more"), "edge")
    whole = sum(((range_of(e) < last).cast("bigint") for e in epochs), F.lit(0).cast("bigint"))
    at_edge = F.col("source").eqNullSafe(F.col("edge_source")) & (F.col("before") == F.col("edge_before"))
    copies = (whole + F.coalesce("more", F.lit(0).cast("bigint"))).alias("copies")
    taken = queued.join(edge, at_edge, "left").select("doc_id", "size", "source_size", "target", copies)
    empty = sized.filter("size = 0")
    empty = empty.join(targets, empty["source"].eqNullSafe(targets["source"])).select(
        "doc_id", "size", "source_size", "target", F.lit(0).cast("bigint").alias("copies")
    )
    return taken.unionByName(empty)


def mixed_documents(docs: DataFrame, id_column: str = "doc_id", **options: object) -> DataFrame:
    """The documents of the mix with all their columns, each as often as it is taken.

    The rows of an id that repeats share the copies of that id as evenly as they can.
    """
    taken = fair_mix(docs, id_column=id_column, **options).groupBy("doc_id")
    taken = taken.agg(F.sum("copies").alias("_copies"), F.count("*").alias("_rows")).withColumnRenamed("doc_id", "_id")
    taken = materialise(taken.filter("_copies > 0"), "taken")
    columns = [docs[f"`{c}`"] for c in docs.columns]

    def of(keys: DataFrame, times: Column) -> DataFrame:
        """The documents of the keys, each so many times. Columns of both sides are told apart by their frame."""
        found = docs.join(keys, docs[id_column].eqNullSafe(keys["_id"])).select(F.struct(*columns).alias("_row"), times.alias("_times"))
        return found.select("_row", F.explode(F.array_repeat(F.lit(0), F.col("_times").cast("int")))).select("_row.*")

    repeated = taken.filter("_rows > 1")
    if repeated.isEmpty():
        return of(taken, taken["_copies"])
    single = taken.filter("_rows = 1")
    place = F.row_number().over(Window.partitionBy(docs[id_column]).orderBy(F.struct(*columns)))
    share = F.floor(repeated["_copies"] / repeated["_rows"]) + (place <= repeated["_copies"] % repeated["_rows"]).cast("int")
    return of(single, single["_copies"]).union(of(repeated, share))
