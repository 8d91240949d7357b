"""Exact dedup against a persistent index of digests."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from vaultline.llm.common import materialise, text_of
from vaultline.session import exists, scratch_dir


class DigestIndex:
    """A table with one row per text seen so far, bucketed and sorted by the text's SHA-256.

    Each batch is reduced to one row per digest, sort-merge anti-joined with the index, which is
    not shuffled for it, and the digests that are new are appended. Texts are never shuffled.

    A new index goes to the shared folder. With ``name`` and ``location`` it can be kept
    and opened again; the number of buckets belongs to the table and must stay. Each batch is a
    partition named by its id, so a batch that is added again replaces what it has brought.
    """

    def __init__(
        self,
        spark: SparkSession,
        name: str | None = None,
        location: str | None = None,
        buckets: int | None = None,
        id_type: str = "bigint",
    ) -> None:
        self.spark = spark
        self.name = name or f"digest_index_{uuid.uuid4().hex}"
        self.location = location or scratch_dir(spark, "digest-index")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (digest BINARY, keep_id {id_type}, copies BIGINT, batch STRING) USING parquet "
            f"PARTITIONED BY (batch) CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.location}'"
        )
        if location and exists(spark, location):
            spark.sql(f"ALTER TABLE {self.name} RECOVER PARTITIONS")

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        """Take the table out of the catalogue; its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def add(
        self, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", batch: str | None = None
    ) -> DataFrame:
        """Judge a batch and add its new texts to the index.

        One row per row of the batch: ``doc_id``, ``keep_id`` (the document of this text that
        stays), ``group_size`` (rows of this text in the batch, and in the batch that first
        brought it if that was an earlier one), ``kept``, ``digest`` and ``repeats``
        (rows with this id and text). Other columns are ignored.

        Of equal texts of one batch the largest id stays; a text of an earlier batch keeps its
        document, and nothing of the later batch stays. A null text counts as empty. Rows without
        an id take part, and one stays only if no row of that text has an id. Of whole
        rows that repeat, one stays. An empty batch gives no rows.

        ``batch`` names the batch. A load that died after the digests were added may add the same rows under the same
        name: they are judged without what they brought themselves, so the same rows stay. Without a name
        each call is a batch of its own.
        """
        batch = batch or uuid.uuid4().hex
        if not re.fullmatch(r"[\w.-]+", batch):
            raise ValueError(f"a batch is named by letters, digits, dots and dashes, not {batch!r}")
        rows = docs.select(F.col(id_column).alias("doc_id"), F.unhex(F.sha2(text_of(text_column), 256)).alias("digest"))
        rows = materialise(rows.groupBy("digest", "doc_id").agg(F.count("*").alias("repeats")), "digests")
        groups = rows.groupBy("digest").agg(F.max("doc_id").alias("batch_id"), F.sum("repeats").alias("size"))
        # Partitioned as the index is, so that the index stays in place.
        keyed = materialise(groups, "batch").repartition(self.buckets, "digest")
        index = self.rows().filter(F.col("batch") != batch).select("digest", "keep_id", "copies")
        new = keyed.join(index.hint("merge"), "digest", "left_anti").select(
            "digest", F.col("batch_id").alias("keep_id"), F.col("size").alias("group_size"), F.lit(True).alias("new")
        )
        seen = keyed.join(index.hint("merge"), "digest").select(
            "digest", "keep_id", (F.col("size") + F.col("copies")).alias("group_size"), F.lit(False).alias("new")
        )
        groups = materialise(new.unionByName(seen), "groups")
        added = groups.filter("new").select("digest", "keep_id", F.col("group_size").alias("copies"))
        self.spark.sql(
            f"INSERT OVERWRITE TABLE {self.name} PARTITION (batch = '{batch}') SELECT digest, keep_id, copies FROM {{added}}",
            added=added.repartition(self.buckets, "digest"),
        )
        # Both sides are plain tables here, so Spark splits a digest that a third of all rows have.
        judged = rows.join(groups, "digest").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "repeats")))
        stays = F.col("new") & (F.col("copy") == 1) & F.col("doc_id").eqNullSafe(F.col("keep_id"))
        return judged.select("doc_id", "keep_id", "group_size", stays.alias("kept"), "digest", "repeats")


def exact_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The verdicts of :meth:`DigestIndex.add` for a whole corpus, whose largest id of each text stays.

    If ids are numbers, the rows come in two batches, first the upper half of the ids: a text of the
    first keeps its document, which has the larger id. Rows without an id come last. Here ``group_size`` counts all rows of the text.
    """
    kind = docs.select(id_column).schema[0].dataType
    index = DigestIndex(docs.sparkSession, id_type=kind.simpleString())
    own = docs[id_column]
    middle = docs.agg(F.percentile_approx(own, 0.5)).first()[0] if isinstance(kind, NumericType) else None
    if middle is None:
        batches = [docs]
    else:
        upper = F.coalesce(own > middle, F.lit(False))
        batches = [docs.filter(upper), docs.filter(~upper)]
    judged = [index.add(batch, id_column, text_column) for batch in batches]
    index.drop()
    if len(judged) == 1:
        return judged[0]
    found = judged[0].unionByName(judged[1])
    # The later batch's groups count the copies of the earlier one, too, so the largest count of a text is of all its rows.
    sizes = judged[1].filter(~F.col("kept")).select("digest", "group_size").distinct().withColumnRenamed("group_size", "_all")
    sizes = materialise(sizes, "sizes")
    found = found.join(sizes, "digest", "left").withColumn("group_size", F.greatest("group_size", "_all"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "digest", "repeats")


def kept_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents that stay, with all their columns, each once.

    Rows that share id and text but differ elsewhere count as repeated; the one that sorts first stays.
    """
    kept = exact_dedup(docs, id_column, text_column).filter("kept")
    kept = materialise(kept.select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), "repeats"), "kept")
    columns = [docs[f"`{c}`"] for c in docs.columns]
    digest = F.unhex(F.sha2(text_of(text_column), 256))

    def of(keys: DataFrame) -> DataFrame:
        return docs.join(keys, docs[id_column].eqNullSafe(keys["_id"]) & (digest == keys["_digest"]), "left_semi")

    repeated = kept.filter("repeats > 1")
    if repeated.isEmpty():
        return of(kept)
    firsts = of(repeated).groupBy(docs[id_column], digest).agg(F.min(F.struct(*columns)).alias("_row"))
    return of(kept.filter("repeats = 1")).union(firsts.select("_row.*"))
