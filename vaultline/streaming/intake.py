"""Transaction files taken in as a stream, each of them once.

Two steps, each of which can die at any point and be run again:

1. Spark's file source takes the files it has not seen, as its checkpoint tells, and the file sink
   adds their typed rows to a stage, one partition per file. The logs of source and sink make a batch
   that runs again leave the same stage. Files taken can be archived or deleted by Spark.
2. What the stage holds and no commit of the fact names is loaded under one commit that names its
   files. A commit is made or not, and no file is committed twice, also by loads that overlap.

Other than the daily load, this does not wait for a missing day; files of any day are taken as they come, and
several files of a day add up. Both keep their ledger in the commits of the fact, so either
leaves alone what the other has taken.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.operators.checks import enforce, not_null
from vaultline.operators.stage import stage_transactions
from vaultline.schemas import FACT_TRANSACTIONS, TRANSACTION_FILE_COLUMNS, TRANSACTIONS_DDL
from vaultline.session import any_match, exists
from vaultline.sources.dated_files import dated_names
from vaultline.sources.delimited import header_contract, text_options
from vaultline.sources.store import Store, new_attempt

STAGE_DDL = f"{TRANSACTIONS_DDL}, file string"


@dataclass(frozen=True)
class TransactionIntake:
    """Drops named ``<prefix>DDMMYYYY<suffix>`` below ``folder``: files, or folders of part files.

    Each file is judged alone, so parts that reach a drop later are taken, too. ``archive`` is a folder outside ``folder`` to
    which Spark moves files once their batch is complete; those of the last batch move in the
    next run. ``max_files`` bounds a batch of the stream, and the files of one commit.

    All files of a run must have their columns in one order; one that has not, or has a wrong number of
    cells, fails the run and stays to be taken. Files without rows count as taken by the stream; they get no commit.
    """

    store: Store
    folder: str
    table: str = FACT_TRANSACTIONS
    prefix: str = "transactions_"
    suffix: str = ".txt"
    archive: str | None = None
    max_files: int = 1_000
    required: tuple[str, ...] = field(default=("terminal",))

    @property
    def _pattern(self) -> str:
        return f"{self.folder.rstrip('/')}/*{self.prefix}*{self.suffix}"

    @property
    def _reading(self) -> dict[str, object]:
        return {**text_options(";"), "recursiveFileLookup": True}

    @property
    def _stage(self) -> str:
        return self.store.path(self.table, "intake", "rows")

    def run(self) -> list[int]:
        """Take what is new and commit it; gives the versions of the commits."""
        self.take()
        return self.load()

    def take(self) -> None:
        """Bring new files into the stage. Nothing is visible to readers of the fact yet."""
        spark = self.store.spark
        if not any_match(spark, self._pattern):
            return
        columns = spark.read.options(**self._reading).csv(self._pattern).columns
        header_contract(columns, TRANSACTION_FILE_COLUMNS, self._pattern)
        source = spark.readStream.schema(", ".join(f"`{name}` string" for name in columns)).options(
            maxFilesPerTrigger=self.max_files, **self._reading
        )
        if self.archive:
            source = source.options(cleanSource="archive", sourceArchiveDir=self.archive)
        filled = F.coalesce(*[F.when(F.col(f"`{name}`") != "", F.lit(True)) for name in columns], F.lit(False))
        rows = source.csv(self._pattern).select("*", self._file_of("_metadata.file_path").alias("_file")).filter(filled)
        (
            stage_transactions(rows, F.col("_file").alias("file"))
            .writeStream.format("parquet")
            .partitionBy("file")
            .option("checkpointLocation", self.store.path(self.table, "intake", "checkpoint"))
            .trigger(availableNow=True)
            .start(self._stage)
            .awaitTermination()
        )

    def _file_of(self, path: str) -> Column:
        """The name of the drop, with that of the part if it is a folder."""
        decoded = F.url_decode(F.replace(F.col(path), F.lit("+"), F.lit("%2B")))
        return F.regexp_extract(decoded, rf"({self.prefix}[^/]*{self.suffix.replace('.', '[.]')}(/.*)?)$", 1)

    def _staged(self) -> DataFrame:
        spark = self.store.spark
        if not exists(spark, f"{self._stage}/_spark_metadata"):
            return spark.createDataFrame([], STAGE_DDL)
        return spark.read.schema(STAGE_DDL).parquet(self._stage)

    def waiting(self) -> DataFrame:
        """(file, file_dt) of what is staged and not committed, neither itself nor its whole drop."""
        taken = self.store.loaded_files(self.table)
        drop = F.substring_index("file", "/", 1)
        files = self._staged().select("file").distinct().withColumn("_drop", drop)
        files = files.join(taken.withColumnRenamed("file_name", "file"), "file", "left_anti")
        files = files.join(taken.withColumnRenamed("file_name", "_drop"), "_drop", "left_anti")
        days = dated_names(files.select(F.col("_drop").alias("path")), self.prefix, self.suffix)
        return files.join(days.select(F.col("path").alias("_drop"), "file_dt"), "_drop").select("file", "file_dt")

    def load(self) -> list[int]:
        """Check and commit what waits, the oldest days first, at most ``max_files`` in a commit.

        A file with no date in its name, or with rows that lack what is required, fails the load; its commit is not made.
        """
        versions = []
        while files := self.waiting().orderBy("file_dt", "file").limit(self.max_files).collect():
            versions.append(self._load({row.file: row.file_dt for row in files}))
        return versions

    def _load(self, days: dict[str, datetime]) -> int:
        attempt = new_attempt()
        rows = self._staged().filter(F.col("file").isin(list(days)))
        enforce(rows, not_null(*self.required))
        drop = F.substring_index("file", "/", 1)
        day = F.to_date(F.substring(drop, len(self.prefix) + 1, 8), "ddMMyyyy").cast("string")
        rows = rows.withColumn("load", F.concat_ws(" ", day, F.lit(attempt))).drop("file")
        written = self.store.write_loads(self.table, rows, event="trans_date", attempt=attempt)
        return self.store.commit_files(self.table, written, max(days.values()), sorted(days))
