"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for.

    Adaptive execution matters most: it picks broadcast joins from measured sizes
    and splits join partitions that a hot key has made too large.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # Noting the call site of every column costs more calls to the JVM than the column.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def _on_its_store(spark: SparkSession, path: str):
    own = spark._jvm.org.apache.hadoop.fs.Path(path)
    return own, own.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in any store that Spark reaches."""
    own, store = _on_its_store(spark, path)
    return store.exists(own)


def _link_once(path: str, text: str) -> bool:
    """On a local disk: a hard link to a complete file, which fails if the name is taken."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    draft = f"{os.path.dirname(path)}/.{uuid.uuid4().hex}"
    with open(draft, "w", encoding="utf-8") as out:
        out.write(text)
    try:
        os.link(draft, path)
    except FileExistsError:
        return False
    finally:
        os.unlink(draft)
    return True


def _rename_once(spark: SparkSession, path: str, text: str) -> bool:
    """In any other store: a complete file renamed to a name that must be free, as Spark commits the batches of a stream."""
    own, store = _on_its_store(spark, path)
    hadoop = spark._jvm.org.apache.hadoop.fs
    draft = hadoop.Path(own.getParent(), f".{uuid.uuid4().hex}")
    out = store.create(draft, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        hadoop.FileContext.getFileContext(own.toUri(), spark._jsc.hadoopConfiguration()).rename(
            store.makeQualified(draft), store.makeQualified(own), options
        )
    except Py4JJavaError as error:
        store.delete(draft, False)
        if "FileAlreadyExistsException" in str(error.java_exception):
            return False
        raise
    return True


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file, whole or not at all; false if the name is taken.

    Of several sessions that try at the same time one succeeds. The store must rename files in one step, as
    local disks, HDFS and the like do.
    """
    own, store = _on_its_store(spark, path)
    if store.getUri().getScheme() == "file":
        return _link_once(own.toUri().getPath(), text)
    return _rename_once(spark, path, text)


def remove_older(spark: SparkSession, folder: str, keep: set[str], before: datetime) -> list[str]:
    """Delete the entries of a folder that are neither in ``keep`` nor changed since ``before``; gives their names."""
    if not exists(spark, folder):
        return []
    own, store = _on_its_store(spark, folder)
    limit = int(before.timestamp() * 1000)
    gone = [f.getPath() for f in store.listStatus(own) if f.getModificationTime() < limit and f.getPath().getName() not in keep]
    for path in gone:
        store.delete(path, True)
    return sorted(path.getName() for path in gone)


def any_match(spark: SparkSession, pattern: str) -> bool:
    """Whether any path fits a pattern; a missing folder has none."""
    own, store = _on_its_store(spark, pattern)
    return bool(store.globStatus(own))


def qualified(spark: SparkSession, path: str) -> str:
    """The path as a URI with its file system, as other libraries than Spark need it."""
    own, store = _on_its_store(spark, path)
    uri = store.makeQualified(own).toUri().toString()
    return uri if uri.startswith("file://") else uri.replace("file:/", "file:///", 1)


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder under the shared folder that ``spark.checkpoint.dir`` names.

    Every executor must see it, so a machine-local folder is only accepted when
    the whole of Spark runs on one machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        base = tempfile.mkdtemp(prefix="vaultline-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
