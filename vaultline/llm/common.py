"""What several operators of this subpackage share."""

from __future__ import annotations

import math
import sys
import types
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vaultline.session import scratch_dir

# Words of all contracts are runs of other characters than these.
WORD = r"[^\x20\x09-\x0D]+"


def materialise(frame: DataFrame, purpose: str) -> DataFrame:
    """Write the rows to the shared folder and read them back.

    This cuts the lineage: a lost executor costs its running tasks, not the steps before.
    """
    path = scratch_dir(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def per_worker(key: str, make: Callable[[], Any]) -> Any:
    """A value that the tasks of one Python worker share, such as a loaded tokenizer and what it remembers.

    Functions travel to the workers by value, so their modules' globals are new in each task; an own
    entry among the loaded modules lives as long as the worker. It holds one value: the
    next job that asks for another one, or for :func:`none_per_worker`, frees it.
    """
    holder = sys.modules.setdefault("_vaultline_worker", types.ModuleType("_vaultline_worker"))
    if getattr(holder, "key", None) != key:
        holder.key, holder.value = None, None
        holder.key, holder.value = key, make()
    return holder.value


def none_per_worker() -> None:
    """Free what an earlier job has left in this Python worker."""
    per_worker("nothing", lambda: None)


def bytes_of_signs() -> dict[str, int]:
    """The bytes that the signs of byte-level tokenizers stand for: those that print stand for themselves, the others, in order, follow after 255."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = sorted(set(range(256)).difference(prints))
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(hidden)}


def text_of(name: str) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def shuffle_key(*columns: Column) -> Column:
    """A hexadecimal key that looks random, equal for equal values on every engine and rerun."""
    return F.md5(F.concat_ws("|", *(F.coalesce(c.cast("string"), F.lit("-")) for c in columns)))


def per_bin(rows: int) -> int:
    """Rows of one bin of a running sum: about as many as there are bins."""
    return max(128, math.isqrt(rows))


def running_sums(
    frame: DataFrame,
    groups: list[str],
    key: str,
    order: list[str],
    value: str,
    rows: int,
) -> DataFrame:
    """Add ``before``: the sum of ``value`` over the rows of the group that come earlier.

    Rows of a group are ordered by ``key`` (a :func:`shuffle_key`), then ``order``. The key space
    is cut into even bins; a window adds up one bin, and a second one adds up the sums of the
    bins. So no task sees a whole group, however many rows it has: with n rows about
    sqrt(n) in a bin and sqrt(n) bins in a group.
    """
    bins = max(1, rows // per_bin(rows))
    slot = F.floor(F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint") * bins / (1 << 32)).cast("bigint")
    frame = frame.withColumn("_slot", slot)
    sums = frame.groupBy(*groups, "_slot").agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(*groups).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*groups, "_slot", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*groups, "_slot").orderBy(key, *order).rowsBetween(Window.unboundedPreceding, -1)
    inner = frame.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    same = [inner[g].eqNullSafe(starts[g]) for g in groups]
    joined = inner.join(starts, [*same, inner["_slot"] == starts["_slot"]])
    kept = [inner[c] for c in inner.columns if c not in ("_slot", "_inside")]
    return joined.select(*kept, (inner["_inside"] + starts["_start"]).alias("before"))
