"""Shared-folder tables and row keys.

Intermediate tables go to the folder named in ``spark.checkpoint.dir``: every executor and the
driver can read it, so a lost executor costs a re-read and never a lost table.
"""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of one key that one task joins, or more where else over BROADCAST_HOT keys (some tens of bytes each) would be joined in parts.
ROWS_A_PART = 4096
BROADCAST_HOT = 10_000

COLLECT_S = 2.0
_collected_at = 0.0

_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def note(path: str) -> None:
    """Tells finished(), if the caller runs in one, of a table that was made."""
    if (paths := _made.get()) is not None:
        paths.append(path)


def remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def finished(make: Callable[[], DataFrame], label: str) -> DataFrame:
    """make()'s rows as a written table; every other table that was made for them is removed."""
    made: list[str] = []
    token = _made.set(made)
    try:
        out = materialise(make(), label)
    finally:
        _made.reset(token)
    for path in made:
        if path != out._shared_path:
            remove(out.sparkSession, path)
    note(out._shared_path)
    return out


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir. Where none is set, a local master (tests) gets a new one; a cluster is an error."""
    set_dir = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not set_dir:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        set_dir = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(set_dir)
    return set_dir.rstrip("/")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder as Parquet and read it again: cuts lineage, survives executors.

    Nothing needs the shuffle files of the plan any more once it is written, so the driver is
    asked to collect its garbage (every few seconds at most), upon which Spark deletes them: disk
    holds the shuffles of a step or two at a time, not all.
    """
    global _collected_at
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    note(path)
    df.write.option("compression", "zstd").parquet(path)
    if time.monotonic() - _collected_at > COLLECT_S:
        gc.collect()
        spark._jvm.System.gc()
        _collected_at = time.monotonic()
    out = spark.read.schema(df.schema).parquet(path)
    out._shared_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a table made by materialise() that nothing will read again."""
    if path := getattr(df, "_shared_path", None):
        remove(df.sparkSession, path)


def join_parted(left: DataFrame, right: DataFrame, keys: list[str], spread: str, n: str = "n", how: str = "inner") -> DataFrame:
    """left joined with right on keys, in parts where very many rows of left have a key.

    right is a written table with one row a key, and in n how many rows of left have it (or
    more). Such a key's row is copied once for each part, and left's rows are dealt to parts by a hash of
    spread, so that no task gets them all. There are at most BROADCAST_HOT such keys, whatever
    the input: only they are broadcast. n isn't passed on.
    """
    total, most = right.agg(F.sum(n), F.max(n)).first()
    a_part = max(ROWS_A_PART, (total or 0) // BROADCAST_HOT)
    if (most or 0) <= a_part:
        return left.join(right.drop(n), keys, how)
    parts, part = free_name(left, "parts"), free_name(left, "part")
    parted = right.withColumn(parts, F.ceil(F.col(n) / a_part)).drop(n)
    hot = F.broadcast(parted.where(F.col(parts) > 1).select(*keys, parts))
    dealt = left.join(hot, keys, "left").withColumn(part, F.pmod(F.xxhash64(spread), F.coalesce(parts, F.lit(1)))).drop(parts)
    copied = parted.withColumn(part, F.explode(F.sequence(F.lit(0).cast("long"), F.col(parts) - 1))).drop(parts)
    return dealt.join(copied, [*keys, part], how).drop(part)


def keyed(docs: DataFrame, columns: dict[str, str], label: str) -> DataFrame:
    """The given columns (new name -> column of docs) and a stable row_key, written and read again.

    Row keys tell repeated rows and null ids apart. Columns of docs that are not asked for are
    not read, so their names cannot clash with the operator's own.
    """
    picked = docs.select(*[docs[old].alias(new) for new, old in columns.items()])
    return materialise(picked.withColumn("row_key", F.monotonically_increasing_id()), label)


def free_name(df: DataFrame, wanted: str) -> str:
    """wanted, with underscores until no column of df has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def numbered(rows: DataFrame, group: str, order: list[Column], label: str) -> DataFrame:
    """rows with position (long): 0, 1, 2... of each row among those of its group, by order; rows that tie in all of it in any order.

    One sort by ranges numbers the rows of each part, and a row's position is that number plus
    the rows of its group in earlier parts. A row's own number is the last sort key, so neither
    a group nor very many rows of one key are one task's; windows run over one row for each
    part and group. The sorted table is written once: its ranges stay as they were found.
    """
    rows = materialise(rows.withColumn("row_key", F.monotonically_increasing_id()), f"{label}-rows")
    lined = materialise(rows.orderBy(group, *order, "row_key").drop("row_key").withColumn("at", F.monotonically_increasing_id()), f"{label}-lined")
    discard(rows)
    parts = lined.groupBy(F.shiftright("at", 33).alias("part"), F.col(group).alias("of")).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("of").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = parts.select("part", "of", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"))
    found = lined.join(starts, (F.shiftright("at", 33) == F.col("part")) & F.col(group).eqNullSafe(F.col("of")))
    return found.withColumn("position", F.col("at") + F.col("shift")).drop("at", "part", "of", "shift")
