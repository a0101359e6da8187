"""Exact duplicates through a log-structured index of digests."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from votealloc.llm.shared import discard, join_parted, keyed, materialise, note, shared_dir

#: Whitespace runs that count as one space.
SPACES = r"[\x20\x09-\x0D]+"
#: Hits that are compared with one copy of their keeper's text.
HITS_PER_COPY = 256


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def _write_run(rows: DataFrame, label: str, memtable_rows: int) -> DataFrame:
    """Sorted runs of at most memtable_rows entries, each with min/max statistics and a Bloom filter on the digest."""
    spark = rows.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    note(path)
    writer = rows.sortWithinPartitions("digest", "doc_id").write.option("maxRecordsPerFile", memtable_rows)
    writer.option("parquet.bloom.filter.enabled#digest", "true").option("parquet.bloom.filter.expected.ndv#digest", min(memtable_rows, 1 << 20)).parquet(path)
    out = spark.read.schema(rows.schema).parquet(path)
    out._shared_path = path
    return out


def flush(table: DataFrame, digest=F.xxhash64, memtable_rows: int = 1 << 20) -> DataFrame:
    """Level 0: every task's rows (row_key, doc_id, text) become sorted digest runs; texts stay behind."""
    norm = normalised(F.col("text"))
    rows = table.select("row_key", "doc_id", digest(norm).alias("digest"), F.sha2(norm, 256).alias("text_sha256"))
    return _write_run(rows, "dedup-run", memtable_rows)


def compact(runs: DataFrame, by: list[str], memtable_rows: int = 1 << 20) -> DataFrame:
    """Level 1: one entry a digest with its number of rows and its smallest (doc_id, row_key), null ids last.

    The merge is pre-aggregated in each task, so a digest that a third of all rows share moves
    as one entry a task.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key"))
    merged = runs.groupBy(by).agg(first.alias("first"), F.count("*").alias("group_size"))
    merged = merged.select(*by, F.col("first.doc_id").alias("doc_id"), F.col("first.row_key").alias("keep_row"), "group_size")
    return _write_run(merged, "dedup-level", memtable_rows)


def lookup(index: DataFrame, texts: list[str], digest=F.xxhash64) -> DataFrame:
    """Entries of a few given texts' digests; statistics and Bloom filters rule out most runs before they are read."""
    spark = index.sparkSession
    asked = spark.createDataFrame([(t,) for t in texts], "text string").select(digest(normalised(F.col("text"))).alias("digest"))
    return index.where(F.col("digest").isin([r.digest for r in asked.collect()]))


def _unequal(table: DataFrame, runs: DataFrame, index: DataFrame) -> DataFrame:
    """Digests of which some row's bytes differ from its keeper's, by comparison of the whole normalised texts."""
    many = index.where("group_size > 1").select("digest", "keep_row", F.ceil(F.col("group_size") / HITS_PER_COPY).alias("copies"), F.col("group_size").alias("n"))
    members = join_parted(runs.select("row_key", "digest"), many, ["digest"], "row_key")
    texts = table.select("row_key", "text").join(members, "row_key").select("row_key", "digest", "keep_row", "copies", normalised(F.col("text")).alias("norm"))
    texts = materialise(texts, "dedup-texts")
    hits = texts.where("row_key <> keep_row").withColumn("copy", F.pmod(F.xxhash64("row_key"), "copies"))
    keeper = texts.where("row_key = keep_row").select("keep_row", F.col("norm").alias("keep_norm"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy"))
    return hits.join(keeper, ["keep_row", "copy"]).where("norm <> keep_norm").select("digest").distinct()


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, row_col: str | None = None, digest=F.xxhash64, memtable_rows: int = 1 << 20) -> DataFrame:
    """Groups of rows whose texts are equal once every whitespace run is one space.

    Returns a row for each row of docs: doc_id, keep_id (the smallest doc_id of the group),
    group_size, kept (is this the row that stays), text_sha256 (of the normalised text, UTF-8);
    and row_key, the row_col of docs or else a number of our own.

    Method: tasks flush memtables as sorted runs of (digest, id) with Bloom filters; compaction
    merges all runs at once and keeps the smallest identifier; every hit is verified byte for byte against
    the text of the row that it would drop for. The rows of a large group meet its entry, and
    its keeper's text, in parts. Where a digest turns out to cover different texts, its rows are merged again
    by SHA-256 as well. One merge over all runs finds every hit, so the runs' filters decide
    nothing here; they serve lookup() in an index that is kept.

    Null text counts as empty, and all empty texts are one group. A null doc_id comes after all
    others; of rows with the same doc_id and text one stays. An empty table gives no rows.
    Other columns of docs are not read.
    """
    table = keyed(docs, {"doc_id": id_col, "text": text_col}, "dedup-docs") if row_col is None else docs.select(docs[row_col].alias("row_key"), docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    runs = flush(table, digest, memtable_rows)
    index = compact(runs, ["digest"], memtable_rows)
    unequal = materialise(_unequal(table, runs, index), "dedup-unequal")  # few: only digests that collide
    if row_col is None:
        discard(table)

    def resolve(rows: DataFrame, entries: DataFrame, by: list[str]) -> DataFrame:
        entries = entries.withColumnRenamed("doc_id", "keep_id").withColumn("n", F.col("group_size"))
        return join_parted(rows, entries, by, "row_key").select("doc_id", "keep_id", "group_size", (F.col("row_key") == F.col("keep_row")).alias("kept"), "text_sha256", "row_key")

    if unequal.isEmpty():
        return resolve(runs, index, ["digest"])
    apart = runs.join(unequal, "digest", "left_semi")
    again = compact(apart, ["digest", "text_sha256"], memtable_rows)
    return resolve(runs.join(unequal, "digest", "left_anti"), index, ["digest"]).unionByName(resolve(apart, again, ["digest", "text_sha256"]))
