"""A corpus pipeline of five stages, each an operator of votealloc.llm over all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from votealloc.llm import language_id
from votealloc.llm.decontaminate import contaminated
from votealloc.llm.exact_dedup import exact_duplicates
from votealloc.llm.mixing import mix
from votealloc.llm.near_dedup import near_duplicates
from votealloc.llm.shared import finished, free_name, materialise, remove


def _without_rows(docs: DataFrame, find: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """docs but for the rows whose row_key is in find(docs, name of a column of row numbers).

    Rows are numbered in a written table, so that numbers stay the same. It and the numbers of
    the rows that go are what the result reads; all else is removed before it is returned.
    """
    number, gone = free_name(docs, "row_number"), free_name(docs, "gone")
    table = materialise(docs.withColumn(number, F.monotonically_increasing_id()), "pipeline-docs")
    dropped = finished(lambda: find(table, number).select(F.col("row_key").alias(gone)), "pipeline-gone")
    return table.join(dropped, F.col(f"`{number}`") == F.col(f"`{gone}`"), "left_anti").drop(number)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told clearly; those without a letter or with a narrow margin go."""
    dictionaries = language_id.fit(docs.where(~language_id.held_out(docs["doc_id"])))
    return docs.where(language_id.language_of(docs["text"], dictionaries)["accepted"])


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return _without_rows(docs, lambda table, number: exact_duplicates(table, row_col=number).where("not kept"))


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest doc_id."""
    return _without_rows(docs, lambda table, number: near_duplicates(table, row_col=number).where("not kept"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    of, of_hash = free_name(docs, "of"), free_name(docs, "of_hash")
    bad = finished(lambda: contaminated(docs, benchmark).where("contaminated").select(F.col("doc_id").alias(of), F.col("text_hash").alias(of_hash)).distinct(), "pipeline-leaks")
    return docs.join(bad, docs["doc_id"].eqNullSafe(F.col(f"`{of}`")) & (F.xxhash64(docs["text"]) == F.col(f"`{of_hash}`")), "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with size, source_size, target and taken."""
    mixed = mix(docs)
    return mixed.where(F.col(f"`{mixed.columns[-1]}`") > 0)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact),
    ("near_dedup", drop_near),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
]

#: Language identification can't be expressed in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again.

    A stage's tables, and the table that it read, are removed once it is written: the result is
    a written table, and the only one that stays.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        before = docs
        docs = finished(lambda docs=before, stage=stage: stage(spark, docs, sf_dir), f"stage-{name}")
        if path := getattr(before, "_shared_path", None):
            remove(spark, path)
    return docs
