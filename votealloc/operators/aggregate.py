"""Sums, pivots, shares and choices that the other operators are made of."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from votealloc.functions.keys import is_non_geographic, party_group
from votealloc.functions.measures import coverage_pct

PARTIES = ("dem", "rep", "other")
VOTES = [f"{p}_votes" for p in PARTIES]


def sum_by(df: DataFrame, keys: list[str], *columns: str) -> DataFrame:
    """Sums of columns by keys; partial sums are made before the shuffle."""
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in columns])


def party_columns(df: DataFrame, keys: list[str], loose: bool = False) -> DataFrame:
    """Long party rows as dem_votes, rep_votes and other_votes by keys; 0 where a party has no row."""
    group = party_group(F.col("party"), loose)
    sums = [F.sum(F.when(group == p, F.col("votes")).otherwise(0.0)).alias(f"{p}_votes") for p in PARTIES]
    return df.groupBy(*keys).agg(*sums)


def party_pivot(df: DataFrame, keys: list[str]) -> DataFrame:
    """party_columns as a pivot over three given values, so that no pass is needed to find them."""
    wide = df.withColumn("party_group", party_group(F.col("party"))).groupBy(*keys).pivot("party_group", list(PARTIES)).agg(F.sum("votes"))
    return wide.select(*keys, *[F.coalesce(p, F.lit(0.0)).alias(f"{p}_votes") for p in PARTIES])


def first_by(df: DataFrame, keys: list[str], value: str, order: Column, where: Column | None = None) -> DataFrame:
    """The value of the first row by order; where limits the rows that count."""
    chosen = F.col(value) if where is None else F.when(where, F.col(value))
    rank = order if where is None else F.when(where, order)
    return df.groupBy(*keys).agg(F.min_by(chosen, rank).alias(value))


def top_candidate(df: DataFrame, keys: list[str]) -> DataFrame:
    """The candidate with most votes by keys; ties go to the later name."""
    sums = df.groupBy(*keys, "candidate").agg(F.sum("votes").alias("votes"))
    return sums.groupBy(*keys).agg(F.max_by("candidate", F.struct("votes", "candidate")).alias("candidate"))


def share_of_group(df: DataFrame, keys: list[str], value: str, name: str = "share") -> DataFrame:
    """value over the group's sum, null where that is 0. Few groups are joined back, so a large one isn't one task's work."""
    totals = df.groupBy(*keys).agg(F.sum(value).alias("__total"))
    return df.join(totals, keys).withColumn(name, F.try_divide(F.col(value).cast("double"), F.col("__total").cast("double"))).drop("__total")


def renormalize(df: DataFrame, keys: list[str], weight: str) -> DataFrame:
    """Weights that sum to 1 by keys; groups that sum to 0 go."""
    out = share_of_group(df, keys, weight, "__w").where("__w is not null")
    return out.withColumn(weight, F.col("__w")).drop("__w")


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], k: int = 1) -> DataFrame:
    """The first k rows of each key; Spark keeps k rows a task before it shuffles."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("__n") <= k).drop("__n")


def versus_previous(df: DataFrame, keys: list[str], value: str, order: str = "year") -> DataFrame:
    """value of the cycle before and the change since, by keys."""
    before = F.lag(value).over(Window.partitionBy(*keys).orderBy(order))
    return df.withColumn(f"previous_{value}", before).withColumn(f"{value}_change", F.col(value) - F.col(f"previous_{value}"))


def distinct_list(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set(value)), ", ").alias(f"{value}s"))


def rollup_counts(df: DataFrame) -> DataFrame:
    """Rows by scope, rows by year, and all, in one pass."""
    return df.groupingSets([[F.col("scope")], [F.col("year")], []], "scope", "year").agg(F.count("*").alias("rows"), F.count_distinct("scope", "contest_type", "year").alias("slices"))


def status_counts(df: DataFrame, keys: list[str], statuses: list[str]) -> DataFrame:
    """Rows by status as columns, with all and the share that is matched."""
    counts = [F.count(F.when(F.col("status") == s, 1)).alias(s) for s in statuses]
    out = df.groupBy(*keys).agg(F.count("*").alias("total"), *counts)
    return out.withColumn("matched_pct", coverage_pct(F.col("matched"), F.col("total")))


def split_geographic(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with a place, and rows of absentee or early votes."""
    flag = is_non_geographic(F.col("precinct"), F.col("county"))
    return df.where(~flag), df.where(flag)


def require(df: DataFrame, *columns: str) -> DataFrame:
    """df, if it has the columns: checked when the plan is made."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df
