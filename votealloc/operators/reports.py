"""Quality reports: what matched, what didn't, and whether sums hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from votealloc.functions.measures import accuracy_pct, coverage_pct, margin_pct, within
from votealloc.operators.aggregate import VOTES, status_counts, top_per_key

STATUSES = ["matched", "unmatched", "ambiguous", "non_geographic", "no_county", "bad_key"]


def unmatched_summary(resolved: DataFrame) -> DataFrame:
    """By year: keys by status and the percentage that matched. resolved: (year, key, status)."""
    return status_counts(resolved, ["year"], STATUSES)


def unmatched_examples(resolved: DataFrame, k: int = 500) -> DataFrame:
    """The k keys with most rows of each year and status that didn't match; ties by key."""
    counts = resolved.where("status <> 'matched'").groupBy("year", "status", "key").agg(F.count("*").alias("rows"))
    return top_per_key(counts, ["year", "status"], [F.desc("rows"), F.asc("key")], k)


def match_rates(keys: DataFrame) -> DataFrame:
    """Geographic keys, matched and not, and others, by year, by county and in all. keys: (year, county, matched, non_geo)."""
    geo = ~F.col("non_geo")
    out = keys.groupingSets([[F.col("year")], [F.col("county")], []], "year", "county").agg(
        F.sum(geo.cast("long")).alias("total_geo"), F.sum((geo & F.col("matched")).cast("long")).alias("matched_geo"), F.sum((geo & ~F.col("matched")).cast("long")).alias("unmatched_geo"), F.sum(F.col("non_geo").cast("long")).alias("non_geo")
    )
    return out.withColumn("geo_match_pct", coverage_pct(F.col("matched_geo"), F.col("total_geo")))


def hybrid_summary(sums: DataFrame, expected: DataFrame, keys: list[str]) -> DataFrame:
    """Sums beside expected ones: accuracy, and whether each of dem, rep and total is within 2 votes."""
    rows = sums.join(expected, keys)
    actual, want = [F.col(c) for c in ("dem_votes", "rep_votes", "total_votes")], [F.col(f"expected_{c}") for c in ("dem", "rep", "total")]
    return rows.withColumns({"accuracy_pct": accuracy_pct(actual, want), "ok": within(actual, want)})


def hybrid_report(districts: DataFrame, expected: DataFrame, calibrated: DataFrame, watch: list[str], keys: list[str]) -> DataFrame:
    """By contest (keys): method, margin_pct_<d> of each district of watch (null where it has no row), sums, and how they compare.

    districts: one scope's rows (keys, district, method, votes). expected: (keys, dem_votes,
    rep_votes, other_votes, benchmark); without a row there, benchmark and accuracy_pct are null
    and ok is false. calibrated: (keys, calibration_source), null where there is none.
    """
    total = sum(F.col(c) for c in VOTES)
    points = F.round(margin_pct(F.col("dem_votes"), F.col("rep_votes"), total), 2)
    margins = [F.max(F.when(F.col("district") == d, points)).alias(f"margin_pct_{d}") for d in watch]
    sums = districts.groupBy(*keys).agg(F.min("method").alias("method"), *margins, F.sum("dem_votes").alias("dem_votes"), F.sum("rep_votes").alias("rep_votes"), F.sum(total).alias("total_votes"))
    want = expected.select(*keys, "benchmark", F.col("dem_votes").alias("__dem"), F.col("rep_votes").alias("__rep"), total.alias("__total"))
    rows = sums.join(want, keys, "left").join(calibrated.select(*keys, "calibration_source"), keys, "left")
    actual, wanted = [F.col(c) for c in ("dem_votes", "rep_votes", "total_votes")], [F.col(c) for c in ("__dem", "__rep", "__total")]
    known = F.col("__total").isNotNull()
    rows = rows.withColumns({"accuracy_pct": F.when(known, accuracy_pct(actual, wanted)), "ok": F.coalesce(known & within(actual, wanted), F.lit(False))})
    return rows.select(*keys, "method", *[f"margin_pct_{d}" for d in watch], "dem_votes", "rep_votes", "total_votes", "benchmark", "accuracy_pct", "ok", "calibration_source")


def dataset_profile(rows: DataFrame, column: str) -> DataFrame:
    """Values of a column with their rows and share of all rows."""
    counts = rows.groupBy(column).agg(F.count("*").alias("rows"))
    return counts.join(rows.agg(F.count("*").alias("all")), how="cross").select(F.col(column).alias("value"), "rows", F.round(F.col("rows") / F.col("all"), 6).alias("share"))
