"""Writers: nested JSON only here, at the end; slices are partitions, so one job writes all of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


from votealloc.functions.measures import share

SLICE_KEYS = ["year", "scope", "contest_type"]
ROW = ["dem_votes", "rep_votes", "other_votes", "total_votes", "dem_candidate", "rep_candidate", "margin", "margin_pct", "winner"]


def district_slices(rows: DataFrame) -> DataFrame:
    """One document a slice: general.results by district, with candidates and colour where rows have them; votes are whole numbers."""
    whole = ("dem_votes", "rep_votes", "other_votes", "total_votes", "margin")
    row = F.struct(*[F.col(c).cast("long").alias(c) if c in whole else F.col(c) for c in ROW if c in rows.columns], F.struct(F.col("color")).alias("competitiveness"))
    results = F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("district"), row))))
    return rows.groupBy(*SLICE_KEYS).agg(F.struct(results.alias("results")).alias("general"))


def write_district_slices(rows: DataFrame, path: str) -> None:
    """A JSON file a slice, in folders by scope, contest and year; only those written are replaced."""
    out = district_slices(rows).withColumn("doc", F.to_json(F.struct(*SLICE_KEYS, "general"))).select("scope", "contest_type", "year", F.col("doc").alias("value"))
    out.write.partitionBy("scope", "contest_type", "year").option("partitionOverwriteMode", "dynamic").mode("overwrite").text(path)


def contest_slices(rows: DataFrame, key: str = "precinct_id") -> DataFrame:
    """One document a contest and year: rows in order of their key, those without votes dropped, and their totals."""
    held = rows.where("total_votes > 0")
    columns = [key, *[c for c in ROW if c in rows.columns]]
    return held.groupBy("year", "contest_type").agg(F.to_json(F.array_sort(F.collect_list(F.struct(*columns)))).alias("rows"), F.sum("dem_votes").alias("dem_total"), F.sum("rep_votes").alias("rep_total"), F.sum("other_votes").alias("other_total"))


def manifest(rows: DataFrame, keys: list[str]) -> DataFrame:
    """A line a slice: rows, totals, and whether both major parties have votes."""
    sums = rows.groupBy(*keys).agg(F.count("*").alias("rows"), *[F.sum(f"{p}_votes").alias(f"{p}_total") for p in ("dem", "rep", "other")])
    return sums.withColumn("major_party_contested", (F.col("dem_total") > 0) & (F.col("rep_total") > 0))


def upsert_manifest(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """new lines, and the old ones that no new line has the keys of."""
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new)


def merge_files(*frames: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of several files by keys; a later file's rows replace an earlier one's."""
    ranked = [f.withColumn("__rank", F.lit(i)) for i, f in enumerate(frames)]
    rows = ranked[0]
    for f in ranked[1:]:
        rows = rows.unionByName(f)
    last = rows.groupBy(*keys).agg(F.max("__rank").alias("__last"))
    return rows.join(last, keys).where("__rank = __last").drop("__rank", "__last")


def slice_precedence(slices: DataFrame, pattern: str | None = None, scopes: list[str] | None = None, years: tuple[int, int] | None = None) -> DataFrame:
    """Slices (dir_rank, scope, contest_type, year, ...) of the first folder that has them, after filters."""
    rows = slices
    if pattern:
        rows = rows.where(F.col("contest_type").rlike(pattern))
    if scopes:
        rows = rows.where(F.col("scope").isin(*scopes))
    if years:
        rows = rows.where(F.col("year").between(*years))
    first = rows.groupBy(*SLICE_KEYS).agg(F.min("dir_rank").alias("__first"))
    return rows.join(first, SLICE_KEYS).where("dir_rank = __first").drop("__first")


def long_points(rows: DataFrame) -> DataFrame:
    """Export rows: shares to 6 digits, margin_pct to 4, blanks for what is missing, in order of year, scope, contest and district number."""
    blank = {c: F.coalesce(F.col(c), F.lit("")) if c in rows.columns else F.lit("") for c in ("dem_candidate", "rep_candidate", "winner", "color")}
    out = rows.select(
        "year", "scope", "contest_type", "district", "dem_votes", "rep_votes", "other_votes", "total_votes",
        *[share(F.col(f"{p}_votes"), F.col("total_votes")).alias(f"{p}_share") for p in ("dem", "rep", "other")],
        "margin", F.round("margin_pct", 4).alias("margin_pct"), *[c.alias(n) for n, c in blank.items()],
    )
    return out.orderBy("year", "scope", "contest_type", F.col("district").try_cast("int").asc_nulls_last(), "district")


def point_summary(rows: DataFrame) -> DataFrame:
    from votealloc.operators.aggregate import rollup_counts

    return rollup_counts(rows)


def tileset_properties(rows: DataFrame, contests: list[str], years: list[int], fields: tuple[str, ...] = ("margin_pct", "winner")) -> DataFrame:
    """One line a district with a column for each contest, year and field (contest_year_field)."""
    picks = [F.max(F.when((F.col("contest_type") == c) & (F.col("year") == y), F.col(f))).alias(f"{norm_spaces_slug(c)}_{y}_{f}") for c in contests for y in years for f in fields]
    return rows.groupBy("scope", "district").agg(*picks)


def norm_spaces_slug(text: str) -> str:
    return "_".join(text.lower().replace("-", " ").split())


def write_block_votes(blocks: DataFrame, path: str) -> None:
    """Exact decimals as Parquet, by year; blocks are dealt first, since each task sorts its rows by year and few tasks may make very many."""
    blocks.repartition("year", "block").write.partitionBy("year").mode("overwrite").parquet(path)
