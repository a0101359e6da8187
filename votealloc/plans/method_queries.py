"""The ladder of seven methods over files that Spark writes from the tables, by year."""

from __future__ import annotations

from pyspark.sql import functions as F

from votealloc.operators import aggregate as A
from votealloc.operators import allocate as R
from votealloc.operators import methods as H
from votealloc.operators import reports as Q
from votealloc.plans import binding as B
from votealloc.plans.allocation_queries import _SHARES, _SPL, _THREE, _VTD, _WTS, _counties, _county_shares, _precincts, _splits, _weights
from votealloc.plans.registry import folder, register

OFFICES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
#: The years that each kind of file covers; a better one covers fewer, so each year goes to another method.
YEARS = {"block_direct": [2001], "legacy_direct": [2000, 2001], "legacy_bridge": [1999, 2000, 2001], "precinct_shatter": [1998, 1999, 2000, 2001], "vtd10_overlay": [1997, 1998, 1999, 2000, 2001], "vtd00_overlay": [1996, 1997, 1998, 1999, 2000, 2001]}


def _block_votes(spark, sf_dir, years, factor):
    """Votes of every block in every contest of the years."""
    k, n = F.col("k"), F.substring("office", 1, 1).cast("int")
    contests = [F.explode(F.array(*map(F.lit, years))).alias("year"), "k", "block", "precinct_id"]
    rows = B.blocks(spark, sf_dir).select(*contests).withColumn("office", F.explode(F.array(*map(F.lit, OFFICES))))
    votes = {"dem_votes": (k * factor + F.col("year") + n) % 11, "rep_votes": (k * (factor + 2) + F.col("year")) % 13, "other_votes": k % 3}
    return rows.select("year", "office", "block", *[v.cast("double").alias(c) for c, v in votes.items()])


def _bridge(spark, sf_dir):
    """Old blocks on new ones: three quarters on their own, a quarter on the first of their precinct."""
    rows = B.blocks(spark, sf_dir)
    first = rows.groupBy("precinct_id").agg(F.min("block").alias("first"))
    hops = F.explode(F.array(F.struct(F.col("block").alias("target"), F.lit(0.75).alias("weight")), F.struct(F.col("first").alias("target"), F.lit(0.25).alias("weight")))).alias("h")
    return rows.join(first, "precinct_id").select(F.concat(F.lit("L"), "block").alias("source"), hops).select("source", "h.*")


def ladder_sources(spark, sf_dir):
    """(facts, sources): each method's file, by year, and how its votes come to districts."""
    root = folder(spark)
    results, weights, district_map = B.results(spark, sf_dir), _weights(spark, sf_dir), B.district_map(spark, sf_dir)
    geo = R.vtd_totals(results)[0]
    # Votes of blocks are written year by year: a write by partitions would sort each task's rows of all years in memory.
    for method, factor in (("block_direct", 7), ("legacy_direct", 3), ("legacy_bridge", 5)):
        for year in YEARS[method]:
            votes = _block_votes(spark, sf_dir, [year], factor).drop("year")
            if method == "legacy_bridge":
                votes = votes.withColumn("block", F.concat(F.lit("L"), "block"))
            votes.write.parquet(f"{root}/{method}/year={year}")
    files = {
        "precinct_shatter": _precincts(spark, sf_dir),
        "vtd10_overlay": geo,
        "vtd00_overlay": geo,
        "county_share": _counties(spark, sf_dir).withColumn("precinct_id", F.col("county")),
    }
    for method, rows in files.items():
        kept = rows.where(F.col("year").isin(YEARS[method])) if method in YEARS else rows
        kept.write.partitionBy("year").parquet(f"{root}/{method}")
    read = {m: spark.read.parquet(f"{root}/{m}") for m in H.METHODS}
    of = lambda m, years: read[m].where(F.col("year").isin(years))
    blocks_to_districts = lambda rows: A.sum_by(rows.join(district_map, "block"), ["year", "office", "scope", "district"], *A.VOTES)
    shares = _county_shares(spark, sf_dir).select(F.col("county").alias("precinct_id"), "scope", "district", F.col("share").alias("weight"))
    by_count = R.area_shares(B.blocks(spark, sf_dir).withColumn("vap", F.lit(1)), district_map, ["county", "precinct_id"]).select("county", F.split_part("precinct_id", F.lit(" - "), F.lit(2)).alias("vtd"), "scope", "district", F.col("share").alias("area_share"))
    sources = {
        "block_direct": lambda years: blocks_to_districts(of("block_direct", years)),
        "legacy_direct": lambda years: blocks_to_districts(of("legacy_direct", years)),
        "legacy_bridge": lambda years: blocks_to_districts(R.apply_bridge(of("legacy_bridge", years), _bridge(spark, sf_dir))),
        "precinct_shatter": lambda years: R.allocate(of("precinct_shatter", years), weights),
        "vtd10_overlay": lambda years: R.vtd_to_district(of("vtd10_overlay", years), _splits(spark, sf_dir)),
        "vtd00_overlay": lambda years: R.vtd_to_district(of("vtd00_overlay", years), by_count),
        "county_share": lambda years: R.allocate(of("county_share", years), shares),
    }
    facts = [H.available(read[m], m, weights if m == "precinct_shatter" else None) for m in H.METHODS]
    every = facts[0]
    for more in facts[1:]:
        every = every.unionByName(more)
    return every, sources


_GROUP = "GROUP BY year, office, scope, district"
_SUMS = ", ".join(f"sum({c}) AS {c}" for c in A.VOTES)


def _blocks_sql(name, years, factor):
    listed = ", ".join(f"({y})" for y in years)
    offices = ", ".join(f"('{o}', {o[0]})" for o in OFFICES)
    return f"{name} AS (SELECT year, office, block, precinct_id, ((k * {factor} + year + n) % 11)::DOUBLE AS dem_votes, ((k * {factor + 2} + year) % 13)::DOUBLE AS rep_votes, (k % 3)::DOUBLE AS other_votes FROM blk CROSS JOIN (VALUES {listed}) AS y(year) CROSS JOIN (VALUES {offices}) AS o(office, n))"


_PARTY_SUMS = ", ".join(f"sum(CASE WHEN party_group = '{p}' THEN votes * {{share}} ELSE 0 END) AS {p}_votes" for p in A.PARTIES)
_LADDER = (
    B.RES, B.BLK, B.DMAP, B.PRE, B.CTY, _WTS, _VTD, _SPL, _SHARES, _blocks_sql("b1", [2001], 7), _blocks_sql("b2", [2000], 3), _blocks_sql("b3", [1999], 5),
    "hop AS (SELECT block AS source, block AS target, 0.75::DOUBLE AS weight FROM blk UNION ALL SELECT block, min(block) OVER (PARTITION BY precinct_id), 0.25 FROM blk)",
    "s00 AS (SELECT county, split_part(precinct_id, ' - ', 2) AS vtd, scope, district, count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY county, precinct_id, scope)::DOUBLE AS share FROM blk JOIN dmap USING (block) GROUP BY county, precinct_id, scope, district)",
    f"""lad AS (
  SELECT year, office, scope, district, {_SUMS}, 'block_direct' AS method FROM b1 JOIN dmap USING (block) {_GROUP}
  UNION ALL SELECT year, office, scope, district, {_SUMS}, 'legacy_direct' FROM b2 JOIN dmap USING (block) {_GROUP}
  UNION ALL SELECT year, office, scope, district, {", ".join(f"sum({c} * weight)" for c in A.VOTES)}, 'legacy_bridge' FROM b3 JOIN hop ON b3.block = source JOIN dmap ON dmap.block = target {_GROUP}
  UNION ALL SELECT year, office, scope, district, {", ".join(f"sum({c} * weight)" for c in A.VOTES)}, 'precinct_shatter' FROM pre JOIN wts USING (precinct_id) WHERE year = 1998 {_GROUP}
  UNION ALL SELECT year, office, scope, district, {_PARTY_SUMS.format(share="area_share")}, 'vtd10_overlay' FROM vg JOIN spl USING (county, vtd) WHERE year = 1997 {_GROUP}
  UNION ALL SELECT year, office, scope, district, {_PARTY_SUMS.format(share="share")}, 'vtd00_overlay' FROM vg JOIN s00 USING (county, vtd) WHERE year = 1996 {_GROUP}
  UNION ALL SELECT year, office, scope, district, {", ".join(f"sum({c} * share)" for c in A.VOTES)}, 'county_share' FROM cty JOIN cs USING (county) WHERE year < 1996 {_GROUP})""",
)
_ROUND = ", ".join(f"round({c}, 3) AS {c}" for c in A.VOTES)


@register("r24_method_ladder_districts", B.oracle(*_LADDER, select=f"SELECT year, office, scope, district, method, {_ROUND} FROM lad"))
def method_ladder_districts(spark, sf_dir):
    found = H.best_results(*ladder_sources(spark, sf_dir))
    return found.withColumns({c: F.round(c, 3) for c in A.VOTES})


@register(
    "q4_hybrid_report",
    B.oracle(
        *_LADDER,
        f"sm AS (SELECT year, office, any_value(method) AS method, sum(dem_votes) AS dem_votes, sum(rep_votes) AS rep_votes, sum(dem_votes + rep_votes + other_votes) AS total_votes, {', '.join(f'''round(max(CASE WHEN district = '{d}' THEN coalesce((rep_votes - dem_votes) / nullif(dem_votes + rep_votes + other_votes, 0) * 100, 0) END), 2) AS margin_pct_{d}''' for d in ('3', '7'))} FROM lad WHERE scope = 'state_house' GROUP BY 1, 2)",
        f"ex AS (SELECT year, office, {_THREE}, sum(votes) AS total_votes FROM res GROUP BY 1, 2)",
        select="SELECT sm.year, sm.office, method, margin_pct_3, margin_pct_7, round(sm.dem_votes, 3) AS dem_votes, round(sm.rep_votes, 3) AS rep_votes, round(sm.total_votes, 3) AS total_votes, CASE WHEN ex.year IS NOT NULL THEN 'statewide' END AS benchmark, CASE WHEN ex.year IS NOT NULL THEN round(round((greatest(0, 100 - coalesce(abs(sm.dem_votes - ex.dem_votes) / nullif(ex.dem_votes, 0), 0) * 100) + greatest(0, 100 - coalesce(abs(sm.rep_votes - ex.rep_votes) / nullif(ex.rep_votes, 0), 0) * 100) + greatest(0, 100 - coalesce(abs(sm.total_votes - ex.total_votes) / nullif(ex.total_votes, 0), 0) * 100)) / 3, 4), 2) END AS accuracy_pct, coalesce(abs(sm.dem_votes - ex.dem_votes) <= 2 AND abs(sm.rep_votes - ex.rep_votes) <= 2 AND abs(sm.total_votes - ex.total_votes) <= 2, false) AS ok, CASE WHEN sm.year = 1997 THEN 'county targets' END AS calibration_source FROM sm LEFT JOIN ex ON sm.year = ex.year AND sm.office = ex.office AND sm.year < 1999",
    ),
)
def hybrid_report(spark, sf_dir):
    """Block files have numbers of their own, so the statewide results are no benchmark for their years."""
    found = H.best_results(*ladder_sources(spark, sf_dir)).where("scope = 'state_house'")
    expected = A.party_columns(B.results(spark, sf_dir).where("year < 1999"), ["year", "office"]).withColumn("benchmark", F.lit("statewide"))
    calibrated = B.results(spark, sf_dir).where("year = 1997").select("year", "office", F.lit("county targets").alias("calibration_source")).distinct()
    rows = Q.hybrid_report(found, expected, calibrated, ["3", "7"], ["year", "office"])
    return rows.withColumns({c: F.round(c, 3) for c in ("dem_votes", "rep_votes", "total_votes")}).withColumn("accuracy_pct", F.round("accuracy_pct", 2))
