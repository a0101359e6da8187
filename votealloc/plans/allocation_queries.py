"""Joins, sums, shares and the reallocation operators over the election tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from votealloc.functions import measures as M
from votealloc.operators import aggregate as A
from votealloc.operators import allocate as R
from votealloc.plans import binding as B
from votealloc.plans.registry import register

_PG = "CASE party WHEN 'DEM' THEN 'dem' WHEN 'REP' THEN 'rep' ELSE 'other' END"
_THREE = "sum(CASE WHEN party = 'DEM' THEN votes ELSE 0 END) AS dem_votes, sum(CASE WHEN party = 'REP' THEN votes ELSE 0 END) AS rep_votes, sum(CASE WHEN party NOT IN ('DEM', 'REP') THEN votes ELSE 0 END) AS other_votes"


def _rounded(df, *columns, digits: int = 4):
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


def _r3(*columns):
    return ", ".join(f"round({c}, 4) AS {c}" for c in columns)


def _precincts(spark, sf_dir):
    """Precinct rows of three parties from the rows with a place."""
    rows = B.results(spark, sf_dir).where("precinct <> 'ABSENTEE'").withColumn("precinct_id", F.concat_ws(" - ", "county", "precinct"))
    return A.party_columns(rows, ["year", "office", "county", "precinct_id"])


def _counties(spark, sf_dir):
    return A.party_columns(B.results(spark, sf_dir), ["year", "office", "county"])


# Sums, pivots and choices.
@register("a1_sum_by_keys", B.oracle(B.RES, select="SELECT year, county, sum(votes) AS votes FROM res GROUP BY 1, 2"))
def sum_by_keys(spark, sf_dir):
    return A.sum_by(B.results(spark, sf_dir), ["year", "county"], "votes")


@register("a2_conditional_sum", B.oracle(B.RES, select=f"SELECT year, office, {_THREE} FROM res GROUP BY 1, 2"))
def conditional_sum(spark, sf_dir):
    return A.party_columns(B.results(spark, sf_dir), ["year", "office"])


@register("a3_party_pivot", B.oracle(B.RES, select=f"SELECT year, office, county, {_THREE} FROM res GROUP BY 1, 2, 3"))
def party_pivot(spark, sf_dir):
    return A.party_pivot(B.results(spark, sf_dir), ["year", "office", "county"])


@register("a4_first_candidate", B.oracle(B.RES, select="SELECT year, office, party, min_by(candidate, concat(county, '|', precinct, '|', candidate)) AS candidate FROM res GROUP BY 1, 2, 3"))
def first_candidate(spark, sf_dir):
    return A.first_by(B.results(spark, sf_dir), ["year", "office", "party"], "candidate", F.concat_ws("|", "county", "precinct", "candidate"))


@register("a5_top_candidate", B.oracle(B.RES, select="""SELECT year, office, party, candidate FROM (
  SELECT year, office, party, candidate, row_number() OVER (PARTITION BY year, office, party ORDER BY sum(votes) DESC, candidate DESC) AS n FROM res GROUP BY 1, 2, 3, 4) WHERE n = 1"""))  # fmt: skip
def top_candidate(spark, sf_dir):
    return A.top_candidate(B.results(spark, sf_dir), ["year", "office", "party"])


@register("a6_first_nonblank", B.oracle(B.RES, select="SELECT year, office, min_by(candidate, concat(county, precinct, candidate)) FILTER (WHERE candidate LIKE 'Rep%') AS candidate FROM res GROUP BY 1, 2"))
def first_nonblank(spark, sf_dir):
    return A.first_by(B.results(spark, sf_dir), ["year", "office"], "candidate", F.concat("county", "precinct", "candidate"), F.col("candidate").startswith("Rep"))


@register("a7_count_distinct", B.oracle(B.BLK, B.DMAP, select="SELECT scope, count(DISTINCT precinct_id) AS precincts, count(DISTINCT district) AS districts, count(DISTINCT CASE WHEN vap >= 5000 THEN district END) AS districts_over FROM blk JOIN dmap USING (block) GROUP BY 1"))
def count_distinct(spark, sf_dir):
    rows = B.blocks(spark, sf_dir).join(B.district_map(spark, sf_dir), "block")
    return rows.groupBy("scope").agg(F.count_distinct("precinct_id").alias("precincts"), F.count_distinct("district").alias("districts"), F.count_distinct(F.when(F.col("vap") >= 5000, F.col("district"))).alias("districts_over"))


@register("a8_distinct_list", B.oracle(B.BLK, B.DMAP, select="SELECT county, string_agg(DISTINCT district, ', ' ORDER BY district) AS districts FROM blk JOIN dmap USING (block) WHERE scope = 'state_senate' GROUP BY 1"))
def distinct_list(spark, sf_dir):
    rows = B.blocks(spark, sf_dir).join(B.district_map(spark, sf_dir).where("scope = 'state_senate'"), "block")
    return A.distinct_list(rows, ["county"], "district")


_WTS = """tot AS (SELECT precinct_id, sum(vap) AS people, min(block) AS first_block FROM blk GROUP BY 1),
wts AS (SELECT precinct_id, scope, district, sum(CASE WHEN people > 0 THEN vap::DOUBLE / people::DOUBLE WHEN block = first_block THEN 1.0 ELSE 0.0 END) AS weight
        FROM blk JOIN tot USING (precinct_id) JOIN dmap USING (block) GROUP BY 1, 2, 3)"""


@register("a9_min_max_audit", B.oracle(B.BLK, B.DMAP, _WTS, select="SELECT scope, round(min(w), 6) AS least, round(max(w), 6) AS most, count(*) AS precincts FROM (SELECT scope, precinct_id, sum(weight) AS w FROM wts GROUP BY 1, 2) GROUP BY 1"))
def min_max_audit(spark, sf_dir):
    sums = _weights(spark, sf_dir).groupBy("scope", "precinct_id").agg(F.sum("weight").alias("w"))
    return sums.groupBy("scope").agg(F.round(F.min("w"), 6).alias("least"), F.round(F.max("w"), 6).alias("most"), F.count("*").alias("precincts"))


def _weights(spark, sf_dir):
    return R.precinct_district_weights(B.blocks(spark, sf_dir), B.district_map(spark, sf_dir))


@register("a11_rollup_counts", B.oracle(B.BLK, B.DMAP, B.RES, select="""SELECT scope, year, count(*) AS rows, count(DISTINCT concat(scope, contest_type, year)) AS slices
  FROM (SELECT DISTINCT scope, office AS contest_type, year, district FROM res CROSS JOIN (SELECT DISTINCT scope, district FROM dmap)) GROUP BY GROUPING SETS ((scope), (year), ())"""))  # fmt: skip
def rollup_counts(spark, sf_dir):
    districts = B.district_map(spark, sf_dir).select("scope", "district").distinct()
    contests = B.results(spark, sf_dir).select("year", F.col("office").alias("contest_type")).distinct()
    return A.rollup_counts(contests.crossJoin(districts))


@register("w1_share_of_group", B.oracle(B.RES, select="SELECT year, office, county, votes, round(votes / sum(votes) OVER (PARTITION BY year, office), 9) AS share FROM (SELECT year, office, county, sum(votes) AS votes FROM res GROUP BY 1, 2, 3)"))
def share_of_group(spark, sf_dir):
    return _rounded(A.share_of_group(A.sum_by(B.results(spark, sf_dir), ["year", "office", "county"], "votes"), ["year", "office"], "votes"), "share", digits=9)


@register("w2_renormalize_weights", B.oracle(B.BLK, select="SELECT block, precinct_id, round(vap / sum(vap) OVER (PARTITION BY precinct_id), 9) AS weight FROM blk WHERE vap >= 1000"))
def renormalize_weights(spark, sf_dir):
    rows = B.blocks(spark, sf_dir).where("vap >= 1000").select("block", "precinct_id", F.col("vap").cast("double").alias("weight"))
    return _rounded(A.renormalize(rows, ["precinct_id"], "weight"), "weight", digits=9)


@register("w3_top1_per_key", B.oracle(B.BLK, select="SELECT precinct_id, block, vap FROM blk QUALIFY row_number() OVER (PARTITION BY precinct_id ORDER BY vap DESC, block) = 1"))
def top1_per_key(spark, sf_dir):
    return A.top_per_key(B.blocks(spark, sf_dir).select("precinct_id", "block", "vap"), ["precinct_id"], [F.desc("vap"), F.asc("block")])


@register("w5_latest_vs_previous", B.oracle(B.RES, select="SELECT office, county, year, votes, lag(votes) OVER w AS previous_votes, votes - lag(votes) OVER w AS votes_change FROM (SELECT office, county, year, sum(votes) AS votes FROM res GROUP BY 1, 2, 3) WINDOW w AS (PARTITION BY office, county ORDER BY year)"))
def latest_vs_previous(spark, sf_dir):
    return A.versus_previous(A.sum_by(B.results(spark, sf_dir), ["office", "county", "year"], "votes"), ["office", "county"], "votes")


@register("t2_top_k_per_group", B.oracle(B.RES, select="SELECT year, county, votes FROM (SELECT year, county, sum(votes) AS votes FROM res GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY year ORDER BY votes DESC, county) <= 5"))
def top_k_per_group(spark, sf_dir):
    return A.top_per_key(A.sum_by(B.results(spark, sf_dir), ["year", "county"], "votes"), ["year"], [F.desc("votes"), F.asc("county")], 5)


@register("u1_union_all", B.oracle(B.RES, select="SELECT 'geo' AS kind, county, votes FROM res WHERE precinct <> 'ABSENTEE' UNION ALL SELECT 'loose', county, votes FROM res WHERE precinct = 'ABSENTEE'"))
def union_all(spark, sf_dir):
    geo, loose = A.split_geographic(B.results(spark, sf_dir))
    return geo.select(F.lit("geo").alias("kind"), "county", "votes").unionByName(loose.select(F.lit("loose").alias("kind"), "county", "votes"))


@register("u2_key_union", B.oracle(B.RES, select="SELECT coalesce(d.county, r.county) AS county, coalesce(d.v, 0) AS dem, coalesce(r.v, 0) AS rep FROM (SELECT county, sum(votes) v FROM res WHERE party = 'DEM' AND year = 1996 GROUP BY 1) d FULL JOIN (SELECT county, sum(votes) v FROM res WHERE party = 'REP' AND year = 1997 GROUP BY 1) r ON d.county = r.county"))
def key_union(spark, sf_dir):
    rows = B.results(spark, sf_dir)
    dem, rep = (A.sum_by(rows.where(f"party = '{p}' and year = {y}"), ["county"], "votes").withColumnRenamed("votes", n) for p, y, n in (("DEM", 1996, "dem"), ("REP", 1997, "rep")))
    return dem.join(rep, "county", "full").select("county", F.coalesce("dem", F.lit(0.0)).alias("dem"), F.coalesce("rep", F.lit(0.0)).alias("rep"))


@register("u3_distinct_keys", B.oracle(B.RES, select="SELECT DISTINCT county, precinct FROM res"))
def distinct_keys(spark, sf_dir):
    return B.results(spark, sf_dir).select("county", "precinct").dropDuplicates(["county", "precinct"])


# Filters.
@register("f1_office_filter", B.oracle(B.RES, select="SELECT office, sum(votes) AS votes FROM res WHERE office IN ('1-URGENT', '2-HIGH') GROUP BY 1"))
def office_filter(spark, sf_dir):
    return A.sum_by(B.results(spark, sf_dir).where(F.col("office").isin("1-URGENT", "2-HIGH")), ["office"], "votes")


@register("f2_contest_regex", B.oracle(B.RES, select="SELECT DISTINCT office FROM res WHERE regexp_matches(office, '^[1-3]-')"))
def contest_regex(spark, sf_dir):
    return B.results(spark, sf_dir).where(F.col("office").rlike("^[1-3]-")).select("office").distinct()


@register("f3_year_range", B.oracle(B.RES, select="SELECT year, sum(votes) AS votes FROM res WHERE year BETWEEN 1996 AND 2000 AND year % 2 = 0 GROUP BY 1"))
def year_range(spark, sf_dir):
    return A.sum_by(B.results(spark, sf_dir).where(F.col("year").between(1996, 2000) & (F.col("year") % 2 == 0)), ["year"], "votes")


@register("f4_state_prefix", B.oracle(B.BLK, select="SELECT block, vap FROM blk WHERE starts_with(block, '00000000000001')"))
def state_prefix(spark, sf_dir):
    return B.blocks(spark, sf_dir).where(F.col("block").startswith("00000000000001")).select("block", "vap")


@register("f5_sliver_filter", B.oracle(B.BLK, B.DMAP, _WTS, select="SELECT precinct_id, scope, district, round(weight / sum(weight) OVER (PARTITION BY precinct_id, scope), 6) AS weight FROM wts WHERE weight >= 0.05"))
def sliver_filter(spark, sf_dir):
    return _rounded(A.renormalize(_weights(spark, sf_dir).where("weight >= 0.05"), ["precinct_id", "scope"], "weight"), "weight", digits=6)


@register("f6_non_zero_rows", B.oracle(B.BLK, select="SELECT block FROM blk WHERE vap <> 0"))
def non_zero_rows(spark, sf_dir):
    return B.blocks(spark, sf_dir).where("vap <> 0").select("block")


# Joins.
@register("j1_equi_inner", B.oracle(B.BLK, B.DMAP, select="SELECT scope, district, sum(vap)::BIGINT AS vap FROM blk JOIN dmap USING (block) GROUP BY 1, 2"))
def equi_inner(spark, sf_dir):
    return A.sum_by(B.blocks(spark, sf_dir).join(B.district_map(spark, sf_dir), "block"), ["scope", "district"], "vap")


@register("j2_equi_left", B.oracle(B.BLK, B.RES, "p AS (SELECT DISTINCT concat(county, ' - ', precinct) AS precinct_id FROM res)", select="SELECT precinct_id, coalesce(v, 0)::BIGINT AS vap FROM p LEFT JOIN (SELECT precinct_id, sum(vap) AS v FROM blk GROUP BY 1) USING (precinct_id)"))
def equi_left(spark, sf_dir):
    p = B.results(spark, sf_dir).select(F.concat_ws(" - ", "county", "precinct").alias("precinct_id")).distinct()
    v = A.sum_by(B.blocks(spark, sf_dir), ["precinct_id"], "vap")
    return p.join(v, "precinct_id", "left").select("precinct_id", F.coalesce("vap", F.lit(0)).alias("vap"))


@register("j3_full_outer", B.oracle(B.BLK, select="SELECT coalesce(a.county, b.county) AS county, coalesce(a.n, 0) AS big, coalesce(b.n, 0) AS empty FROM (SELECT county, count(*) n FROM blk WHERE vap > 9000 GROUP BY 1) a FULL JOIN (SELECT county, count(*) n FROM blk WHERE vap = 0 GROUP BY 1) b ON a.county = b.county"))
def full_outer(spark, sf_dir):
    rows = B.blocks(spark, sf_dir)
    big, empty = (rows.where(w).groupBy("county").agg(F.count("*").alias(n)) for w, n in (("vap > 9000", "big"), ("vap = 0", "empty")))
    return big.join(empty, "county", "full").select("county", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("big", "empty")])


@register("j4_left_anti", B.oracle(B.BLK, B.RES, select="SELECT DISTINCT concat(county, ' - ', precinct) AS precinct_id FROM res WHERE concat(county, ' - ', precinct) NOT IN (SELECT precinct_id FROM blk)"))
def left_anti(spark, sf_dir):
    p = B.results(spark, sf_dir).select(F.concat_ws(" - ", "county", "precinct").alias("precinct_id")).distinct()
    return p.join(B.blocks(spark, sf_dir).select("precinct_id"), "precinct_id", "left_anti")


@register("j5_left_semi", B.oracle(B.BLK, B.RES, select="SELECT DISTINCT concat(county, ' - ', precinct) AS precinct_id FROM res WHERE concat(county, ' - ', precinct) IN (SELECT precinct_id FROM blk)"))
def left_semi(spark, sf_dir):
    p = B.results(spark, sf_dir).select(F.concat_ws(" - ", "county", "precinct").alias("precinct_id")).distinct()
    return p.join(B.blocks(spark, sf_dir).select("precinct_id"), "precinct_id", "left_semi")


@register("j6_map_lookup", B.oracle(B.RES, select=f"SELECT candidate, min({_PG}) AS party_group, sum(votes) AS votes FROM res GROUP BY 1"))
def map_lookup(spark, sf_dir):
    rows = R.override_party(B.results(spark, sf_dir))
    party = rows.groupBy("candidate").agg(F.min("party_group").alias("party_group"))
    return A.sum_by(rows.drop("party_group").join(party, "candidate"), ["candidate", "party_group"], "votes")


@register("j7_theta_join", B.oracle(B.RES, select="SELECT vintage, sum(votes) AS votes FROM res JOIN (VALUES (1995, 1996, 'old'), (1997, 1999, 'mid'), (2000, 9999, 'new')) AS v(y0, y1, vintage) ON year BETWEEN y0 AND y1 GROUP BY 1"))
def theta_join(spark, sf_dir):
    from votealloc.sources.readers import vintage_by_year

    return A.sum_by(vintage_by_year(B.results(spark, sf_dir), [(1995, 1996, "old"), (1997, 1999, "mid"), (2000, 9999, "new")]), ["vintage"], "votes")


@register("j7_first_range", """WITH rng AS (
  SELECT p_partkey * 3 % 1501 AS low, p_partkey * 3 % 1501 + CASE p_partkey % 4 WHEN 0 THEN 2 WHEN 1 THEN 40 WHEN 2 THEN 0 ELSE 700 END AS high, p_partkey % 9 AS place, p_name AS name FROM part
  UNION ALL SELECT NULL, 60, 3, 'low end' UNION ALL SELECT 1450, NULL, 0, 'high end')
SELECT c_custkey AS k, name FROM customer LEFT JOIN rng ON (low IS NULL OR c_custkey >= low) AND (high IS NULL OR c_custkey <= high)
QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY place, coalesce(low, -1e9), coalesce(high, 1e9), name) = 1""")
def first_range_join(spark, sf_dir):
    """Of very many overlapping ranges, narrow, wide and open, the first by place for each customer."""
    from votealloc.operators.ranges import first_range

    k = F.col("p_partkey")
    low = (k * 3 % 1501).cast("long")
    more = F.when(k % 4 == 0, 2).when(k % 4 == 1, 40).when(k % 4 == 2, 0).otherwise(700)
    ranges = B.table(spark, sf_dir, "part").select(low.alias("low"), (low + more).alias("high"), (k % 9).alias("place"), F.col("p_name").alias("name"))
    ends = spark.createDataFrame([(None, 60, 3, "low end"), (1450, None, 0, "high end")], "low long, high long, place long, name string")
    return first_range(B.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")), ranges.unionByName(ends), "k", how="left")


@register("j8_prefix_join", B.oracle(B.BLK, select="""SELECT a.county, a.short, min(b.precinct_id) AS precinct_id FROM (SELECT DISTINCT county, substr(precinct_id, 1, length(county) + 5) AS short FROM blk) a
  JOIN (SELECT DISTINCT county, precinct_id FROM blk) b ON a.county = b.county AND starts_with(b.precinct_id, a.short) GROUP BY 1, 2 HAVING count(*) = 1"""))  # fmt: skip
def prefix_join(spark, sf_dir):
    rows = B.blocks(spark, sf_dir)
    short = rows.select("county", F.expr("substr(precinct_id, 1, length(county) + 5)").alias("short")).distinct()
    full = rows.select("county", "precinct_id").distinct()
    hits = short.join(full, "county").where(F.col("precinct_id").startswith(F.col("short")))
    return hits.groupBy("county", "short").agg(F.count("*").alias("n"), F.min("precinct_id").alias("precinct_id")).where("n = 1").drop("n")


@register("j11_lookup_precedence", B.oracle(B.RES, select="SELECT year, county, coalesce(CASE WHEN year = 1996 THEN 'year:' || county END, CASE WHEN county < 'NATION_15' THEN 'any:' || county END, county) AS name, sum(votes) AS votes FROM res GROUP BY 1, 2, 3"))
def lookup_precedence(spark, sf_dir):
    from votealloc.operators.resolve import apply_overrides

    rows = A.sum_by(B.results(spark, sf_dir), ["year", "county"], "votes").withColumn("precinct_id", F.col("county"))
    names = rows.select("county").distinct()
    rules = names.select(F.lit("1996").alias("year"), F.col("county").alias("raw"), F.concat(F.lit("year:"), "county").alias("canonical"))
    rules = rules.unionByName(names.where("county < 'NATION_15'").select(F.lit("*").alias("year"), F.col("county").alias("raw"), F.concat(F.lit("any:"), "county").alias("canonical")))
    return apply_overrides(rows, rules).select("year", "county", F.col("precinct_id").alias("name"), "votes")


# Reallocation.
_NG = """geo AS (SELECT year, office, county, concat(county, ' - ', precinct) AS precinct_id, candidate, sum(votes) AS v FROM res WHERE precinct <> 'ABSENTEE' GROUP BY ALL),
loose AS (SELECT year, office, county, candidate, sum(votes) AS l FROM res WHERE precinct = 'ABSENTEE' GROUP BY ALL),
own AS (SELECT year, office, county, candidate, sum(v) AS o FROM geo GROUP BY ALL),
plain AS (SELECT g.*, g.v + coalesce(l.l * g.v / nullif(o.o, 0), 0) AS p FROM geo g JOIN own o USING (year, office, county, candidate) LEFT JOIN loose l USING (year, office, county, candidate)),
homeless AS (SELECT * FROM loose ANTI JOIN (SELECT * FROM own WHERE o > 0) o USING (year, office, county, candidate)),
pool AS (SELECT year, office, county, sum(l) AS pool FROM homeless GROUP BY ALL),
bp AS (SELECT year, office, county, precinct_id, sum(v) AS here FROM geo GROUP BY ALL),
extra AS (SELECT b.*, pool * here / sum(here) OVER (PARTITION BY year, office, county) AS extra FROM bp b JOIN pool USING (year, office, county)),
placed AS (SELECT p.year, p.office, p.county, p.precinct_id, p.candidate, p.p + coalesce(e.extra * p.p / sum(p.p) OVER (PARTITION BY p.year, p.office, p.county, p.precinct_id), 0) AS votes
           FROM plain p LEFT JOIN extra e USING (year, office, county, precinct_id))"""
_PPV = f"""party AS (SELECT year, office, candidate, min({_PG}) AS pg FROM res GROUP BY ALL),
ppv AS (SELECT year, office, county, precinct_id, sum(CASE WHEN pg = 'dem' THEN votes ELSE 0 END) AS dem_votes, sum(CASE WHEN pg = 'rep' THEN votes ELSE 0 END) AS rep_votes, sum(CASE WHEN pg = 'other' THEN votes ELSE 0 END) AS other_votes
        FROM placed JOIN party USING (year, office, candidate) GROUP BY ALL)"""


@register("r1_precinct_party_votes", B.oracle(B.RES, _NG, _PPV, select=f"SELECT year, office, county, precinct_id, {_r3(*A.VOTES)} FROM ppv"))
def precinct_party_votes(spark, sf_dir):
    return _rounded(R.precinct_party_votes(B.results(spark, sf_dir)), *A.VOTES)


_BV = """shat AS (
  SELECT year, office, precinct_id, block, largest,
         dem_votes, rep_votes, other_votes,
         floor(dem_votes::HUGEINT * 1000000 * vap::HUGEINT / nullif(people, 0)) AS d, vap, people FROM pre JOIN blk USING (precinct_id) JOIN (SELECT precinct_id, sum(vap)::HUGEINT AS people, arg_min(block, concat(lpad((99999999 - vap)::VARCHAR, 9, '0'), block)) AS largest FROM blk GROUP BY 1) USING (precinct_id))"""


@register("r2_shatter_votes", B.oracle(B.RES, B.BLK, B.PRE, select="SELECT year, office, block, round(dem_votes * vap / people, 4) AS dem_votes, round(rep_votes * vap / people, 4) AS rep_votes FROM pre JOIN blk USING (precinct_id) JOIN (SELECT precinct_id, sum(vap) AS people, arg_min(block, concat(lpad((99999999 - vap)::VARCHAR, 9, '0'), block)) AS largest FROM blk GROUP BY 1) USING (precinct_id) WHERE block <> largest"))
def shatter_votes(spark, sf_dir):
    blocks, _ = R.shatter(_precincts(spark, sf_dir), B.blocks(spark, sf_dir), ["dem_votes", "rep_votes"], with_largest=True)
    rows = blocks.where("not largest")
    return rows.select("year", "office", "block", *[F.round(F.col(c).cast("double"), 4).alias(c) for c in ("dem_votes", "rep_votes")])


@register("w4_residual_to_largest", B.oracle(B.RES, B.BLK, B.PRE, select="SELECT year, office, precinct_id, dem_votes AS votes, dem_votes AS on_blocks, 0.0 AS delta FROM pre WHERE precinct_id IN (SELECT precinct_id FROM blk)"))
def residual_to_largest(spark, sf_dir):
    _, audit = R.shatter(_precincts(spark, sf_dir), B.blocks(spark, sf_dir), ["dem_votes"])
    return audit.select("year", "office", "precinct_id", F.col("dem_votes").alias("votes"), F.col("block_dem_votes").alias("on_blocks"), F.col("delta_dem_votes").alias("delta"))


@register("r3_allocate_non_geo_by_candidate", B.oracle(B.RES, _NG, select=f"SELECT year, office, county, precinct_id, candidate, {_r3('votes')} FROM placed"))
def allocate_non_geo(spark, sf_dir):
    return _rounded(R.spread_non_geographic(B.results(spark, sf_dir))[0], "votes")


_KEPT = """kept AS (SELECT year, office, county, precinct_id, candidate, sum(votes) AS votes FROM (
  SELECT year, office, county, precinct_id, candidate, p AS votes FROM plain
  UNION ALL SELECT year, office, county, precinct_id, h.candidate, l * here / there FROM homeless h JOIN (SELECT *, sum(here) OVER (PARTITION BY year, office, county) AS there FROM bp) USING (year, office, county) WHERE there > 0) GROUP BY ALL)"""


@register("r3_keep_candidate", B.oracle(B.RES, _NG, _KEPT, select=f"SELECT year, office, county, precinct_id, candidate, {_r3('votes')} FROM kept"))
def keep_candidate(spark, sf_dir):
    return _rounded(R.spread_non_geographic(B.results(spark, sf_dir), keep_candidate=True)[0], "votes")


_SHARES = "cs AS (SELECT county, scope, district, sum(vap)::DOUBLE AS people, sum(vap)::DOUBLE / nullif(sum(sum(vap)) OVER (PARTITION BY county, scope), 0)::DOUBLE AS share FROM blk JOIN dmap USING (block) GROUP BY 1, 2, 3)"


def _county_shares(spark, sf_dir):
    return R.area_shares(B.blocks(spark, sf_dir), B.district_map(spark, sf_dir), ["county"])


@register("r4_non_geo_county_weights", B.oracle(B.RES, B.BLK, B.DMAP, B.PRE, _WTS, _SHARES, f"ng AS (SELECT year, office, county, {_THREE} FROM res WHERE precinct = 'ABSENTEE' GROUP BY 1, 2, 3)", select="""
  SELECT year, office, scope, district, round(sum(d), 4) AS dem_votes, round(sum(r), 4) AS rep_votes, round(sum(o), 4) AS other_votes FROM (
  SELECT year, office, scope, district, dem_votes * weight AS d, rep_votes * weight AS r, other_votes * weight AS o FROM pre JOIN wts USING (precinct_id)
  UNION ALL SELECT year, office, scope, district, dem_votes * share, rep_votes * share, other_votes * share FROM ng JOIN cs USING (county)) GROUP BY 1, 2, 3, 4"""))  # fmt: skip
def non_geo_county_weights(spark, sf_dir):
    base = R.allocate(_precincts(spark, sf_dir), _weights(spark, sf_dir))
    return _rounded(R.add_county_pool(base, R.county_non_geographic(B.results(spark, sf_dir)), _county_shares(spark, sf_dir)), *A.VOTES)


@register("r5_aggregate_to_districts", B.oracle(B.RES, B.BLK, B.DMAP, B.PRE, _WTS, select="SELECT year, office, scope, district, round(sum(dem_votes * weight), 3) AS dem_votes, round(sum(rep_votes * weight), 3) AS rep_votes FROM pre JOIN wts USING (precinct_id) GROUP BY 1, 2, 3, 4"))
def aggregate_to_districts(spark, sf_dir):
    sums = R.shatter_to_districts(_precincts(spark, sf_dir), B.blocks(spark, sf_dir), B.district_map(spark, sf_dir), ["dem_votes", "rep_votes"])
    return _rounded(sums, "dem_votes", "rep_votes", digits=3)


@register("r6_county_shares", B.oracle(B.BLK, B.DMAP, _SHARES, select="SELECT county, scope, district, round(share, 9) AS share FROM cs WHERE share IS NOT NULL"))
def county_shares(spark, sf_dir):
    return _rounded(_county_shares(spark, sf_dir), "share", digits=9)


_BUCKET = "CASE WHEN regexp_matches(split_part(precinct_id, ' - ', 2), '^0*([0-9]{1,3})-0*([0-9]{1,3})[A-Z]?$') THEN NULL ELSE trim(split_part(split_part(precinct_id, ' - ', 2), '-', 1)) END"
_BSH = f"bs AS (SELECT county, {_BUCKET} AS bucket, scope, district, sum(vap)::DOUBLE / nullif(sum(sum(vap)) OVER (PARTITION BY county, {_BUCKET}, scope), 0)::DOUBLE AS share FROM blk JOIN dmap USING (block) GROUP BY 1, 2, 3, 4)"


def _bucket_shares(spark, sf_dir):
    return R.area_shares(B.blocks(spark, sf_dir).withColumn("bucket", R.bucket_of(F.col("precinct_id"))), B.district_map(spark, sf_dir), ["county", "bucket"])


@register("r7_bucket_shares", B.oracle(B.BLK, B.DMAP, _BSH, select="SELECT county, bucket, scope, district, round(share, 9) AS share FROM bs WHERE share IS NOT NULL"))
def bucket_shares(spark, sf_dir):
    return _rounded(_bucket_shares(spark, sf_dir), "share", digits=9)


_MAN = "man AS (SELECT scope, upper(n_name) AS county, CAST(n_nationkey % 3 + 1 AS VARCHAR) AS district, CASE WHEN n_nationkey % 5 = 0 THEN 0.005 ELSE 0.4 END AS share FROM nation CROSS JOIN (VALUES ('congressional')) AS s(scope) WHERE n_nationkey < 10 UNION ALL SELECT 'congressional', upper(n_name), '9', 0.1 FROM nation WHERE n_nationkey < 10 AND n_nationkey % 5 <> 0)"


@register("r8_county_share_overrides", B.oracle(B.BLK, B.DMAP, _SHARES, _MAN, select="SELECT county, scope, district, round(share, 9) AS share FROM cs WHERE share IS NOT NULL AND (scope, county) NOT IN (SELECT (scope, county) FROM man) UNION ALL SELECT county, scope, district, round(share / sum(share) OVER (PARTITION BY scope, county), 9) FROM man WHERE share >= 0.01"))
def county_share_overrides(spark, sf_dir):
    nation = B.table(spark, sf_dir, "nation").where("n_nationkey < 10").select(F.lit("congressional").alias("scope"), F.upper("n_name").alias("county"), "n_nationkey")
    k = F.col("n_nationkey")
    manual = nation.select("scope", "county", (k % 3 + 1).cast("string").alias("district"), F.when(k % 5 == 0, 0.005).otherwise(0.4).alias("share"))
    manual = manual.unionByName(nation.where(k % 5 != 0).select("scope", "county", F.lit("9").alias("district"), F.lit(0.1).alias("share")))
    return _rounded(R.override_shares(_county_shares(spark, sf_dir), manual), "share", digits=9)


_FALL = """lost AS (SELECT DISTINCT county, precinct_id, CASE WHEN true THEN trim(split_part(split_part(precinct_id, ' - ', 2), '-', 1)) END AS bucket FROM {src} WHERE precinct_id NOT IN (SELECT precinct_id FROM blk)),
asked AS (SELECT * FROM lost CROSS JOIN (SELECT DISTINCT scope FROM dmap)),
byb AS (SELECT precinct_id, a.scope, district, share AS weight, 'bucket' AS method FROM asked a JOIN bs ON a.county = bs.county AND a.bucket = bs.bucket AND a.scope = bs.scope WHERE share IS NOT NULL),
byc AS (SELECT precinct_id, a.scope, district, share AS weight, 'county' AS method FROM asked a JOIN cs ON a.county = cs.county AND a.scope = cs.scope WHERE share IS NOT NULL AND (precinct_id, a.scope) NOT IN (SELECT (precinct_id, scope) FROM byb)),
fall AS (SELECT * FROM byb UNION ALL SELECT * FROM byc)"""


def _fallback(spark, sf_dir, precincts, matched):
    scopes = B.district_map(spark, sf_dir).select("scope").distinct()
    return R.fallback_weights(precincts, matched, _county_shares(spark, sf_dir), _bucket_shares(spark, sf_dir), scopes)


@register("r9_unmatched_fallback", B.oracle(B.RES, B.BLK, B.DMAP, B.PRE, _SHARES, _BSH, _FALL.format(src="pre"), select="SELECT precinct_id, scope, district, method, round(weight, 9) AS weight FROM fall"))
def unmatched_fallback(spark, sf_dir):
    weights = R.placed_weights(_precincts(spark, sf_dir), B.blocks(spark, sf_dir), B.district_map(spark, sf_dir))
    return _rounded(weights.where("method <> 'map'"), "weight", digits=9)


@register("r10_bucket_then_county_all", B.oracle(B.RES, B.BLK, B.DMAP, B.PRE, _SHARES, _BSH, _FALL.format(src="pre").replace("WHERE precinct_id NOT IN (SELECT precinct_id FROM blk)", ""), select="SELECT year, office, scope, district, round(sum(dem_votes * weight), 4) AS dem_votes, round(sum(rep_votes * weight), 4) AS rep_votes, round(sum(other_votes * weight), 4) AS other_votes FROM pre JOIN fall USING (precinct_id) GROUP BY 1, 2, 3, 4"))
def bucket_then_county_all(spark, sf_dir):
    precincts = _precincts(spark, sf_dir)
    none = _weights(spark, sf_dir).where("false")
    return _rounded(R.allocate(precincts, _fallback(spark, sf_dir, precincts, none)), *A.VOTES)


_MEAS = f"""round_even(round(dv, 9), 0) AS dem_votes, round_even(round(rv, 9), 0) AS rep_votes, round_even(round(ov, 9), 0) AS other_votes"""
_COLOR = "CASE " + " ".join(f"WHEN abs(pct) >= {s[0]} THEN CASE WHEN pct > 0 THEN '{s[1]}' ELSE '{s[2]}' END" for s in M.COLOR_STEPS) + f" ELSE '{M.EVEN_COLOR}' END"
_FLAG = B.oracle(
    B.RES, B.BLK, B.DMAP, _NG, _PPV, _WTS, _SHARES, _BSH, _FALL.format(src="ppv"),
    "allw AS (SELECT precinct_id, scope, district, weight FROM wts UNION ALL SELECT precinct_id, scope, district, weight FROM fall)",
    "sums AS (SELECT year, office, scope, district, sum(dem_votes * weight) AS dv, sum(rep_votes * weight) AS rv, sum(other_votes * weight) AS ov FROM ppv JOIN allw USING (precinct_id) GROUP BY 1, 2, 3, 4)",
    f"m AS (SELECT year, office, scope, district, {_MEAS} FROM sums)",
    "m2 AS (SELECT *, dem_votes + rep_votes + other_votes AS total_votes, rep_votes - dem_votes AS margin, coalesce((rep_votes - dem_votes) / nullif(dem_votes + rep_votes + other_votes, 0) * 100, 0) AS pct FROM m)",
    select=f"SELECT year, office, scope, district, dem_votes, rep_votes, other_votes, total_votes, margin, round(pct, 2) AS margin_pct, CASE WHEN rep_votes > dem_votes THEN 'REP' WHEN dem_votes > rep_votes THEN 'DEM' ELSE 'TIE' END AS winner, {_COLOR} AS color FROM m2",
)


@register("r11_party_to_scope", _FLAG)
def party_to_scope(spark, sf_dir):
    return R.district_results(B.results(spark, sf_dir), B.blocks(spark, sf_dir), B.district_map(spark, sf_dir))


#: The map's part and the fallback's are rounded each, then added.
_COMPAT = _FLAG.replace("allw AS (SELECT precinct_id, scope, district, weight FROM wts UNION ALL SELECT precinct_id, scope, district, weight FROM fall)", "allw AS (SELECT precinct_id, scope, district, weight, 1 AS stage FROM wts UNION ALL SELECT precinct_id, scope, district, weight, 2 FROM fall)").replace(
    "sums AS (SELECT year, office, scope, district, sum(dem_votes * weight) AS dv, sum(rep_votes * weight) AS rv, sum(other_votes * weight) AS ov FROM ppv JOIN allw USING (precinct_id) GROUP BY 1, 2, 3, 4)",
    "parts AS (SELECT year, office, scope, district, stage, round_even(round(sum(dem_votes * weight), 9), 0) AS dv, round_even(round(sum(rep_votes * weight), 9), 0) AS rv, round_even(round(sum(other_votes * weight), 9), 0) AS ov FROM ppv JOIN allw USING (precinct_id) GROUP BY 1, 2, 3, 4, 5),\nsums AS (SELECT year, office, scope, district, sum(dv) AS dv, sum(rv) AS rv, sum(ov) AS ov FROM parts GROUP BY 1, 2, 3, 4)",
)


@register("r11_compat_rounding", _COMPAT)
def compat_rounding(spark, sf_dir):
    return R.district_results(B.results(spark, sf_dir), B.blocks(spark, sf_dir), B.district_map(spark, sf_dir), compat_rounding=True)


@register("r12_county_fallback_diagnostic", B.oracle(B.RES, B.BLK, B.DMAP, B.PRE, _SHARES, "sh AS (SELECT county, scope, sum(share) AS s FROM cs GROUP BY 1, 2)", "l AS (SELECT year, office, county, sum(dem_votes + rep_votes + other_votes) AS u FROM pre WHERE precinct_id NOT IN (SELECT precinct_id FROM blk) GROUP BY 1, 2, 3)", select="SELECT year, office, county, u AS unmatched_votes, " + ", ".join(f"round(u * coalesce((SELECT s FROM sh WHERE sh.county = l.county AND scope = '{s}'), 0), 4) AS {s}_allocated, round(u * (1 - coalesce((SELECT s FROM sh WHERE sh.county = l.county AND scope = '{s}'), 0)), 4) + 0.0 AS {s}_left" for s in B.SCOPES) + " FROM l"))
def county_fallback_diagnostic(spark, sf_dir):
    return R.fallback_diagnostic(_precincts(spark, sf_dir), _weights(spark, sf_dir), _county_shares(spark, sf_dir))


@register("r14_county_fallback_map", B.oracle(B.BLK, B.DMAP, _SHARES, select="SELECT county, scope, district, 1.0 AS share FROM cs WHERE share >= 0.3"))
def county_fallback_map(spark, sf_dir):
    return R.dominant_shares(_county_shares(spark, sf_dir), 0.3)


_CTYW = B.CTY


@register("r15_county_totals_allocate", B.oracle(B.RES, B.BLK, B.DMAP, _CTYW, _SHARES, select="SELECT year, office, scope, district, round(sum(dem_votes * share), 4) AS dem_votes, round(sum(rep_votes * share), 4) AS rep_votes, round(sum(other_votes * share), 4) AS other_votes FROM cty JOIN cs USING (county) GROUP BY 1, 2, 3, 4"))
def county_totals_allocate(spark, sf_dir):
    weights = _county_shares(spark, sf_dir).select(F.col("county").alias("precinct_id"), "scope", "district", F.col("share").alias("weight"))
    return _rounded(R.allocate(_counties(spark, sf_dir).withColumn("precinct_id", F.col("county")), weights), *A.VOTES)


_VTD = f"""vg AS (SELECT year, office, county, trim(replace(precinct, 'PRECINCT', ' ')) AS vtd, {_PG} AS party_group, sum(votes) AS votes FROM res WHERE precinct <> 'ABSENTEE' GROUP BY ALL),
vl AS (SELECT year, office, county, {_PG} AS party_group, sum(votes) AS pool FROM res WHERE precinct = 'ABSENTEE' GROUP BY ALL)"""


@register("r16_vtd_party_totals", B.oracle(B.RES, _VTD, select="SELECT * FROM vg"))
def vtd_party_totals(spark, sf_dir):
    return R.vtd_totals(B.results(spark, sf_dir))[0]


@register("r17_vtd_non_geo_perf", B.oracle(B.RES, _VTD, select="SELECT year, office, county, vtd, party_group, round(votes + coalesce(pool * votes / sum(votes) OVER (PARTITION BY year, office, county, party_group), 0), 4) AS votes FROM vg LEFT JOIN vl USING (year, office, county, party_group)"))
def vtd_non_geo_perf(spark, sf_dir):
    return _rounded(R.spread_to_vtds(*R.vtd_totals(B.results(spark, sf_dir))), "votes")


_VP = "vp AS (SELECT county, split_part(precinct_id, ' - ', 2) AS vtd, sum(vap)::DOUBLE AS vap FROM blk WHERE county < 'NATION_2' GROUP BY 1, 2), vps AS (SELECT county, vtd, vap / sum(vap) OVER (PARTITION BY county) AS share FROM vp)"


def _people(spark, sf_dir):
    rows = B.blocks(spark, sf_dir).where("county < 'NATION_2'").withColumn("vtd", F.split_part("precinct_id", F.lit(" - "), F.lit(2)))
    return A.sum_by(rows, ["county", "vtd"], "vap")


@register("r18_vtd_non_geo_vap", B.oracle(B.RES, B.BLK, _VTD, _VP, select="SELECT year, office, county, vg.vtd, party_group, round(votes + coalesce(pool * CASE WHEN county IN (SELECT county FROM vps) THEN coalesce(share, 0) ELSE votes / sum(votes) OVER (PARTITION BY year, office, county, party_group) END, 0), 4) AS votes FROM vg LEFT JOIN vl USING (year, office, county, party_group) LEFT JOIN vps USING (county, vtd)"))
def vtd_non_geo_vap(spark, sf_dir):
    return _rounded(R.spread_to_vtds(*R.vtd_totals(B.results(spark, sf_dir)), _people(spark, sf_dir)), "votes")


_SPL = "spl AS (SELECT county, split_part(precinct_id, ' - ', 2) AS vtd, scope, district, weight AS area_share FROM wts JOIN (SELECT DISTINCT county, precinct_id FROM blk) USING (precinct_id))"


def _splits(spark, sf_dir):
    names = B.blocks(spark, sf_dir).select("county", "precinct_id").distinct()
    return _weights(spark, sf_dir).join(names, "precinct_id").select("county", F.split_part("precinct_id", F.lit(" - "), F.lit(2)).alias("vtd"), "scope", "district", F.col("weight").alias("area_share"))


_SC = f"""tg AS (SELECT year, office, county, {_PG} AS party_group, sum(votes) * 1.25 AS target FROM res GROUP BY ALL), ac AS (SELECT year, office, county, party_group, sum(votes) AS actual FROM vg GROUP BY ALL),
sc AS (SELECT year, office, county, party_group, coalesce(target / nullif(actual, 0), 1.0) AS scale FROM tg LEFT JOIN ac USING (year, office, county, party_group))"""


def _scales(spark, sf_dir):
    geo, _ = R.vtd_totals(B.results(spark, sf_dir))
    target = A.sum_by(R.override_party(B.results(spark, sf_dir)), ["year", "office", "county", "party_group"], "votes").withColumn("votes", F.col("votes") * 1.25)
    return R.county_scales(A.sum_by(geo, ["year", "office", "county", "party_group"], "votes"), target)


@register("r20_county_scales", B.oracle(B.RES, _VTD, _SC, select="SELECT year, office, county, party_group, round(scale, 6) AS scale FROM sc"))
def county_scales(spark, sf_dir):
    return _rounded(_scales(spark, sf_dir), "scale", digits=6)


@register("r19_vtd_to_district", B.oracle(B.RES, B.BLK, B.DMAP, _WTS, _VTD, _SPL, _SC, select="SELECT year, office, scope, district, round(sum(CASE WHEN party_group = 'dem' THEN votes * area_share * coalesce(scale, 1) ELSE 0 END), 3) AS dem_votes, round(sum(CASE WHEN party_group = 'rep' THEN votes * area_share * coalesce(scale, 1) ELSE 0 END), 3) AS rep_votes, round(sum(CASE WHEN party_group = 'other' THEN votes * area_share * coalesce(scale, 1) ELSE 0 END), 3) AS other_votes FROM vg JOIN spl USING (county, vtd) LEFT JOIN sc USING (year, office, county, party_group) GROUP BY 1, 2, 3, 4"))
def vtd_to_district(spark, sf_dir):
    geo, _ = R.vtd_totals(B.results(spark, sf_dir))
    return _rounded(R.vtd_to_district(geo, _splits(spark, sf_dir), _scales(spark, sf_dir)), *A.VOTES, digits=3)


_H1 = "h1 AS (SELECT CAST(c_custkey AS VARCHAR) AS source, CAST(c_custkey % 50 AS VARCHAR) AS middle, 0.5 + c_custkey % 3 AS weight FROM customer UNION ALL SELECT CAST(c_custkey AS VARCHAR), CAST((c_custkey + 7) % 50 AS VARCHAR), 1.0 FROM customer), h2 AS (SELECT CAST(i AS VARCHAR) AS middle, CAST(i % 20 AS VARCHAR) AS target, 0.75 AS weight FROM range(50) t(i) UNION ALL SELECT CAST(i AS VARCHAR), CAST((i + 3) % 20 AS VARCHAR), 0.25 FROM range(50) t(i)), paths AS (SELECT source, target, sum(h1.weight * h2.weight) AS w FROM h1 JOIN h2 USING (middle) GROUP BY 1, 2), bridge AS (SELECT source, target, w / sum(w) OVER (PARTITION BY source) AS weight FROM paths)"


def _bridge(spark, sf_dir):
    k = F.col("c_custkey")
    customer = B.table(spark, sf_dir, "customer")
    first = customer.select(k.cast("string").alias("source"), (k % 50).cast("string").alias("middle"), (0.5 + k % 3).alias("weight"))
    first = first.unionByName(customer.select(k.cast("string").alias("source"), ((k + 7) % 50).cast("string").alias("middle"), F.lit(1.0).alias("weight")))
    i = F.col("id")
    second = spark.range(50).select(i.cast("string").alias("middle"), (i % 20).cast("string").alias("target"), F.lit(0.75).alias("weight"))
    second = second.unionByName(spark.range(50).select(i.cast("string").alias("middle"), ((i + 3) % 20).cast("string").alias("target"), F.lit(0.25).alias("weight")))
    return R.compose_bridge(first, second)


@register("r21_compose_bridge", "WITH " + _H1 + " SELECT source, target, round(weight, 9) AS weight FROM bridge")
def compose_bridge(spark, sf_dir):
    return _rounded(_bridge(spark, sf_dir), "weight", digits=9)


_OV = "ov AS (SELECT CAST(year(o_orderdate) AS INT) AS year, o_orderpriority AS office, CAST(o_custkey AS VARCHAR) AS block, CAST(count(*) AS DOUBLE) AS dem_votes FROM orders GROUP BY 1, 2, 3)"


@register("r22_apply_bridge", "WITH " + _H1 + ", " + _OV + " SELECT year, office, target AS block, round(sum(dem_votes * weight), 4) AS dem_votes FROM ov JOIN bridge ON block = source GROUP BY 1, 2, 3")
def apply_bridge(spark, sf_dir):
    votes = B.table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year"), F.col("o_orderpriority").alias("office"), F.col("o_custkey").cast("string").alias("block")).agg(F.count("*").cast("double").alias("dem_votes"))
    return _rounded(R.apply_bridge(votes, _bridge(spark, sf_dir), ["dem_votes"]), "dem_votes")


@register("r23_vintage_probe", B.oracle(B.BLK, select="SELECT round(avg(CASE WHEN b.block IS NULL THEN 0 ELSE 1 END), 6) AS hit_share, avg(CASE WHEN b.block IS NULL THEN 0 ELSE 1 END) >= 0.8 AS same_vintage FROM (SELECT DISTINCT lpad(CAST(o_custkey AS VARCHAR), 15, '0') AS block FROM orders) o LEFT JOIN blk b USING (block)"))
def vintage_probe(spark, sf_dir):
    ids = B.table(spark, sf_dir, "orders").select(F.lpad(F.col("o_custkey").cast("string"), 15, "0").alias("block"))
    return R.vintage_probe(ids, B.blocks(spark, sf_dir))


@register("r24_hybrid_method_ladder", B.oracle(B.RES, select="SELECT year, office, CASE WHEN year < 1997 THEN 'county' ELSE 'precinct' END AS method, sum(votes) AS votes FROM res WHERE year < 1997 OR precinct <> 'ABSENTEE' GROUP BY 1, 2, 3"))
def hybrid_method_ladder(spark, sf_dir):
    rows = B.results(spark, sf_dir)
    precinct = A.sum_by(rows.where("precinct <> 'ABSENTEE' and year >= 1997"), ["year", "office"], "votes").withColumns({"method": F.lit("precinct"), "priority": F.lit(1)})
    county = A.sum_by(rows, ["year", "office"], "votes").withColumns({"method": F.lit("county"), "priority": F.lit(2)})
    return R.best_method(precinct.unionByName(county), ["year", "office"]).select("year", "office", "method", "votes")


_WIDE = "wide AS (SELECT block, vap AS E_16_PRES_Total, vap * 2 // 5 AS E_16_PRES_Dem, vap // 2 AS E_16_PRES_Rep, k % 100 AS E_20_GOV_Total, k % 60 AS E_20_GOV_Dem, k % 50 AS E_20_GOV_Rep FROM blk)"


@register("r25_blockfile_direct", B.oracle(B.BLK, B.DMAP, _WIDE, "lng AS (SELECT block, 'E_16_PRES' AS contest, E_16_PRES_Total AS t, E_16_PRES_Dem AS d, E_16_PRES_Rep AS r FROM wide UNION ALL SELECT block, 'E_20_GOV', E_20_GOV_Total, E_20_GOV_Dem, E_20_GOV_Rep FROM wide)", "s AS (SELECT contest, scope, district, sum(d)::DOUBLE AS dem_votes, sum(r)::DOUBLE AS rep_votes, sum(greatest(t - d - r, 0))::DOUBLE AS other_votes FROM lng JOIN dmap USING (block) GROUP BY 1, 2, 3)", "m2 AS (SELECT *, dem_votes + rep_votes + other_votes AS total_votes, coalesce((rep_votes - dem_votes) / nullif(dem_votes + rep_votes + other_votes, 0) * 100, 0) AS pct FROM s)", select=f"SELECT contest, scope, district, dem_votes, rep_votes, other_votes, total_votes, rep_votes - dem_votes AS margin, round(pct, 2) AS margin_pct, CASE WHEN rep_votes > dem_votes THEN 'REP' WHEN dem_votes > rep_votes THEN 'DEM' ELSE 'TIE' END AS winner, {_COLOR} AS color FROM m2"))
def blockfile_direct(spark, sf_dir):
    v, k = F.col("vap"), F.col("k")
    wide = B.blocks(spark, sf_dir).select("block", v.alias("E_16_PRES_Total"), F.floor(v * 2 / 5).alias("E_16_PRES_Dem"), F.floor(v / 2).alias("E_16_PRES_Rep"), (k % 100).alias("E_20_GOV_Total"), (k % 60).alias("E_20_GOV_Dem"), (k % 50).alias("E_20_GOV_Rep"), k.alias("E_20_AUD_Total"))
    return R.block_file_districts(wide, B.district_map(spark, sf_dir))


@register("r26_direct_district_contests", B.oracle(B.RES, f"s AS (SELECT year, office, county, {_THREE} FROM res GROUP BY 1, 2, 3)", "c AS (SELECT year, office, county, party, candidate, row_number() OVER (PARTITION BY year, office, county, party ORDER BY sum(votes) DESC, candidate DESC) AS n FROM res GROUP BY 1, 2, 3, 4, 5)", "m2 AS (SELECT s.*, dem_votes + rep_votes + other_votes AS total_votes, (rep_votes - dem_votes) / (dem_votes + rep_votes + other_votes) * 100 AS pct, d.candidate AS dc, r.candidate AS rc FROM s LEFT JOIN c d ON d.year = s.year AND d.office = s.office AND d.county = s.county AND d.party = 'DEM' AND d.n = 1 LEFT JOIN c r ON r.year = s.year AND r.office = s.office AND r.county = s.county AND r.party = 'REP' AND r.n = 1)", select=f"SELECT year, office, county, dem_votes, rep_votes, other_votes, coalesce(dc, 'No Democratic Candidate') AS dem_candidate, coalesce(rc, 'No Republican Candidate') AS rep_candidate, total_votes, rep_votes - dem_votes AS margin, round(pct, 2) AS margin_pct, CASE WHEN rep_votes > dem_votes THEN 'REP' WHEN dem_votes > rep_votes THEN 'DEM' ELSE 'TIE' END AS winner, {_COLOR} AS color FROM m2"))
def direct_district_contests(spark, sf_dir):
    return R.direct_contests(B.results(spark, sf_dir), ["year", "office", "county"])


@register("r28_split_precinct", B.oracle(B.RES, select="SELECT year, office, county, party, candidate, 'MACHINERY' AS precinct_id, votes - round_even(votes * 0.25, 0) AS votes FROM res WHERE precinct = 'MACHINERY' UNION ALL SELECT year, office, county, party, candidate, 'MACHINERY-2', round_even(votes * 0.25, 0) FROM res WHERE precinct = 'MACHINERY' UNION ALL SELECT year, office, county, party, candidate, precinct, votes FROM res WHERE precinct <> 'MACHINERY'"))
def split_precinct(spark, sf_dir):
    rows = B.results(spark, sf_dir).withColumnRenamed("precinct", "precinct_id")
    return R.split_precinct(rows, "MACHINERY", "MACHINERY-2", 0.25, ["year", "office"]).select("year", "office", "county", "party", "candidate", "precinct_id", "votes")


@register("r29_precinct_results", B.oracle(B.RES, f"s AS (SELECT year, office, county, precinct, {_THREE}, min(CASE WHEN party = 'DEM' THEN candidate END) AS dem_candidate, min(CASE WHEN party = 'REP' THEN candidate END) AS rep_candidate FROM res GROUP BY 1, 2, 3, 4)", "m2 AS (SELECT *, dem_votes + rep_votes + other_votes AS total_votes, (rep_votes - dem_votes) / (dem_votes + rep_votes + other_votes) * 100 AS pct FROM s)", select=f"SELECT year, office, county, precinct, dem_votes, rep_votes, other_votes, dem_candidate, rep_candidate, total_votes, rep_votes - dem_votes AS margin, round(pct, 2) AS margin_pct, CASE WHEN rep_votes > dem_votes THEN 'REP' WHEN dem_votes > rep_votes THEN 'DEM' ELSE 'TIE' END AS winner, {_COLOR} AS color FROM m2"))
def precinct_results(spark, sf_dir):
    return R.precinct_results(B.results(spark, sf_dir), ["year", "office", "county", "precinct"])


@register("r30_batch_contests", B.oracle(B.RES, B.BLK, B.DMAP, B.PRE, _WTS, _SHARES, _BSH, _FALL.format(src="pre"), "allw AS (SELECT *, 'map' AS method FROM wts UNION ALL SELECT precinct_id, scope, district, weight, method FROM fall)", "pl AS (SELECT precinct_id, scope, max(CASE WHEN method = 'map' THEN 1 ELSE 0 END) AS direct FROM allw GROUP BY 1, 2)", select="""
  SELECT year, office, scope, t.total_precincts, matched_precincts::BIGINT AS matched_precincts, placed_precincts, districts, fallback_votes, round(100.0 * matched_precincts / total_precincts, 2) AS coverage_pct
  FROM (SELECT year, office, count(*) AS total_precincts FROM pre GROUP BY 1, 2) t
  JOIN (SELECT year, office, scope, sum(direct) AS matched_precincts, count(*) AS placed_precincts FROM pre JOIN pl USING (precinct_id) GROUP BY 1, 2, 3) USING (year, office)
  JOIN (SELECT year, office, scope, count(DISTINCT district) AS districts, round(sum(CASE WHEN method <> 'map' THEN (dem_votes + rep_votes + other_votes) * weight ELSE 0 END), 4) AS fallback_votes FROM pre JOIN allw USING (precinct_id) GROUP BY 1, 2, 3) USING (year, office, scope)"""))  # fmt: skip
def batch_contests(spark, sf_dir):
    precincts = _precincts(spark, sf_dir)
    return R.batch_summary(precincts, R.placed_weights(precincts, B.blocks(spark, sf_dir), B.district_map(spark, sf_dir)))


_CAL = "dist AS (SELECT year, office, scope, district, round_even(round(sum(dem_votes * weight), 9), 0) AS dem_votes, round_even(round(sum(rep_votes * weight), 9), 0) AS rep_votes, round_even(round(sum(other_votes * weight), 9), 0) AS other_votes FROM pre JOIN wts USING (precinct_id) GROUP BY 1, 2, 3, 4)"


@register("r27_calibrate_slices", B.oracle(B.RES, B.BLK, B.DMAP, B.PRE, _WTS, _CAL, """e AS (SELECT *, dem_votes + rep_votes + other_votes AS t, CAST(district AS INT) % 4 AS q FROM dist),
  x AS (SELECT *, CASE WHEN q > 0 THEN floor(round(t * 0.5, 9)) END AS fd, CASE WHEN q > 0 THEN floor(round(t * 0.25, 9)) END AS fr, floor(round(t * 0.25, 9)) AS fo, round(t * 0.5, 9) - floor(round(t * 0.5, 9)) AS xd, round(t * 0.25, 9) - floor(round(t * 0.25, 9)) AS xr FROM e),
  y AS (SELECT *, t - fd - fr - fo AS left_over FROM x)""", select="""SELECT year, office, scope, district, q > 0 AS calibrated,
  CASE WHEN q > 0 THEN fd + CASE WHEN (CASE WHEN xr > xd THEN 1 ELSE 0 END) + (CASE WHEN xr > xd THEN 1 ELSE 0 END) < left_over THEN 1 ELSE 0 END ELSE dem_votes END AS dem_votes,
  CASE WHEN q > 0 THEN fr + CASE WHEN (CASE WHEN xd >= xr THEN 1 ELSE 0 END) < left_over THEN 1 ELSE 0 END ELSE rep_votes END AS rep_votes, t AS total_votes FROM y"""))  # fmt: skip
def calibrate_slices(spark, sf_dir):
    sums = R.allocate(_precincts(spark, sf_dir), _weights(spark, sf_dir))
    districts = sums.withColumns({c: M.half_even(F.col(c)) for c in A.VOTES})
    names = B.district_map(spark, sf_dir).select("scope", "district").distinct().where(F.col("district").cast("int") % 4 > 0)
    stats = names.withColumns({"dem_share": F.lit(0.5), "rep_share": F.lit(0.25), "other_share": F.lit(0.25)})
    return R.calibrate(districts, stats, ["scope", "district"]).select("year", "office", "scope", "district", "calibrated", "dem_votes", "rep_votes", "total_votes")
