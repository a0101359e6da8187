"""Keys, labels and measures over labels and votes derived from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from votealloc.functions import keys as K
from votealloc.functions import measures as M
from votealloc.plans import binding as B
from votealloc.plans.registry import register


def _labelled(key: str, sql: str, **columns):
    """A query that adds columns to the label table, and its SQL."""

    @register(key, B.oracle(B.LAB, select=f"SELECT k, {sql} FROM lab"))
    def query(spark, sf_dir):
        return B.labels(spark, sf_dir).select("k", *[make().alias(name) for name, make in columns.items()])

    return query


def _named(key: str, table: str, source, sql: str, **columns):
    @register(key, B.oracle(table, select=f"SELECT k, {sql} FROM {table.split()[0]}"))
    def query(spark, sf_dir):
        return source(spark, sf_dir).select("k", *[make().alias(name) for name, make in columns.items()])

    return query



@register("k1_geoid_pad", "SELECT c_custkey AS k, CASE WHEN length(t) < 15 THEN lpad(t, 15, '0') ELSE t END AS geoid, CASE WHEN length(t) < 3 THEN lpad(t, 3, '0') ELSE t END AS county_code FROM (SELECT c_custkey, trim(' ' || (c_custkey * 97)::VARCHAR) AS t FROM customer)")
def geoid_pad(spark, sf_dir):
    text = F.concat(F.lit(" "), (F.col("c_custkey") * 97).cast("string"))
    return B.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), K.pad(text, 15).alias("geoid"), K.pad(text, 3).alias("county_code"))


_labelled(
    "k2_norm_key",
    "upper(trim(label)) AS norm, regexp_replace(upper(trim(label)), '\\s+', ' ', 'g') AS spaced, regexp_replace(upper(trim(label)), '[^A-Z0-9]', '', 'g') AS compact",
    norm=lambda: K.norm(F.col("label")), spaced=lambda: K.norm_spaces(F.col("label")), compact=lambda: K.compact(F.col("label")),
)


@register("k3_norm_district", """
WITH d AS (SELECT c_custkey AS k, CASE c_custkey % 5 WHEN 0 THEN '000' WHEN 1 THEN concat('0', CAST(c_custkey % 60 AS VARCHAR), '.0') WHEN 2 THEN 'UN' WHEN 3 THEN CAST(c_custkey % 60 AS VARCHAR) ELSE concat(' ', CAST(c_custkey % 9 AS VARCHAR), 'A') END AS t FROM customer)
SELECT k, coalesce(nullif(regexp_replace(regexp_replace(trim(t), '\\.0$', ''), '^0+', ''), ''), '0') AS map_district,
       CASE WHEN upper(trim(t)) <> 'UN' THEN coalesce(CAST(CAST(try_cast(trim(t) AS DOUBLE) AS INT) AS VARCHAR), upper(trim(t))) END AS stats_district FROM d""")  # fmt: skip
def norm_district(spark, sf_dir):
    k = F.col("c_custkey")
    small = (k % 60).cast("string")
    text = F.when(k % 5 == 0, "000").when(k % 5 == 1, F.concat(F.lit("0"), small, F.lit(".0"))).when(k % 5 == 2, "UN").when(k % 5 == 3, small).otherwise(F.concat(F.lit(" "), (k % 9).cast("string"), F.lit("A")))
    return B.table(spark, sf_dir, "customer").select(k.alias("k"), K.district_of_map(text).alias("map_district"), K.district_of_stats(text).alias("stats_district"))


_PAIR = "concat(CASE WHEN length({a}) < 2 THEN lpad({a}, 2, '0') ELSE {a} END, '-', CASE WHEN length({b}) < 2 THEN lpad({b}, 2, '0') ELSE {b} END)"


def _pair(text: str, pattern: str) -> str:
    a, b = (f"CAST(CAST(nullif(regexp_extract({text}, '{pattern}', {g}), '') AS INT) AS VARCHAR)" for g in (1, 2))
    return f"CASE WHEN regexp_matches({text}, '{pattern}') THEN {_PAIR.format(a=a, b=b)} END"


P = "upper(trim(label))"
CT = "upper(trim(county))"
_labelled("k4_precinct_bucket", f"coalesce({_pair(P, '^0*([0-9]{1,3})-0*([0-9]{1,3})[A-Z]?$')}, trim(split_part({P}, '-', 1))) AS bucket", bucket=lambda: K.precinct_bucket(F.col("label")))

_BARE = f"trim(replace(replace({P}, 'PRECINCT', ' '), 'VTD', ' '))"
_CODE = f"coalesce(nullif(trim(split_part({_BARE}, '_', 1)), ''), {_BARE})"
_PCT = r"^PCT\s*0*([0-9]{1,3})(\.[0-9]+)?$"
_PN = f"CAST(CAST(nullif(regexp_extract({_BARE}, '{_PCT}', 1), '') AS INT) AS VARCHAR)"
_CLEANED = f"""coalesce(
  CASE WHEN {CT} = 'ROBESON' AND {P} = 'LUM 1' THEN '14' END,
  CASE WHEN regexp_matches({_BARE}, '{_PCT}') THEN concat(CASE WHEN {CT} = 'MECKLENBURG' AND length({_PN}) < 3 THEN lpad({_PN}, 3, '0') ELSE {_PN} END, regexp_extract({_BARE}, '{_PCT}', 2)) END,
  {_pair(_CODE, chr(92) + "b([0-9]{1,3})-([0-9]{1,3})[A-Z]?" + chr(92) + "b")},
  CASE WHEN regexp_matches({_CODE}, '^[0-9]+$') THEN CASE WHEN {CT} = 'ROBESON' AND length(CAST(CAST({_CODE} AS BIGINT) AS VARCHAR)) < 2 THEN lpad(CAST(CAST({_CODE} AS BIGINT) AS VARCHAR), 2, '0') ELSE CAST(CAST({_CODE} AS BIGINT) AS VARCHAR) END END,
  nullif(regexp_extract({_CODE}, '^([0-9A-Z-]*[0-9][0-9A-Z-]*)(?:\\s|$)', 1), ''), {_CODE})"""
_labelled("k5_clean_precinct", f"{_CLEANED} AS cleaned", cleaned=lambda: K.clean_precinct(F.col("label"), F.col("county")))
_labelled("k6_vtd_code", f"coalesce(nullif(regexp_extract({P}, '\\b([0-9]{{2}}-[0-9]{{2}})[A-Z]?\\b', 1), ''), trim(replace({P}, 'PRECINCT', ' '))) AS vtd", vtd=lambda: K.vtd_code(F.col("label")))
_TOKEN = f"trim(regexp_replace(translate(replace(replace(replace(replace(replace({P}, 'PRECINCT', ' '), 'PCT', ' '), 'PRCT', ' '), 'VTD', ' '), 'WARD', ' '), '-_.', '   '), '\\s+', ' ', 'g'))"
_labelled("k7_normalize_precinct_token", f"{_TOKEN} AS token", token=lambda: K.precinct_token(F.col("label")))
_CMP = "regexp_replace({0}, '[^A-Z0-9]', '', 'g')"
_VARIANTS = f"""SELECT k, p AS a FROM x UNION SELECT k, {_CMP.format('p')} FROM x UNION SELECT k, t FROM x UNION SELECT k, {_CMP.format('t')} FROM x
  UNION SELECT k, trim(split_part(p, '_', 1)) FROM x WHERE contains(p, '_') UNION SELECT k, trim(substr(p, instr(p, '_') + 1)) FROM x WHERE contains(p, '_')
  UNION SELECT k, {_CMP.format("split_part(p, '_', 1)")} FROM x WHERE contains(p, '_') UNION SELECT k, {_CMP.format("substr(p, instr(p, '_') + 1)")} FROM x WHERE contains(p, '_')
  UNION SELECT k, f FROM y UNION SELECT k, {_CMP.format('f')} FROM y UNION SELECT k, r FROM y UNION SELECT k, {_CMP.format('r')} FROM y
  UNION SELECT k, concat(CAST(m AS VARCHAR), '.', CAST(n AS VARCHAR)) FROM z UNION SELECT k, concat(m2, '.', CAST(n AS VARCHAR)) FROM z
  UNION SELECT k, concat(m2, CAST(n AS VARCHAR)) FROM z UNION SELECT k, concat(m2, CASE WHEN n < 10 THEN concat('0', CAST(n AS VARCHAR)) ELSE CAST(n AS VARCHAR) END) FROM z
  UNION SELECT k, CAST(CAST(p AS BIGINT) AS VARCHAR) FROM x WHERE regexp_matches(p, '^[0-9]+$') UNION SELECT k, CASE WHEN length(p) < 4 THEN lpad(p, 4, '0') ELSE p END FROM x WHERE regexp_matches(p, '^[0-9]+$')"""
_XYZ = f"""x AS (SELECT k, {P} AS p, {_TOKEN} AS t FROM lab),
y AS (SELECT k, split_part(t, ' ', 1) AS f, trim(substr(t, length(split_part(t, ' ', 1)) + 1)) AS r FROM x WHERE regexp_matches(split_part(t, ' ', 1), '[0-9]')),
z AS (SELECT *, CASE WHEN m < 10 THEN concat('0', CAST(m AS VARCHAR)) ELSE CAST(m AS VARCHAR) END AS m2 FROM (SELECT k, CAST(regexp_extract(p, '^([0-9]+)[.-]([0-9]+)$', 1) AS BIGINT) AS m, CAST(regexp_extract(p, '^([0-9]+)[.-]([0-9]+)$', 2) AS BIGINT) AS n FROM x WHERE regexp_matches(p, '^([0-9]+)[.-]([0-9]+)$')))"""


@register("k8_alias_variants", B.oracle(B.LAB, _XYZ, f"v AS ({_VARIANTS})", select="SELECT k, a AS alias FROM v WHERE a <> ''"))
def alias_variants(spark, sf_dir):
    return B.labels(spark, sf_dir).select("k", F.explode(K.alias_variants(F.col("label"))).alias("alias"))


def _marks(marks) -> str:
    return " OR ".join(f"contains({P}, '{m}')" for m in marks)


_REAL = f"({P} = 'PROVIDENCE' OR ({CT} IN ('CASWELL', 'WAKE') AND {P} = 'PROVI'))"
_labelled(
    "k9_is_non_geographic",
    f"NOT {_REAL} AND ({_marks(K.NON_GEO_MARKS['full'])} OR regexp_matches({P}, '^OS([ _-]|$)|^OS[A-Z0-9]+|(^|[^A-Z0-9])OS([^A-Z0-9]|$)|^ONESTOP( |$)|^EV[A-Z0-9]+$')) AS by_full, "
    f"NOT {_REAL} AND ({_marks(K.NON_GEO_MARKS['lines'])} OR regexp_matches({P}, '(^|[^A-Z0-9])OS([^A-Z0-9]|$)|^OS-|^EV[ _-]|[ _-]EV ')) AS by_lines, ({_marks(K.NON_GEO_MARKS['simple'])}) AS by_simple",
    by_full=lambda: K.is_non_geographic(F.col("label"), F.col("county")), by_lines=lambda: K.is_non_geographic(F.col("label"), F.col("county"), "lines"), by_simple=lambda: K.is_non_geographic(F.col("label"), None, "simple"),
)

_named(
    "k10_office_key", B.OFF, B.offices,
    """CASE k % 14 WHEN 0 THEN 'president' WHEN 1 THEN 'us_senate' WHEN 2 THEN concat('nc_court_of_appeals_judge_seat_', lpad(CAST(k % 15 AS VARCHAR), 2, '0'))
    WHEN 3 THEN 'nc_supreme_court_associate_justice_edmunds_hill_seat' WHEN 4 THEN 'nc_supreme_court_chief_justice' WHEN 5 THEN 'nc_court_of_appeals_judge_tyson_seat'
    WHEN 6 THEN 'nc_court_of_appeals_judge_davis_seat' WHEN 9 THEN 'president' WHEN 10 THEN 'lieutenant_governor' WHEN 11 THEN 'superintendent' WHEN 13 THEN 'governor' END AS contest_type""",
    contest_type=lambda: K.office_key(F.col("office")),
)
_WORDS = " ".join(f"WHEN contains(lower(office), '{w}'){' AND NOT contains(lower(office), ' + chr(39) + 'lieutenant' + chr(39) + ')' if w == 'governor' else ''} THEN '{k}'" for w, k in K.OFFICE_WORDS)
_named("k11_office_key_keyword", B.OFF, B.offices, f"CASE {_WORDS} ELSE replace(replace(lower(office), ' ', '_'), '.', '') END AS contest_type", contest_type=lambda: K.office_key_by_word(F.col("office")))
_named(
    "k12_office_sets", B.OFF, B.offices,
    "regexp_replace(regexp_replace(lower(trim(office)), '[^a-z0-9]+', '_', 'g'), '^_|_$', '', 'g') AS slug, "
    f"office IN {K.COUNCIL + ('US PRESIDENT', 'US SENATE')} AS in_default, office IN {K.COUNCIL} AS in_council, "
    "starts_with(office, 'NC SUPREME COURT ') OR starts_with(office, 'NC COURT OF APPEALS ') AS in_judicial",
    slug=lambda: K.office_slug(F.col("office")), in_default=lambda: K.in_office_set(F.col("office"), "default"), in_council=lambda: K.in_office_set(F.col("office"), "council"), in_judicial=lambda: K.in_office_set(F.col("office"), "judicial"),
)


@register("k13_detect_office", B.oracle(B.OFF, select="SELECT min(office) AS office FROM off WHERE contains(upper(office), 'PRESIDENT') AND NOT contains(upper(office), 'REPRESENTATIVE')"))
def detect_office(spark, sf_dir):
    up = F.upper("office")
    return B.offices(spark, sf_dir).where(up.contains("PRESIDENT") & ~up.contains("REPRESENTATIVE")).agg(F.min("office").alias("office"))


_PT = "CASE o_orderkey % 5 WHEN 0 THEN 'DEM' WHEN 1 THEN ' rep' WHEN 2 THEN 'Democrat' WHEN 3 THEN 'r' ELSE 'GRE' END"


@register("k14_party_group", f"""SELECT o_orderkey AS k, CASE upper(trim({_PT})) WHEN 'DEM' THEN 'dem' WHEN 'REP' THEN 'rep' ELSE 'other' END AS strict,
  CASE WHEN upper(trim({_PT})) IN ('DEM', 'D', 'DEMOCRAT', 'DEMOCRATIC') THEN 'dem' WHEN upper(trim({_PT})) IN ('REP', 'R', 'REPUBLICAN') THEN 'rep' ELSE 'other' END AS loose FROM orders""")  # fmt: skip
def party_group(spark, sf_dir):
    party = F.expr(_PT)
    return B.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), K.party_group(party).alias("strict"), K.party_group(party, loose=True).alias("loose"))


@register("k15_party_override", B.oracle(B.RES, select="SELECT year, office, CASE WHEN year = 1996 AND candidate LIKE 'Rep Ash%' AND starts_with(office, '1-') THEN 'other' ELSE CASE party WHEN 'DEM' THEN 'dem' WHEN 'REP' THEN 'rep' ELSE 'other' END END AS party_group, sum(votes) AS votes FROM res GROUP BY 1, 2, 3"))
def party_override(spark, sf_dir):
    from votealloc.operators.allocate import override_party

    rules = spark.createDataFrame([(1996, "^REP ASH", "^1-", "other")], "year int, candidate_like string, office_like string, to_group string")
    return override_party(B.results(spark, sf_dir), rules).groupBy("year", "office", "party_group").agg(F.sum("votes").alias("votes"))


@register("k15_rules_by_token", B.oracle(B.RES, select="SELECT year, office, county, CASE WHEN candidate LIKE '% Ash' AND year = 1996 THEN 'other' WHEN year = 1997 AND starts_with(office, '1-') THEN 'rep' ELSE CASE party WHEN 'DEM' THEN 'dem' WHEN 'REP' THEN 'rep' ELSE 'other' END END AS party_group, sum(votes) AS votes FROM res GROUP BY 1, 2, 3, 4"))
def rules_by_token(spark, sf_dir):
    """Rules by words that many parts' numbers stand in for, of which three fit; two fit the same rows, and the lower place wins."""
    from votealloc.operators.allocate import override_party

    idle = B.table(spark, sf_dir, "part").select(F.lit(1996).alias("year"), F.concat(F.lit("PART"), F.col("p_partkey").cast("string")).alias("token"), F.lit("^X").alias("candidate_like"), F.lit("").alias("office_like"), F.lit("dem").alias("to_group"), F.lit(0).alias("place"))
    rules = spark.createDataFrame([(1996, "ASH", " ASH$", "", "other", 1), (1996, "ASH", "^REP ASH", "", "dem", 2), (1997, None, "", "^1-", "rep", 1)], "year int, token string, candidate_like string, office_like string, to_group string, place int")
    rows = override_party(B.results(spark, sf_dir), rules.unionByName(idle))
    return rows.groupBy("year", "office", "county", "party_group").agg(F.sum("votes").alias("votes"))


_named("k16_ticket_head", B.CAN, B.candidates, "CASE k % 9 WHEN 0 THEN 'DONALD J. TRUMP' WHEN 1 THEN 'A. Gore' WHEN 2 THEN trim(name) WHEN 4 THEN 'X' WHEN 7 THEN 'BUSH' WHEN 8 THEN 'Obama' ELSE trim(name) END AS head", head=lambda: K.ticket_head(F.col("name")))
_named("k17_canonical_candidate", B.CAN, B.candidates, "CASE WHEN k % 9 = 2 THEN 'Phil Berger, Jr.' ELSE trim(name) END AS canonical", canonical=lambda: K.canonical_candidate(F.col("name")))
_named("k18_candidate_fallback", B.CAN, B.candidates, "CASE WHEN trim(name) <> '' THEN trim(name) WHEN votes > 0 THEN 'Democratic (Unspecified)' ELSE 'No Democratic Candidate' END AS candidate", candidate=lambda: K.candidate_or_default(F.col("name"), F.col("votes"), "Democratic"))
_named("k19_district_from_office", B.OFF, B.offices, "CASE k % 14 WHEN 7 THEN CAST(k % 120 + 1 AS INT) WHEN 8 THEN CAST(k % 50 + 1 AS INT) END AS district", district=lambda: K.district_in_office(F.col("office")))


@register("k20_district_label", B.oracle(B.BLK, B.DMAP, select="SELECT DISTINCT scope, district, CASE scope WHEN 'state_house' THEN concat('HD-', lpad(district, 3, '0')) WHEN 'state_senate' THEN concat('SD-', lpad(district, 2, '0')) ELSE concat('CD-', lpad(district, 2, '0')) END AS label FROM dmap"))
def district_label(spark, sf_dir):
    return B.district_map(spark, sf_dir).select("scope", "district").distinct().withColumn("label", K.district_label(F.col("scope"), F.col("district")))


@register("k21_fips_county", "SELECT c_custkey AS k, n_name AS county FROM customer LEFT JOIN nation ON n_nationkey = CAST(lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS INT)")
def fips_county(spark, sf_dir):
    names = B.table(spark, sf_dir, "nation").select(K.pad_number(F.col("n_nationkey"), 3).alias("fips"), F.col("n_name").alias("county"))
    customer = B.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), K.pad_number(F.col("c_nationkey"), 3).alias("fips"))
    return customer.join(names, "fips", "left").select("k", "county")


_labelled(
    "k22_precinct_norm",
    "concat_ws(' - ', trim(regexp_replace(regexp_replace(upper(county), '[^A-Z0-9 .-]', ' ', 'g'), '\\s+', ' ', 'g')), trim(regexp_replace(regexp_replace(upper(label), '[^A-Z0-9 .-]', ' ', 'g'), '\\s+', ' ', 'g'))) AS precinct_norm",
    precinct_norm=lambda: K.precinct_norm(F.col("county"), F.col("label")),
)
_labelled("k23_safe_num", "coalesce(CAST(round_even(try_cast(trim(label) AS DOUBLE), 0) AS BIGINT), 0) AS as_int, coalesce(try_cast(trim(label) AS DOUBLE), -1.0) AS as_float", as_int=lambda: K.safe_int(F.trim("label")), as_float=lambda: K.safe_float(F.trim("label"), -1.0))

_VOTES = "SELECT c_custkey AS k, CAST(c_custkey % 97 AS DOUBLE) AS dem, CAST(c_custkey * 7 % 89 AS DOUBLE) AS rep, CAST(c_custkey % 5 AS DOUBLE) AS oth, CAST(c_custkey % 97 + c_custkey * 7 % 89 + c_custkey % 5 AS DOUBLE) AS total FROM customer"
_MPCT = "(CASE WHEN total = 0 THEN 0 ELSE (rep - dem) / total * 100 END)"


def _measured(key: str, sql: str, make):
    @register(key, f"WITH v AS ({_VOTES}) SELECT k, {sql} FROM v")
    def query(spark, sf_dir):
        k = F.col("c_custkey")
        dem, rep, oth = ((x).cast("double") for x in (k % 97, k * 7 % 89, k % 5))
        rows = B.table(spark, sf_dir, "customer").select(k.alias("k"), dem.alias("dem"), rep.alias("rep"), oth.alias("oth"), (dem + rep + oth).alias("total"))
        return rows.select("k", *[c.alias(name) for name, c in make(*(F.col(c) for c in ("dem", "rep", "oth", "total"))).items()])

    return query


def _steps(steps, both: bool, last: str) -> str:
    out = "CASE "
    for step in steps:
        shown = f"CASE WHEN {_MPCT} > 0 THEN '{step[1]}' ELSE '{step[2]}' END" if both else f"'{step[1]}'"
        out += f"WHEN abs({_MPCT}) >= {step[0]} THEN {shown} "
    return out + f"ELSE '{last}' END"


_measured("m1_margin", f"rep - dem AS margin, round({_MPCT}, 6) AS margin_pct", lambda d, r, o, t: {"margin": M.margin(d, r), "margin_pct": F.round(M.margin_pct(d, r, t), 6)})
_measured("m2_winner", "CASE WHEN rep > dem THEN 'REP' WHEN dem > rep THEN 'DEM' ELSE 'TIE' END AS winner, CASE WHEN total = 0 THEN 'N/A' WHEN rep > dem THEN 'REP' WHEN dem > rep THEN 'DEM' ELSE 'TIE' END AS winner_or_na", lambda d, r, o, t: {"winner": M.winner(d, r), "winner_or_na": M.winner(d, r, t)})
_measured("m3_competitiveness_color", f"{_steps(M.COLOR_STEPS, True, M.EVEN_COLOR)} AS color, {_steps(M.COLOR_STEPS[:-1], True, M.EVEN_COLOR)} AS color_without_tilt", lambda d, r, o, t: {"color": M.competitiveness_color(M.margin_pct(d, r, t)), "color_without_tilt": F.coalesce(M.competitiveness_color(M.margin_pct(d, r, t), tilt=False), F.lit(M.EVEN_COLOR))})
_measured("m4_margin_tier", f"{_steps(M.TIERS, False, 'Tossup')} AS tier, {_steps(M.TIERS_SHOWN, False, 'Tossup')} AS shown", lambda d, r, o, t: {"tier": M.margin_tier(M.margin_pct(d, r, t)), "shown": M.margin_tier(M.margin_pct(d, r, t), M.TIERS_SHOWN)})
_measured("m5_shares", "round(coalesce(dem / nullif(total, 0), 0), 6) AS dem_share, round(coalesce(rep / nullif(total, 0), 0), 6) AS rep_share, round(coalesce(oth / nullif(total, 0), 0), 6) AS other_share", lambda d, r, o, t: {"dem_share": M.share(d, t), "rep_share": M.share(r, t), "other_share": M.share(o, t)})
_measured("m6_coverage_pct", "round(coalesce(dem / nullif(total, 0) * 100, 0), 2) AS coverage", lambda d, r, o, t: {"coverage": M.coverage_pct(d, t)})
_measured(
    "m7_accuracy_pct",
    "round((greatest(0, 100 - coalesce(abs(dem - rep) / nullif(rep, 0) * 100, 0)) + greatest(0, 100 - coalesce(abs(rep - dem) / nullif(dem, 0) * 100, 0)) + greatest(0, 100 - coalesce(abs(total - oth - total) / nullif(total, 0) * 100, 0))) / 3, 4) AS accuracy, abs(dem - rep) <= 2 AND oth <= 2 AS ok",
    lambda d, r, o, t: {"accuracy": M.accuracy_pct([d, r, t - o], [r, d, t]), "ok": M.within([d, t - o], [r, t])},
)
_measured(
    "m8_largest_remainder",
    """CAST(fd + CASE WHEN (CASE WHEN xr > xd THEN 1 ELSE 0 END) + (CASE WHEN xo > xd THEN 1 ELSE 0 END) < n - fd - fr - fo THEN 1 ELSE 0 END AS BIGINT) AS dem_part,
       CAST(fr + CASE WHEN (CASE WHEN xd >= xr THEN 1 ELSE 0 END) + (CASE WHEN xo > xr THEN 1 ELSE 0 END) < n - fd - fr - fo THEN 1 ELSE 0 END AS BIGINT) AS rep_part,
       CAST(fo + CASE WHEN (CASE WHEN xd >= xo THEN 1 ELSE 0 END) + (CASE WHEN xr >= xo THEN 1 ELSE 0 END) < n - fd - fr - fo THEN 1 ELSE 0 END AS BIGINT) AS other_part
  FROM (SELECT k, n, floor(ed) AS fd, floor(er) AS fr, floor(eo) AS fo, round(ed - floor(ed), 9) AS xd, round(er - floor(er), 9) AS xr, round(eo - floor(eo), 9) AS xo FROM
        (SELECT k, 101 AS n, round(101.0 * dem / nullif(total, 0), 9) AS ed, round(101.0 * rep / nullif(total, 0), 9) AS er, round(101.0 * oth / nullif(total, 0), 9) AS eo FROM v)) AS parts --""",
    lambda d, r, o, t: dict(zip(("dem_part", "rep_part", "other_part"), M.largest_remainder(F.lit(101), [F.try_divide(x, t) for x in (d, r, o)]), strict=True)),
)
_measured("m9_split_pair", "CAST(total - round_even(round(total * 0.375, 9), 0) AS BIGINT) AS first, CAST(round_even(round(total * 0.375, 9), 0) AS BIGINT) AS second", lambda d, r, o, t: dict(zip(("first", "second"), M.split_pair(t, F.lit(0.375)), strict=True)))
