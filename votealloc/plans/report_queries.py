"""Key resolution, geometry, demographics, reports, exports and trends over the election tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from votealloc.functions import measures as M
from votealloc.operators import aggregate as A
from votealloc.operators import allocate as R
from votealloc.operators import analytics as Y
from votealloc.operators import demographics as P
from votealloc.operators import geometry as G
from votealloc.operators import reports as Q
from votealloc.operators import resolve as X
from votealloc.operators.identity import identities
from votealloc.plans import binding as B
from votealloc.plans.allocation_queries import _COLOR, _THREE, _WTS, _precincts, _rounded, _weights
from votealloc.plans.key_queries import _CLEANED, _TOKEN, _VARIANTS, CT as COUNTY, P as LABEL
from votealloc.plans.registry import folder, register
from votealloc.sources import readers as S
from votealloc.sources import sinks as K

# Key resolution.
_FEAT = "feat AS (SELECT k, upper(trim(county)) AS county, upper(trim(label)) AS code, CASE WHEN k % 2 = 0 THEN 'OAK HILL' ELSE 'ELM' END AS description FROM lab)"
_TEXTS = """lab2 AS (SELECT k * 4 AS k, code AS label FROM feat UNION ALL SELECT k * 4 + 1, description FROM feat UNION ALL SELECT k * 4 + 2, concat(code, '_', description) FROM feat UNION ALL SELECT k * 4 + 3, concat(code, ' ', description) FROM feat)"""


def _forms(source: str, tag: str) -> str:
    """The label forms of table source as (k, a) in table v{tag}."""
    from votealloc.plans.key_queries import _XYZ

    text = f"{_XYZ.replace('FROM lab)', f'FROM {source})')}, v AS ({_VARIANTS})"
    for name in ("x", "y", "z", "v"):
        text = text.replace(f"\n{name} AS", f"\n{name}{tag} AS").replace(f", {name} AS", f", {name}{tag} AS").replace(f"FROM {name} ", f"FROM {name}{tag} ").replace(f"FROM {name}\n", f"FROM {name}{tag}\n").replace(f"FROM {name})", f"FROM {name}{tag})")
    return ("x" + tag + text[1:]) if text.startswith("x AS") else text


_INDEX = "idx AS (SELECT DISTINCT f.county, v1.a AS alias, concat(f.county, ' - ', f.code) AS canonical FROM v1 JOIN feat f ON f.k = v1.k // 4 WHERE v1.a <> '')"


def _features(spark, sf_dir):
    rows = B.labels(spark, sf_dir)
    return rows.select("county", F.col("label").alias("code"), F.when(F.col("k") % 2 == 0, "OAK HILL").otherwise("ELM").alias("description"))


@register("x4_alias_index", B.oracle(B.LAB, _FEAT, _TEXTS, _forms("lab2", "1"), _INDEX, select="SELECT county, alias, canonical FROM idx"))
def alias_index(spark, sf_dir):
    return X.alias_index(_features(spark, sf_dir))


_KEYS = "keys AS (SELECT DISTINCT CASE WHEN k % 11 = 0 THEN label WHEN k % 13 = 0 THEN concat('NOWHERE - ', label) WHEN k % 17 = 0 THEN concat(upper(trim(county)), ' - ', label, ' QQ') ELSE concat(upper(trim(county)), ' - ', label) END AS key FROM lab)"


def _keys(spark, sf_dir):
    k = F.col("k")
    # The label is named once: each further place would spell it out again, in code too long for the JVM to compile.
    place = F.when(k % 11 == 0, "").when(k % 13 == 0, "NOWHERE - ").otherwise(F.concat(F.upper(F.trim("county")), F.lit(" - ")))
    tail = F.when((k % 11 != 0) & (k % 13 != 0) & (k % 17 == 0), " QQ").otherwise("")
    key = F.concat(place, "label", tail)
    return B.labels(spark, sf_dir).select("k", key.alias("key"))


_RES6 = f"""k2 AS (SELECT row_number() OVER (ORDER BY key) AS k, key, upper(trim(split_part(key, ' - ', 1))) AS county, upper(trim(split_part(key, ' - ', 2))) AS p FROM keys),
k3 AS (SELECT k, key, county, contains(key, ' - ') AS good,
  NOT (p = 'PROVIDENCE' OR (county IN ('CASWELL', 'WAKE') AND p = 'PROVI')) AND (contains(p, 'ABSENTEE') OR contains(p, 'PROVISIONAL') OR contains(p, 'CURBSIDE') OR contains(p, 'ONE STOP') OR contains(p, 'EARLY VOT') OR contains(p, 'TRANSFER') OR contains(p, 'MAIL') OR contains(p, 'STOP ') OR contains(p, 'EARLY ') OR regexp_matches(p, '(^|[^A-Z0-9])OS([^A-Z0-9]|$)|^OS-|^EV[ _-]|[ _-]EV ')) AS loose,
  CASE WHEN county = 'WAKE' AND regexp_matches(p, '\\b[0-9]{{2}}-[0-9]{{2}}\\b') THEN regexp_extract(p, '\\b([0-9]{{2}}-[0-9]{{2}})\\b', 1) ELSE p END AS label FROM k2)"""
_RES7 = """hits AS (SELECT k3.k, count(DISTINCT canonical) AS n, min(canonical) AS one FROM k3 JOIN v2 ON v2.k = k3.k JOIN idx ON idx.county = k3.county AND idx.alias = v2.a WHERE v2.a <> '' GROUP BY 1),
solved AS (SELECT key, CASE WHEN NOT good THEN 'bad_key' WHEN loose THEN 'non_geographic' WHEN county NOT IN (SELECT county FROM idx) THEN 'no_county' WHEN n = 1 THEN 'matched' WHEN n > 1 THEN 'ambiguous' ELSE 'unmatched' END AS status, one FROM k3 LEFT JOIN hits USING (k))"""
_SOLVE = (B.LAB, _FEAT, _TEXTS, _forms("lab2", "1"), _INDEX, _KEYS, _RES6, _forms("k3", "2"), _RES7)


@register("x6_resolve_key", B.oracle(*_SOLVE, select="SELECT key, CASE WHEN status = 'matched' THEN one END AS canonical, status FROM solved"))
def resolve_key(spark, sf_dir):
    return X.resolve_keys(_keys(spark, sf_dir), X.alias_index(_features(spark, sf_dir)))


def _resolved(spark, sf_dir):
    keys = _keys(spark, sf_dir).select("key", (F.lit(2000) + F.col("k") % 4 * 2).alias("year"))
    return keys.join(X.resolve_keys(keys, X.alias_index(_features(spark, sf_dir))), "key")


_YEARS = "rows AS (SELECT 2000 + k % 4 * 2 AS year, CASE WHEN k % 11 = 0 THEN label WHEN k % 13 = 0 THEN concat('NOWHERE - ', label) WHEN k % 17 = 0 THEN concat(upper(trim(county)), ' - ', label, ' QQ') ELSE concat(upper(trim(county)), ' - ', label) END AS key FROM lab), yr AS (SELECT year, key, status FROM rows JOIN solved USING (key))"
_COUNTS = ", ".join(f"count(*) FILTER (WHERE status = '{s}') AS {s}" for s in Q.STATUSES)


@register("q1_unmatched_summary", B.oracle(*_SOLVE, _YEARS, select=f"SELECT year, count(*) AS total, {_COUNTS}, round(100.0 * count(*) FILTER (WHERE status = 'matched') / count(*), 2) AS matched_pct FROM yr GROUP BY 1"))
def unmatched_summary(spark, sf_dir):
    return Q.unmatched_summary(_resolved(spark, sf_dir))


@register("a10_status_counts", B.oracle(*_SOLVE, _YEARS, select=f"SELECT year, count(*) AS total, {_COUNTS}, round(100.0 * count(*) FILTER (WHERE status = 'matched') / count(*), 2) AS matched_pct FROM yr GROUP BY 1"))
def status_counts(spark, sf_dir):
    return A.status_counts(_resolved(spark, sf_dir), ["year"], Q.STATUSES)


@register("q2_unmatched_examples", B.oracle(*_SOLVE, _YEARS, select="SELECT year, status, key, count(*) AS rows FROM yr WHERE status <> 'matched' GROUP BY 1, 2, 3 QUALIFY row_number() OVER (PARTITION BY year, status ORDER BY count(*) DESC, key) <= 20"))
def unmatched_examples(spark, sf_dir):
    return Q.unmatched_examples(_resolved(spark, sf_dir), 20)


_ID = "concat(upper(trim(county)), ' - ', upper(trim(label)))"
_RULES = f"""known AS (SELECT DISTINCT {_ID} AS id FROM lab WHERE k % 2 = 0),
token AS (SELECT id, trim(split_part(id, ' - ', 1)) AS county, regexp_replace(split_part(id, ' - ', 2), '[^A-Z0-9]', '', 'g') AS t FROM known),
kx AS (SELECT DISTINCT upper(trim(concat(upper(trim(county)), ' - ', label))) AS raw FROM lab WHERE k % 2 = 1),
ky AS (SELECT raw, trim(split_part(raw, ' - ', 1)) AS county, trim(split_part(raw, ' - ', 2)) AS p FROM kx WHERE contains(raw, ' - ') AND raw NOT IN (SELECT id FROM known)),
kz AS (SELECT *, {_CLEANED.replace(LABEL, "p").replace(COUNTY, "county")} AS cleaned, regexp_replace(p, '[^A-Z0-9]', '', 'g') AS t,
  try_cast(nullif(regexp_extract(p, '^0*([0-9]{{1,4}})([A-Z]?)$', 1), '') AS INT)::VARCHAR AS n, regexp_extract(p, '^0*([0-9]{{1,4}})([A-Z]?)$', 2) AS suffix FROM ky),
guess AS (
  SELECT raw, county, 2 AS rule, '14' AS code FROM kz WHERE county = 'ROBESON' AND p = 'LUM 1'
  UNION ALL SELECT raw, county, 3, cleaned FROM kz WHERE cleaned <> p
  UNION ALL SELECT raw, county, 4, left(p, length(p) - 1) FROM kz WHERE ends_with(p, 'A')
  UNION ALL SELECT raw, county, 5, CAST(regexp_extract(p, '^0*([0-9]+)(?:-1)?$', 1) AS BIGINT)::VARCHAR || 'A' FROM kz WHERE regexp_matches(p, '^0*([0-9]+)(?:-1)?$')
  UNION ALL SELECT raw, county, 6, p || '-1' FROM kz WHERE regexp_matches(p, '^[A-Z0-9]+$')
  UNION ALL SELECT raw, county, 7, CASE WHEN length(n) < w THEN lpad(n, w, '0') ELSE n END || suffix FROM kz CROSS JOIN (VALUES (1), (2), (3), (4)) AS widths(w) WHERE n IS NOT NULL),
fits AS (
  SELECT raw, rule, id FROM guess JOIN known ON id = concat(county, ' - ', code)
  UNION SELECT raw, 8, id FROM kz JOIN token USING (county, t) WHERE t <> ''
  UNION SELECT raw, 9, id FROM kz JOIN token ON kz.county = token.county AND starts_with(token.t, kz.t) WHERE length(kz.t) >= 3),
lone AS (SELECT raw, rule, min(id) AS id FROM fits GROUP BY 1, 2 HAVING rule < 7 OR count(*) = 1)"""


@register("x1_auto_overrides", B.oracle(B.LAB, _RULES, select="SELECT raw AS precinct_id, arg_min(id, rule) AS canonical_id, min(rule) AS rule FROM lone GROUP BY 1"))
def auto_overrides(spark, sf_dir):
    canonical = B.labels(spark, sf_dir).where("k % 2 = 0").select(F.concat_ws(" - ", F.upper(F.trim("county")), F.upper(F.trim("label"))).alias("precinct_id"))
    raw = B.labels(spark, sf_dir).where("k % 2 = 1").select(F.concat_ws(" - ", F.upper(F.trim("county")), "label").alias("precinct_id"))
    return X.auto_overrides(raw, canonical)


@register("x2_apply_overrides", B.oracle(B.RES, select="SELECT year, CASE WHEN county = 'NATION_0' AND year = 1996 THEN 'DZ' ELSE county END AS precinct_id, sum(votes) AS votes FROM res GROUP BY 1, 2"))
def apply_overrides(spark, sf_dir):
    rows = A.sum_by(B.results(spark, sf_dir).withColumnRenamed("county", "precinct_id"), ["year", "precinct_id"], "votes")
    rules = B.table(spark, sf_dir, "nation").where("n_name = 'NATION_0'").select(F.lit("1996").alias("year"), F.upper("n_name").alias("raw"), F.lit("DZ").alias("canonical"))
    return X.apply_overrides(rows, rules)


@register("x3_load_overrides", "SELECT upper(n_name) AS raw, concat('C', CAST(n_nationkey AS VARCHAR)) AS canonical FROM nation WHERE n_nationkey % 3 < 2")
def load_overrides(spark, sf_dir):
    k = F.col("n_nationkey")
    rules = B.table(spark, sf_dir, "nation").select(F.when(k % 3 == 0, "").when(k % 3 == 1, "2020").otherwise("2018").alias("year"), F.concat(F.lit(" "), "n_name").alias("raw"), F.concat(F.lit("c"), k.cast("string")).alias("canonical"))
    return X.load_overrides(rules, 2020)


#: Every nation has rules that clash: of a year and of all, manual and automatic, by place; the SQL states the same order.
_CLASH = """rul AS (
  SELECT CASE n_nationkey % 3 WHEN 0 THEN '*' WHEN 1 THEN '1996' ELSE '' END AS year, 'auto' AS kind, 1 AS place, upper(n_name) AS raw, concat('A', CAST(n_nationkey AS VARCHAR)) AS canonical FROM nation
  UNION ALL SELECT '*', 'manual', 2, upper(n_name), concat('M', CAST(n_nationkey AS VARCHAR)) FROM nation WHERE n_nationkey % 2 = 0
  UNION ALL SELECT '*', 'manual', 1, upper(n_name), concat('N', CAST(n_nationkey AS VARCHAR)) FROM nation WHERE n_nationkey % 4 = 0
  UNION ALL SELECT '1997', 'auto', 1, upper(n_name), concat('Y', CAST(n_nationkey AS VARCHAR)) FROM nation WHERE n_nationkey % 5 = 0),
yrs AS (SELECT DISTINCT year FROM res),
fit AS (SELECT y.year, raw, canonical, row_number() OVER (PARTITION BY y.year, raw ORDER BY rul.year IN ('*', ''), kind <> 'manual', place, canonical) AS n FROM rul JOIN yrs y ON rul.year IN ('*', '', CAST(y.year AS VARCHAR))),
pick AS (SELECT year, raw, canonical FROM fit WHERE n = 1)"""


def _clashing(spark, sf_dir):
    k = F.col("n_nationkey")
    rule = lambda fits, year, kind, place, letter: F.when(fits, F.struct(year.alias("year"), F.lit(kind).alias("kind"), F.lit(place).alias("place"), F.concat(F.lit(letter), k.cast("string")).alias("canonical")))
    some_year = F.when(k % 3 == 0, "*").when(k % 3 == 1, "1996").otherwise("")
    rules = F.array(rule(F.lit(True), some_year, "auto", 1, "A"), rule(k % 2 == 0, F.lit("*"), "manual", 2, "M"), rule(k % 4 == 0, F.lit("*"), "manual", 1, "N"), rule(k % 5 == 0, F.lit("1997"), "auto", 1, "Y"))
    return B.table(spark, sf_dir, "nation").select(F.upper("n_name").alias("raw"), F.explode(F.filter(rules, lambda r: r.isNotNull())).alias("r")).select("raw", "r.*")


@register("x3_override_precedence", B.oracle(B.RES, _CLASH, select="SELECT year, raw, canonical FROM pick"))
def override_precedence(spark, sf_dir):
    return X.rules_by_year(_clashing(spark, sf_dir), B.results(spark, sf_dir).select("year").distinct())


@register("x2_clashing_overrides", B.oracle(B.RES, _CLASH, select="SELECT r.year, coalesce(canonical, county) AS precinct_id, sum(votes) AS votes FROM res r LEFT JOIN pick p ON r.year = p.year AND county = raw GROUP BY 1, 2"))
def clashing_overrides(spark, sf_dir):
    rows = A.sum_by(B.results(spark, sf_dir).withColumnRenamed("county", "precinct_id"), ["year", "precinct_id"], "votes")
    return A.sum_by(X.apply_overrides(rows, _clashing(spark, sf_dir)), ["year", "precinct_id"], "votes")


#: Chains of up to 25 rules NATION_k to NATION_(k - 1), cycles of NATION_20 to 22 and of the pair 23, 24; every fifth key is on the map.
_CHAIN = """WITH RECURSIVE hop AS (
  SELECT upper(n_name) AS raw, CASE n_nationkey WHEN 20 THEN 'NATION_22' WHEN 23 THEN 'NATION_24' WHEN 0 THEN 'NOWHERE' ELSE concat('NATION_', CAST(n_nationkey - 1 AS VARCHAR)) END AS goal,
         n_nationkey % 5 = 1 AND n_nationkey < 20 AS known FROM nation),
walk AS (
  SELECT raw, goal, 1 AS n FROM hop WHERE NOT known
  UNION ALL SELECT w.raw, h.goal, n + 1 FROM walk w JOIN hop h ON w.goal = h.raw WHERE NOT h.known AND n < 30),
done AS (SELECT w.raw, w.goal FROM walk w JOIN hop h ON h.raw = w.goal AND h.known)"""


def _chained(spark, sf_dir):
    k = F.col("n_nationkey")
    goal = F.when(k == 20, "NATION_22").when(k == 23, "NATION_24").when(k == 0, "NOWHERE").otherwise(F.concat(F.lit("NATION_"), (k - 1).cast("string")))
    nation = B.table(spark, sf_dir, "nation")
    return nation.select(F.lit("*").alias("year"), F.upper("n_name").alias("raw"), goal.alias("canonical")), nation.where("n_nationkey % 5 = 1 and n_nationkey < 20").select(F.upper("n_name").alias("precinct_id"))


@register("x8_bridge_chains", _CHAIN + ",\n" + B.RES + " SELECT year, coalesce(goal, county) AS precinct_id, sum(votes) AS votes FROM res LEFT JOIN done ON county = raw GROUP BY 1, 2")
def bridge_chains(spark, sf_dir):
    rules, known = _chained(spark, sf_dir)
    rows = A.sum_by(B.results(spark, sf_dir).withColumnRenamed("county", "precinct_id"), ["year", "precinct_id"], "votes")
    return A.sum_by(X.apply_overrides(rows, rules, known=known), ["year", "precinct_id"], "votes")


@register("x8_two_way_pairs", B.oracle(B.RES, select="SELECT year, office, CASE WHEN precinct = 'BUILDING' THEN 'HOUSEHOLD' ELSE precinct END AS precinct, county, sum(votes) AS votes FROM res GROUP BY 1, 2, 3, 4"))
def two_way_pairs(spark, sf_dir):
    """Pairs in both directions of keys that the map has (MACHINERY, AUTOMOBILE) never swap; of BUILDING and HOUSEHOLD it has the latter."""
    rows = B.results(spark, sf_dir).groupBy("year", "office", "county", "precinct").agg(F.sum("votes").alias("votes")).withColumn("precinct_id", F.concat_ws(" - ", "county", "precinct"))
    counties = B.table(spark, sf_dir, "nation").select(F.upper("n_name").alias("county"))
    pairs = counties.select("county", F.explode(F.array(F.struct(F.lit("MACHINERY").alias("a"), F.lit("AUTOMOBILE").alias("b")), F.struct(F.lit("HOUSEHOLD").alias("a"), F.lit("BUILDING").alias("b")))).alias("p"), F.lit(True).alias("both")).select("county", "p.*", "both")
    known = counties.select(F.explode(F.array(*[F.concat(F.col("county"), F.lit(f" - {p}")) for p in ("MACHINERY", "AUTOMOBILE", "HOUSEHOLD")])).alias("precinct_id"))
    moved = X.apply_overrides(rows, X.two_way(pairs), known=known).withColumn("precinct", F.element_at(F.split("precinct_id", " - "), -1))
    return moved.groupBy("year", "office", "county", "precinct").agg(F.sum("votes").alias("votes"))


_MORE = (
    "mf AS (SELECT row_number() OVER (ORDER BY county, code, name) AS k, * FROM (SELECT DISTINCT upper(trim(county)) AS county, label AS code, concat('NEW ', CAST(k % 97 AS VARCHAR)) AS name FROM lab))",
    "mt AS (SELECT k * 3 AS k, upper(trim(code)) AS label FROM mf UNION ALL SELECT k * 3 + 1, upper(trim(name)) FROM mf UNION ALL SELECT k * 3 + 2, concat(upper(trim(code)), ' ', upper(trim(name))) FROM mf)",
    _forms("mt", "3"),
    """fm AS (SELECT DISTINCT m.county, m.k AS f, v3.a AS alias FROM v3 JOIN mf m ON m.k = v3.k // 3 WHERE v3.a <> ''),
own AS (SELECT f, min(canonical) AS canonical FROM fm JOIN idx USING (county, alias) GROUP BY f HAVING count(DISTINCT canonical) = 1),
fresh AS (SELECT DISTINCT county, alias, canonical FROM fm JOIN own USING (f))""",
)


@register("x5_enrich_alias_index", B.oracle(B.LAB, _FEAT, _TEXTS, _forms("lab2", "1"), _INDEX, *_MORE, select="SELECT county, alias, min(canonical) AS canonical FROM fresh WHERE (county, alias) NOT IN (SELECT (county, alias) FROM idx) GROUP BY 1, 2 HAVING count(*) = 1"))
def enrich_alias_index(spark, sf_dir):
    more = B.labels(spark, sf_dir).select("county", F.col("label").alias("code"), F.concat(F.lit("NEW "), (F.col("k") % 97).cast("string")).alias("name"))
    return X.enrich_alias_index(X.alias_index(_features(spark, sf_dir)), more)


def _pass(n: int, code: str, name: str, earlier: tuple[int, ...]) -> tuple[str, ...]:
    """One pass of growth as SQL: features p{n}, their forms, owners by the index and earlier passes, and the new aliases a{n}."""
    known = "SELECT county, alias, canonical FROM idx" + "".join(f" UNION ALL SELECT county, alias, canonical FROM a{k}" for k in earlier)
    return (
        f"p{n} AS (SELECT row_number() OVER (ORDER BY county, code, name) AS k, * FROM (SELECT DISTINCT upper(trim(county)) AS county, {code} AS code, {name} AS name FROM lab))",
        f"t{n} AS (SELECT k * 3 AS k, upper(trim(code)) AS label FROM p{n} UNION ALL SELECT k * 3 + 1, upper(trim(name)) FROM p{n} UNION ALL SELECT k * 3 + 2, concat(upper(trim(code)), ' ', upper(trim(name))) FROM p{n})",
        _forms(f"t{n}", f"p{n}"),
        f"""f{n} AS (SELECT DISTINCT m.county, m.k AS f, vp{n}.a AS alias FROM vp{n} JOIN p{n} m ON m.k = vp{n}.k // 3 WHERE vp{n}.a <> ''),
k{n} AS ({known}),
o{n} AS (SELECT f, min(canonical) AS canonical FROM f{n} JOIN k{n} USING (county, alias) GROUP BY f HAVING count(DISTINCT canonical) = 1),
a{n} AS (SELECT county, alias, min(canonical) AS canonical FROM (SELECT DISTINCT county, alias, canonical FROM f{n} JOIN o{n} USING (f)) WHERE (county, alias) NOT IN (SELECT (county, alias) FROM k{n}) GROUP BY 1, 2 HAVING count(*) = 1)""",
    )


_NEW, _OLD, _ELDER = ((f"concat('{w} ', CAST(k % {m} AS VARCHAR))") for w, m in (("NEW", 97), ("OLD", 89), ("ELDER", 83)))
_PASSES = (*_pass(1, "label", _NEW, ()), *_pass(2, _NEW, _OLD, (1,)), *_pass(3, _OLD, _ELDER, (1, 2)))


def _vintages(spark, sf_dir):
    """Three maps in turn; each knows the names of the one before as codes."""
    rows, k = B.labels(spark, sf_dir), F.col("k")
    new, old, elder = (F.concat(F.lit(f"{w} "), (k % m).cast("string")) for w, m in (("NEW", 97), ("OLD", 89), ("ELDER", 83)))
    return [rows.select("county", code.alias("code"), name.alias("name")) for code, name in ((F.col("label"), new), (new, old), (old, elder))]


_GROW = (B.LAB, _FEAT, _TEXTS, _forms("lab2", "1"), _INDEX, *_PASSES)


@register("x5_growth_by_vintage", B.oracle(*_GROW, select=" UNION ALL ".join(f"SELECT {n} AS pass, county, alias, canonical FROM a{n}" for n in (1, 2, 3))))
def growth_by_vintage(spark, sf_dir):
    return X.grow_alias_index(X.alias_index(_features(spark, sf_dir)), _vintages(spark, sf_dir))[0]


@register("x5_growth_counts", B.oracle(*_GROW, select=" UNION ALL ".join(f"SELECT {n} AS pass, (SELECT count(*) FROM a{n}) AS added" for n in (1, 2, 3))))
def growth_counts(spark, sf_dir):
    return X.grow_alias_index(X.alias_index(_features(spark, sf_dir)), _vintages(spark, sf_dir))[1]


_OVER = "ov AS (SELECT precinct_id, CAST(k % 7 AS VARCHAR) AS vtd, sum(vap)::DOUBLE AS area FROM blk GROUP BY 1, 2)"


@register("x7_vtd_bridge_key", B.oracle(B.BLK, _OVER, select="SELECT precinct_id, vtd FROM ov QUALIFY row_number() OVER (PARTITION BY precinct_id ORDER BY area DESC, vtd) = 1"))
def vtd_bridge_key(spark, sf_dir):
    rows = B.blocks(spark, sf_dir)
    overlaps = rows.groupBy("precinct_id", (F.col("k") % 7).cast("string").alias("vtd")).agg(F.sum("vap").cast("double").alias("area"))
    return X.bridge_to_vtd(rows.select("precinct_id").distinct(), overlaps)


@register("x8_bridge_keys", "SELECT '*' AS year, concat(upper(n_name), ' - A') AS raw, concat(upper(n_name), ' - B') AS canonical FROM nation UNION ALL SELECT '*', concat(upper(n_name), ' - B'), concat(upper(n_name), ' - A') FROM nation WHERE n_nationkey % 2 = 0")
def bridge_keys(spark, sf_dir):
    pairs = B.table(spark, sf_dir, "nation").select(F.upper("n_name").alias("county"), F.lit("A").alias("a"), F.lit("B").alias("b"), (F.col("n_nationkey") % 2 == 0).alias("both"))
    return X.two_way(pairs)


@register("q3_match_rates", B.oracle(B.RES, B.BLK, "p AS (SELECT DISTINCT year, county, precinct, concat(county, ' - ', precinct) IN (SELECT precinct_id FROM blk) AS matched, precinct = 'ABSENTEE' AS non_geo FROM res)", select="SELECT year, county, sum(CASE WHEN NOT non_geo THEN 1 ELSE 0 END)::BIGINT AS total_geo, sum(CASE WHEN NOT non_geo AND matched THEN 1 ELSE 0 END)::BIGINT AS matched_geo, sum(CASE WHEN NOT non_geo AND NOT matched THEN 1 ELSE 0 END)::BIGINT AS unmatched_geo, sum(CASE WHEN non_geo THEN 1 ELSE 0 END)::BIGINT AS non_geo, round(100.0 * sum(CASE WHEN NOT non_geo AND matched THEN 1 ELSE 0 END) / sum(CASE WHEN NOT non_geo THEN 1 ELSE 0 END), 2) AS geo_match_pct FROM p GROUP BY GROUPING SETS ((year), (county), ())"))
def match_rates(spark, sf_dir):
    rows = B.results(spark, sf_dir).select("year", "county", "precinct").distinct().withColumn("precinct_id", F.concat_ws(" - ", "county", "precinct"))
    hit = B.blocks(spark, sf_dir).select("precinct_id").distinct().withColumn("hit", F.lit(True))
    return Q.match_rates(rows.join(hit, "precinct_id", "left").select("year", "county", F.coalesce("hit", F.lit(False)).alias("matched"), (F.col("precinct") == "ABSENTEE").alias("non_geo")))


@register("q4_hybrid_summary", B.oracle(B.RES, f"s AS (SELECT year, {_THREE}, sum(votes) AS total_votes FROM res GROUP BY 1)", select="SELECT year, dem_votes, rep_votes, other_votes, total_votes, dem_votes + 1 AS expected_dem, rep_votes - 2 AS expected_rep, total_votes + 3 AS expected_total, round((greatest(0, 100 - 1 / (dem_votes + 1) * 100) + greatest(0, 100 - 2 / (rep_votes - 2) * 100) + greatest(0, 100 - 3 / (total_votes + 3) * 100)) / 3, 4) AS accuracy_pct, false AS ok FROM s"))
def hybrid_summary(spark, sf_dir):
    sums = A.party_columns(B.results(spark, sf_dir), ["year"]).withColumn("total_votes", F.col("dem_votes") + F.col("rep_votes") + F.col("other_votes"))
    expected = sums.select("year", (F.col("dem_votes") + 1).alias("expected_dem"), (F.col("rep_votes") - 2).alias("expected_rep"), (F.col("total_votes") + 3).alias("expected_total"))
    return Q.hybrid_summary(sums, expected, ["year"])


@register("q5_zero_sum_audit", B.oracle(B.RES, B.BLK, B.PRE, select="SELECT year, office, precinct_id, dem_votes, rep_votes, other_votes, dem_votes AS block_dem_votes, rep_votes AS block_rep_votes, other_votes AS block_other_votes, 0.0 AS delta_dem_votes, 0.0 AS delta_rep_votes, 0.0 AS delta_other_votes FROM pre WHERE precinct_id IN (SELECT precinct_id FROM blk)"))
def zero_sum_audit(spark, sf_dir):
    return R.shatter(_precincts(spark, sf_dir), B.blocks(spark, sf_dir))[1]


@register("q6_dataset_profile", "SELECT o_orderpriority AS value, count(*) AS rows, round(count(*) / (SELECT count(*) FROM orders), 6) AS share FROM orders GROUP BY 1")
def dataset_profile(spark, sf_dir):
    return Q.dataset_profile(B.table(spark, sf_dir, "orders"), "o_orderpriority")


# R13 needs resolved keys: counties' precincts with a status.
_LADDER = (
    B.RES, B.BLK, B.DMAP, B.PRE, _WTS, "sp AS (SELECT precinct_id AS key, district, weight AS w FROM wts WHERE scope = 'state_senate')",
    "al AS (SELECT year, office, county, concat(county, ' - ', precinct) AS key, CASE WHEN precinct = 'ABSENTEE' THEN 'non_geographic' WHEN concat(county, ' - ', precinct) IN (SELECT key FROM sp) THEN 'matched' ELSE 'unmatched' END AS status, " + _THREE + " FROM {rows} GROUP BY 1, 2, 3, 4, 5)",
    "ow AS (SELECT year, office, county, key, district, w FROM al JOIN sp USING (key) WHERE status = 'matched')",
    "dy AS (SELECT year, office, county, district, sum((dem_votes + rep_votes + other_votes) * w) AS v FROM ow JOIN al USING (year, office, county, key) GROUP BY 1, 2, 3, 4)",
    "ds AS (SELECT year, office, county, district, v / sum(v) OVER (PARTITION BY year, office, county) AS w FROM dy)",
)
_COUNTY_STEP = "SELECT al.year, al.office, al.key, ds.district, ds.w, 2 FROM al JOIN ds USING (year, office, county) WHERE status <> 'matched'"
_LADDER_SUMS = "SELECT year, office, district, round(sum(dem_votes * w), 3) AS dem_votes, round(sum(rep_votes * w), 3) AS rep_votes, round(sum(other_votes * w), 3) AS other_votes, count(DISTINCT CASE WHEN p = 0 THEN key END) AS direct_rows, count(DISTINCT key) AS placed_rows FROM fin JOIN al USING (year, office, key) GROUP BY 1, 2, 3"


def _ladder_sql(rows: str, steps: str, *tables: str) -> str:
    parts = [part.replace("{rows}", rows) for part in _LADDER]
    return B.oracle(*parts, *tables, f"fin AS (SELECT year, office, key, district, w, 0 AS p FROM ow UNION ALL {steps})", select=_LADDER_SUMS)


def _ladder(spark, sf_dir, results, **options):
    splits = _weights(spark, sf_dir).where("scope = 'state_senate'").select(F.col("precinct_id").alias("key"), "district", F.col("weight").alias("area_weight"))
    rows = A.party_columns(results.withColumn("key", F.concat_ws(" - ", "county", "precinct")), ["year", "office", "county", "key"])
    hit = B.blocks(spark, sf_dir).select(F.col("precinct_id").alias("key")).distinct().withColumn("hit", F.lit(True))
    status = F.when(F.col("key").endswith(" - ABSENTEE"), "non_geographic").when(F.col("hit"), "matched").otherwise("unmatched")
    rows = rows.join(hit, "key", "left").withColumn("status", status).drop("hit")
    return _rounded(R.ladder_allocate(rows, splits, **options), *A.VOTES, digits=3)


@register("r13_area_weight_allocate", _ladder_sql("res", _COUNTY_STEP))
def area_weight_allocate(spark, sf_dir):
    return _ladder(spark, sf_dir, B.results(spark, sf_dir), bucket_before=1900)


# A precinct that the map lacks, in the bucket of one that it has.
_NEW = "(SELECT * REPLACE (CASE WHEN precinct = 'BUILDING' THEN 'MACHINERY-9' ELSE precinct END AS precinct) FROM res)"
_BUCKET_SHARES = (
    "bkt AS (SELECT year, office, county, district, sum((dem_votes + rep_votes + other_votes) * w) AS v FROM ow JOIN al USING (year, office, county, key) WHERE ends_with(key, ' - MACHINERY') GROUP BY 1, 2, 3, 4)",
    "bb AS (SELECT year, office, county, district, v / sum(v) OVER (PARTITION BY year, office, county) AS w FROM bkt)",
)
_BUCKET_STEP = f"SELECT al.year, al.office, al.key, bb.district, bb.w, 1 FROM al JOIN bb USING (year, office, county) WHERE ends_with(key, '-9') UNION ALL {_COUNTY_STEP} AND (NOT ends_with(key, '-9') OR (al.year, al.office, al.county) NOT IN (SELECT (year, office, county) FROM bb))"


def _renamed(spark, sf_dir):
    return B.results(spark, sf_dir).withColumn("precinct", F.when(F.col("precinct") == "BUILDING", "MACHINERY-9").otherwise(F.col("precinct")))


@register("r13_bucket_before_county", _ladder_sql(_NEW, _BUCKET_STEP, *_BUCKET_SHARES))
def bucket_before_county(spark, sf_dir):
    return _ladder(spark, sf_dir, _renamed(spark, sf_dir))


@register("r13_legacy_overwrite", _ladder_sql(_NEW, _COUNTY_STEP))
def legacy_overwrite(spark, sf_dir):
    return _ladder(spark, sf_dir, _renamed(spark, sf_dir), legacy_overwrite=True)


# Geometry: districts are unit squares of nations, points are customers.
_RECT = "rect AS (SELECT upper(n_name) AS district, (n_nationkey % 5)::DOUBLE AS x0, (n_nationkey // 5)::DOUBLE AS y0 FROM nation)"


def _rings(spark, sf_dir):
    k = F.col("n_nationkey")
    x, y = (k % 5).cast("double"), F.floor(k / 5).cast("double")
    corner = lambda dx, dy: F.struct((x + dx).alias("x"), (y + dy).alias("y"))
    return B.table(spark, sf_dir, "nation").select(F.upper("n_name").alias("district"), F.array(corner(0, 0), corner(1, 0), corner(1, 1), corner(0, 1)).alias("ring"))


def _points(spark, sf_dir):
    k = F.col("c_custkey")
    return B.table(spark, sf_dir, "customer").select(k.alias("id"), (k % 611 / 100.0 + 0.005).alias("x"), (k * 7 % 503 / 100.0 + 0.005).alias("y"))


_PTS = "pts AS (SELECT c_custkey AS id, c_custkey % 611 / 100.0 + 0.005 AS x, c_custkey * 7 % 503 / 100.0 + 0.005 AS y FROM customer), inr AS (SELECT id, min(district) AS district FROM pts JOIN rect ON x >= x0 AND x < x0 + 1 AND y >= y0 AND y < y0 + 1 GROUP BY 1)"


@register("g1_bbox_point", "WITH " + _RECT + " SELECT district, x0 + 0.5 AS x, y0 + 0.5 AS y FROM rect")
def bbox_point(spark, sf_dir):
    return _rings(spark, sf_dir).select("district", G.bbox_point(F.col("ring")).alias("p")).select("district", "p.*")


@register("g2_ring_area", "WITH " + _RECT + " SELECT district, 1.0 AS area FROM rect")
def ring_area(spark, sf_dir):
    return _rings(spark, sf_dir).select("district", G.ring_area(F.col("ring")).alias("area"))


@register("g3_point_in_district", "WITH " + _RECT + ", " + _PTS + " SELECT id, district FROM pts LEFT JOIN inr USING (id)")
def point_in_district(spark, sf_dir):
    return G.points_in_districts(_points(spark, sf_dir), _rings(spark, sf_dir), 0.25).select("id", "district")


_PIECE = "pc AS (SELECT precinct_id, district, sum(vap)::DOUBLE AS area FROM blk JOIN dmap USING (block) WHERE scope = 'congressional' GROUP BY 1, 2), w0 AS (SELECT *, area / nullif(sum(area) OVER (PARTITION BY precinct_id), 0) AS w FROM pc)"


def _pieces(spark, sf_dir):
    rows = B.blocks(spark, sf_dir).join(B.district_map(spark, sf_dir).where("scope = 'congressional'"), "block")
    return rows.select("precinct_id", "county", "district", F.col("vap").cast("double").alias("area"))


@register("g4_area_crosswalk", B.oracle(B.BLK, B.DMAP, _PIECE, select="SELECT precinct_id, district, round(w / sum(w) OVER (PARTITION BY precinct_id), 6) AS area_weight FROM w0 WHERE w >= 0.02"))
def area_crosswalk(spark, sf_dir):
    return _rounded(G.area_crosswalk(_pieces(spark, sf_dir), ["precinct_id"], least=0.02), "area_weight", digits=6).select("precinct_id", "district", "area_weight")


@register("g5_max_overlap", B.oracle(B.BLK, B.DMAP, _PIECE, select="SELECT precinct_id, district FROM pc QUALIFY row_number() OVER (PARTITION BY precinct_id ORDER BY area DESC, district) = 1"))
def max_overlap(spark, sf_dir):
    return G.max_overlap(_pieces(spark, sf_dir), ["precinct_id"])


@register("g6_block_assignment", "WITH " + _RECT + ", " + _PTS + " SELECT id, coalesce(district, 'ZZ') AS district, CASE WHEN district IS NULL THEN 'overlap' ELSE 'point' END AS method, 1.0 AS area_weight, coalesce(district, 'ZZ') AS district_label FROM pts LEFT JOIN inr USING (id)")
def block_assignment(spark, sf_dir):
    points = _points(spark, sf_dir)
    pieces = points.select("id", F.lit("ZZ").alias("district"), F.lit(2.0).alias("area")).unionByName(points.select("id", F.lit("AA").alias("district"), F.lit(1.0).alias("area")))
    return G.assign_blocks(points, _rings(spark, sf_dir), pieces, 0.25, "congressional")


@register("g7_vtd_area_shares", B.oracle(B.BLK, B.DMAP, _PIECE, select="SELECT precinct_id, district, round(w, 6) AS area_weight FROM w0 WHERE w IS NOT NULL"))
def vtd_area_shares(spark, sf_dir):
    return _rounded(G.area_crosswalk(_pieces(spark, sf_dir), ["precinct_id"], least=None, scale=False), "area_weight", digits=6).select("precinct_id", "district", "area_weight")


@register("g8_two_way_overlap_share", B.oracle(B.BLK, B.DMAP, _PIECE, select="SELECT round(sum(CASE WHEN district = '2' THEN area ELSE 0 END) / sum(area), 6) AS share FROM pc WHERE precinct_id = 'NATION_3 - MACHINERY' AND district IN ('1', '2')"))
def two_way_overlap_share(spark, sf_dir):
    return _rounded(G.two_way_share(_pieces(spark, sf_dir).withColumnRenamed("precinct_id", "key"), "NATION_3 - MACHINERY", "1", "2"), "share", digits=6)


@register("g9_crosswalk_county_qc", B.oracle(B.BLK, B.DMAP, _PIECE, "x AS (SELECT DISTINCT county, precinct_id FROM blk)", "c AS (SELECT county, precinct_id, district, w FROM w0 JOIN x USING (precinct_id) WHERE w >= 0.02)", "e AS (SELECT county, precinct_id, count(DISTINCT district) AS n, max(w) AS m FROM c GROUP BY 1, 2)", select="SELECT county, count(*) AS precincts, sum(CASE WHEN n > 1 THEN 1 ELSE 0 END)::BIGINT AS split_precincts, round(min(m), 6) AS least_main_weight, (SELECT count(DISTINCT district) FROM c WHERE c.county = e.county) AS districts, (SELECT string_agg(DISTINCT district, ', ' ORDER BY district) FROM c WHERE c.county = e.county) AS district_list, round(100.0 * sum(CASE WHEN n > 1 THEN 1 ELSE 0 END) / count(*), 2) AS split_pct FROM e GROUP BY county"))
def crosswalk_county_qc(spark, sf_dir):
    rows = G.area_crosswalk(_pieces(spark, sf_dir), ["county", "precinct_id"], least=0.02, scale=False)
    return G.crosswalk_by_county(rows.withColumnRenamed("precinct_id", "key"))


@register("g10_relabel_features", "SELECT lpad(CAST(c_nationkey * 2 AS VARCHAR), 3, '0') AS fips, CAST(c_custkey AS VARCHAR) AS code, CASE WHEN n_name IS NOT NULL THEN concat(upper(n_name), ' - ', CAST(c_custkey AS VARCHAR)) ELSE 'old' END AS name, n_name IS NOT NULL AS fixed FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey * 2")
def relabel_features(spark, sf_dir):
    names = B.table(spark, sf_dir, "nation").select(F.lpad(F.col("n_nationkey").cast("string"), 3, "0").alias("fips"), F.col("n_name").alias("county"))
    features = B.table(spark, sf_dir, "customer").select((F.col("c_nationkey") * 2).alias("fips"), F.col("c_custkey").cast("string").alias("code"), F.lit("old").alias("name"))
    return G.relabel_features(features, names)[0]


# Demographics.
_PEOPLE = "ppl AS (SELECT precinct_id, sum(vap)::DOUBLE AS vap, sum(vap * (k % 5) // 5)::DOUBLE AS white, sum(vap * (k % 3) // 6)::DOUBLE AS black FROM blk GROUP BY 1)"


def _people(spark, sf_dir):
    v, k = F.col("vap"), F.col("k")
    return B.blocks(spark, sf_dir).select("precinct_id", v.cast("double").alias("vap"), F.floor(v * (k % 5) / 5).cast("double").alias("white"), F.floor(v * (k % 3) / 6).cast("double").alias("black"))


@register("p1_precinct_demographics", B.oracle(B.BLK, _PEOPLE, select="SELECT precinct_id, vap, white, black, round(coalesce(white / nullif(vap, 0) * 100, 0), 2) AS white_pct, round(coalesce(black / nullif(vap, 0) * 100, 0), 2) AS black_pct FROM ppl"))
def precinct_demographics(spark, sf_dir):
    return P.precinct_demographics(_people(spark, sf_dir), ["white", "black"])


@register("p2_district_demographics", B.oracle(B.BLK, B.DMAP, _WTS, _PEOPLE, "d AS (SELECT CAST(district AS INT) AS n, sum(vap * weight) AS t, sum(white * weight) AS w FROM ppl JOIN wts USING (precinct_id) WHERE scope = 'congressional' GROUP BY 1)", select="SELECT CAST(i AS VARCHAR) AS district, CAST(round_even(coalesce(t, 0), 0) AS BIGINT) AS total_population, round(coalesce(w / nullif(t, 0) * 100, 0), 1) AS white_pct FROM (SELECT DISTINCT c_custkey % 14 + 1 AS i FROM customer) l LEFT JOIN d ON l.i = d.n"))
def district_demographics(spark, sf_dir):
    crosswalk = _weights(spark, sf_dir).where("scope = 'congressional'").select(F.col("precinct_id").alias("key"), "district", F.col("weight").alias("area_weight"))
    people = A.sum_by(_people(spark, sf_dir), ["precinct_id"], "vap", "white").withColumnRenamed("precinct_id", "key")
    labels = B.table(spark, sf_dir, "customer").select((F.col("c_custkey") % 14 + 1).cast("string").alias("district")).distinct()
    return P.district_demographics(people, crosswalk, labels, ["white"])


_CPEOPLE = "cp AS (SELECT split_part(precinct_id, ' - ', 1) AS county, sum(vap) AS vap, sum(white) AS white, sum(black) AS black FROM ppl GROUP BY 1)"


def _county_people(spark, sf_dir):
    rows = _people(spark, sf_dir).withColumn("county", F.split_part("precinct_id", F.lit(" - "), F.lit(1)))
    return P.county_demographics(A.sum_by(rows, ["county"], "vap", "white", "black"), ["white", "black"], "vap")


@register("p3_county_demographics", B.oracle(B.BLK, _PEOPLE, _CPEOPLE, select="SELECT county, vap, white, black, round(white / vap * 100, 2) AS white_pct, round(black / vap * 100, 2) AS black_pct FROM cp"))
def county_demographics(spark, sf_dir):
    return _county_people(spark, sf_dir)


@register("p4_plurality_group", B.oracle(B.BLK, _PEOPLE, select="SELECT precinct_id, CASE WHEN greatest(w, b) <= 0 THEN 'no data' WHEN abs(w - b) < 5 THEN 'mixed' WHEN w > b THEN 'white' ELSE 'black' END AS plurality FROM (SELECT precinct_id, round(coalesce(white / nullif(vap, 0) * 100, 0), 2) AS w, round(coalesce(black / nullif(vap, 0) * 100, 0), 2) AS b FROM ppl)"))
def plurality_group(spark, sf_dir):
    return P.plurality_group(P.precinct_demographics(_people(spark, sf_dir), ["white", "black"]), ["white", "black"], 5.0).select("precinct_id", "plurality")


# Exports.
_SL = "sl AS (SELECT year, 'county' AS scope, office AS contest_type, county AS district, dem_votes, rep_votes, other_votes, dem_votes + rep_votes + other_votes AS total_votes, rep_votes - dem_votes AS margin, coalesce((rep_votes - dem_votes) / nullif(dem_votes + rep_votes + other_votes, 0) * 100, 0) AS pct FROM cty)"


def _slices(spark, sf_dir):
    rows = A.party_columns(B.results(spark, sf_dir), ["year", "office", "county"])
    return M.with_measures(rows.select("year", F.lit("county").alias("scope"), F.col("office").alias("contest_type"), F.col("county").alias("district"), *A.VOTES))


_MAN = "man AS (SELECT year, contest_type, count(*) AS rows, sum(dem_votes) AS dem_total, sum(rep_votes) AS rep_total, sum(other_votes) AS other_total, sum(dem_votes) > 0 AND sum(rep_votes) > 0 AS major_party_contested FROM sl GROUP BY 1, 2)"


_GENERAL = f"""concat('{{"results":{{', string_agg(concat('"', district, '":', CAST(json_object('dem_votes', dem_votes::BIGINT, 'rep_votes', rep_votes::BIGINT, 'other_votes', other_votes::BIGINT, 'total_votes', total_votes::BIGINT, 'margin', margin::BIGINT,
  'margin_pct', round(pct, 2), 'winner', CASE WHEN rep_votes > dem_votes THEN 'REP' WHEN dem_votes > rep_votes THEN 'DEM' ELSE 'TIE' END, 'competitiveness', json_object('color', {_COLOR})) AS VARCHAR)), ',' ORDER BY district), '}}}}')"""


@register("k_s1_district_slices", B.oracle(B.RES, B.CTY, _SL, select=f"SELECT year, scope, contest_type, {_GENERAL} AS general FROM sl GROUP BY 1, 2, 3"))
def district_slices(spark, sf_dir):
    return K.district_slices(_slices(spark, sf_dir)).select("year", "scope", "contest_type", F.to_json("general").alias("general"))


@register("k_s2_contest_slices", B.oracle(B.RES, B.CTY, _SL, select="SELECT year, contest_type, sum(dem_votes) AS dem_total, sum(rep_votes) AS rep_total, sum(other_votes) AS other_total FROM sl WHERE total_votes > 0 GROUP BY 1, 2"))
def contest_slices(spark, sf_dir):
    return K.contest_slices(_slices(spark, sf_dir), "district").drop("rows")


@register("k_s3_contest_manifest", B.oracle(B.RES, B.CTY, _SL, _MAN, select="SELECT * FROM man"))
def contest_manifest(spark, sf_dir):
    return K.manifest(_slices(spark, sf_dir), ["year", "contest_type"])


@register("k_s4_upsert_manifest", B.oracle(B.RES, B.CTY, _SL, _MAN, select="SELECT year, contest_type, CASE WHEN year = 1996 THEN 0 ELSE rows END AS rows FROM man"))
def upsert_manifest(spark, sf_dir):
    old = K.manifest(_slices(spark, sf_dir), ["year", "contest_type"]).select("year", "contest_type", "rows")
    return K.upsert_manifest(old, old.where("year = 1996").withColumn("rows", F.lit(0).cast("long")), ["year", "contest_type"])


@register("k_s5_rebuild_manifest", B.oracle(B.RES, B.CTY, _SL, select="SELECT year, scope, contest_type, count(*) AS districts FROM sl GROUP BY 1, 2, 3"))
def rebuild_manifest(spark, sf_dir):
    path = folder(spark)
    K.write_district_slices(_slices(spark, sf_dir), path)
    return S.rebuild_manifest(spark, path)


@register("k_s6_split_by_contest_year", B.oracle(B.RES, B.CTY, _SL, select="SELECT DISTINCT concat(scope, '_', contest_type, '_', CAST(year AS VARCHAR), '.json') AS name FROM sl WHERE total_votes > 0"))
def split_by_contest_year(spark, sf_dir):
    path = folder(spark)
    K.write_district_slices(_slices(spark, sf_dir).where("total_votes > 0"), path)
    return spark.read.text(path).select(F.concat("scope", F.lit("_"), "contest_type", F.lit("_"), F.col("year").cast("string"), F.lit(".json")).alias("name")).distinct()


@register("k_s7_merge_contest_files", B.oracle(B.RES, select="SELECT year, office, CASE WHEN year >= 1998 THEN sum(votes) * 2 ELSE sum(votes) END AS votes FROM res GROUP BY 1, 2"))
def merge_contest_files(spark, sf_dir):
    rows = A.sum_by(B.results(spark, sf_dir), ["year", "office"], "votes")
    return K.merge_files(rows, rows.where("year >= 1998").withColumn("votes", F.col("votes") * 2), keys=["year", "office"])


_SH = ", ".join(f"round(coalesce({p}_votes / nullif(total_votes, 0), 0), 6) AS {p}_share" for p in ("dem", "rep", "other"))


@register("k_s8_export_long_points", B.oracle(B.RES, B.CTY, _SL, select=f"SELECT year, scope, contest_type, district, dem_votes, rep_votes, other_votes, total_votes, {_SH}, margin, round(round(pct, 2), 4) AS margin_pct, '' AS dem_candidate, '' AS rep_candidate, CASE WHEN rep_votes > dem_votes THEN 'REP' WHEN dem_votes > rep_votes THEN 'DEM' ELSE 'TIE' END AS winner, {_COLOR} AS color FROM sl"))
def export_long_points(spark, sf_dir):
    return K.long_points(_slices(spark, sf_dir))


@register("k_s9_slice_precedence", B.oracle(B.RES, B.CTY, _SL, select="SELECT year, scope, contest_type, district, CASE WHEN year % 2 = 0 THEN 1 ELSE 2 END AS dir_rank FROM sl WHERE regexp_matches(contest_type, '^[12]-') AND year BETWEEN 1996 AND 1999"))
def slice_precedence(spark, sf_dir):
    rows = _slices(spark, sf_dir).select("year", "scope", "contest_type", "district")
    both = rows.where("year % 2 = 0").withColumn("dir_rank", F.lit(1)).unionByName(rows.withColumn("dir_rank", F.lit(2)))
    return K.slice_precedence(both, "^[12]-", ["county"], (1996, 1999))


@register("k_s10_point_summary", B.oracle(B.RES, B.CTY, _SL, select="SELECT scope, year, count(*) AS rows, count(DISTINCT concat(scope, contest_type, CAST(year AS VARCHAR))) AS slices FROM sl GROUP BY GROUPING SETS ((scope), (year), ())"))
def point_summary(spark, sf_dir):
    return K.point_summary(_slices(spark, sf_dir))


@register("k_s11_tileset_properties", B.oracle(B.RES, B.CTY, _SL, select="SELECT scope, district, " + ", ".join(f"max(CASE WHEN contest_type = '{c}' AND year = {y} THEN {e} END) AS \"{n}_{y}_{f}\"" for c, n in (("1-URGENT", "1_urgent"), ("2-HIGH", "2_high")) for y in (1996, 1997) for f, e in (("margin_pct", "round(pct, 2)"), ("winner", "CASE WHEN rep_votes > dem_votes THEN 'REP' WHEN dem_votes > rep_votes THEN 'DEM' ELSE 'TIE' END"))) + " FROM sl GROUP BY 1, 2"))
def tileset_properties(spark, sf_dir):
    return K.tileset_properties(_slices(spark, sf_dir), ["1-URGENT", "2-HIGH"], [1996, 1997])


@register("k_s12_write_block_votes", B.oracle(B.RES, B.BLK, B.PRE, select="SELECT year, office, round(sum(dem_votes), 4) AS dem_votes FROM pre WHERE precinct_id IN (SELECT precinct_id FROM blk) GROUP BY 1, 2"))
def write_block_votes(spark, sf_dir):
    blocks, _ = R.shatter(_precincts(spark, sf_dir), B.blocks(spark, sf_dir), ["dem_votes"])
    path = folder(spark)
    K.write_block_votes(blocks, path)
    return spark.read.parquet(path).groupBy("year", "office").agg(F.round(F.sum("dem_votes").cast("double"), 4).alias("dem_votes"))


# Sources that are transformations of what is read.
@register("s3_board_to_long", "SELECT upper(n_name) AS county, c_mktsegment AS precinct, CASE WHEN c_custkey % 2 = 0 THEN 'US SENATE' ELSE 'SHERIFF' END AS office, '' AS district, '' AS party, 'x' AS candidate, CAST(c_custkey % 3 AS DOUBLE) AS votes FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 3 <> 0")
def board_to_long(spark, sf_dir):
    rows = B.table(spark, sf_dir, "customer").join(B.table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    k = F.col("c_custkey")
    board = rows.select(F.col("n_name").alias("County"), F.col("c_mktsegment").alias("Precinct"), F.when(k % 2 == 0, "UNITED STATES SENATE").otherwise("SHERIFF").alias("Contest Name"), F.lit("x").alias("Choice"), F.lit(None).cast("string").alias("Choice Party"), (k % 3).cast("string").alias("Total Votes"))
    return S.board_to_long(board, {"UNITED STATES SENATE": "US SENATE"})


@register("s5_year_from_path", "SELECT c_custkey AS k, CASE c_custkey % 3 WHEN 0 THEN CAST(1990 + c_custkey % 30 AS INT) WHEN 1 THEN 2012 END AS year FROM customer")
def year_from_path(spark, sf_dir):
    k = F.col("c_custkey")
    path = F.when(k % 3 == 0, F.concat(F.lit("/data/"), (1990 + k % 30).cast("string"), F.lit("/x.csv"))).when(k % 3 == 1, "/data/raw/20121106__x.csv").otherwise("/data/raw/x.csv")
    return B.table(spark, sf_dir, "customer").select(k.alias("k"), S.year_of_path(path).alias("year"))


@register("s6_scan_block_vap", "SELECT concat('37', lpad(CAST(c_custkey AS VARCHAR), 13, '0')) AS block, CASE WHEN c_custkey % 5 = 0 THEN 0 ELSE c_custkey % 1000 END AS vap FROM customer WHERE c_custkey % 3 > 0")
def scan_block_vap(spark, sf_dir):
    k = F.col("c_custkey")
    path = folder(spark)
    code = F.concat(F.when(k % 3 > 0, "37").otherwise("45"), F.lpad(k.cast("string"), 13, "0"))
    B.table(spark, sf_dir, "customer").select(code.alias("GEOCODE"), F.when(k % 5 == 0, "n/a").otherwise((k % 1000).cast("string")).alias("P1")).write.csv(path, header=True)
    return S.scan_block_vap(spark, path, "GEOCODE", "P1", "37")


@register("s7_scan_crosswalk", "SELECT lpad(CAST(c_custkey AS VARCHAR), 15, '0') AS block, upper(c_mktsegment) AS precinct_id FROM customer WHERE c_custkey % 4 <> 0")
def scan_crosswalk(spark, sf_dir):
    k = F.col("c_custkey")
    return S.clean_crosswalk(B.table(spark, sf_dir, "customer").select(k.alias("b"), F.when(k % 4 == 0, " ").otherwise(F.lower("c_mktsegment")).alias("p")), "b", "p")


@register("s8_scan_district_map", "SELECT lpad(CAST(c_custkey % 500 AS VARCHAR), 15, '0') AS block, min_by(CAST(c_custkey % 14 AS VARCHAR), c_custkey) AS district FROM customer GROUP BY 1")
def scan_district_map(spark, sf_dir):
    k = F.col("c_custkey")
    return S.clean_district_map(B.table(spark, sf_dir, "customer").select((k % 500).alias("b"), F.concat(F.lit("0"), (k % 14).cast("string"), F.lit(".0")).alias("d"), k.alias("n")), "b", "d", "n")


@register("s9_scan_district_stats", "SELECT CAST(n_nationkey AS VARCHAR) AS district, round(0.5, 6) AS dem_share, round(0.25, 6) AS rep_share, round(0.25, 6) AS other_share FROM nation WHERE n_nationkey % 4 <> 1 AND n_nationkey <> 0")
def scan_district_stats(spark, sf_dir):
    k = F.col("n_nationkey")
    rows = B.table(spark, sf_dir, "nation").select(F.when(k % 4 == 1, "UN").otherwise(F.concat(F.lit("0"), k.cast("string"))).alias("ID"), (k * 2).alias("Dem"), k.alias("Rep"), k.alias("Oth"))
    return S.clean_district_stats(rows)


@register("s12_parse_slices", "SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 0 THEN 'state_house' END AS scope, CASE WHEN c_custkey % 2 = 0 THEN 'us_senate' END AS contest_type, CASE WHEN c_custkey % 2 = 0 THEN CAST(1990 + c_custkey % 30 AS INT) END AS year FROM customer")
def parse_slices(spark, sf_dir):
    k = F.col("c_custkey")
    name = F.when(k % 2 == 0, F.concat(F.lit("state_house_us_senate_"), (1990 + k % 30).cast("string"), F.lit(".json"))).otherwise("manifest.json")
    return B.table(spark, sf_dir, "customer").select(k.alias("k"), S.parse_slice_name(name).alias("s")).select("k", "s.*")


@register("s14_scan_log_totals", "SELECT concat('CD ', CAST(c_custkey AS VARCHAR)) AS name, c_custkey * 1000 AS total FROM customer WHERE c_custkey % 2 = 0")
def scan_log_totals(spark, sf_dir):
    k = F.col("c_custkey")
    line = F.when(k % 2 == 0, F.concat(F.lit("CD "), k.cast("string"), F.lit("; 12; "), F.format_number(k * 1000, 0), F.lit(" ; 3"))).otherwise("done")
    return S.parse_log_totals(B.table(spark, sf_dir, "customer").select(line.alias("value")))


@register("s15_scan_sbe_code_map", "WITH t AS (SELECT upper(n_name) AS county, concat('C', CAST(n_nationkey AS VARCHAR)) AS code, concat('CC', CAST(n_nationkey AS VARCHAR), '_EAST ', CAST(n_nationkey AS VARCHAR)) AS label FROM nation) SELECT county, code, label FROM t UNION SELECT county, code, replace(label, '_', ' ') FROM t UNION SELECT county, code, replace(label, ' ', '_') FROM t UNION SELECT county, code, split_part(label, '_', 2) FROM t")
def scan_sbe_code_map(spark, sf_dir):
    k = F.col("n_nationkey").cast("string")
    return S.official_codes(B.table(spark, sf_dir, "nation").select(F.col("n_name").alias("county"), F.concat(F.lit("c"), k).alias("code"), F.concat(F.lit("cc"), k, F.lit("_East  "), k).alias("label"))).select("county", "code", "label")


@register("s16_scan_dp1_county", "SELECT upper(n_name) AS county, 1000000 + n_nationkey AS people FROM nation WHERE n_nationkey % 2 = 0")
def scan_dp1_county(spark, sf_dir):
    k = F.col("n_nationkey")
    rows = B.table(spark, sf_dir, "nation").select(F.concat("n_name", F.when(k % 2 == 0, " County, North Carolina").otherwise(" city")).alias("area"), F.format_number(k + 1000000, 0).alias("people"))
    return S.county_profile(rows, "area")


@register("s17_scan_vtd_vap", "SELECT lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS county, c_mktsegment AS vtd, sum(CASE WHEN c_custkey % 7 = 0 THEN 0 ELSE c_custkey % 100 END)::BIGINT AS vap FROM customer WHERE c_custkey % 3 = 1 GROUP BY 1, 2")
def scan_vtd_vap(spark, sf_dir):
    k = F.col("c_custkey")
    rows = B.table(spark, sf_dir, "customer").select((k % 3).alias("s"), F.col("c_nationkey").alias("c"), F.lower("c_mktsegment").alias("v"), F.when(k % 7 == 0, "x").otherwise((k % 100).cast("string")).alias("n"))
    return S.vtd_people(rows, "01", "s", "c", "v", "n")


@register("s18_vintage_by_year", B.oracle(B.RES, select="SELECT DISTINCT year, CASE WHEN year <= 1996 THEN 'a' WHEN year <= 1999 THEN 'b' ELSE 'c' END AS vintage FROM res"))
def vintage_by_year(spark, sf_dir):
    return S.vintage_by_year(B.results(spark, sf_dir).select("year").distinct(), [(0, 1996, "a"), (1997, 1999, "b"), (2000, 9999, "c")])


# Trends and scenarios over county rows.
_CM = "cm AS (SELECT *, dem_votes + rep_votes + other_votes AS total_votes, round(coalesce((rep_votes - dem_votes) / nullif(dem_votes + rep_votes + other_votes, 0) * 100, 0), 4) AS margin_pct, CASE WHEN rep_votes > dem_votes THEN 'REP' WHEN dem_votes > rep_votes THEN 'DEM' ELSE 'TIE' END AS winner FROM cty)"
_T = (B.RES, B.CTY, _CM)
_COLS = "year, office, county, dem_votes, rep_votes, other_votes, total_votes, margin_pct, winner"
_SUMS = "sum(dem_votes) AS dem_votes, sum(rep_votes) AS rep_votes, sum(other_votes) AS other_votes"


def _trend(spark, sf_dir):
    return Y.rollup(A.party_columns(B.results(spark, sf_dir), ["year", "office", "county"]), ["year", "office", "county"])


def _ty(key: str, select: str, make, *parts: str):
    @register(key, B.oracle(*_T, *parts, select=select))
    def query(spark, sf_dir):
        return make(spark, sf_dir, _trend(spark, sf_dir))

    return query


_ty("y1_county_rollup", f"SELECT {_COLS} FROM cm", lambda s, d, t: t)


@register("y2_region_rollup", B.oracle(*_T, f"rg AS (SELECT year, office, r_name AS region, {_SUMS} FROM cty JOIN nation ON upper(n_name) = county JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2, 3 UNION ALL SELECT year, office, NULL, {_SUMS} FROM cty GROUP BY 1, 2)", select=f"SELECT region, {_COLS.replace('county, ', '')} FROM ({_CM[len('cm AS ('):-1].replace('FROM cty', 'FROM rg')})"))
def region_rollup(spark, sf_dir):
    regions = B.table(spark, sf_dir, "nation").join(B.table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.upper("n_name").alias("county"), F.col("r_name").alias("region"))
    return Y.region_rollup(A.party_columns(B.results(spark, sf_dir), ["year", "office", "county"]), regions)


_ty("y3_contested_filter", f"SELECT {_COLS} FROM cm WHERE (year, county) IN (SELECT (year, county) FROM cm GROUP BY year, county HAVING sum(dem_votes) > 0 AND sum(rep_votes) > 5)", lambda s, d, t: Y.contested(t.withColumn("rep_votes", F.col("rep_votes") - 0), ["year", "county"]).join(t.groupBy("year", "county").agg(F.sum("rep_votes").alias("r")).where("r > 5").select("year", "county"), ["year", "county"], "left_semi"))
_ty("y4_flips", f"SELECT {_COLS}, round(margin_pct - lag(margin_pct) OVER w, 4) AS shift, coalesce(lag(winner) OVER w <> winner, false) AS flipped FROM cm WINDOW w AS (PARTITION BY county, office ORDER BY year)", lambda s, d, t: Y.flips(t))
_ty("y5_split_ticket", "SELECT a.county, a.year, a.margin_pct AS first_margin_pct, a.winner AS first_winner, b.margin_pct AS second_margin_pct, b.winner AS second_winner, round(a.margin_pct - b.margin_pct, 4) AS gap, a.winner <> b.winner AS split FROM cm a JOIN cm b ON a.county = b.county AND a.year = b.year WHERE a.office = '1-URGENT' AND b.office = '2-HIGH'", lambda s, d, t: Y.split_ticket(t, "1-URGENT", "2-HIGH"))
_SW = "sw AS (SELECT year, office, county, round_even(least(greatest(dem_votes + (dem_votes + rep_votes) * 3.0 / 100, 0), dem_votes + rep_votes), 0) AS dem_votes, dem_votes + rep_votes - round_even(least(greatest(dem_votes + (dem_votes + rep_votes) * 3.0 / 100, 0), dem_votes + rep_votes), 0) AS rep_votes, other_votes FROM cty)"
_ty("y6_swing", f"SELECT {_COLS} FROM ({_CM[len('cm AS ('):-1].replace('FROM cty', 'FROM sw')})", lambda s, d, t: Y.swing(t, 3.0), _SW)
_ty("y7_recount_flag", f"SELECT {_COLS} FROM cm WHERE abs(margin_pct) < 0.5 AND total_votes > 0", lambda s, d, t: Y.recounts(t))
_ST = f"st AS (SELECT office, year, round((sum(rep_votes) - sum(dem_votes)) / sum(dem_votes + rep_votes + other_votes) * 100, 4) AS state_margin_pct FROM cty GROUP BY 1, 2), vs AS (SELECT cm.*, state_margin_pct, round(margin_pct - state_margin_pct, 4) AS lean FROM cm JOIN st USING (office, year))"
_ty("y18_compared_with_state", f"SELECT {_COLS}, state_margin_pct, lean FROM vs", lambda s, d, t: Y.versus_state(t), _ST)
_ty("y8_barometer", "SELECT county, office, distance, cycles FROM (SELECT county, office, round(avg(abs(lean)), 4) AS distance, count(*) AS cycles FROM (SELECT * FROM vs QUALIFY row_number() OVER (PARTITION BY county, office ORDER BY year DESC) <= 3) GROUP BY 1, 2) WHERE cycles = 3 QUALIFY row_number() OVER (PARTITION BY office ORDER BY distance, county) <= 5", lambda s, d, t: Y.barometer(t), _ST)
_FL = "fl AS (SELECT *, round(margin_pct - lag(margin_pct) OVER w, 4) AS shift, coalesce(lag(winner) OVER w <> winner, false) AS flipped FROM cm WINDOW w AS (PARTITION BY county, office ORDER BY year))"
_ty("y9_realignment_index", f"SELECT {_COLS}, shift, flipped FROM fl WHERE shift IS NOT NULL QUALIFY row_number() OVER (PARTITION BY office, year ORDER BY abs(shift) DESC, county) <= 10", lambda s, d, t: Y.realignment(t), _FL)


@register("y10_ghost_precincts", B.oracle(B.RES, B.BLK, select="SELECT DISTINCT concat(county, ' - ', precinct) AS precinct_id FROM res WHERE concat(county, ' - ', precinct) NOT IN (SELECT precinct_id FROM blk)"))
def ghost_precincts(spark, sf_dir):
    return Y.ghosts(B.results(spark, sf_dir).select(F.concat_ws(" - ", "county", "precinct").alias("precinct_id")), B.blocks(spark, sf_dir))


_ty("y11_turnout_intensity", f"SELECT {_COLS}, round(total_votes / max(total_votes) OVER (PARTITION BY office, year), 6) AS intensity FROM cm", lambda s, d, t: Y.turnout_intensity(t, ["office", "year"]))
_ty("y12_growth_dynamic", f"SELECT {_COLS}, dem_votes - lag(dem_votes) OVER w AS dem_growth, rep_votes - lag(rep_votes) OVER w AS rep_growth FROM cm WINDOW w AS (PARTITION BY county, office ORDER BY year)", lambda s, d, t: Y.growth(t))
_HI = "h AS (SELECT county, office, arg_min(margin_pct, year) AS f, arg_max(margin_pct, year) AS l, count(*) AS cycles, max(year) AS year FROM cm GROUP BY 1, 2), h2 AS (SELECT h.*, p.pm AS previous FROM h JOIN (SELECT county, office, arg_max(pm, year) AS pm FROM (SELECT county, office, year, lag(margin_pct) OVER (PARTITION BY county, office ORDER BY year) AS pm FROM cm) GROUP BY 1, 2) p USING (county, office))"
_TRAJ = """tr AS (SELECT county, office, f AS first, l AS latest, cycles, year, previous,
  CASE WHEN sign(f) <> sign(l) AND abs(l) < 10 THEN 'Emerging' WHEN sign(f) <> sign(l) THEN 'Realigned' WHEN (l - f) * sign(l) <= -2 THEN 'Emerging' WHEN (l - f) * sign(l) >= 2 THEN 'Reinforcing' ELSE 'Durable' END AS origin,
  CASE WHEN l > 0 THEN 'Republican' ELSE 'Democratic' END AS side, CASE WHEN abs(l) >= 20 THEN 'Stronghold' WHEN abs(l) >= 10 THEN 'Advantage' WHEN abs(l) >= 4 THEN 'Edge' WHEN abs(l) >= 0.5 THEN 'Tilt' ELSE 'Battleground' END AS position FROM h2)"""
_ty("y13_trajectory", "SELECT *, CASE WHEN position = 'Battleground' THEN 'Battleground' ELSE concat(origin, ' ', side, ' ', position) END AS status FROM tr", lambda s, d, t: Y.trajectory(t), _HI, _TRAJ)
_ty("y13_shown_status", "SELECT county, office, status, CASE WHEN position = 'Battleground' THEN 'Battleground' ELSE concat(CASE origin WHEN 'Durable' THEN 'Stable' WHEN 'Reinforcing' THEN 'Strengthening' WHEN 'Realigned' THEN 'Shifted' ELSE origin END, ' ', side, ' (', position, ')') END AS shown FROM (SELECT *, CASE WHEN position = 'Battleground' THEN 'Battleground' ELSE concat(origin, ' ', side, ' ', position) END AS status FROM tr)", lambda s, d, t: Y.shown_status(Y.trajectory(t)).select("county", "office", "status", "shown"), _HI, _TRAJ)
_ty("y14_momentum", """SELECT county, office, f AS first, l AS latest, cycles, year, previous,
  coalesce(CASE WHEN l - f >= 2 AND l - previous >= 2 AND l - previous > (l - f) / (cycles - 1) THEN 'Moving right faster' WHEN l - f >= 2 AND l - previous >= 2 THEN 'Moving right' WHEN l - f >= 8 THEN 'Long-run move right' WHEN l - previous >= 2 THEN 'Moving right' END,
  CASE WHEN f - l >= 2 AND previous - l >= 2 AND previous - l > (f - l) / (cycles - 1) THEN 'Moving left faster' WHEN f - l >= 2 AND previous - l >= 2 THEN 'Moving left' WHEN f - l >= 8 THEN 'Long-run move left' WHEN previous - l >= 2 THEN 'Moving left' END, 'Stable') AS momentum,
  CASE WHEN l - f <= -8 AND l > 0 AND l < 10 AND l - previous <= 0 THEN 'Active Suburban Transition' WHEN l - f >= 8 AND l < 0 AND l > -10 AND l - previous >= 0 THEN 'Active Republican Transition' WHEN l - f <= -8 AND l - previous > 0 THEN 'Suburbanizing (Lagging)' WHEN l - f >= 8 AND l - previous < 0 THEN 'Counter-Suburbanizing (Lagging)' WHEN l - f >= 8 THEN 'Breaking right' WHEN l - f <= -8 THEN 'Breaking left' WHEN l > 0 AND l - previous <= -2 THEN 'Red-leaning, cooling' WHEN l < 0 AND l - previous >= 2 THEN 'Blue-leaning, cooling' WHEN l - f >= 2 AND l - previous > 0 THEN 'Moving right' WHEN l - f <= -2 AND l - previous < 0 THEN 'Moving left' ELSE 'Stable / Mixed' END AS subtype FROM h2""", lambda s, d, t: Y.momentum(t), _HI)  # fmt: skip
_ty("y19_confidence", "SELECT county, office, latest, round(sd, 4) AS sd, CASE WHEN abs(latest) >= 10 AND net = n AND sd <= 8 THEN 'High' WHEN net = n OR abs(latest) >= 10 THEN 'Medium' ELSE 'Low' END AS confidence FROM (SELECT county, office, arg_max(margin_pct, year) AS latest, stddev_pop(margin_pct) AS sd, abs(sum(sign(margin_pct))) AS net, count(*) AS n FROM cm GROUP BY 1, 2)", lambda s, d, t: Y.confidence(t))


@register("y15_historical_backfill", B.oracle(B.RES, B.BLK, B.CTY, B.PRE, "sh AS (SELECT DISTINCT county, precinct_id FROM blk)", "bf AS (SELECT year, office, county, precinct_id, dem_votes, rep_votes, other_votes, 'precinct' AS scope, NULL AS reason FROM pre UNION ALL SELECT c.year, c.office, c.county, s.precinct_id, c.dem_votes, c.rep_votes, c.other_votes, 'county', 'historical_unmatched_precinct' FROM sh s JOIN cty c ON s.county = c.county WHERE c.year <= 1998 AND (c.year, c.office, s.precinct_id) NOT IN (SELECT (year, office, precinct_id) FROM pre))", select=f"SELECT precinct_id, scope, reason, {_COLS} FROM ({_CM[len('cm AS ('):-1].replace('FROM cty', 'FROM bf')})"))
def historical_backfill(spark, sf_dir):
    counties = A.party_columns(B.results(spark, sf_dir), ["year", "office", "county"])
    return Y.backfill(_precincts(spark, sf_dir), B.blocks(spark, sf_dir).select("county", "precinct_id"), counties, 1998)


_ty("y16_modeled_contest", f"SELECT {_COLS.replace('year, office, ', '')} FROM ({_CM[len('cm AS ('):-1].replace('FROM cty', 'FROM mc')})", lambda s, d, t: Y.modeled_contest(t, (1996, "1-URGENT"), (1998, "2-HIGH"), 0.6, 1.5), "mx AS (SELECT a.county, least(greatest(a.dem_votes / nullif(a.dem_votes + a.rep_votes, 0) * 0.6 + b.dem_votes / nullif(b.dem_votes + b.rep_votes, 0) * (1 - 0.6) + 1.5 / 100, 0), 1) AS sh, round_even(round(greatest(a.dem_votes + a.rep_votes, b.dem_votes + b.rep_votes) * 0.575, 9), 0) AS size, a.dem_votes + a.rep_votes > 0 AND b.dem_votes + b.rep_votes > 0 AS both_held FROM cty a JOIN cty b ON a.county = b.county WHERE a.year = 1996 AND a.office = '1-URGENT' AND b.year = 1998 AND b.office = '2-HIGH'), mc AS (SELECT county, round_even(round(size * sh, 9), 0) AS dem_votes, size - round_even(round(size * sh, 9), 0) AS rep_votes, 0.0 AS other_votes FROM mx WHERE both_held)")
#: Bisection for each county's factor, then largest remainders; the query finds the same whole votes by Newton steps.
_FITTED = """bp AS (
  SELECT county, precinct_id, sum(dem_votes) AS d, sum(dem_votes + rep_votes) AS n, sum(CASE WHEN year = 1998 THEN dem_votes + rep_votes ELSE 0 END) AS size FROM pre
  WHERE (year = 1996 AND office = '1-URGENT') OR (year = 1998 AND office = '2-HIGH') GROUP BY 1, 2),
bt AS (SELECT county, precinct_id, (d + 0.5::DOUBLE) / (n + 1) AS seed, round((dem_votes + rep_votes) * size / sum(size) OVER (PARTITION BY county), 9) AS part, dem_votes + rep_votes AS county_size, dem_votes AS county_dem, rep_votes AS county_rep FROM bp JOIN mc USING (county) QUALIFY sum(size) OVER (PARTITION BY county) > 0),
bs AS (SELECT *, floor(part) + CASE WHEN row_number() OVER (PARTITION BY county ORDER BY round(part - floor(part), 9) DESC, precinct_id) <= county_size - sum(floor(part)) OVER (PARTITION BY county) THEN 1 ELSE 0 END AS turnout FROM bt),
halves AS (
  SELECT county, -60::DOUBLE AS low, 60::DOUBLE AS high, 0 AS n FROM (SELECT DISTINCT county FROM bs)
  UNION ALL
  SELECT county, CASE WHEN s < county_dem THEN (low + high) / 2 ELSE low END, CASE WHEN s < county_dem THEN high ELSE (low + high) / 2 END, n + 1
  FROM (SELECT h.county, any_value(low) AS low, any_value(high) AS high, any_value(n) AS n, any_value(county_dem) AS county_dem, sum(turnout / (1 + exp(-(ln(seed / (1 - seed)) + (low + high) / 2)))) AS s FROM halves h JOIN bs USING (county) WHERE n < 70 GROUP BY h.county)),
fd AS (SELECT bs.*, round(CASE WHEN county_dem = 0 THEN 0 WHEN county_rep = 0 THEN turnout ELSE turnout / (1 + exp(-(ln(seed / (1 - seed)) + (low + high) / 2))) END, 6) AS dem FROM bs JOIN halves h ON bs.county = h.county AND h.n = 70),
fw AS (SELECT county, precinct_id, turnout, floor(dem) + CASE WHEN row_number() OVER (PARTITION BY county ORDER BY round(dem - floor(dem), 6) DESC, precinct_id) <= county_dem - sum(floor(dem)) OVER (PARTITION BY county) THEN 1 ELSE 0 END AS dem_votes FROM fd)"""


def _modeled_precincts(s, d, t):
    from votealloc.operators.scenarios import modeled_precincts

    return modeled_precincts(t, _precincts(s, d), (1996, "1-URGENT"), (1998, "2-HIGH"), weight=0.6, bonus=1.5).select("county", "precinct_id", "dem_votes", "rep_votes")


_MX = "mx AS (SELECT a.county, least(greatest(a.dem_votes / nullif(a.dem_votes + a.rep_votes, 0) * 0.6 + b.dem_votes / nullif(b.dem_votes + b.rep_votes, 0) * (1 - 0.6) + 1.5 / 100, 0), 1) AS sh, round_even(round(greatest(a.dem_votes + a.rep_votes, b.dem_votes + b.rep_votes) * 0.575, 9), 0) AS size, a.dem_votes + a.rep_votes > 0 AND b.dem_votes + b.rep_votes > 0 AS both_held FROM cty a JOIN cty b ON a.county = b.county WHERE a.year = 1996 AND a.office = '1-URGENT' AND b.year = 1998 AND b.office = '2-HIGH'), mc AS (SELECT county, round_even(round(size * sh, 9), 0) AS dem_votes, size - round_even(round(size * sh, 9), 0) AS rep_votes FROM mx WHERE both_held)"
register("y16_modeled_precincts", "WITH RECURSIVE " + ",\n".join([B.RES, B.CTY, B.PRE, _MX, _FITTED]) + "\nSELECT county, precinct_id, dem_votes::DOUBLE AS dem_votes, (turnout - dem_votes)::DOUBLE AS rep_votes FROM fw")(lambda s, d: _modeled_precincts(s, d, _trend(s, d)))
_PE = "pe AS (SELECT upper(n_name) AS county, CAST(1000 + n_nationkey AS DOUBLE) AS base, CAST(1010 + n_nationkey * 3 AS DOUBLE) AS before, CAST(1000 + n_nationkey * 6 - 20 AS DOUBLE) AS latest_people FROM nation)"


def _growth(s, d, t):
    k = F.col("n_nationkey")
    people = B.table(s, d, "nation").select(F.upper("n_name").alias("county"), (1000 + k).cast("double").alias("base"), (1010 + k * 3).cast("double").alias("before"), (1000 + k * 6 - 20).cast("double").alias("latest"))
    trend = Y.trajectory(t).select("county", "office", "first", "latest")
    return Y.census_check(trend, people)


_ty("y17_census_check", "SELECT county, office, f AS first, l AS latest, base, before, latest_people, round((latest_people - base) / base * 100, 4) AS growth_pct, round((latest_people - before) / before * 100, 4) AS last_year_pct, CASE WHEN (latest_people - base) / base * 100 >= 5 AND l > f THEN 'fast growth, moving right' WHEN (latest_people - base) / base * 100 >= 5 AND l < f THEN 'fast growth, moving left' WHEN latest_people < base THEN 'declining' ELSE 'mixed growth' END AS note FROM h2 JOIN pe USING (county)", _growth, _HI, _PE)


@register("y20_trend_series", B.oracle(B.RES, B.BLK, B.CTY, _CM, B.PRE, "pm AS (SELECT precinct_id, office, year, round(coalesce((rep_votes - dem_votes) / nullif(dem_votes + rep_votes + other_votes, 0) * 100, 0), 4) AS m FROM pre)", "n AS (SELECT DISTINCT county, precinct_id FROM blk)", select="SELECT precinct_id, office, string_agg(concat(CAST(year AS VARCHAR), ':', CASE WHEN m > 0 THEN 'R' WHEN m < 0 THEN 'D' ELSE '-' END), ',' ORDER BY year) AS series, 'precinct' AS level FROM pm GROUP BY 1, 2 UNION ALL SELECT n.precinct_id, office, string_agg(concat(CAST(year AS VARCHAR), ':', CASE WHEN margin_pct > 0 THEN 'R' WHEN margin_pct < 0 THEN 'D' ELSE '-' END), ',' ORDER BY year), 'county' FROM (SELECT county, precinct_id FROM n UNION SELECT county, precinct_id FROM pre) n JOIN cm USING (county) WHERE (precinct_id, office) NOT IN (SELECT (precinct_id, office) FROM pm) GROUP BY 1, 2"))
def trend_series(spark, sf_dir):
    names = B.blocks(spark, sf_dir).select("county", "precinct_id").distinct()
    out = Y.trend_series(_trend(spark, sf_dir), Y.with_margin(_precincts(spark, sf_dir)), names)
    side = lambda p: F.concat(p["year"].cast("string"), F.lit(":"), F.when(p["margin_pct"] > 0, "R").when(p["margin_pct"] < 0, "D").otherwise("-"))
    return out.withColumn("series", F.array_join(F.transform("series", side), ","))


#: From 1997 on half of the counties spell BUILDING another way, from 1998 a third of those a third way.
_SPELL = "CASE WHEN precinct = 'BUILDING' AND year >= 1998 AND n % 6 = 0 THEN 'BLD' WHEN precinct = 'BUILDING' AND year >= 1997 AND n % 2 = 0 THEN 'BLDG' ELSE precinct END"


@register("y20_series_by_identity", B.oracle(B.RES, B.CTY, _CM, B.PRE, "pm AS (SELECT county, precinct_id, office, year, round(coalesce((rep_votes - dem_votes) / nullif(dem_votes + rep_votes + other_votes, 0) * 100, 0), 4) AS m FROM pre)", "sp AS (SELECT county, precinct_id, office, string_agg(concat(CAST(year AS VARCHAR), ':', CASE WHEN m > 0 THEN 'R' WHEN m < 0 THEN 'D' ELSE '-' END), ',' ORDER BY year) AS series FROM pm GROUP BY 1, 2, 3)", "nm AS (SELECT DISTINCT county, CAST(substr(county, 8) AS INT) AS n, year, precinct, concat(county, ' - ', precinct) AS precinct_id FROM res WHERE precinct <> 'ABSENTEE')", f"al AS (SELECT DISTINCT county, precinct_id, concat(county, ' - ', {_SPELL}) AS spelled FROM nm)", select="SELECT DISTINCT spelled AS precinct_id, office, series, 'precinct' AS level FROM al JOIN sp USING (county, precinct_id) UNION ALL SELECT DISTINCT spelled, office, string_agg(concat(CAST(year AS VARCHAR), ':', CASE WHEN margin_pct > 0 THEN 'R' WHEN margin_pct < 0 THEN 'D' ELSE '-' END), ',' ORDER BY year) OVER (PARTITION BY spelled, office ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), 'county' FROM (SELECT DISTINCT county, precinct_id, spelled FROM al) JOIN cm USING (county) WHERE (precinct_id, office) NOT IN (SELECT (precinct_id, office) FROM sp)"))
def series_by_identity(spark, sf_dir):
    """One series spans three spellings that links of a bridge table chain together; every spelling gets the whole."""
    n = F.substring("county", 8, 9).cast("int")
    code = F.element_at(F.split("precinct_id", " - "), -1)
    other = F.when((code == "BUILDING") & (F.col("year") >= 1998) & (n % 6 == 0), "BLD").when((code == "BUILDING") & (F.col("year") >= 1997) & (n % 2 == 0), "BLDG").otherwise(code)
    rows = _precincts(spark, sf_dir).withColumn("precinct_id", F.concat_ws(" - ", "county", other))
    county = B.table(spark, sf_dir, "nation").select(F.upper("n_name").alias("county"))
    pairs = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in (("BUILDING", "BLDG"), ("BLDG", "BLD"))])).alias("p")
    links = county.select("county", pairs).select("county", *[F.concat_ws(" - ", "county", f"p.{x}").alias(x) for x in "ab"])
    out = Y.trend_series(_trend(spark, sf_dir), Y.with_margin(rows), rows.select("county", "precinct_id"), identities(links))
    side = lambda p: F.concat(p["year"].cast("string"), F.lit(":"), F.when(p["margin_pct"] > 0, "R").when(p["margin_pct"] < 0, "D").otherwise("-"))
    return out.withColumn("series", F.array_join(F.transform("series", side), ","))
