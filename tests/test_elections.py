"""Edge cases of the election operators on tables written by hand, and totals that must hold."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from votealloc.functions import keys as K
from votealloc.functions import measures as M
from votealloc.operators import aggregate as A
from votealloc.operators import allocate as R
from votealloc.operators import analytics as Y
from votealloc.operators import geometry as G
from votealloc.operators import resolve as X
from votealloc.sources import readers as S
from votealloc.sources import sinks as W

RESULTS = "year int, office string, county string, precinct string, party string, candidate string, votes double"


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'string' if v is None or isinstance(v, str) else 'double'}" for k, v in values.items()))
    return row.select(column).first()[0]


@pytest.mark.parametrize("pct,color", [(0.49, "#f7f7f7"), (0.5, "#fee8c8"), (-0.5, "#e1f5fe"), (1, "#fcae91"), (5.5, "#fb6a4a"), (-5.5, "#9ecae1"), (10, "#ef3b2c"), (20, "#cb181d"), (30, "#a50f15"), (-40, "#08306b"), (40, "#67000d")])
def test_color_boundaries(spark, pct, color):
    assert one(spark, M.competitiveness_color(F.col("p")), p=float(pct)) == color


@pytest.mark.parametrize("label,county,want", [("01-07A", "WAKE", "01-07"), ("PCT 012.1", "MECKLENBURG", "012.1"), ("PCT 12", "UNION", "12"), ("7", "ROBESON", "07"), ("MAXTON", "ROBESON", "22"), ("06N NORTH", "X", "06N"), ("01_PATTERSON", "X", "1"), ("ELM", "X", "ELM"), ("", "X", "")])
def test_clean_precinct(spark, label, county, want):
    assert one(spark, K.clean_precinct(F.col("p"), F.col("c")), p=label, c=county) == want


def test_pad_keeps_long_keys(spark):
    assert one(spark, K.pad(F.col("x"), 15), x="1234567890123456") == "1234567890123456"
    assert one(spark, K.pad(F.col("x"), 15), x=" 7 ") == "000000000000007"


@pytest.mark.parametrize("name,county,full", [("ABSENTEE", "X", True), ("PROVIDENCE", "X", False), ("PROVI", "WAKE", False), ("PROVI", "X", True), ("OSNB 81", "WAKE", True), ("NASHVILLE OS", "X", True), ("MOSS", "X", False), ("EVX1", "X", True), (None, "X", False)])
def test_non_geographic(spark, name, county, full):
    assert one(spark, K.is_non_geographic(F.col("p"), F.col("c")), p=name, c=county) is full


def test_margin_of_nothing(spark):
    assert one(spark, M.margin_pct(F.col("d"), F.col("r"), F.col("t")), d=0.0, r=0.0, t=0.0) == 0.0


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 10_000), st.integers(0, 100), st.integers(0, 100), st.integers(1, 100)), min_size=1, max_size=20))
def test_largest_remainder_keeps_totals(spark, rows):
    df = spark.createDataFrame([(float(t), *map(float, s)) for t, *s in rows], "t double, a double, b double, c double")
    total = F.col("a") + F.col("b") + F.col("c")
    parts = M.largest_remainder(F.col("t"), [F.col(x) / total for x in "abc"])
    for r in df.select("t", *[p.alias(n) for p, n in zip(parts, "xyz", strict=True)]).collect():
        assert r.x + r.y + r.z == r.t and min(r.x, r.y, r.z) >= 0


def results(spark, rows):
    return spark.createDataFrame([(2020, "gov", *r) for r in rows], RESULTS)


def test_absentee_votes_are_spread_and_totals_hold(spark):
    rows = [
        ("A", "P1", "DEM", "Dee", 30.0), ("A", "P2", "DEM", "Dee", 10.0), ("A", "P1", "REP", "Ray", 20.0), ("A", "ABSENTEE", "DEM", "Dee", 8.0),
        ("A", "ABSENTEE", "LIB", "Lou", 6.0), ("B", "ABSENTEE", "DEM", "Dee", 5.0), ("C", "P9", "DEM", "Dee", 0.0), ("C", "ABSENTEE", "DEM", "Dee", 4.0),
    ]
    placed, left = R.spread_non_geographic(results(spark, rows))
    got = {(r.precinct_id, r.candidate): r.votes for r in placed.collect()}
    assert got[("A - P2", "Dee")] == pytest.approx(12 + 6 * 10 / 60)
    assert {(r.county, r.candidate): r.unallocated for r in left.collect()} == {("B", "Dee"): 5.0, ("C", "Dee"): 4.0}
    assert sum(got.values()) + 9 == pytest.approx(sum(r[-1] for r in rows))


def test_shatter_is_exact_and_handles_empty_precincts(spark):
    blocks = spark.createDataFrame([("b1", "A - P1", 1), ("b2", "A - P1", 1), ("b3", "A - P1", 1), ("b4", "A - P2", 0), ("b5", "A - P2", 0)], "block string, precinct_id string, vap long")
    votes = spark.createDataFrame([(2020, "gov", "A", "A - P1", 10.0, 1.0, 0.0), (2020, "gov", "A", "A - P2", 7.0, 0.0, 2.0), (2020, "gov", "A", "A - P3", 5.0, 0.0, 0.0)], "year int, office string, county string, precinct_id string, dem_votes double, rep_votes double, other_votes double")
    shattered, audit = R.shatter(votes, blocks)
    assert all(r.delta_dem_votes == 0 and r.delta_other_votes == 0 for r in audit.collect()) and audit.count() == 2
    got = {r.block: float(r.dem_votes) for r in shattered.collect()}
    assert got["b4"] == 7 and got["b5"] == 0 and sum(got.values()) == 17
    assert {r.block: r.weight for r in R.block_weights(blocks).collect()}["b4"] == 1.0


def test_fallback_prefers_the_bucket_and_reports_the_rest(spark):
    cols = "year int, office string, county string, precinct_id string, dem_votes double, rep_votes double, other_votes double"
    precincts = spark.createDataFrame([(2020, "gov", "A", "A - 01-07", 10.0, 0.0, 0.0), (2020, "gov", "A", "A - 01-07B", 4.0, 0.0, 0.0), (2020, "gov", "A", "A - 02-01", 6.0, 0.0, 0.0), (2020, "gov", "Z", "Z - X", 3.0, 0.0, 0.0)], cols)
    blocks = spark.createDataFrame([("b1", "A", "A - 01-07", 5), ("b2", "A", "A - 09-01", 15)], "block string, county string, precinct_id string, vap long")
    dmap = spark.createDataFrame([("b1", "s", "1"), ("b2", "s", "2")], "block string, scope string, district string")
    direct = R.precinct_district_weights(blocks, dmap).withColumn("method", F.lit("map"))
    scopes = dmap.select("scope").distinct()
    bucket = R.area_shares(blocks.withColumn("bucket", R.bucket_of(F.col("precinct_id"))), dmap, ["county", "bucket"])
    weights = direct.unionByName(R.fallback_weights(precincts, direct, R.area_shares(blocks, dmap, ["county"]), bucket, scopes))
    got = {r.district: r.dem_votes for r in R.allocate(precincts, weights).collect()}
    assert got == pytest.approx({"1": 14 + 1.5, "2": 4.5})
    assert R.unallocated(precincts, weights, scopes).first().dem_votes == 3.0
    cover = R.coverage(precincts, weights).first()
    assert (cover.total_precincts, cover.matched_precincts, cover.placed_precincts) == (4, 1, 3)


@pytest.mark.parametrize("year,first", [(2014, 5.0), (2018, 2.5)])
def test_ladder_uses_buckets_only_before_2016(spark, year, first):
    rows = spark.createDataFrame([(year, "gov", "A", "A - 01-01", "matched", 10.0, 0.0, 0.0), (year, "gov", "A", "A - 02-01", "matched", 10.0, 0.0, 0.0), (year, "gov", "A", "A - 01-01B", "unmatched", 5.0, 0.0, 0.0)], "year int, office string, county string, key string, status string, dem_votes double, rep_votes double, other_votes double")
    splits = spark.createDataFrame([("A - 01-01", "1", 1.0), ("A - 02-01", "2", 1.0)], "key string, district string, area_weight double")
    got = {r.district: r.dem_votes for r in R.ladder_allocate(rows, splits).collect()}
    assert got["1"] == pytest.approx(10 + first) and sum(got.values()) == pytest.approx(25)


def test_auto_overrides_follow_the_rules(spark):
    known = ["WAKE - 01-07", "GASTON - 4A", "ROCKINGHAM - WS-1", "UNION - 0019", "ROBESON - 22", "CUMBERLAND - CC-3", "LEE - DV1A1A", "LEE - QQ1X", "LEE - QQ1Y"]
    raw = ["WAKE - 01-07A", "GASTON - 04-1", "ROCKINGHAM - WS", "UNION - 019", "ROBESON - MAXTON", "CUMBERLAND - CC3", "LEE - DV1A", "LEE - QQ1", "nokey", "LEE - NOPE"]
    frame = lambda x: spark.createDataFrame([(k,) for k in x], "precinct_id string")
    got = {r.precinct_id: (r.canonical_id, r.rule) for r in X.auto_overrides(frame(raw), frame(known)).collect()}
    assert got["WAKE - 01-07A"] == ("WAKE - 01-07", 3) and got["GASTON - 04-1"] == ("GASTON - 4A", 5) and got["ROCKINGHAM - WS"] == ("ROCKINGHAM - WS-1", 6)
    assert got["UNION - 019"] == ("UNION - 0019", 7) and got["ROBESON - MAXTON"] == ("ROBESON - 22", 2) and got["CUMBERLAND - CC3"][1] == 8 and got["LEE - DV1A"][1] == 9
    assert not {"LEE - QQ1", "nokey", "LEE - NOPE"} & set(got)
    assert {c for c, _ in got.values()} <= set(known)


def test_enriched_aliases_are_unique_and_new(spark):
    index = spark.createDataFrame([("A", "01", "A - 01"), ("A", "02", "A - 02")], "county string, alias string, canonical string")
    more = spark.createDataFrame([("A", "01", "OAK"), ("A", "02", "ELM"), ("A", "01", "ELM")], "county string, code string, name string")
    got = {r.alias: r.canonical for r in X.enrich_alias_index(index, more).collect()}
    assert got["OAK"] == "A - 01" and "ELM" not in got and "01" not in got


def test_trajectory_examples(spark):
    rows = [("m", 2008, -7.2), ("m", 2020, 1.6), ("m", 2024, 4.4), ("n", 2008, -6.4), ("n", 2020, 0.9), ("n", 2024, 3.1)]
    df = spark.createDataFrame([(c, "pres", y, m) for c, y, m in rows], "county string, office string, year int, margin_pct double")
    got = {r.county: r.status for r in Y.trajectory(df).collect()}
    assert got == {"m": "Emerging Republican Edge", "n": "Emerging Republican Tilt"}


@pytest.mark.parametrize("year,added", [(2020, 1), (2024, 0)])
def test_backfill(spark, year, added):
    cols = "year int, office string, county string, precinct_id string, dem_votes double, rep_votes double, other_votes double"
    rows = spark.createDataFrame([(year, "gov", "WAKE", "WAKE - 01-01", 60.0, 40.0, 0.0)], cols)
    shapes = spark.createDataFrame([("WAKE", "WAKE - 01-01"), ("WAKE", "WAKE - 01-02")], "county string, precinct_id string")
    county = spark.createDataFrame([(year, "gov", "WAKE", 600.0, 400.0, 0.0)], cols.replace("precinct_id string, ", ""))
    extra = Y.backfill(rows, shapes, county).where("scope = 'county'").collect()
    assert len(extra) == added
    if added:
        assert (extra[0].precinct_id, extra[0].total_votes, extra[0].winner, extra[0].reason) == ("WAKE - 01-02", 1000.0, "DEM", "historical_unmatched_precinct")


def test_geometry(spark):
    ring = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((0, 0), (4, 0), (4, 3), (0, 3))])
    row = spark.range(1).select(G.ring_area(ring).alias("area"), G.in_ring(F.lit(1.0), F.lit(1.0), ring).alias("inside"), G.in_ring(F.lit(5.0), F.lit(1.0), ring).alias("outside"), G.albers(F.lit(-96.0), F.lit(23.0)).alias("origin"), G.albers(F.lit(-78.6), F.lit(35.8)).alias("raleigh")).first()
    assert row.area == 12 and row.inside and not row.outside
    assert abs(row.origin.x) < 1e-6 and abs(row.origin.y) < 1e-6
    assert 1.5e6 < row.raleigh.x < 1.6e6 and 1.5e6 < row.raleigh.y < 1.65e6


def test_slices_survive_a_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([(2020, "state_house", "us_senate", str(d), float(d), 2.0, 0.0) for d in range(1, 5)], "year int, scope string, contest_type string, district string, dem_votes double, rep_votes double, other_votes double")
    rows = M.with_measures(rows)
    W.write_district_slices(rows, f"{tmp_path}/slices")
    (tmp_path / "flat").mkdir()
    part = next((tmp_path / "slices").rglob("part-*.txt"))
    (tmp_path / "flat" / "state_house_us_senate_2020.json").write_text(part.read_text())
    back = S.scan_slices(spark, f"{tmp_path}/flat").select("year", "scope", "contest_type", "district", "margin", "winner")
    assert sorted(map(tuple, back.collect())) == sorted((r.year, r.scope, r.contest_type, r.district, int(r.margin), r.winner) for r in rows.collect())


def test_results_files(spark, tmp_path):
    for year, extra in ((2018, ""), (2020, "A,ABSENTEE,GOV,,DEM,Dee,bad\n")):
        folder = tmp_path / str(year)
        folder.mkdir()
        (folder / f"{year}1106__general__precinct.csv").write_text("county,precinct,office,district,party,candidate,votes\nA,P1,GOV,,DEM,Dee,3\n" + extra)
    (tmp_path / "2020" / "2020__general__precinct_b.csv").write_text("county,precinct,office,district,party,candidate,votes\n")
    rows = S.scan_results_csv(spark, f"{tmp_path}/*/*1106*.csv").collect()
    assert sorted((r.year, r.votes) for r in rows) == [(2018, 3.0), (2020, 0.0), (2020, 3.0)]
    found = {r.year: r.path for r in S.discover_year_files(spark, str(tmp_path), largest=True).collect()}
    assert found[2020].endswith("20201106__general__precinct.csv") and set(found) == {2018, 2020}


def test_board_file(spark, tmp_path):
    head = "County\tPrecinct\tContest Type\tContest Name\tChoice\tChoice Party\tTotal Votes\tElection Date\n"
    (tmp_path / "b.txt").write_text(head + "wake\t01-01\tS\tUS SENATE\tDee\tDEM\t5\t11/03/2020\nwake\t01-01\tC\tSHERIFF\tX\t\t9\t11/03/2020\nwake\t01-02\tS\tUS SENATE\tRay\t\t0\t11/03/2020\n")
    rows = S.board_to_long(S.scan_board_tsv(spark, f"{tmp_path}/b.txt")).collect()
    assert [(r.county, r.precinct, r.party, r.votes) for r in rows] == [("WAKE", "01-01", "DEM", 5.0)]


def test_nested_files(spark, tmp_path):
    (tmp_path / "n.json").write_text('{"results_by_year": {"2020": {"gov": {"general": {"results": {"A - 1": {"dem_votes": 3, "rep_votes": 1}}}}}}}')
    (tmp_path / "g.json").write_text('{"features": [{"properties": {"prec_id": "01"}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1]]]}}]}')
    row = S.scan_nested_results(spark, f"{tmp_path}/n.json").first()
    assert (row.year, row.office, row.key, row.dem_votes) == (2020, "gov", "A - 1", 3)
    shape = S.scan_geojson(spark, f"{tmp_path}/g.json", "prec_id string").first()
    assert shape.prec_id == "01" and shape.rings[0][1] == [1.0, 0.0]


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="missing columns: votes"):
        A.require(spark.range(1), "id", "votes")
    with pytest.raises(ValueError, match="no contest"):
        R.block_file_districts(spark.createDataFrame([("b", 1)], "block string, E_16_PRES_Total int"), spark.createDataFrame([("b", "s", "1")], "block string, scope string, district string"))
