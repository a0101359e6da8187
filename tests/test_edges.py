"""Edge cases of overlays, ladders, analytics, demographics and reports: nulls, ties, zero totals, empty tables."""

import math
import random

import pytest
from pyspark.sql import functions as F

from votealloc.functions import keys as K
from votealloc.operators import allocate as R
from votealloc.operators import analytics as Y
from votealloc.operators import demographics as P
from votealloc.operators import geometry as G
from votealloc.operators import reports as Q
from votealloc.sources import readers as S

RING = "ring array<struct<x:double,y:double>>"
VOTES = "dem_votes double, rep_votes double, other_votes double"


def clipped_area(subject, window):
    """Common area of a polygon and a convex counterclockwise one: the polygon cut by one side after the other."""
    points = subject
    for (ax, ay), (bx, by) in zip(window, window[1:] + window[:1], strict=True):
        inside = lambda p: (bx - ax) * (p[1] - ay) - (by - ay) * (p[0] - ax)  # noqa: B023, E731
        out = []
        for p, q in zip(points, points[1:] + points[:1], strict=True):
            dp, dq = inside(p), inside(q)
            if dp >= 0:
                out.append(p)
            if dp * dq < 0:
                t = dp / (dp - dq)
                out.append((p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])))
        points = out
        if not points:
            return 0.0
    return abs(sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(points, points[1:] + points[:1], strict=True))) / 2


def areas(spark, first, second, cell=1.0):
    a = spark.createDataFrame(first, f"id int, {RING}")
    b = spark.createDataFrame(second, f"district string, {RING}")
    return {(r.id, r.district): r.area for r in G.overlay(a, b, ["id"], cell).collect()}


def test_overlay_is_exact_on_random_polygons(spark):
    rng = random.Random(7)
    stars, windows = [], []
    for i in range(25):
        cx, cy, n = rng.uniform(-3, 3), rng.uniform(-3, 3), rng.randint(3, 11)
        turns = sorted(rng.uniform(0, 6.283) for _ in range(n))
        star = [(cx + (r := rng.uniform(0.2, 2.5)) * math.cos(t), cy + r * math.sin(t)) for t in turns]
        stars.append((i, star if i % 2 else star[::-1]))
    for i in range(12):
        x, y, s = rng.uniform(-3, 3), rng.uniform(-3, 3), rng.uniform(0.3, 2)
        windows.append((str(i), [(x, y - s), (x + s, y), (x, y + s), (x - s, y)]))
    got = areas(spark, stars, windows, 0.7)
    for i, star in stars:
        for name, window in windows:
            assert got.get((i, name), 0.0) == pytest.approx(clipped_area(star, window), abs=1e-7)


def test_overlay_edge_cases(spark):
    square = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)]
    ell = [(0.0, 0.0), (2.0, 0.0), (2.0, 1.0), (1.0, 1.0), (1.0, 2.0), (0.0, 2.0)]
    got = areas(spark, [(1, square), (2, ell), (3, [*square, square[0]]), (4, None), (5, square[:2]), (6, [(2.0, 0.0), (4.0, 0.0), (4.0, 2.0), (2.0, 2.0)])], [("sq", square), ("ell", ell[::-1]), ("none", None)])
    assert got == pytest.approx({(1, "sq"): 4, (1, "ell"): 3, (2, "sq"): 3, (2, "ell"): 3, (3, "sq"): 4, (3, "ell"): 3})
    parts = areas(spark, [(1, [(x + 0.0, 0.0), (x + 1.0, 0.0), (x + 1.0, 1.0), (x + 0.0, 1.0)]) for x in (0, 5)], [("d", [(0.5, 0.0), (5.5, 0.0), (5.5, 1.0), (0.5, 1.0)])])
    assert parts == pytest.approx({(1, "d"): 1.0})
    assert areas(spark, [], [("sq", square)]) == {}


def test_crosswalk_of_an_overlay(spark):
    square = lambda x, w: [(x, 0.0), (x + w, 0.0), (x + w, 1.0), (x, 1.0)]
    a = spark.createDataFrame([(1, square(0.0, 1.0)), (2, square(1.0, 2.0))], f"id int, {RING}")
    b = spark.createDataFrame([("W", square(0.0, 1.5)), ("E", square(1.5, 1.5))], f"district string, {RING}")
    got = {(r.id, r.district): r.area_weight for r in G.area_crosswalk(G.overlay(a, b, ["id"], 1.0), ["id"]).collect()}
    assert got == pytest.approx({(1, "W"): 1.0, (2, "W"): 0.25, (2, "E"): 0.75})


def test_two_way_share(spark):
    pieces = spark.createDataFrame([("A", "1", 3.0), ("A", "2", 1.0), ("A", "3", 4.0), ("B", "1", 0.0)], "key string, district string, area double")
    share = lambda key, *two: G.two_way_share(pieces, key, *two).first().share
    assert [share("A", "1", "2"), share("A", "3", "1"), share("A", "2", "9")] == [0.25, 3 / 7, 0.0]
    assert [share("C", "1", "2"), share("A", "8", "9"), share("B", "1", "2")] == [None] * 3


@pytest.mark.parametrize("legacy,first", [(False, 15.0), (True, 12.5)])
def test_legacy_overwrite(spark, legacy, first):
    rows = spark.createDataFrame([(2014, "gov", "A", k, s, v, 0.0, 0.0) for k, s, v in (("A - 01-01", "matched", 10.0), ("A - 02-01", "matched", 10.0), ("A - 01-01B", "unmatched", 5.0))], f"year int, office string, county string, key string, status string, {VOTES}")
    splits = spark.createDataFrame([("A - 01-01", "1", 1.0), ("A - 02-01", "2", 1.0)], "key string, district string, area_weight double")
    got = {r.district: r.dem_votes for r in R.ladder_allocate(rows, splits, legacy_overwrite=legacy).collect()}
    assert got["1"] == pytest.approx(first) and sum(got.values()) == pytest.approx(25)


def test_ladder_of_fixed_shares(spark):
    rows = spark.createDataFrame([(2022, "gov", "Z", "Z - X", "unmatched", 8.0, 0.0, 0.0), (2022, "gov", "Z", "Z - ABS", "non_geographic", 4.0, 0.0, 0.0), (2022, "gov", "Y", "Y - X", "unmatched", 2.0, 0.0, 0.0), (2018, "gov", "Y", "Y - X", "unmatched", 3.0, 0.0, 0.0)], f"year int, office string, county string, key string, status string, {VOTES}")
    splits = spark.createDataFrame([], "key string, district string, area_weight double")
    fixed = spark.createDataFrame([("non_geo", "Z", "1", 1.0), ("county", "Z", "2", 1.0), ("legacy", "Y", "3", 1.0)], "kind string, county string, district string, share double")
    got = {(r.year, r.district): r.dem_votes for r in R.ladder_allocate(rows, splits, fixed).collect()}
    assert got == {(2022, "1"): 4.0, (2022, "2"): 8.0, (2018, "3"): 3.0}
    assert R.ladder_allocate(rows.where("false"), splits).count() == 0


def margins(spark, rows):
    return spark.createDataFrame(rows, f"county string, office string, year int, {VOTES}, margin_pct double, winner string, total_votes double")


def row(county, year, dem, rep):
    return county, "gov", year, float(dem), float(rep), 0.0, 100.0 * (rep - dem) / (dem + rep) if dem + rep else 0.0, "DEM" if dem > rep else "REP" if rep > dem else "TIE", float(dem + rep)


def test_flips_and_growth_need_an_earlier_cycle(spark):
    df = margins(spark, [row("a", 2016, 60, 40), row("a", 2020, 40, 60), row("b", 2020, 50, 50)])
    got = {(r.county, r.year): (r["shift"], r.flipped) for r in Y.flips(df).collect()}
    assert got == {("a", 2016): (None, False), ("a", 2020): (40.0, True), ("b", 2020): (None, False)}
    assert {(r.county, r.year): r.dem_growth for r in Y.growth(df).collect()} == {("a", 2016): None, ("a", 2020): -20.0, ("b", 2020): None}
    assert Y.flips(df.where("false")).count() == 0


def test_swing_stays_within_the_votes(spark):
    df = margins(spark, [row("a", 2020, 95, 5), row("z", 2020, 0, 0)])
    got = {r.county: (r.dem_votes, r.rep_votes, r.winner) for r in Y.swing(df, 20.0).collect()}
    assert got == {"a": (100.0, 0.0, "DEM"), "z": (0.0, 0.0, "TIE")}
    assert {r.county: r.dem_votes for r in Y.swing(df, -100.0).collect()} == {"a": 0.0, "z": 0.0}


def test_recounts_intensity_and_contested(spark):
    df = margins(spark, [row("a", 2020, 500, 502), row("b", 2020, 0, 0), row("c", 2020, 50, 70), row("d", 2018, 0, 9)])
    assert [r.county for r in Y.recounts(df).collect()] == ["a"]
    assert {r.county: r.intensity for r in Y.turnout_intensity(df, ["year"]).collect()} == {"a": 1.0, "b": 0.0, "c": pytest.approx(120 / 1002, abs=1e-6), "d": 1.0}
    assert sorted(r.county for r in Y.contested(df, ["office", "year"]).collect()) == ["a", "b", "c"]


def test_split_ticket_needs_both_contests(spark):
    df = margins(spark, [row("a", 2020, 60, 40), ("a", "pres", 2020, 40.0, 60.0, 0.0, 20.0, "REP", 100.0), row("b", 2020, 1, 2)])
    got = Y.split_ticket(df, "pres", "gov").collect()
    assert [(r.county, r.gap, r.split) for r in got] == [("a", 40.0, True)]


def test_rollups_keep_ties_and_empty_contests(spark):
    df = margins(spark, [row("a", 2020, 10, 10), row("b", 2020, 0, 0)])
    got = {r.county: (r.margin_pct, r.winner) for r in Y.rollup(df, ["county"]).collect()}
    assert got == {"a": (0.0, "TIE"), "b": (0.0, "TIE")}
    regions = spark.createDataFrame([("a", "East"), ("a", "Coast")], "county string, region string")
    assert {r.region for r in Y.region_rollup(df, regions).collect()} == {"East", "Coast", None}


def test_top_lists_break_ties_by_county(spark):
    df = margins(spark, [row(c, y, 50, 50) for c in "cab" for y in (2012, 2016, 2020)])
    assert [r.county for r in Y.barometer(df, k=2).orderBy("county").collect()] == ["a", "b"]
    assert {(r.county, r.year) for r in Y.realignment(df, k=1).collect()} == {("a", 2016), ("a", 2020)}


def test_labels_of_a_single_cycle(spark):
    df = margins(spark, [row("a", 2020, 50, 50), row("b", 2020, 30, 70)])
    assert {r.county: r.status for r in Y.trajectory(df).collect()} == {"a": "Battleground", "b": "Durable Republican Stronghold"}
    assert {r.county: (r.momentum, r.subtype) for r in Y.momentum(df).collect()} == {"a": ("Stable", "Stable / Mixed"), "b": ("Stable", "Stable / Mixed")}
    assert {r.county: r.confidence for r in Y.confidence(df).collect()} == {"a": "Low", "b": "High"}


def test_modelled_contest_without_two_party_votes(spark):
    df = margins(spark, [row("a", 2020, 60, 40), row("a", 2016, 50, 50), row("z", 2020, 0, 0), row("z", 2016, 0, 0), row("y", 2020, 0, 0), row("y", 2016, 9, 1), row("once", 2020, 1, 1)])
    model = lambda need_both: {r.county: (r.dem_votes, r.rep_votes) for r in Y.modeled_contest(df, (2020, "gov"), (2016, "gov"), turnout=1.0, need_both=need_both).collect()}
    assert model(True) == {"a": (55.0, 45.0)}
    assert model(False) == {"a": (55.0, 45.0), "y": (0.0, 10.0), "z": (0.0, 0.0)}


def test_ghosts_and_series(spark):
    keys = spark.createDataFrame([("A - 1",), ("A - 1",), ("A - 2",), (None,)], "precinct_id string")
    shapes = spark.createDataFrame([("A - 1",), ("A - 1",)], "precinct_id string")
    assert {r.precinct_id for r in Y.ghosts(keys, shapes).collect()} == {"A - 2", None}
    county = margins(spark, [row("A", 2016, 1, 2), row("A", 2020, 2, 1)])
    own = county.where("year = 2020").withColumn("precinct_id", F.lit("A - 1"))
    names = spark.createDataFrame([("A", "A - 1"), ("A", "A - 2")], "county string, precinct_id string")
    assert {(r.precinct_id, r.level, len(r.series)) for r in Y.trend_series(county, own, names).collect()} == {("A - 1", "precinct", 1), ("A - 2", "county", 2)}


def test_demographics(spark):
    blocks = spark.createDataFrame([("p", 10, 4, None), ("p", 10, 5, None), ("q", 0, 0, None)], "precinct_id string, vap int, white int, black int")
    got = {r.precinct_id: (r.white_pct, r.black_pct) for r in P.precinct_demographics(blocks, ["white", "black"]).collect()}
    assert got == {"p": (45.0, None), "q": (0.0, None)}
    people = spark.createDataFrame([("k", 9.0, 3.0)], "key string, vap double, white double")
    cross = spark.createDataFrame([("k", "1", 0.5)], "key string, district string, area_weight double")
    labels = spark.createDataFrame([("1",), ("2",)], "district string")
    assert {r.district: r.total_population for r in P.district_demographics(people, cross, labels, ["white"]).collect()} == {"1": 4, "2": 0}
    shares = spark.createDataFrame([(50.0, 49.5), (60.0, 30.0), (0.0, 0.0), (None, None), (None, 3.0)], "white_pct double, black_pct double")
    assert [r.plurality for r in P.plurality_group(shares, ["white", "black"]).collect()] == ["mixed", "white", "no data", "no data", "black"]


def test_reports_of_nothing_and_of_ties(spark):
    keys = spark.createDataFrame([(2020, "b", "unmatched"), (2020, "a", "unmatched"), (2020, "a", "matched")], "year int, key string, status string")
    assert [r.key for r in Q.unmatched_examples(keys, 1).collect()] == ["a"]
    assert Q.unmatched_summary(keys).first().total == 3 and Q.unmatched_summary(keys.where("false")).count() == 0
    rates = spark.createDataFrame([(2020, "A", False, True)], "year int, county string, matched boolean, non_geo boolean")
    assert {r.total_geo for r in Q.match_rates(rates).collect()} == {0}
    assert Q.dataset_profile(keys.where("false"), "key").count() == 0


def test_a_folder_of_slices_is_recounted(spark, tmp_path):
    (tmp_path / "state_house_us_senate_2020.json").write_text('{"general": {"results": {"1": {"dem_votes": 1}, "2": {"dem_votes": 2}}}}')
    (tmp_path / "state_house_governor_2020.json").write_text('{"general": {"results": {"1": ')
    (tmp_path / "state_house_auditor_2020.json").write_text("")
    (tmp_path / "notes.json").write_text('{"general": {"results": {"1": {"dem_votes": 1}}}}')
    got = {(r.scope, r.contest_type, r.year): r.districts for r in S.rebuild_manifest(spark, str(tmp_path)).collect()}
    assert got[("state_house", "us_senate", 2020)] == 2 and got[("state_house", "governor", 2020)] == 0
    assert got.get(("state_house", "auditor", 2020), 0) == 0 and len(got) in (2, 3)


@pytest.mark.parametrize("label,full,lines", [("OS", True, True), ("OS-1", True, True), ("OSX", True, False), ("A OS B", True, True), ("MOSS", False, False), ("ONESTOP", True, False), ("ONESTOP 3", True, True), ("ONESTOPX", False, False), ("XONESTOP", False, False), ("EVX", True, False), ("EV", False, False), ("EVX-", False, False), ("EV 1", True, True), ("EV_1", True, True), ("A EV B", True, True), ("A EV", False, False), ("", False, False), ("NEVER", False, False)])
def test_one_stop_and_early_sites(spark, label, full, lines):
    df = spark.createDataFrame([(label,)], "p string")
    got = df.select(K.is_non_geographic(F.col("p")).alias("full"), K.is_non_geographic(F.col("p"), None, "lines").alias("lines")).first()
    assert (got.full, got.lines) == (full, lines)


@pytest.mark.parametrize("office,key", [
    ("SUPREME COURT ASSOCIATE JUSTICE (EDMUNDS-HILL SEAT)", "nc_supreme_court_associate_justice_edmunds_hill_seat"), ("COURT OF APPEALS JUDGE - TYSON SEAT", "nc_court_of_appeals_judge_tyson_seat"),
    ("COURT OF APPEALS JUDGE-TYSON SEAT", "nc_court_of_appeals_judge_tyson_seat"), ("NC COURT OF APPEALS JUDGE (DAVIS)", "nc_court_of_appeals_judge_davis_seat"),
    ("COURT OF APPEALS JUDGE (DAVIS)", None), ("COURT OF APPEALS JUDGE - SEAT", None), ("NC COURT OF APPEALS JUDGE ()", None), ("NC COURT OF APPEALS JUDGE SEAT 03 (VOTE FOR 1)", "nc_court_of_appeals_judge_seat_03"), (None, None), ("", None),
])
def test_court_seats(spark, office, key):
    assert spark.createDataFrame([(office,)], "o string").select(K.office_key(F.col("o"))).first()[0] == key


def test_compat_rounding_rounds_parts(spark):
    pool = spark.createDataFrame([(2020, "gov", "A", 1.0, 0.0, 0.0)], f"year int, office string, county string, {VOTES}")
    shares = spark.createDataFrame([("A", "house", "1", 0.4), ("A", "house", "2", 0.6)], "county string, scope string, district string, share double")
    districts = spark.createDataFrame([(2020, "gov", "house", "1", 2.4, 0.0, 0.0), (2020, "gov", "house", "3", 0.5, 1.5, 0.0)], f"year int, office string, scope string, district string, {VOTES}")
    got = lambda compat: {r.district: (r.dem_votes, r.rep_votes) for r in R.add_county_pool(districts, pool, shares, compat_rounding=compat).collect()}
    assert got(True) == {"1": (2.0, 0.0), "2": (1.0, 0.0), "3": (0.0, 2.0)}
    assert got(False)["1"] == (pytest.approx(2.8), 0.0)


def test_shown_status(spark):
    rows = spark.createDataFrame([("Durable", "Democratic", "Edge"), ("Realigned", "Republican", "Battleground"), ("Odd", "Republican", "Tilt")], "origin string, side string, position string")
    assert [r.shown for r in Y.shown_status(rows).collect()] == ["Stable Democratic (Edge)", "Battleground", "Odd Republican (Tilt)"]
    assert [r.shown for r in Y.shown_status(rows, {}).collect()][0] == "Durable Democratic (Edge)"
