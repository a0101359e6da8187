"""Modelled contests by precinct, whole votes over large groups, and identities of precincts, against plain loops."""

import math
import random

import pytest
from pyspark.sql import functions as F

from votealloc.operators import analytics as Y
from votealloc.operators.identity import alias_links, identities, with_identity
from votealloc.operators.ranks import apportion, positions
from votealloc.operators.scenarios import fit_odds, modeled_precincts

VOTES = "dem_votes double, rep_votes double, other_votes double"


def test_positions_and_apportion(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["A", "B", None]), i, rng.choice([0.0, 0.5, 1.25, 2.3, 7.9])) for i in range(400)]
    table = spark.createDataFrame(rows, "g string, id int, x double").repartition(7)
    got = {(r.g, r.id): r.position for r in positions(table, ["g"], [F.col("x").desc(), F.col("id")]).collect()}
    for g in ("A", "B", None):
        line = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[2], r[1]))
        assert [got[g, i] for _, i, _ in line] == list(range(len(line)))
    sums = {g: round(sum(x for h, _, x in rows if h == g)) for g in ("A", "B")}
    whole = table.where("g is not null").withColumn("total", F.when(F.col("g") == "A", sums["A"]).otherwise(sums["B"]))
    parts = {r.id: (r.g, r.x, r.n) for r in apportion(whole, ["g"], "x", "total", [F.col("id")], "n").collect()}
    for g in sums:
        assert sum(n for h, _, n in parts.values() if h == g) == sums[g]
    assert all(n - math.floor(x) in (0, 1) for _, x, n in parts.values())
    cut = min((x % 1 for g, x, n in parts.values() if g == "A" and n > x), default=1)
    assert all(n > math.floor(x) for g, x, n in parts.values() if g == "A" and x % 1 > cut)


def fitted(odds, turnout, dem):
    low, high = -80.0, 80.0
    share = lambda k: [t / (1 + math.exp(-(math.log(o) + k))) for o, t in zip(odds, turnout, strict=True)]
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if sum(share(middle)) < dem else (low, middle)
    return share(low)


def test_fit_odds_is_where_proportional_fitting_ends(spark):
    rng = random.Random(3)
    rows, targets = [], []
    for county in "ABCDEF":
        sizes = [float(rng.randint(1, 900)) for _ in range(rng.randint(1, 40))]
        seeds = [rng.choice([1e-6, 1 - 1e-6, rng.random() * 0.98 + 0.01]) for _ in sizes]
        dem = {"A": 0.0, "B": sum(sizes), "C": 1.0, "D": sum(sizes) - 1}.get(county, round(sum(sizes) * rng.random()))
        targets.append((county, float(dem), sum(sizes) - dem))
        rows += [(county, i, s, t) for i, (s, t) in enumerate(zip(seeds, sizes, strict=True))]
    got = {(r.county, r.i): r.dem for r in fit_odds(spark.createDataFrame(rows, "county string, i int, seed double, turnout double"), spark.createDataFrame(targets, "county string, dem double, rep double")).collect()}
    for county, dem, rep in targets:
        own = [r for r in rows if r[0] == county]
        want = [0.0] * len(own) if dem == 0 else [r[3] for r in own] if rep == 0 else fitted([r[2] / (1 - r[2]) for r in own], [r[3] for r in own], dem)
        assert [got[county, r[1]] for r in own] == pytest.approx(want, abs=1e-6)
        assert sum(got[county, r[1]] for r in own) == pytest.approx(dem, abs=1e-6)
    # Scaling to both margins in turn, from the same seeds, comes to the same votes.
    own, (_, dem, rep) = [r for r in rows if r[0] == "E"], targets[4]
    table = [[r[2], 1 - r[2]] for r in own]
    for _ in range(3000):
        for row, r in zip(table, own, strict=True):
            row[:] = [v * r[3] / sum(row) for v in row]
        sums = [sum(c) for c in zip(*table, strict=True)]
        for row in table:
            row[:] = [row[0] * dem / sums[0], row[1] * rep / sums[1]]
    assert [row[0] for row in table] == pytest.approx([got["E", r[1]] for r in own], abs=1e-3)


def test_modeled_precincts_sum_to_their_county(spark):
    rng = random.Random(5)
    precincts = [(year, "gov", county, f"{county} - {k}", float(rng.randint(0, 60)), float(rng.randint(0, 60)), 1.0) for county in "ABC" for k in range(30) for year in (2020, 2024) if rng.random() < 0.9]
    precincts += [(2024, "gov", "R", "R - 1", 0.0, 50.0, 0.0), (2020, "gov", "R", "R - 1", 0.0, 9.0, 0.0), (2024, "gov", "N", "N - 1", 0.0, 0.0, 0.0), (2020, "gov", "N", "N - 1", 3.0, 1.0, 0.0)]
    loose = [(2024, "gov", "A", None, 400.0, 100.0, 0.0), (2024, "gov", "N", None, 5.0, 5.0, 0.0), (2020, "gov", "Only", None, 5.0, 5.0, 0.0)]
    schema = f"year int, office string, county string, precinct_id string, {VOTES}"
    table = spark.createDataFrame(precincts, schema)
    counties = Y.rollup(spark.createDataFrame(precincts + loose, schema), ["year", "office", "county"])
    first, second = (2020, "gov"), (2024, "gov")
    model = {r.county: (r.dem_votes, r.rep_votes) for r in Y.modeled_contest(counties, first, second).collect()}
    got = modeled_precincts(counties, table, first, second).collect()
    assert {r.county for r in got} == {"A", "B", "C", "R"}
    for county in {r.county for r in got}:
        own = [r for r in got if r.county == county]
        assert (sum(r.dem_votes for r in own), sum(r.rep_votes for r in own)) == model[county]
        assert all(r.dem_votes >= 0 and r.rep_votes >= 0 and r.dem_votes % 1 == 0 for r in own)
    assert len(got) == len({p[3] for p in precincts if p[2] != "N"})
    assert modeled_precincts(counties, table.where("false"), first, second).count() == 0


def test_identities_of_chains_stars_and_rings(spark):
    rng = random.Random(7)
    links = [("A", f"c{i:03d}", f"c{i + 1:03d}") for i in range(120)] + [("A", "hub", f"s{i}") for i in range(50)] + [("B", f"r{i}", f"r{(i + 1) % 9}") for i in range(9)]
    links += [("C", f"n{rng.randrange(80)}", f"n{rng.randrange(80)}") for _ in range(60)] + [("D", "same", "same"), ("A", "c000", "c001")]
    rng.shuffle(links)
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for county, a, b in links:
        if a != b:
            x, y = root((county, a)), root((county, b))
            parent[max(x, y)] = min(x, y)
    got = {(r.county, r.name): r.root for r in identities(spark.createDataFrame(links, "county string, a string, b string")).collect()}
    assert got == {x: root(x)[1] for x in list(parent)}
    assert identities(spark.createDataFrame([], "county string, a string, b string")).count() == 0


def test_alias_links_join_spellings_of_one_code(spark):
    names = spark.createDataFrame([("A", "A - 007"), ("A", "A - 7"), ("A", "A - 8"), ("B", "B - 07")], "county string, precinct_id string")
    roots = identities(alias_links(names))
    got = {r.precinct_id: r.root for r in with_identity(names, roots).collect()}
    assert got["A - 007"] == got["A - 7"] and got["A - 8"] == "A - 8" and got["B - 07"] == "B - 07"


def test_series_fall_back_by_contest(spark):
    schema = f"county string, precinct_id string, office string, year int, {VOTES}"
    own = Y.with_margin(spark.createDataFrame([("C", "C - 1", "pres", 2020, 6.0, 4.0, 0.0), ("C", "C - 01", "pres", 2016, 1.0, 3.0, 0.0), ("C", "C - 01", "pres", 2020, 0.0, 10.0, 0.0)], schema))
    county = Y.rollup(spark.createDataFrame([("C", None, o, y, 5.0, 5.0, 0.0) for o in ("pres", "gov") for y in (2016, 2020)], schema), ["county", "office", "year"])
    names = spark.createDataFrame([("C", "C - 1"), ("C", "C - 9")], "county string, precinct_id string")
    flat = lambda df: {(r.precinct_id, r.office): (r.level, [tuple(p) for p in r.series]) for r in df.collect()}
    lone = flat(Y.trend_series(county, own, names))
    assert lone["C - 1", "pres"] == ("precinct", [(2020, -20.0)])
    assert lone["C - 1", "gov"] == ("county", [(2016, 0.0), (2020, 0.0)]) and lone["C - 9", "pres"][0] == "county"
    roots = identities(spark.createDataFrame([("C", "C - 1", "C - 01")], "county string, a string, b string"))
    both = flat(Y.trend_series(county, own, names, roots))
    assert both["C - 1", "pres"] == both["C - 01", "pres"] == ("precinct", [(2016, 50.0), (2020, 40.0)])
    assert both["C - 1", "gov"][0] == both["C - 01", "gov"][0] == "county"
