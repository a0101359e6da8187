"""Shapes of parts and holes against plain loops: random polygons, any depth of coordinates, split files, skewed points."""

import json
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from votealloc.operators import geometry as G
from votealloc.sources import readers as S

PARTS = "parts array<array<array<struct<x:double,y:double>>>>"


def star(rng, cx, cy, least, most, n=None):
    turns = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n or rng.randint(5, 14)))
    return [(cx + (r := rng.uniform(least, most)) * math.cos(t), cy + r * math.sin(t)) for t in turns]


def round_ring(rng, cx, cy, radius, n, dent=0.2):
    """A ring around (cx, cy) whose radius stays between 1 - dent and 1 times radius: a hole of less than (1 - 2 dent) lies within."""
    return [(cx + (r := radius * rng.uniform(1 - dent, 1)) * math.cos(2 * math.pi * k / n), cy + r * math.sin(2 * math.pi * k / n)) for k in range(n)]


def shapes(rng, n):
    """Shapes of one to three parts, far from each other, with up to a hole each, in either direction."""
    out = []
    for i in range(n):
        parts = []
        for k in range(rng.randint(1, 3)):
            cx, cy, radius = rng.uniform(0, 10) + 12 * k, rng.uniform(0, 10), rng.uniform(0.3, 4)
            rings = [round_ring(rng, cx, cy, radius, rng.randint(12, 40))]
            if rng.random() < 0.7:
                rings.append(round_ring(rng, cx, cy, radius * 0.5, rng.randint(9, 20)))
            parts.append([ring if rng.random() < 0.5 else ring[::-1] for ring in rings])
        out.append((f"D{i:02d}", parts))
    return out


def turns_in(x, y, ring):
    inside = False
    for (px, py), (qx, qy) in zip(ring, ring[1:] + ring[:1], strict=True):
        if (py > y) != (qy > y) and x < px + (y - py) * (qx - px) / (qy - py):
            inside = not inside
    return inside


def holds(parts, x, y):
    return any(turns_in(x, y, part[0]) and not any(turns_in(x, y, hole) for hole in part[1:]) for part in parts)


def plain_area(ring):
    return abs(sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(ring, ring[1:] + ring[:1], strict=True))) / 2


@pytest.mark.parametrize(("cell", "levels", "most"), [(0.1, 3, 65_536), (0.5, 4, 5), (3.0, 1, 65_536), (0.02, 5, 65_536)])
def test_points_in_parts_and_holes(spark, cell, levels, most):
    rng = random.Random(levels)
    districts = shapes(rng, 12)
    points = [(i, rng.uniform(-6, 45), rng.uniform(-6, 16)) for i in range(1500)] + [(5000 + i, 5.0 + i * 1e-5, 5.0) for i in range(40)] + [(9000, None, 1.0), (9001, 1.0, None)]
    table = spark.createDataFrame([*districts, ("N", None), ("E", []), ("F", [[]])], f"district string, {PARTS}")
    found = G.points_in_districts(spark.createDataFrame(points, "id long, x double, y double"), table, cell, levels, most).collect()
    want = {i: None if x is None or y is None else min((d for d, parts in districts if holds(parts, x, y)), default=None) for i, x, y in points}
    assert {r.id: r.district for r in found} == want and len(found) == len(points)
    assert sum(d is not None for d in want.values()) > 150


def test_a_large_district_is_few_cells(spark):
    side = [(0.0, 0.0), (640.0, 0.0), (640.0, 640.0), (0.0, 640.0)]
    outline = [(a[0] + (b[0] - a[0]) * k / 50, a[1] + (b[1] - a[1]) * k / 50) for a, b in zip(side, side[1:] + side[:1], strict=True) for k in range(50)]
    cells = G.district_cells(spark.createDataFrame([("D", [[outline]])], f"district string, {PARTS}"), 1.0, 4)
    flat = 640 * 640
    assert cells.count() < flat / 20
    inside = cells.where("edges is null")
    assert inside.select(F.sum(F.pow(F.lit(4.0), 2 * (3 - F.col("level"))))).first()[0] > 0.9 * flat - 4 * 640 * 64


def test_hot_cells_are_dealt(spark):
    """10,000 points of one cell are tested by copies of it, 100 on average each."""
    square = [[(0.0, 0.0), (8.0, 0.0), (8.0, 8.0), (0.0, 8.0)]]
    points = spark.range(10_000).select("id", (F.rand(1) * 0.01 + 7.99).alias("x"), F.lit(4.0).alias("y"))
    found = G.points_in_districts(points, spark.createDataFrame([("D", [square])], f"district string, {PARTS}"), 1.0, 2, 100)
    assert found.where("district = 'D'").count() == 10_000
    plan = found._jdf.queryExecution().analyzed().toString()
    assert "copies" in plan


def overlaid(spark, first, second, cell=1.5):
    a, b = spark.createDataFrame(first, f"id string, {PARTS}"), spark.createDataFrame(second, f"district string, {PARTS}")
    return {(r.id, r.district): r.area for r in G.overlay(a, b, ["id"], cell).collect()}


def test_shape_area(spark):
    rng = random.Random(3)
    rows = [*shapes(rng, 20), ("N", None), ("E", []), ("F", [[]]), ("L", [[[(0.0, 0.0), (1.0, 1.0)]]])]
    got = {r.district: r.a for r in spark.createDataFrame(rows, f"district string, {PARTS}").select("district", G.shape_area(F.col("parts")).alias("a")).collect()}
    for name, parts in rows:
        assert got[name] == pytest.approx(sum(plain_area(p[0]) - sum(map(plain_area, p[1:])) for p in parts or [] if p and len(p[0]) > 2))


def test_overlay_of_parts_and_holes(spark):
    """Squares tile the plane, so a shape's pieces add up to it; each piece agrees with a fine raster of points."""
    rng = random.Random(6)
    first = shapes(rng, 6)
    tiles = [(f"{x},{y}", [[[(x * 3.0, y * 3.0), (x * 3.0 + 3, y * 3.0), (x * 3.0 + 3, y * 3.0 + 3), (x * 3.0, y * 3.0 + 3)]]]) for x in range(-2, 14) for y in range(-2, 6)]
    got = overlaid(spark, first, tiles)
    for name, parts in first:
        assert sum(v for (i, _), v in got.items() if i == name) == pytest.approx(sum(plain_area(p[0]) - sum(map(plain_area, p[1:])) for p in parts), rel=1e-9)
    second = [(f"E{i}", parts) for i, (_, parts) in enumerate(shapes(rng, 4))]
    both, n = overlaid(spark, first, second), 60
    checked = 0
    for name, parts in first:
        for other, more in second:
            dots = sum(holds(parts, -5 + (x + 0.5) / 6, -5 + (y + 0.5) / 6) and holds(more, -5 + (x + 0.5) / 6, -5 + (y + 0.5) / 6) for x in range(6 * 48) for y in range(n * 2))
            assert both.get((name, other), 0.0) == pytest.approx(dots / 36, abs=0.6)
            checked += dots > 50
    assert checked > 3
    assert {k[::-1]: pytest.approx(v) for k, v in overlaid(spark, second, first).items()} == both


def test_overlay_counts_repeated_rows_and_skips_what_has_no_area(spark):
    ring = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)]
    hole = [(0.5, 0.5), (1.5, 0.5), (1.5, 1.5), (0.5, 1.5)]
    got = overlaid(spark, [("a", [[ring, hole]]), ("a", [[ring, hole]]), ("b", None), ("c", []), ("d", [[]]), ("e", [[hole]])], [("s", [[ring]]), ("s", [[ring]]), ("t", [[ring, hole]])])
    assert got == pytest.approx({("a", "s"): 12.0, ("a", "t"): 6.0, ("e", "s"): 2.0})


def test_overlay_of_long_outlines(spark):
    """Two outlines of 10,000 points: their edges' product would be 10**8 rows."""
    rng = random.Random(2)
    a, b = round_ring(rng, 0, 0, 5, 10_000, 0.02), round_ring(rng, 1, 1, 5, 10_000, 0.02)
    both = overlaid(spark, [("a", [[a]])], [("b", [[b]])], 20.0)[("a", "b")]
    around = [("n", [[[(-50.0, -50.0), (50.0, -50.0), (50.0, 50.0), (-50.0, 50.0)], b]])]
    assert both + overlaid(spark, [("a", [[a]])], around, 200.0)[("a", "n")] == pytest.approx(plain_area(a), rel=1e-9)


def test_overlay_is_the_same_in_rows_and_by_columns(spark):
    rng = random.Random(11)
    first, second = shapes(rng, 8), shapes(rng, 8)
    a, b = spark.createDataFrame([*first, *first[:2]], f"id string, {PARTS}"), spark.createDataFrame(second, f"district string, {PARTS}")
    by_columns, mixed, in_rows = ({(r.id, r.district): r.area for r in G.overlay(a, b, ["id"], 1.5, few).collect()} for few in (0, 18, 1000))
    assert len(by_columns) > 5
    assert mixed == pytest.approx(by_columns) and in_rows == pytest.approx(by_columns)


def noise(rng):
    return "".join(rng.choice(["a", '"', "\\", "{", "}", "é", "[", "]", ":", ",", "\n", "Feature", '"x": {']) for _ in range(rng.randint(0, 12)))


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "6000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1000")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def tuples(v):
    return tuple(map(tuples, v)) if isinstance(v, list | tuple) else v


def test_geojson_of_any_depth_read_in_splits(spark, tmp_path, small_splits):
    rng = random.Random(1)
    features = []
    for i in range(150):
        ring = lambda: [[round(rng.uniform(0, 9), 3), rng.randint(0, 9)] for _ in range(rng.randint(3, 30))]
        kind = rng.choice(["Polygon", "MultiPolygon", "Point", "LineString", "GeometryCollection", None])
        place = {"Polygon": lambda: [ring(), ring()], "MultiPolygon": lambda: [[ring()], [ring(), ring()]], "Point": lambda: [1.5, 2], "LineString": ring}.get(kind, lambda: None)()
        geometry = kind and {"type": kind, "coordinates": place}
        if kind == "GeometryCollection":
            geometry = {"type": kind, "geometries": [{"type": "Point", "coordinates": [7, 8]}, {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1]]]}]}
        feature = {"type": "Feature", "properties": {"id": i, "name": noise(rng), "sub": {"k": noise(rng)}}, "geometry": geometry}
        features.append(dict(reversed(feature.items())) if i % 3 == 0 else feature)
    whole = {"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "x{"}}, "features": features}
    (tmp_path / "a.geojson").write_text(json.dumps(whole, ensure_ascii=False), encoding="utf-8")
    (tmp_path / "b.geojson").write_text(json.dumps({**whole, "features": features[:20]}, indent=1))
    (tmp_path / "c.geojson").write_text(json.dumps({**whole, "features": []}))
    assert spark.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions() > 5

    def read(f):
        g = f["geometry"]
        if g is None:
            return None, None, None
        if g["type"] == "GeometryCollection":
            return g["type"], ((((0.0, 0.0), (1.0, 0.0), (1.0, 1.0)),),), ((7.0, 8.0), (0.0, 0.0), (1.0, 0.0), (1.0, 1.0))
        pair = lambda c: tuple((float(x), float(y)) for x, y in c)
        if g["type"] in ("Point", "LineString"):
            return g["type"], None, pair([g["coordinates"]] if g["type"] == "Point" else g["coordinates"])
        parts = tuple(tuple(pair(r) for r in part) for part in ([g["coordinates"]] if g["type"] == "Polygon" else g["coordinates"]))
        return g["type"], parts, tuple(p for part in parts for r in part for p in r)

    got = S.scan_geojson(spark, str(tmp_path), "id long, name string, sub struct<k: string>").collect()
    want = Counter((f["properties"]["id"], f["properties"]["name"], f["properties"]["sub"]["k"], *read(f)) for f in features + features[:20])
    assert Counter((r.id, r.name, r["sub"].k, r["shape"], tuples(r.parts), tuples(r.points)) for r in got) == want


def test_nested_results_read_in_splits(spark, tmp_path, small_splits):
    rng = random.Random(4)
    decoy = {"dem_votes": 9, "rep_votes": 9}
    years = {str(y): {f'off"{o}': {"general": {"meta": {"x": decoy}, "results": {f'C{{ - {k} é"': {"dem_votes": k, "rep_votes": o, "dem_candidate": noise(rng)} for k in range(30)}}} for o in range(4)} for y in (2000, 2004)}
    (tmp_path / "a.json").write_text(json.dumps({"meta": {"a": {"b": {"c": {"d": {"e": decoy}}}}}, "results_by_year": years}))
    got = S.scan_nested_results(spark, str(tmp_path)).collect()
    want = Counter((int(y), o, k, *v.values()) for y, offices in years.items() for o, body in offices.items() for k, v in body["general"]["results"].items())
    assert Counter((r.year, r.office, r.key, r.dem_votes, r.rep_votes, r.dem_candidate) for r in got) == want
