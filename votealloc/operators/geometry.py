"""Areas, points and overlays as Columns and equi-joins.

A ring is an array of (x, y). A shape is an array of parts, a part an array of rings: its outline,
then its holes. Tables have a shape in `parts`, or one ring in `ring`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from votealloc.functions.keys import district_label, pad
from votealloc.operators.aggregate import renormalize, share_of_group


def shape_of(rows: DataFrame) -> Column:
    """The shapes of a table: its parts, or its rings as parts without holes."""
    return F.col("parts") if "parts" in rows.columns else F.when(F.col("ring").isNotNull(), F.array(F.array("ring")))


def points_of(parts: Column) -> Column:
    """All points of a shape, for its box."""
    return F.flatten(F.flatten(parts))


def bbox_point(ring: Column, digits: int = 6) -> Column:
    """The middle of the bounding box of a ring, or of any array of points; nulls where there is no point."""
    def mid(axis: str) -> Column:
        values = F.transform(ring, lambda p: p[axis])
        return F.round((F.array_min(values) + F.array_max(values)) / 2, digits)

    return F.struct(mid("x").alias("x"), mid("y").alias("y"))


def _edges(ring: Column) -> Column:
    """Each point with the next; the last with the first."""
    following = F.concat(F.slice(ring, F.lit(2), F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    return F.arrays_zip(ring.alias("p"), following.alias("q"))


def _turn(ring: Column) -> Column:
    """Twice the area of a simple polygon (shoelace), negative if its points go clockwise."""
    return F.aggregate(_edges(ring), F.lit(0.0), lambda s, e: s + e["p"]["x"] * e["q"]["y"] - e["q"]["x"] * e["p"]["y"])


def ring_area(ring: Column) -> Column:
    """Area of a simple polygon; 0 for fewer than three points."""
    return F.when(F.size(ring) >= 3, F.abs(_turn(ring)) / 2).otherwise(0.0)


def shape_area(parts: Column) -> Column:
    """Area of a shape: that of each part's outline less that of its holes; 0 for null."""
    def whole(part: Column) -> Column:
        return 2 * ring_area(F.get(part, 0)) - F.aggregate(part, F.lit(0.0), lambda s, ring: s + ring_area(ring))

    return F.coalesce(F.aggregate(parts, F.lit(0.0), lambda s, part: s + F.when(F.size(part) > 0, whole(part)).otherwise(0.0)), F.lit(0.0))


#: The equal-area conic projection of the conterminous United States (EPSG 5070, GRS 80).
ALBERS = {"a": 6378137.0, "f": 1 / 298.257222101, "lat0": 23.0, "lon0": -96.0, "lat1": 29.5, "lat2": 45.5}


def albers(lon: Column, lat: Column) -> Column:
    """Longitude and latitude in degrees as metres (x, y) of an equal-area map."""
    a, e2 = ALBERS["a"], ALBERS["f"] * (2 - ALBERS["f"])
    e = math.sqrt(e2)

    def q(s, log):
        return (1 - e2) * (s / (1 - e2 * s * s) - log((1 - e * s) / (1 + e * s)) / (2 * e))

    s0, s1, s2 = (math.sin(math.radians(ALBERS[k])) for k in ("lat0", "lat1", "lat2"))
    m1, m2 = (math.sqrt(1 - s * s) / math.sqrt(1 - e2 * s * s) for s in (s1, s2))
    n = (m1 * m1 - m2 * m2) / (q(s2, math.log) - q(s1, math.log))
    c = m1 * m1 + n * q(s1, math.log)
    rho0 = a * math.sqrt(c - n * q(s0, math.log)) / n
    rho = F.sqrt(F.lit(c) - n * q(F.sin(F.radians(lat)), F.ln)) * a / n
    theta = F.radians(lon - ALBERS["lon0"]) * n
    return F.struct((rho * F.sin(theta)).alias("x"), (F.lit(rho0) - rho * F.cos(theta)).alias("y"))


def in_edges(x: Column, y: Column, edges: Column) -> Column:
    """Is a point inside what the edges enclose, holes left out? Counts those that a ray to the right crosses; low and left borders are inside."""
    def crosses(e: Column) -> Column:
        p, q = e["p"], e["q"]
        at = p["x"] + (y - p["y"]) * F.try_divide(q["x"] - p["x"], q["y"] - p["y"])
        return F.coalesce(((p["y"] > y) != (q["y"] > y)) & (x < at), F.lit(False))

    return F.aggregate(edges, F.lit(0), lambda n, e: n + crosses(e).cast("int")) % 2 == 1


def in_ring(x: Column, y: Column, ring: Column) -> Column:
    return in_edges(x, y, _edges(ring))


def in_shape(x: Column, y: Column, parts: Column) -> Column:
    """Is a point in one of a shape's parts and in none of its holes?"""
    return in_edges(x, y, F.flatten(F.transform(F.flatten(parts), _edges)))


#: Cells of one level are cut in so many, as a power of two, along x and along y for the next.
FACTOR_BITS = 2
#: A border cell that so few edges matter to isn't cut further.
FEW_EDGES = 24
#: Points of one cell that one task tests at most, on average of the parts that they are dealt to.
POINTS_A_PART = 65_536


def district_cells(districts: DataFrame, cell: float, levels: int = 3) -> DataFrame:
    """(district, level, cx, cy, edges): cells that cover each district's shape; edges are null where the cell lies inside.

    Cells of level 0 are the largest, those of the last `cell` wide. A cell without an edge is
    inside or goes, so a large district is few large cells and a seam of small ones. A border
    cell keeps the edges that a ray to the right from a point in it can cross. It is a chain of
    projections: nothing is shuffled.
    """
    edges = F.flatten(F.transform(F.flatten(shape_of(districts)), _edges))
    rows = districts.select("district", edges.alias("edges")).where(F.size("edges") > 0)
    top = cell * (1 << FACTOR_BITS * (levels - 1))
    for axis in "xy":
        values = F.transform("edges", lambda e: e["p"][axis])  # noqa: B023
        rows = rows.withColumn(f"c{axis}", F.explode(F.sequence(F.floor(F.array_min(values) / top), F.floor(F.array_max(values) / top))))
    rows = rows.withColumn("level", F.lit(0))
    for level in range(levels):
        width = cell * (1 << FACTOR_BITS * (levels - 1 - level))
        if level:
            steps = range(1 << FACTOR_BITS)
            child = lambda i, j: F.struct((F.col("level") + 1).alias("level"), (F.shiftleft("cx", FACTOR_BITS) + i).alias("cx"), (F.shiftleft("cy", FACTOR_BITS) + j).alias("cy"))
            goes_on = F.col("edges").isNotNull() & (F.size("edges") > FEW_EDGES)
            cells = F.when(goes_on, F.array(*[child(i, j) for i in steps for j in steps])).otherwise(F.array(F.struct("level", "cx", "cy")))
            rows = rows.select("district", "edges", F.explode(cells).alias("c")).select("district", "edges", "c.*")
        # A hair more than the cell, for points whose cell a rounding decides.
        left, low, right, high = (F.col(c) * width + shift for c, shift in (("cx", -1e-9 * width), ("cy", -1e-9 * width), ("cx", (1 + 1e-9) * width), ("cy", (1 + 1e-9) * width)))
        current = (F.col("level") == level) & F.col("edges").isNotNull()
        near = F.filter("edges", lambda e: (F.greatest(e["p"]["y"], e["q"]["y"]) >= low) & (F.least(e["p"]["y"], e["q"]["y"]) <= high) & (F.greatest(e["p"]["x"], e["q"]["x"]) >= left))
        rows = rows.withColumns({"current": current, "edges": F.when(current, near).otherwise(F.col("edges"))})
        border = F.exists("edges", lambda e: F.least(e["p"]["x"], e["q"]["x"]) <= right)
        inside = in_edges((F.col("cx") + 0.5) * width, (F.col("cy") + 0.5) * width, F.col("edges"))
        rows = rows.withColumn("border", border).where(~F.col("current") | F.col("border") | inside)
        rows = rows.withColumn("edges", F.when(~F.col("current") | F.col("border"), F.col("edges"))).drop("current", "border")
    return rows


def points_in_districts(points: DataFrame, districts: DataFrame, cell: float, levels: int = 3, most: int = POINTS_A_PART) -> DataFrame:
    """points (id, x, y) with the district (district, parts or ring) that holds each; null outside all.

    Points meet the cells of district_cells by their own cell at each level; only in border
    cells do edges decide. A cell with more than `most` points is copied and its points are
    dealt to the copies by a hash of their id (no cell has, where there are no more in all). Pick cell so that a district covers some hundreds
    of the smallest. On a shared border the first district wins; a point in a hole is in no district.
    Points with a null coordinate and shapes that are null or have no edges meet nothing.
    """
    keys = ["level", "cx", "cy"]
    at = {axis: F.floor(F.col(axis) / cell).cast("long") for axis in "xy"}
    up = [F.struct(F.lit(k).alias("level"), *[F.shiftright(at[axis], FACTOR_BITS * (levels - 1 - k)).alias(f"c{axis}") for axis in "xy"]) for k in range(levels)]
    placed = points.where("x is not null and y is not null").select("id", "x", "y", F.explode(F.array(*up)).alias("c")).select("id", "x", "y", "c.*")
    cells = district_cells(districts, cell, levels)
    if points.select("id").limit(most + 1).count() > most:
        hot = placed.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > most).select(*keys, F.ceil(F.col("n") / most).alias("copies"))
        cells = cells.join(hot, keys, "left").withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("copies", F.lit(1)) - 1))).drop("copies")
        placed = placed.join(hot, keys, "left").withColumn("copy", F.pmod(F.xxhash64("id"), F.coalesce("copies", F.lit(1)))).drop("copies")
        keys = [*keys, "copy"]
    hits = placed.join(cells, keys).where(F.col("edges").isNull() | in_edges(F.col("x"), F.col("y"), F.col("edges")))
    return points.join(hits.groupBy("id").agg(F.min("district").alias("district")), "id", "left")


def _sides(ring: Column) -> Column:
    """Edges that aren't upright: their ends in x, y at the left end, slope, and 1 or -1 for the direction."""
    def side(e: Column) -> Column:
        p, q = e["p"], e["q"]
        slope = F.try_divide(q["y"] - p["y"], q["x"] - p["x"])
        return F.struct(F.least(p["x"], q["x"]).alias("left"), F.greatest(p["x"], q["x"]).alias("right"), F.when(p["x"] < q["x"], p["y"]).otherwise(q["y"]).alias("y"), slope.alias("slope"), F.signum(q["x"] - p["x"]).alias("way"))

    return F.transform(F.filter(_edges(ring), lambda e: e["p"]["x"] != e["q"]["x"]), side)


#: A ring of so few points meets another edge by edge in the pair's own row.
FEW_POINTS = 16


def overlay(first: DataFrame, second: DataFrame, keys: list[str], cell: float, few: int = FEW_POINTS) -> DataFrame:
    """(keys, district, area): the exact common areas of shapes first (keys, parts or ring) and second (district, parts or ring).

    A ring is the signed sum of what lies under its edges, so the common part of two rings is the
    signed sum, over pairs of their edges, of what lies under both: half of the two areas less
    what lies between the edges; a hole counts against its part. Rings are simple, convex or not,
    closed or open, in either direction; parts of a key in one row or several add up. Null
    shapes and rings of fewer than three points have no area.

    Only rings whose boxes share a cell meet, each pair in one cell (that of the lower left
    corner of their boxes' common part), so nothing is made distinct. Where one ring of a pair has
    few points, its edges meet the other's in the pair's row, without a shuffle. The edges of two
    longer rings are cut to columns of the common part, as many as the ring with fewer edges
    has, and meet by column: work follows edges that lie over each other, not the product of two
    outlines. Pick cell so that the smaller shapes cover a few.
    """
    def placed(rows: DataFrame, names: list[str], side: str) -> DataFrame:
        ends = [pick(F.col("__ring").getField(axis)).alias(f"{side}_{axis}_{name}") for axis in "xy" for name, pick in (("from", F.array_min), ("to", F.array_max))]
        role = F.when(F.col("__ring_no") == 0, 1.0).otherwise(-1.0)
        rows = rows.select(*names, F.struct("__part_no", "__ring_no").alias(f"{side}_no"), role.alias(f"{side}_role"), F.size("__ring").alias(f"{side}_n"), _sides(F.col("__ring")).alias(f"{side}_sides"), _turn(F.col("__ring")).alias(f"{side}_turn"), *ends)
        for axis in "xy":
            rows = rows.withColumn(f"__c{axis}", F.explode(F.sequence(F.floor(F.col(f"{side}_{axis}_from") / cell), F.floor(F.col(f"{side}_{axis}_to") / cell))))
        return rows

    def rings(rows: DataFrame, names: list[str], least: int) -> DataFrame:
        rows = rows.select(*names, F.posexplode(shape_of(rows)).alias("__part_no", "__part")).select(*names, "__part_no", F.posexplode("__part").alias("__ring_no", "__ring"))
        return rows.where(F.size("__ring") >= least)

    def paired(least: int) -> DataFrame:
        """Pairs of rings of at least so many points, with the common part of their boxes."""
        pairs = placed(rings(first, keys, least), keys, "__a").join(placed(rings(second, ["district"], least), ["district"], "__b"), ["__cx", "__cy"])
        for axis in "xy":
            start, end = F.greatest(f"__a_{axis}_from", f"__b_{axis}_from"), F.least(f"__a_{axis}_to", f"__b_{axis}_to")
            pairs = pairs.withColumns({f"__{axis}_from": start, f"__{axis}_to": end}).where((start < end) & (F.floor(start / cell) == F.col(f"__c{axis}")))
        sign = F.signum("__a_turn") * F.signum("__b_turn") * F.col("__a_role") * F.col("__b_role")
        return pairs.withColumns({"__sign": sign, "__floor": F.least("__a_y_from", "__b_y_from"), "__twice": F.least(F.abs("__a_turn"), F.abs("__b_turn"))})

    def inner(side: str) -> Column:
        """A side's edges over the common part."""
        return F.filter(f"{side}_sides", lambda e: (e["left"] < F.col("__x_to")) & (e["right"] > F.col("__x_from")))

    # Edges of a pair's rings that meet, with what piece() needs.
    measured = [*keys, "district", "__sign", "__floor", "__twice", "__low", "__high"]

    def in_rows() -> DataFrame:
        pairs = paired(3).where((F.col("__a_n") <= few) | (F.col("__b_n") <= few)).withColumns({"__low": F.col("__x_from"), "__high": F.col("__x_to")})
        # What two edges have under both is the same either way round: the ring with fewer points comes first, so that few rows carry the other's edges.
        swap = F.col("__a_n") > F.col("__b_n")
        fewer, more = F.when(swap, F.col("__b_sides")).otherwise(F.col("__a_sides")), F.when(swap, inner("__a")).when(F.col("__b_n") > few, inner("__b")).otherwise(F.col("__b_sides"))
        # Outer, and nulls left out: of a plain explode Spark makes a test of the array's size, which is made of every pair before the join's own.
        met = pairs.select(*measured, more.alias("__bs"), F.explode_outer(fewer).alias("__a"))
        return met.select(*measured, "__a", F.explode_outer("__bs").alias("__b")).where("__a is not null and __b is not null")

    # Each side cut to the common part, then to its columns; the cuts of one column meet, of the one ring with the other.
    def by_columns() -> DataFrame:
        columns = F.greatest(F.least(F.size("__a_sides"), F.size("__b_sides")), F.lit(1))
        pairs = paired(max(few + 1, 3)).withColumns({"__columns": columns, "__step": (F.col("__x_to") - F.col("__x_from")) / columns})

        def cut(side: str) -> Column:
            index = lambda x: F.least(F.greatest(F.floor((x - F.col("__x_from")) / F.col("__step")), F.lit(0)), F.col("__columns") - 1)
            return F.transform(inner(side), lambda e: F.struct(F.lit(side == "__a").alias("a"), e.alias("e"), index(e["left"]).alias("from"), index(e["right"]).alias("to")))

        # Repeated rows of a pair fall into one group, in which each edge comes as often as the pair does.
        name = ["__a_no", "__b_no", "__a_role", "__b_role", "__sign", "__floor", "__twice", "__x_from", "__x_to", "__y_from", "__y_to", "__a_turn", "__b_turn", "__step", "__columns"]
        sides = pairs.select(*keys, "district", *name, F.explode(F.concat(cut("__a"), cut("__b"))).alias("__s"))
        sides = sides.select(*keys, "district", *name, "__s.a", "__s.e", F.explode(F.sequence("__s.from", "__s.to")).alias("__column"))
        low, high = F.col("__x_from") + F.col("__column") * F.col("__step"), F.when(F.col("__column") == F.col("__columns") - 1, F.col("__x_to")).otherwise(F.col("__x_from") + (F.col("__column") + 1) * F.col("__step"))
        met = sides.groupBy(*keys, "district", *name, "__column").agg(F.collect_set(F.when(F.col("a"), F.col("e"))).alias("__as"), F.collect_set(F.when(~F.col("a"), F.col("e"))).alias("__bs"), F.count_if("a").alias("__n"))
        times = F.col("__n") / F.size("__as")
        met = met.withColumns({"__low": low, "__high": high, "__sign": F.col("__sign") * times}).select(*measured, "__bs", F.explode("__as").alias("__a"))
        return met.select(*measured, "__a", F.explode("__bs").alias("__b"))

    met = in_rows().unionByName(by_columns())
    met = met.withColumns({"__left": F.greatest("__a.left", "__b.left", "__low"), "__right": F.least("__a.right", "__b.right", "__high")}).where("__left < __right")
    heights = {f"__{s}_{end}": F.col(f"__{s}.y") + F.col(f"__{s}.slope") * (F.col(f"__{end}") - F.col(f"__{s}.left")) - F.col("__floor") for s in "ab" for end in ("left", "right")}
    met = met.withColumns(heights).withColumns({"__gap_left": F.col("__a_left") - F.col("__b_left"), "__gap_right": F.col("__a_right") - F.col("__b_right")})
    apart = F.abs("__gap_left") + F.abs("__gap_right")
    crossed = F.signum("__gap_left") * F.signum("__gap_right") < 0
    between = F.when(crossed, (F.col("__gap_left") * F.col("__gap_left") + F.col("__gap_right") * F.col("__gap_right")) / apart).otherwise(apart)
    both = F.col("__a_left") + F.col("__a_right") + F.col("__b_left") + F.col("__b_right") - between
    piece = F.col("__sign") * F.col("__a.way") * F.col("__b.way") * (F.col("__right") - F.col("__left")) * both / 4
    areas = met.groupBy(*keys, "district").agg(F.sum(piece).alias("area"), F.max("__twice").alias("__twice"))
    # Shapes that only touch have a common area of a rounding error.
    return areas.where("area > 1e-9 * __twice").drop("__twice")


def area_crosswalk(pieces: DataFrame, keys: list[str], area: str = "area", least: float | None = 0.001, scale: bool = True) -> DataFrame:
    """Weights of districts in each key from pieces (keys, district, area) that nest in both, such as blocks.

    Weights are areas over the key's area, cut to [0, 1]; those under least go, the rest is scaled to 1.
    """
    sums = pieces.groupBy(*keys, "district").agg(F.sum(area).alias(area))
    rows = share_of_group(sums, keys, area, "area_weight").where("area_weight is not null")
    rows = rows.withColumn("area_weight", F.least(F.greatest("area_weight", F.lit(0.0)), F.lit(1.0)))
    if least is not None:
        rows = rows.where(F.col("area_weight") >= least)
    return renormalize(rows, keys, "area_weight") if scale else rows


def max_overlap(pieces: DataFrame, keys: list[str], area: str = "area") -> DataFrame:
    """The district with the largest common area of each key; ties: the first name."""
    sums = pieces.groupBy(*keys, "district").agg(F.sum(area).alias(area))
    return sums.groupBy(*keys).agg(F.min_by("district", F.struct(-F.col(area), "district")).alias("district"))


def assign_blocks(points: DataFrame, districts: DataFrame, pieces: DataFrame, cell: float, scope: str) -> DataFrame:
    """Each block (id) in one district: by its point, else by largest overlap; with weight 1 and the district's label."""
    by_point = points_in_districts(points, districts, cell).select("id", "district")
    rest = by_point.where("district is null").select("id").join(max_overlap(pieces, ["id"]), "id")
    rows = by_point.where("district is not null").withColumn("method", F.lit("point")).unionByName(rest.withColumn("method", F.lit("overlap")))
    return rows.withColumns({"area_weight": F.lit(1.0), "district_label": district_label(F.lit(scope), F.col("district"))})


def two_way_share(pieces: DataFrame, source: str, first: str, second: str) -> DataFrame:
    """The share of precinct source that lies in second, of what lies in first or second; null where it lies in neither."""
    rows = pieces.where((F.col("key") == source) & F.col("district").isin(first, second))
    return rows.agg(F.sum(F.when(F.col("district") == second, F.col("area")).otherwise(0.0)).alias("inside"), F.sum("area").alias("both")).select(F.try_divide("inside", "both").alias("share"))


def crosswalk_by_county(crosswalk: DataFrame) -> DataFrame:
    """By county: precincts, districts, precincts in several districts, their percentage; list of districts, largest split weight."""
    each = crosswalk.groupBy("county", "key").agg(F.count_distinct("district").alias("n"), F.max("area_weight").alias("most"))
    whole = each.groupBy("county").agg(F.count("*").alias("precincts"), F.sum((F.col("n") > 1).cast("long")).alias("split_precincts"), F.round(F.min("most"), 6).alias("least_main_weight"))
    lists = crosswalk.groupBy("county").agg(F.count_distinct("district").alias("districts"), F.array_join(F.array_sort(F.collect_set("district")), ", ").alias("district_list"))
    return whole.join(lists, "county").withColumn("split_pct", F.round(100.0 * F.col("split_precincts") / F.col("precincts"), 2))


def relabel_features(features: DataFrame, names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Features (fips, code, name) named COUNTY - code, and how many were fixed or skipped (unknown county)."""
    rows = features.withColumn("fips", pad(F.col("fips").cast("string"), 3)).join(names.select("fips", "county"), "fips", "left")
    rows = rows.withColumn("fixed", F.col("county").isNotNull()).withColumn("name", F.when(F.col("fixed"), F.concat_ws(" - ", F.upper("county"), "code")).otherwise(F.col("name")))
    counts = rows.agg(F.sum(F.col("fixed").cast("long")).alias("fixed"), F.sum((~F.col("fixed")).cast("long")).alias("skipped"))
    return rows.drop("county"), counts
