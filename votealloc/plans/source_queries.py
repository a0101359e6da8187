"""Readers over files that Spark writes from the tables, and predicates that only show in a sink or a plan."""

from __future__ import annotations

from pyspark.sql import functions as F

from votealloc.functions.measures import with_measures
from votealloc.operators import aggregate as A
from votealloc.operators import geometry as G
from votealloc.plans import binding as B
from votealloc.plans.registry import folder, register
from votealloc.plans.report_queries import _points, _rings
from votealloc.plans.report_queries import _SH, _SL, _slices
from votealloc.sources import readers as S
from votealloc.sources import sinks as K
from votealloc.sources import slices as L


_RECT = "rect AS (SELECT upper(n_name) AS district, (n_nationkey % 5)::DOUBLE AS x0, (n_nationkey // 5)::DOUBLE AS y0 FROM nation)"


@register("s1_scan_results_csv", B.oracle(B.RES, select="SELECT county, precinct, office, party, candidate, votes, year FROM res"))
def scan_results_csv(spark, sf_dir):
    path = folder(spark)
    rows = B.results(spark, sf_dir).select("county", "precinct", "office", F.lit("").alias("district"), "party", "candidate", F.col("votes").cast("string").alias("votes"), F.col("year").alias("cycle"))
    rows.write.partitionBy("cycle").csv(path, header=True)
    return S.scan_results_csv(spark, path).drop("district")


_BOARD = "CASE WHEN c_custkey % 3 = 0 THEN 'C' ELSE 'S' END"


@register("s2_scan_board_tsv", f"SELECT n_name AS county, c_mktsegment AS precinct, CAST(c_custkey AS VARCHAR) AS votes FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE {_BOARD} = 'S' AND c_custkey % 2 = 0")
def scan_board_tsv(spark, sf_dir):
    path = folder(spark)
    k = F.col("c_custkey")
    rows = B.table(spark, sf_dir, "customer").join(B.table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    names = ("County", "Precinct", "Contest Type", "Contest Name", "Choice", "Choice Party", "Total Votes", "Election Date")
    values = (F.col("n_name"), F.col("c_mktsegment"), F.expr(_BOARD), F.when(k % 2 == 0, "US SENATE").otherwise("SHERIFF"), F.lit("x"), F.lit("DEM"), k.cast("string"), F.lit("11/03/2020"))
    rows.select(*[v.alias(n) for v, n in zip(values, names, strict=True)]).write.csv(path, sep="\t", header=True)
    found = S.scan_board_tsv(spark, path, ["US SENATE"])
    return found.select(F.col("County").alias("county"), F.col("Precinct").alias("precinct"), F.col("`Total Votes`").alias("votes"))


@register("s4_discover_year_files", "SELECT DISTINCT CAST(1990 + c_nationkey AS INT) AS year, 1 AS files FROM customer")
def discover_year_files(spark, sf_dir):
    root = folder(spark)
    B.table(spark, sf_dir, "customer").select((1990 + F.col("c_nationkey")).cast("int").alias("cycle"), "c_mktsegment").write.partitionBy("cycle").csv(root)
    return S.discover_year_files(spark, root, "*.csv").groupBy("year").agg(F.count("*").cast("int").alias("files"))


@register("s10_scan_block_votes_wide", B.oracle(B.BLK, B.DMAP, select="SELECT scope, sum(vap * 2 // 5)::DOUBLE AS dem_votes, sum(vap // 2)::DOUBLE AS rep_votes FROM blk JOIN dmap USING (block) GROUP BY 1"))
def scan_block_votes_wide(spark, sf_dir):
    from votealloc.operators.allocate import block_file_districts

    path = folder(spark)
    v = F.col("vap")
    B.blocks(spark, sf_dir).select("block", v.alias("E_16_PRES_Total"), F.floor(v * 2 / 5).alias("E_16_PRES_Dem"), F.floor(v / 2).alias("E_16_PRES_Rep"), v.alias("E_20_AUD_Total")).write.csv(path, header=True)
    wide = spark.read.csv(path, header=True)
    return A.sum_by(block_file_districts(wide, B.district_map(spark, sf_dir)), ["scope"], "dem_votes", "rep_votes")


@register("s11_scan_nested_results", B.oracle(B.RES, select="SELECT year, office, county AS key, sum(CASE WHEN party = 'DEM' THEN votes ELSE 0 END)::BIGINT AS dem_votes, sum(CASE WHEN party = 'REP' THEN votes ELSE 0 END)::BIGINT AS rep_votes FROM res GROUP BY 1, 2, 3"))
def scan_nested_results(spark, sf_dir):
    path = folder(spark)
    rows = A.party_columns(B.results(spark, sf_dir), ["year", "office", "county"])
    row = F.struct(F.col("dem_votes").cast("long").alias("dem_votes"), F.col("rep_votes").cast("long").alias("rep_votes"))
    general = F.struct(F.map_from_entries(F.collect_list(F.struct("county", row))).alias("results")).alias("general")
    offices = rows.groupBy("year", "office").agg(general).groupBy("year").agg(F.map_from_entries(F.collect_list(F.struct("office", F.struct("general").alias("body")))).alias("offices"))
    offices.select(F.to_json(F.struct(F.create_map(F.col("year").cast("string"), "offices").alias("results_by_year"))).alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return S.scan_nested_results(spark, path).select("year", "office", "key", "dem_votes", "rep_votes")


@register("s13_scan_geojson_features", "SELECT upper(n_name) AS name, 'Polygon' AS shape, 4 AS corners FROM nation")
def scan_geojson_features(spark, sf_dir):
    path = folder(spark)
    ring = F.transform("ring", lambda p: F.array(p["x"], p["y"]))
    feature = F.struct(F.struct(F.col("district").alias("name")).alias("properties"), F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"))
    _rings(spark, sf_dir).select(F.to_json(F.struct(F.array(feature).alias("features"))).alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    corners = F.size(F.get(F.get("parts", 0), 0))
    return S.scan_geojson(spark, path, "name string").select("name", "shape", corners.alias("corners"))


#: Districts of two parts, a square with a hole and a small rectangle, as signed boxes.
_BOXES = """box AS (
  SELECT district, x0 AS l, x0 + 1 AS r, y0 AS b, y0 + 1 AS t, 1 AS sign FROM rect
  UNION ALL SELECT district, x0 + 0.25, x0 + 0.75, y0 + 0.25, y0 + 0.75, -1 FROM rect
  UNION ALL SELECT district, 5 + x0 * 0.2, 5.2 + x0 * 0.2, y0, y0 + 0.5, 1 FROM rect)"""


def _box(left, right, low, high):
    return F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in ((left, low), (right, low), (right, high), (left, high))])


def _districts(spark, sf_dir):
    k = F.col("n_nationkey")
    x, y = (k % 5).cast("double"), F.floor(k / 5).cast("double")
    outline, hole, island = _box(x, x + 1, y, y + 1), _box(x + 0.25, x + 0.75, y + 0.25, y + 0.75), _box(5 + x * 0.2, 5.2 + x * 0.2, y, y + 0.5)
    return B.table(spark, sf_dir, "nation").select(F.upper("n_name").alias("district"), F.array(F.array(outline, hole), F.array(island)).alias("parts"))


def _written_districts(spark, sf_dir):
    """The districts as one GeoJSON file of MultiPolygons, with a coordinate system beside the features, read by several tasks."""
    path = folder(spark)
    coordinates = F.transform("parts", lambda part: F.transform(part, lambda ring: F.transform(ring, lambda p: F.array(p["x"], p["y"]))))
    geometry = F.struct(F.lit("MultiPolygon").alias("type"), coordinates.alias("coordinates"))
    feature = F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(F.col("district").alias("name")).alias("properties"), geometry.alias("geometry")))
    many = _districts(spark, sf_dir).agg(F.concat(F.lit('{"type":"FeatureCollection","crs":{"type":"name","properties":{"name":"x"}},"features":['), F.array_join(F.collect_list(feature), ","), F.lit("]}")).alias("value"))
    many.write.text(path)
    return S.scan_geojson(spark, path, "name string").withColumnRenamed("name", "district")


@register("s13_scan_geojson_multipart", f"WITH {_RECT}, {_BOXES} SELECT district, 'MultiPolygon' AS shape, 2 AS parts, 1 AS holes, min(l) AS left_end, max(r) AS right_end FROM box GROUP BY 1")
def scan_geojson_multipart(spark, sf_dir):
    rows = _written_districts(spark, sf_dir)
    holes = F.aggregate("parts", F.lit(0), lambda n, part: n + F.size(part) - 1)
    xs = F.transform("points", lambda p: p["x"])
    return rows.select("district", "shape", F.size("parts").alias("parts"), holes.alias("holes"), F.array_min(xs).alias("left_end"), F.array_max(xs).alias("right_end"))


@register("g1_bbox_multipart", f"WITH {_RECT}, {_BOXES} SELECT district, round((min(l) + max(r)) / 2, 6)::DOUBLE AS x, round((min(b) + max(t)) / 2, 6)::DOUBLE AS y FROM box GROUP BY 1")
def bbox_multipart(spark, sf_dir):
    return _written_districts(spark, sf_dir).select("district", G.bbox_point(F.col("points")).alias("p")).select("district", "p.*")


@register("g2_shape_area", f"WITH {_RECT}, {_BOXES} SELECT district, round(sum(sign * (r - l) * (t - b)), 9)::DOUBLE AS area FROM box GROUP BY 1")
def shape_area(spark, sf_dir):
    return _written_districts(spark, sf_dir).select("district", F.round(G.shape_area(F.col("parts")), 9).alias("area"))


_HOLED_PTS = "pts AS (SELECT c_custkey AS id, c_custkey % 611 / 100.0 + 0.005 AS x, c_custkey * 7 % 503 / 100.0 + 0.005 AS y FROM customer), inr AS (SELECT id, min(district) AS district FROM (SELECT id, district FROM pts JOIN box ON x >= l AND x < r AND y >= b AND y < t GROUP BY ALL HAVING sum(sign) = 1) GROUP BY 1)"


@register("g3_point_in_multipart", f"WITH {_RECT}, {_BOXES}, {_HOLED_PTS} SELECT id, district FROM pts LEFT JOIN inr USING (id)")
def point_in_multipart(spark, sf_dir):
    return G.points_in_districts(_points(spark, sf_dir), _districts(spark, sf_dir), 0.05).select("id", "district")


@register("g6_block_assignment_multipart", f"WITH {_RECT}, {_BOXES}, {_HOLED_PTS} SELECT id, coalesce(district, 'ZZ') AS district, CASE WHEN district IS NULL THEN 'overlap' ELSE 'point' END AS method, 1.0 AS area_weight, coalesce(district, 'ZZ') AS district_label FROM pts LEFT JOIN inr USING (id)")
def block_assignment_multipart(spark, sf_dir):
    points = _points(spark, sf_dir)
    pieces = points.select("id", F.lit("ZZ").alias("district"), F.lit(2.0).alias("area")).unionByName(points.select("id", F.lit("AA").alias("district"), F.lit(1.0).alias("area")))
    return G.assign_blocks(points, _districts(spark, sf_dir), pieces, 0.05, "congressional")


@register("j9_spatial_within", f"WITH {_RECT}, pts AS (SELECT c_custkey AS id, c_custkey % 611 / 100.0 + 0.005 AS x, c_custkey * 7 % 503 / 100.0 + 0.005 AS y FROM customer) SELECT district, count(*) AS points FROM pts JOIN rect ON x >= x0 AND x < x0 + 1 AND y >= y0 AND y < y0 + 1 GROUP BY 1")
def spatial_within(spark, sf_dir):
    return G.points_in_districts(_points(spark, sf_dir), _rings(spark, sf_dir), 0.25).where("district is not null").groupBy("district").agg(F.count("*").alias("points"))


#: Precincts as rectangles beside their customer's point, cut by the squares of districts.
_CUT = """prc AS (SELECT c_custkey AS id, c_custkey % 611 / 100.0 + 0.005 AS x, c_custkey * 7 % 503 / 100.0 + 0.005 AS y, 0.3 + c_custkey % 4 / 10.0 AS w FROM customer),
cut AS (SELECT id, district, round((least(x + w, x0 + 1) - greatest(x, x0)) * (least(y + 0.2, y0 + 1) - greatest(y, y0)), 9)::DOUBLE AS area FROM prc JOIN rect ON x < x0 + 1 AND x + w > x0 AND y < y0 + 1 AND y + 0.2 > y0)"""


@register("j10_spatial_overlay", f"WITH {_RECT}, {_CUT} SELECT * FROM cut")
def spatial_overlay(spark, sf_dir):
    width = F.lit(0.3) + F.col("id") % 4 / 10.0
    corner = lambda dx, dy: F.struct((F.col("x") + dx).alias("x"), (F.col("y") + dy).alias("y"))
    # Dealt before their shapes are made: the file has few bytes a row, and so few splits for the work that is done on each.
    precincts = _points(spark, sf_dir).repartition("id").select("id", F.array(corner(0.0, 0.0), corner(width, 0.0), corner(width, 0.2), corner(0.0, 0.2)).alias("ring"))
    return G.overlay(precincts, _rings(spark, sf_dir), ["id"], 0.5).withColumn("area", F.round("area", 9))


#: Precincts with a hole, as signed boxes, over the districts of two parts.
_HOLED_CUT = """prc AS (SELECT c_custkey AS id, c_custkey % 611 / 100.0 + 0.005 AS x, c_custkey * 7 % 503 / 100.0 + 0.005 AS y, 0.3 + c_custkey % 4 / 10.0 AS w FROM customer),
pbox AS (SELECT id, x AS pl, x + w AS pr, y AS pb, y + 0.2 AS pt, 1 AS ps FROM prc UNION ALL SELECT id, x + 0.1, x + 0.2, y + 0.05, y + 0.15, -1 FROM prc),
cut AS (SELECT id, district, round(sum(sign * ps * greatest(least(pr, r) - greatest(pl, l), 0) * greatest(least(pt, t) - greatest(pb, b), 0)), 9)::DOUBLE AS area FROM pbox JOIN box ON pl < r AND pr > l AND pb < t AND pt > b GROUP BY 1, 2)"""


@register("j10_overlay_multipart", f"WITH {_RECT}, {_BOXES}, {_HOLED_CUT} SELECT * FROM cut WHERE area > 0.000001")
def overlay_multipart(spark, sf_dir):
    x, y, width = F.col("x"), F.col("y"), F.lit(0.3) + F.col("id") % 4 / 10.0
    shape = F.array(F.array(_box(x, x + width, y, y + 0.2), _box(x + 0.1, x + 0.2, y + 0.05, y + 0.15)))
    # Dealt as in spatial_overlay.
    found = G.overlay(_points(spark, sf_dir).repartition("id").select("id", shape.alias("parts")), _districts(spark, sf_dir), ["id"], 0.5)
    return found.withColumn("area", F.round("area", 9)).where("area > 0.000001")


@register("g5_overlay_max", f"WITH {_RECT}, {_CUT} SELECT id, min_by(district, struct_pack(a := -round(area, 6), d := district)) AS district FROM cut GROUP BY id")
def overlay_max(spark, sf_dir):
    pieces = spatial_overlay(spark, sf_dir).withColumn("area", F.round("area", 6))
    return G.max_overlap(pieces, ["id"])


@register("g4_overlay_crosswalk", f"WITH {_RECT}, {_CUT} SELECT id, district, round(area / sum(area) OVER (PARTITION BY id), 9) AS area_weight FROM cut")
def overlay_crosswalk(spark, sf_dir):
    return G.area_crosswalk(spatial_overlay(spark, sf_dir), ["id"], least=None).select("id", "district", F.round("area_weight", 9).alias("area_weight"))


@register("t1_order_output", B.oracle(B.BLK, B.DMAP, select="SELECT scope, district, row_number() OVER (PARTITION BY scope ORDER BY CAST(district AS INT)) AS place FROM (SELECT DISTINCT scope, district FROM dmap)"))
def order_output(spark, sf_dir):
    from pyspark.sql import Window

    rows = B.district_map(spark, sf_dir).select("scope", "district").distinct()
    return rows.withColumn("place", F.row_number().over(Window.partitionBy("scope").orderBy(F.col("district").cast("int")))).orderBy("scope", "place")


@register("u4_except_keys", B.oracle(B.RES, B.BLK, select="SELECT county FROM (SELECT DISTINCT county FROM res) EXCEPT SELECT county FROM blk WHERE vap > 9900"))
def except_keys(spark, sf_dir):
    rows = A.require(B.results(spark, sf_dir), "year", "county").select("county").distinct()
    return rows.exceptAll(B.blocks(spark, sf_dir).where("vap > 9900").select("county").distinct())


# Slices under their own names.
def _coverage(spark, sf_dir):
    """Result rows of a contest as keys, and those with a place as matched ones."""
    rows = B.results(spark, sf_dir).groupBy("year", F.lit("county").alias("scope"), F.col("office").alias("contest_type")).agg(F.count("*").alias("total_precinct_keys"), F.count_if(F.col("precinct") != "ABSENTEE").alias("matched_precinct_keys"))
    return L.slice_meta(rows.withColumn("office", F.col("contest_type")), "batch", "by_candidate")


def _written_slices(spark, sf_dir):
    path = folder(spark)
    L.write_slices(_slices(spark, sf_dir), path, _coverage(spark, sf_dir))
    return path


_MT = "mt AS (SELECT year, office AS contest_type, count(*) AS total_keys, sum(CASE WHEN precinct <> 'ABSENTEE' THEN 1 ELSE 0 END)::BIGINT AS matched_keys FROM res GROUP BY 1, 2)"
_PCT = "coalesce(round(100.0 * matched_keys / total_keys, 2), 0)::DOUBLE"


@register("k_s1_named_slices", B.oracle(B.RES, _MT, select=f"SELECT concat('county_', contest_type, '_', CAST(year AS VARCHAR), '.json') AS file, year, 'county' AS scope, contest_type, contest_type AS office, 'batch' AS source, 'by_candidate' AS nongeo_allocation_mode, matched_keys AS matched_precinct_keys, total_keys AS total_precinct_keys, {_PCT} AS match_coverage_pct FROM mt"))
def named_slices(spark, sf_dir):
    """The documents' own keys and meta, by file name."""
    docs = spark.read.schema(spark.createDataFrame([], L._DOC).schema).option("pathGlobFilter", "county_*.json").json(_written_slices(spark, sf_dir), multiLine=True)
    return docs.select(L._plain(F.col("_metadata.file_name")).alias("file"), "year", "scope", "contest_type", "meta.*")


@register("s12_slices_by_manifest", B.oracle(B.RES, B.CTY, _SL, select="SELECT scope, contest_type, year, count(*) AS districts FROM sl WHERE year <> 1998 OR starts_with(contest_type, '1-') GROUP BY 1, 2, 3"))
def slices_by_manifest(spark, sf_dir):
    """A manifest that leaves most slices of 1998 out, has lines without keys and of files that don't exist, leads the listing."""
    path = _written_slices(spark, sf_dir)
    lines = L.read_manifest(spark, path)
    kept = lines.where("year <> '1998' or contest_type like '1-%'").withColumns({c: F.when(F.col("year") != "1996", F.col(c)) for c in ("scope", "contest_type")})
    other = folder(spark)
    L.write_slices(_slices(spark, sf_dir), other)
    spark._jvm.org.apache.hadoop.fs.Path(other, L.MANIFEST_NAME).getFileSystem(spark._jsc.hadoopConfiguration()).delete(spark._jvm.org.apache.hadoop.fs.Path(other, L.MANIFEST_NAME), False)
    L.write_manifest(kept.unionByName(kept.limit(1).withColumn("file", F.lit("county_9-GONE_1996.json"))), other)
    found = L.discover_slices(spark, other, ("county",))
    counts = lines.select(F.col("scope"), "contest_type", F.col("year").cast("int").alias("year"), "districts")
    return found.join(counts, ["scope", "contest_type", "year"]).select("scope", "contest_type", "year", "districts")


@register("k_s8_points_of_slices", B.oracle(B.RES, B.CTY, _SL, _MT, select=f"SELECT 2024 AS lines_year, scope, contest_type, year, district, dem_votes::BIGINT AS dem_votes, rep_votes::BIGINT AS rep_votes, other_votes::BIGINT AS other_votes, total_votes::BIGINT AS total_votes, {_SH}, margin::BIGINT AS margin_votes, round(pct, 2) AS margin_pct, CASE WHEN rep_votes > dem_votes THEN 'REP' WHEN dem_votes > rep_votes THEN 'DEM' ELSE 'TIE' END AS winner, {_PCT} AS match_coverage_pct, matched_keys AS matched_precinct_keys, total_keys AS total_precinct_keys, '' AS dem_candidate, '' AS rep_candidate, concat('county_', contest_type, '_', CAST(year AS VARCHAR), '.json') AS source_file FROM sl JOIN mt USING (year, contest_type)"))
def points_of_slices(spark, sf_dir):
    """All 21 columns from files; the source file without its folder, whose name is new each time."""
    rows = L.export_points(L.scan_slices(spark, [_written_slices(spark, sf_dir)], ("county",)), 2024)
    return rows.withColumn("source_file", L._plain(F.element_at(F.split("source_file", "/"), -1)))


@register("k_s6_split_contents", B.oracle(B.RES, B.CTY, _SL, select="SELECT year, contest_type, district, dem_votes::BIGINT AS dem_votes, rep_votes::BIGINT AS rep_votes, 0::BIGINT AS other_votes FROM sl WHERE dem_votes + rep_votes > 0"))
def split_contents(spark, sf_dir):
    """A consolidated file is read, cut to a file a contest and year, and read again; rows without votes are left out."""
    rows = scan_nested_results(spark, sf_dir).select("year", F.lit("county").alias("scope"), F.col("office").alias("contest_type"), F.col("key").alias("district"), *[F.col(c).cast("double").alias(c) for c in ("dem_votes", "rep_votes")], F.lit(0.0).alias("other_votes"))
    path = folder(spark)
    L.write_slices(with_measures(rows).where("total_votes > 0"), path)
    return L.scan_slices(spark, [path], ("county",)).select("year", "contest_type", "district", *A.VOTES)


@register("k_s2_contest_rows", B.oracle(B.RES, B.CTY, _SL, select="SELECT year, contest_type, (row_number() OVER (PARTITION BY year, contest_type ORDER BY district) - 1)::INTEGER AS place, district, dem_votes, rep_votes, other_votes, total_votes, margin, round(pct, 2) AS margin_pct, sum(dem_votes) OVER w AS dem_total, sum(rep_votes) OVER w AS rep_total, sum(other_votes) OVER w AS other_total FROM sl WHERE total_votes > 0 WINDOW w AS (PARTITION BY year, contest_type)"))
def contest_rows(spark, sf_dir):
    """The documents' rows, in the order in which they hold them, and their totals."""
    fields = ["district string", *[f"{c} double" for c in (*A.VOTES, "total_votes", "margin", "margin_pct")]]
    docs = K.contest_slices(_slices(spark, sf_dir), "district")
    rows = docs.select("year", "contest_type", *[f"{p}_total" for p in A.PARTIES], F.posexplode(F.from_json("rows", f"array<struct<{', '.join(f.replace(' ', ': ', 1) for f in fields)}>>")).alias("place", "r"))
    return rows.select("year", "contest_type", "place", "r.*", *[f"{p}_total" for p in A.PARTIES])
