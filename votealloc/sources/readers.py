"""Readers of result files, maps and control tables: schemas are given, so no pass infers them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from votealloc.functions import keys as K
from votealloc.sources.json_records import json_records

RESULT_COLUMNS = ("county", "precinct", "office", "district", "party", "candidate", "votes")
RESULTS = ", ".join(f"{c} string" for c in RESULT_COLUMNS)
BOARD = "`County` string, `Precinct` string, `Contest Type` string, `Contest Name` string, `Choice` string, `Choice Party` string, `Total Votes` string, `Election Date` string"


def scan_results_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Long results as strings, with year (from the folder or the file's name) and votes as numbers; bad ones are 0."""
    rows = spark.read.schema(RESULTS).csv(path, header=True, enforceSchema=False)
    return rows.select(*RESULT_COLUMNS[:-1], F.coalesce(F.col("votes").try_cast("double"), F.lit(0.0)).alias("votes"), year_of_path(F.col("_metadata.file_path")).alias("year"))


def year_of_path(path):
    """The year in a path: a folder of four digits (or name=four digits), else the first four of the name; null if there is none."""
    folder, name = K.some(F.regexp_extract(path, r"/(?:\w+=)?(\d{4})/[^/]*$", 1)), K.some(F.regexp_extract(path, r"/(\d{4})[^/]*$", 1))
    return F.coalesce(folder, name).cast("int")


def scan_board_tsv(spark: SparkSession, path: str | list[str], contests: list[str] | None = None) -> DataFrame:
    """Statewide contests of the state board's tab file; contests limits them by name."""
    rows = spark.read.schema(BOARD).csv(path, sep="\t", header=True, enforceSchema=False).where(F.col("`Contest Type`") == "S")
    return rows.where(F.col("`Contest Name`").isin(*contests)) if contests else rows


def board_to_long(board: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """Board rows as long results: contests renamed, district blank, rows without votes dropped."""
    office = F.col("`Contest Name`")
    if names:
        office = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), office), office)
    rows = board.select(K.norm(F.col("County")).alias("county"), F.trim("Precinct").alias("precinct"), office.alias("office"), F.lit("").alias("district"), F.coalesce("`Choice Party`", F.lit("")).alias("party"), F.col("Choice").alias("candidate"), F.col("`Total Votes`").try_cast("double").alias("votes"))
    return rows.where("votes is not null and votes <> 0")


def discover_year_files(spark: SparkSession, root: str, pattern: str = "*general*precinct*.csv", largest: bool = False) -> DataFrame:
    """(year, path) of each year's file: the last by name, or the largest. Contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(root).select("path", "length")
    order = F.struct("length", "path") if largest else F.col("path")
    return files.withColumn("year", year_of_path(F.col("path"))).where("year is not null").groupBy("year").agg(F.max_by("path", order).alias("path"))


def scan_block_vap(spark: SparkSession, path: str, code: str, people: str, prefix: str = "") -> DataFrame:
    """(block, vap) of a census file, of one state's prefix; bad numbers are 0."""
    rows = spark.read.csv(path, header=True).select(K.pad(F.col(code), 15).alias("block"), F.coalesce(F.col(people).try_cast("bigint"), F.lit(0)).alias("vap"))
    return rows.where(F.col("block").startswith(prefix)) if prefix else rows


def clean_crosswalk(rows: DataFrame, block: str, precinct: str) -> DataFrame:
    """(block, precinct_id) padded, trimmed, without blanks."""
    out = rows.select(K.pad(F.col(block).cast("string"), 15).alias("block"), K.norm(F.col(precinct)).alias("precinct_id"))
    return out.where("block <> '' and precinct_id <> ''")


def clean_district_map(rows: DataFrame, block: str, district: str, order: str | None = None) -> DataFrame:
    """(block, district) once a block: the row that is first by order (else by district)."""
    out = rows.select(K.pad(F.col(block).cast("string"), 15).alias("block"), K.district_of_map(F.col(district).cast("string")).alias("district"), (F.col(order) if order else F.col(district)).alias("__order"))
    return out.groupBy("block").agg(F.min_by("district", "__order").alias("district"))


def clean_district_stats(rows: DataFrame) -> DataFrame:
    """(district, dem_share, rep_share, other_share) from ID, Dem, Rep, Oth; unassigned rows and zero sums go."""
    dem, rep, oth = (K.safe_float(F.col(c).cast("string")) for c in ("Dem", "Rep", "Oth"))
    total = dem + rep + oth
    out = rows.select(K.district_of_stats(F.col("ID").cast("string")).alias("district"), *[F.try_divide(x, total).alias(n) for x, n in ((dem, "dem_share"), (rep, "rep_share"), (oth, "other_share"))])
    return out.where("district is not null and dem_share is not null")


def scan_nested_results(spark: SparkSession, path: str) -> DataFrame:
    """Consolidated files (results_by_year, year, office, general, results, key) as rows (year, office, key, votes and candidates).

    A file of any size is read by several tasks; objects that other keys lead to are left out.
    """
    row = "dem_votes bigint, rep_votes bigint, other_votes bigint, total_votes bigint, dem_candidate string, rep_candidate string"
    found = json_records(spark, path, 7, keys=True)
    at = lambda depth: F.get("keys", F.lit(depth - 2))
    rows = found.where((at(2) == "results_by_year") & (at(5) == "general") & (at(6) == "results"))
    return rows.select(at(3).cast("int").alias("year"), at(4).alias("office"), at(7).alias("key"), F.from_json("value", row).alias("row")).select("year", "office", "key", "row.*")


SLICE_NAME = r"^(congressional|state_house|state_senate)_(.+)_(\d{4})\.json$"
SLICE = "year int, scope string, contest_type string, general struct<results: map<string, struct<dem_votes:bigint, rep_votes:bigint, other_votes:bigint, total_votes:bigint, dem_candidate:string, rep_candidate:string, margin:bigint, margin_pct:double, winner:string, competitiveness:struct<color:string>>>>"


def parse_slice_name(name):
    """scope, contest_type and year of a slice file's name; null where it isn't one."""
    ok = name.rlike(SLICE_NAME)
    return F.when(ok, F.struct(F.regexp_extract(name, SLICE_NAME, 1).alias("scope"), F.regexp_extract(name, SLICE_NAME, 2).alias("contest_type"), F.regexp_extract(name, SLICE_NAME, 3).try_cast("int").alias("year")))


def scan_slices(spark: SparkSession, path: str) -> DataFrame:
    """All slices of a folder as rows of districts; scope, contest and year from the file's name where the file lacks them."""
    files = spark.read.schema(SLICE).json(path, multiLine=True).withColumn("__name", parse_slice_name(F.element_at(F.split("_metadata.file_path", "/"), -1)))
    rows = files.select(*[F.coalesce(c, F.col(f"__name.{c}")).alias(c) for c in ("year", "scope", "contest_type")], F.explode("general.results").alias("district", "row"))
    return rows.select("year", "scope", "contest_type", "district", "row.*")


def rebuild_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(year, scope, contest_type, districts) of the slices in a folder, each recounted from its file.

    Scope, contest and year come from the file's own keys, its folders, or its name; files that
    have them nowhere are left out. A file without readable results counts 0 districts.
    """
    files = spark.read.option("pathGlobFilter", "*.*").text(path, wholetext=True)
    doc = F.from_json("value", SLICE)
    name = parse_slice_name(F.element_at(F.split("_metadata.file_path", "/"), -1))
    folders = [c for c in ("year", "scope", "contest_type") if c in files.columns]
    found = [F.coalesce(doc[c], *[F.col(x).cast("int" if x == "year" else "string") for x in folders if x == c], name[c]).alias(c) for c in ("year", "scope", "contest_type")]
    rows = files.select(*found, F.coalesce(F.size(F.map_keys(doc["general"]["results"])), F.lit(-1)).alias("n"))
    rows = rows.where("year is not null and scope is not null and contest_type is not null")
    return rows.groupBy("year", "scope", "contest_type").agg(F.sum(F.greatest("n", F.lit(0))).cast("long").alias("districts"))


def _point(p):
    return F.struct(F.get(p, 0).alias("x"), F.get(p, 1).alias("y"))


def _nested(text, depth: int):
    """Coordinates of a depth as arrays of points: 0 a point, 1 a list of them..."""
    def points(value, level: int):
        return _point(value) if level == 0 else F.transform(value, lambda v: points(v, level - 1))

    return points(F.from_json(text, "array<" * depth + "array<double>" + ">" * depth), depth)


def geometry_parts(geometry):
    """(parts, points) of a geometry (type, coordinates as text): the shape of polygons, and all points of any type.

    Polygon and MultiPolygon have parts, also within a GeometryCollection; other types have null.
    """
    text, kind = geometry["coordinates"], geometry["type"]
    one = lambda g: (
        F.when(g["type"] == "MultiPolygon", _nested(g["coordinates"], 3)).when(g["type"] == "Polygon", F.array(_nested(g["coordinates"], 2)))
    )
    lines = lambda g: (
        F.when(g["type"] == "Point", F.array(_nested(g["coordinates"], 0)))
        .when(g["type"].isin("MultiPoint", "LineString"), _nested(g["coordinates"], 1))
        .when(g["type"] == "MultiLineString", F.flatten(_nested(g["coordinates"], 2)))
        .otherwise(F.flatten(F.flatten(one(g))))
    )
    several = geometry["geometries"]
    mixed = F.flatten(F.filter(F.transform(several, one), lambda x: x.isNotNull()))
    parts = F.when(kind == "GeometryCollection", F.when(F.size(mixed) > 0, mixed)).otherwise(F.when(text.isNotNull(), one(geometry)))
    points = F.when(kind == "GeometryCollection", F.flatten(F.filter(F.transform(several, lines), lambda x: x.isNotNull()))).otherwise(lines(geometry))
    return F.struct(parts.alias("parts"), points.alias("points"))


def scan_geojson(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """Features of GeoJSON files as rows: their properties (a DDL list), shape (the geometry's type), rings, parts and points.

    rings are a Polygon's, of [x, y] numbers, null for other types. parts is the shape of polygons (parts of an outline and its holes, of points x and y), null for
    other types; points are all points of any type, null where there is no geometry. A file of
    any size is read by several tasks. Objects beside the features (such as crs) are left out.
    """
    one = "type: string, coordinates: string"
    schema = f"type string, properties struct<{properties}>, geometry struct<{one}, geometries: array<struct<{one}>>>"
    rows = json_records(spark, path, 2).select(F.from_json("value", schema).alias("f")).where("f.type is null or f.type = 'Feature'")
    rings = F.when(F.col("f.geometry.type") == "Polygon", F.from_json("f.geometry.coordinates", "array<array<array<double>>>"))
    return rows.select("f.properties.*", F.col("f.geometry.type").alias("shape"), rings.alias("rings"), geometry_parts(F.col("f.geometry")).alias("g")).select("*", "g.*").drop("g")


def parse_log_totals(lines: DataFrame) -> DataFrame:
    """(name, total) from lines NAME; n; n; n: the second number."""
    pattern = r"^\s*([^;]+?)\s*;\s*([\d,]+)\s*;\s*([\d,]+)\s*;\s*([\d,]+)\s*$"
    value = F.col("value")
    return lines.where(value.rlike(pattern)).select(F.regexp_extract(value, pattern, 1).alias("name"), F.replace(F.regexp_extract(value, pattern, 3), F.lit(","), F.lit("")).try_cast("bigint").alias("total"))


def official_codes(features: DataFrame) -> DataFrame:
    """(county, label, code) of the board's precinct list, with underscore, space and prefix-less forms; ties: the last code."""
    county, code, label = K.norm(F.col("county")), K.norm(F.col("code")), K.norm_spaces(F.col("label"))
    forms = F.array(label, K.norm_spaces(F.replace(label, F.lit("_"), F.lit(" "))), K.norm_spaces(F.replace(label, F.lit(" "), F.lit("_"))), F.when(label.contains("_"), K.norm_spaces(F.substring(label, F.instr(label, "_") + 1, F.length(label)))))
    rows = features.select(county.alias("county"), code.alias("code"), F.explode(forms).alias("label")).where("county <> '' and code <> '' and label <> ''")
    return rows.groupBy("county", "label").agg(F.max("code").alias("code"))


def county_profile(rows: DataFrame, name: str, state: str = "North Carolina") -> DataFrame:
    """Rows of a census profile that are counties, name cut to the county; numbers with commas as numbers."""
    ending = f" County, {state}"
    numbers = [F.replace(F.col(c).cast("string"), F.lit(","), F.lit("")).try_cast("bigint").alias(c) for c in rows.columns if c != name]
    return rows.where(F.col(name).endswith(ending)).select(F.upper(F.replace(F.col(name), F.lit(ending), F.lit(""))).alias("county"), *numbers)


def vtd_people(rows: DataFrame, state: str, state_col: str, county_col: str, vtd_col: str, people_col: str) -> DataFrame:
    """(county, vtd, vap) sums of one state's voting districts."""
    own = rows.where(K.pad(F.col(state_col).cast("string"), 2) == state)
    return own.groupBy(K.pad(F.col(county_col).cast("string"), 3).alias("county"), K.norm(F.col(vtd_col)).alias("vtd")).agg(F.sum(F.coalesce(F.col(people_col).cast("string").try_cast("bigint"), F.lit(0))).alias("vap"))


def vintage_by_year(rows: DataFrame, vintages: list[tuple[int, int, str]]) -> DataFrame:
    """rows with the first vintage whose years (from, to, name) hold the row's, once each; rows that none holds go. No join: the few ranges are conditions."""
    found = F.lit(None).cast("string")
    for first, last, name in reversed(vintages):
        found = F.when(F.col("year").between(first, last), name).otherwise(found)
    return rows.withColumn("vintage", found).where("vintage is not null")
