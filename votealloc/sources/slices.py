"""Result slices, a JSON file for each scope, contest and year, under their own names, with a manifest that leads to them."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from votealloc.functions.measures import share
from votealloc.sources.sinks import SLICE_KEYS, district_slices

SCOPES = ("congressional", "state_house", "state_senate")
META = ("match_coverage_pct", "matched_precinct_keys", "total_precinct_keys", "source", "office", "nongeo_allocation_mode")
_META = "match_coverage_pct double, matched_precinct_keys bigint, total_precinct_keys bigint, source string, office string, nongeo_allocation_mode string"
_ROW = "dem_votes: bigint, rep_votes: bigint, other_votes: bigint, total_votes: bigint, dem_candidate: string, rep_candidate: string, margin: bigint, margin_pct: double, winner: string"
_DOC = f"year int, scope string, contest_type string, meta struct<{_META.replace(' double', ': double').replace(' bigint', ': bigint').replace(' string', ': string')}>, general struct<results: map<string, struct<{_ROW}>>>"
_MANIFEST = "files array<struct<file: string, scope: string, contest_type: string, year: string, districts: bigint>>"
MANIFEST_NAME = "manifest.json"


def slice_meta(coverage: DataFrame, source: str, mode: str) -> DataFrame:
    """A line of meta for each slice: coverage has (year, scope, contest_type, matched_precinct_keys, total_precinct_keys, office)."""
    pct = F.coalesce(F.round(F.try_divide(100.0 * F.col("matched_precinct_keys"), F.col("total_precinct_keys")), 2), F.lit(0.0))
    return coverage.select(*SLICE_KEYS, pct.alias("match_coverage_pct"), *[F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long")).alias(c) for c in META[1:3]], F.lit(source).alias("source"), "office", F.lit(mode).alias("nongeo_allocation_mode"))


def _files(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def write_slices(rows: DataFrame, path: str, meta: DataFrame | None = None) -> DataFrame:
    """Writes each slice of rows as path/<scope>_<contest_type>_<year>.json and merges them into path/manifest.json.

    meta has one line a slice (slice_meta); a slice without one has no meta. Tasks write the
    documents; the driver only gives the files their names. Slices written before under other
    names stay, those of the same name are replaced. Returns the manifest's lines.
    """
    spark = rows.sparkSession
    docs = district_slices(rows)
    if meta is not None:
        docs = docs.join(meta.select(*SLICE_KEYS, F.struct(*META).alias("meta")), SLICE_KEYS, "left")
    name = F.concat_ws("_", "scope", "contest_type", F.col("year").cast("string"))
    value = F.to_json(F.struct("year", "scope", "contest_type", *(["meta"] if meta is not None else []), "general"))
    fs, target = _files(spark, path)
    step = f"{path.rstrip('/')}/.step-{uuid.uuid4().hex}"
    docs.select(name.alias("file"), value.alias("value")).write.partitionBy("file").text(step)
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(target)
    for folder in fs.listStatus(path_of(step)):
        if folder.isDirectory():
            slice_name = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(folder.getPath().getName().removeprefix("file="))
            part = next(f.getPath() for f in fs.listStatus(folder.getPath()) if f.getPath().getName().startswith("part-"))
            final = path_of(target, f"{slice_name}.json")
            fs.delete(final, False)
            fs.rename(part, final)
    fs.delete(path_of(step), True)
    lines = docs.select(F.concat(name, F.lit(".json")).alias("file"), "scope", "contest_type", F.col("year").cast("string").alias("year"), F.size("general.results").cast("long").alias("districts"))
    return write_manifest(lines, path)


def write_manifest(lines: DataFrame, path: str) -> DataFrame:
    """lines (file, scope, contest_type, year, districts) merged into path/manifest.json: those of a file replace its old one. Returns all lines."""
    spark = lines.sparkSession
    fs, _ = _files(spark, path)
    final = spark._jvm.org.apache.hadoop.fs.Path(path, MANIFEST_NAME)
    if fs.exists(final):
        old = read_manifest(spark, path)
        lines = old.join(lines.select("file"), "file", "left_anti").select(*lines.columns).unionByName(lines)
    step = f"{path.rstrip('/')}/.step-{uuid.uuid4().hex}"
    one = lines.agg(F.array_sort(F.collect_list(F.struct("file", "scope", "contest_type", "year", "districts"))).alias("files"))
    one.select(F.to_json(F.struct("files")).alias("value")).coalesce(1).write.text(step)
    folder = spark._jvm.org.apache.hadoop.fs.Path(step)
    part = next(f.getPath() for f in fs.listStatus(folder) if f.getPath().getName().startswith("part-"))
    fs.delete(final, False)
    fs.rename(part, final)
    fs.delete(folder, True)
    return read_manifest(spark, path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest's lines (file, scope, contest_type, year, districts); none where it can't be read."""
    doc = spark.read.text(f"{path}/{MANIFEST_NAME}", wholetext=True)
    return doc.select(F.explode(F.from_json("value", _MANIFEST)["files"]).alias("f")).select("f.*")


def _parsed(name: Column, scopes: tuple[str, ...]) -> Column:
    pattern = rf"^({'|'.join(scopes)})_(.+)_(\d{{4}})\.json$"
    return F.when(name.rlike(pattern), F.struct(*[F.regexp_extract(name, pattern, k).alias(c) for k, c in ((1, "scope"), (2, "contest_type"), (3, "year"))]))


def _plain(path: Column) -> Column:
    """A path without the escapes that Spark's own columns of paths may have."""
    return F.coalesce(F.try_url_decode(path), path)


def discover_slices(spark: SparkSession, path: str, scopes: tuple[str, ...] = SCOPES) -> DataFrame:
    """(scope, contest_type, year, path) of a folder's slices: those of its manifest, or by their names where it leads to none.

    A manifest's line counts if its file exists and it names a scope of scopes, contest and year, or its file's
    name does. Files are listed, not read. A missing folder has no slices.
    """
    empty = spark.range(0).selectExpr("'' scope", "'' contest_type", "0 year", "'' path")
    fs, folder = _files(spark, path)
    if not fs.exists(folder):
        return empty
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(path).select("path", _plain(F.element_at(F.split("path", "/"), -1)).alias("file"))
    found = listed.select("path", _parsed(F.col("file"), scopes).alias("s")).where("s is not null").select("s.scope", "s.contest_type", F.col("s.year").cast("int").alias("year"), "path").withColumn("rank", F.lit(2))
    if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(path, MANIFEST_NAME)):
        blank = lambda c: F.when(F.trim(c) != "", F.trim(c))
        lines = read_manifest(spark, path).withColumn("s", _parsed(F.col("file"), scopes))
        whole = blank("scope").isNotNull() & blank("contest_type").isNotNull() & F.col("year").isNotNull()
        named = [F.when(whole, blank(c)).otherwise(F.col(f"s.{c}")).alias(c) for c in ("scope", "contest_type", "year")]
        led = lines.select("file", *named).withColumn("year", F.col("year").try_cast("int")).where(F.col("scope").isin(*scopes) & F.col("contest_type").isNotNull() & F.col("year").isNotNull())
        led = led.join(listed, "file").select("scope", "contest_type", "year", "path").withColumn("rank", F.lit(1))
        both = led.unionByName(found)
        best = both.agg(F.min("rank").alias("best"))
        found = both.join(best, F.col("rank") == F.col("best")).drop("best")
    return found.drop("rank")


def scan_slices(spark: SparkSession, paths: list[str], scopes: tuple[str, ...] = SCOPES, years: list[int] | None = None, contest: str | None = None) -> DataFrame:
    """District rows of the slices asked for, from the first of the folders that has each; other files aren't opened.

    Fields that a slice lacks are filled in: total and margin from the votes, winner from the
    margin (also where it is none of REP, DEM and TIE), names as blanks, meta's numbers as 0.
    """
    found = None
    for rank, path in enumerate(paths):
        more = discover_slices(spark, path, scopes).withColumn("dir_rank", F.lit(rank))
        found = more if found is None else found.unionByName(more)
    if years is not None:
        found = found.where(F.col("year").isin(years))
    if contest is not None:
        found = found.where(F.col("contest_type").rlike(contest))
    first = found.groupBy(*SLICE_KEYS).agg(F.min_by("path", F.struct("dir_rank", "path")).alias("path"))
    asked = [r.path for r in first.select("path").collect()]
    schema = spark.createDataFrame([], _DOC).schema
    docs = spark.read.schema(schema).json(asked, multiLine=True) if asked else spark.createDataFrame([], schema)
    docs = docs.withColumn("source_file", F.col("_metadata.file_path") if asked else F.lit(None).cast("string"))
    named = first.select(*[F.col(c).alias(f"__{c}") for c in SLICE_KEYS], F.col("path").alias("__path"))
    tail = lambda c: _plain(F.regexp_replace(c, "^file:/*", "/"))
    docs = docs.join(named, tail(F.col("source_file")) == tail(F.col("__path")))
    rows = docs.select(*[F.col(f"__{c}").alias(c) for c in SLICE_KEYS], "meta", F.col("__path").alias("source_file"), F.explode("general.results").alias("district", "r")).where("r is not null")
    votes = {c: F.coalesce(f"r.{c}", F.lit(0).cast("long")) for c in ("dem_votes", "rep_votes", "other_votes")}
    rows = rows.withColumns(votes).withColumn("total_votes", F.coalesce("r.total_votes", F.col("dem_votes") + F.col("rep_votes") + F.col("other_votes")))
    rows = rows.withColumn("margin", F.coalesce("r.margin", F.col("rep_votes") - F.col("dem_votes")))
    by_margin = F.when(F.col("margin") > 0, "REP").when(F.col("margin") < 0, "DEM").otherwise("TIE")
    given = F.upper(F.when(F.col("r.winner") != "", F.col("r.winner")))
    rows = rows.withColumns({
        "margin_pct": F.coalesce("r.margin_pct", F.try_divide(F.col("margin") * 100.0, F.col("total_votes")), F.lit(0.0)),
        "winner": F.when(given.isNull(), by_margin).when(given.isin("REP", "DEM", "TIE"), given).otherwise("TIE"),
        **{c: F.coalesce(f"r.{c}", F.lit("")) for c in ("dem_candidate", "rep_candidate")},
        "match_coverage_pct": F.coalesce("meta.match_coverage_pct", F.lit(0.0)),
        **{c: F.coalesce(f"meta.{c}", F.lit(0).cast("long")) for c in META[1:3]},
    })
    return rows.drop("r", "meta")


POINTS = ("lines_year", "scope", "contest_type", "year", "district", "dem_votes", "rep_votes", "other_votes", "total_votes", "dem_share", "rep_share", "other_share", "margin_votes", "margin_pct", "winner", "match_coverage_pct", "matched_precinct_keys", "total_precinct_keys", "dem_candidate", "rep_candidate", "source_file")


def export_points(rows: DataFrame, lines_year: int) -> DataFrame:
    """Rows of scan_slices as the long export's 21 columns, shares to 6 and margins to 4 digits, by year, scope, contest and district number."""
    shares = {f"{p}_share": share(F.col(f"{p}_votes"), F.col("total_votes")) for p in ("dem", "rep", "other")}
    out = rows.withColumns({"lines_year": F.lit(lines_year), "margin_votes": F.col("margin"), "margin_pct": F.round("margin_pct", 4), **shares})
    number = F.coalesce(F.regexp_replace(F.trim("district"), "^0+", "").try_cast("int"), F.lit(0))
    return out.select(*POINTS).orderBy("year", "scope", "contest_type", number, "district")
