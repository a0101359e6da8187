"""Slices under their own names: manifests, listing, defaults, precedence of folders; files that aren't asked for stay closed."""

import json

import pytest

from votealloc.functions.measures import with_measures
from votealloc.sources import slices as L

ROWS = "year int, scope string, contest_type string, district string, dem_votes double, rep_votes double, other_votes double"


def rows(spark, *lines):
    return with_measures(spark.createDataFrame([(y, s, c, d, float(a), float(b), float(o)) for y, s, c, d, a, b, o in lines], ROWS))


def put(path, text):
    """Writes a file by hand; the checksum that Hadoop keeps beside its own goes."""
    path.with_name(f".{path.name}.crc").unlink(missing_ok=True)
    path.write_text(text)


def found(spark, path, **options):
    return {(r.scope, r.contest_type, r.year, r.path.rsplit("/", 1)[-1]) for r in L.discover_slices(spark, str(path), **options).collect()}


@pytest.fixture
def folder(spark, tmp_path):
    table = rows(spark, (2020, "state_house", "us_senate", "1", 5, 3, 1), (2020, "state_house", "us_senate", "02", 0, 0, 0), (2016, "congressional", "governor", "10", 7, 9, 0))
    meta = spark.createDataFrame([(2020, "state_house", "us_senate", 3, 4, "US SENATE"), (2016, "congressional", "governor", None, 0, None)], "year int, scope string, contest_type string, matched_precinct_keys int, total_precinct_keys int, office string")
    L.write_slices(table, str(tmp_path / "a"), L.slice_meta(meta, "src", "mode"))
    return tmp_path / "a"


def test_documents_and_manifest(spark, folder):
    doc = json.loads((folder / "state_house_us_senate_2020.json").read_text())
    assert doc["meta"] == {"match_coverage_pct": 75.0, "matched_precinct_keys": 3, "total_precinct_keys": 4, "source": "src", "office": "US SENATE", "nongeo_allocation_mode": "mode"}
    assert set(doc["general"]["results"]) == {"1", "02"} and doc["general"]["results"]["1"]["competitiveness"]["color"]
    lines = json.loads((folder / "manifest.json").read_text())["files"]
    assert [(x["file"], x["districts"]) for x in lines] == [("congressional_governor_2016.json", 1), ("state_house_us_senate_2020.json", 2)]
    assert sorted(p.name for p in folder.iterdir() if not p.name.startswith(".")) == ["congressional_governor_2016.json", "manifest.json", "state_house_us_senate_2020.json"]


def test_writing_again_replaces_a_slice_and_keeps_others(spark, folder):
    L.write_slices(rows(spark, (2020, "state_house", "us_senate", "9", 1, 0, 0), (2024, "state_house", "us_senate", "1", 1, 1, 0)), str(folder))
    assert {r.file: r.districts for r in L.read_manifest(spark, str(folder)).collect()} == {"congressional_governor_2016.json": 1, "state_house_us_senate_2020.json": 1, "state_house_us_senate_2024.json": 1}
    doc = json.loads((folder / "state_house_us_senate_2020.json").read_text())
    assert list(doc["general"]["results"]) == ["9"] and "meta" not in doc


def test_listing_by_manifest_or_by_name(spark, folder, tmp_path):
    both = {("congressional", "governor", 2016, "congressional_governor_2016.json"), ("state_house", "us_senate", 2020, "state_house_us_senate_2020.json")}
    assert found(spark, folder) == both
    put(folder / "other_name.json", "{}")
    lines = [{"file": "other_name.json", "scope": " state_senate ", "contest_type": "x", "year": 2000}, {"file": "congressional_governor_2016.json"}, {"file": "gone_2000.json", "scope": "state_house", "contest_type": "x", "year": 2000}, {"file": "state_house_us_senate_2020.json", "scope": "moon", "contest_type": "x", "year": 2000}, {"scope": "state_house"}]
    put(folder / "manifest.json", json.dumps({"files": lines}))
    assert found(spark, folder) == {("state_senate", "x", 2000, "other_name.json"), ("congressional", "governor", 2016, "congressional_governor_2016.json")}
    for broken in ("{not json", '{"files": []}', '{"files": [{"file": "gone_2000.json"}]}', "{}"):
        put(folder / "manifest.json", broken)
        assert found(spark, folder) == both
    (folder / "manifest.json").unlink()
    assert found(spark, folder) == both
    assert found(spark, tmp_path / "nowhere") == set()


def test_missing_fields_have_defaults(spark, tmp_path):
    results = {"1": {"dem_votes": 2, "rep_votes": 5}, "2": {"dem_votes": 3, "winner": "dem", "margin": -9, "total_votes": 30}, "3": {}, "4": {"rep_votes": 1, "winner": "?", "dem_candidate": "Ann"}, "5": None}
    (tmp_path / "state_house_x_2020.json").write_text(json.dumps({"general": {"results": results}}))
    (tmp_path / "state_house_empty_2020.json").write_text("{}")
    (tmp_path / "state_house_broken_2020.json").write_text('{"general": {"results": ')
    got = {r.district: r for r in L.scan_slices(spark, [str(tmp_path)]).collect()}
    short = {d: (r.year, r.scope, r.contest_type, r.dem_votes, r.rep_votes, r.other_votes, r.total_votes, r.margin, r.winner, r.dem_candidate) for d, r in got.items()}
    key = (2020, "state_house", "x")
    assert short == {"1": (*key, 2, 5, 0, 7, 3, "REP", ""), "2": (*key, 3, 0, 0, 30, -9, "DEM", ""), "3": (*key, 0, 0, 0, 0, 0, "TIE", ""), "4": (*key, 0, 1, 0, 1, 1, "TIE", "Ann")}
    assert got["1"].margin_pct == pytest.approx(300 / 7) and got["3"].margin_pct == 0.0 and got["1"].match_coverage_pct == 0.0


def test_only_asked_slices_of_the_first_folder_are_opened(spark, folder, tmp_path):
    second = tmp_path / "b c"
    L.write_slices(rows(spark, (2020, "state_house", "us_senate", "77", 1, 2, 3), (2012, "state_house", "us_senate", "8", 1, 2, 3)), str(second))
    scan = L.scan_slices(spark, [str(tmp_path / "none"), str(folder), str(second)], ("state_house",), contest="senate")
    assert {(r.year, r.district) for r in scan.collect()} == {(2020, "1"), (2020, "02"), (2012, "8")}
    opened = L.scan_slices(spark, [str(folder), str(second)], years=[2016])
    docs = [line for line in opened._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan json" in line]
    assert len(docs) == 1 and "Location: InMemoryFileIndex(1 paths)" in docs[0]
    assert L.scan_slices(spark, [str(folder)], years=[1900]).count() == 0


def test_export_points(spark, folder):
    out = L.export_points(L.scan_slices(spark, [str(folder)]), 2024)
    assert tuple(out.columns) == L.POINTS and len(L.POINTS) == 21
    assert [(r.year, r.district, r.dem_share, r.margin_votes, r.match_coverage_pct) for r in out.collect()] == [(2016, "10", 0.4375, 2, 0.0), (2020, "1", 0.555556, -2, 75.0), (2020, "02", 0.0, 0, 75.0)]
