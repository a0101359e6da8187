"""The ladder of methods: the best one there is serves each contest, and files of rejected ones stay unread."""

import pytest
from pyspark.sql import functions as F

from votealloc.operators import methods as H
from votealloc.operators.reports import hybrid_report

VOTES = "dem_votes double, rep_votes double, other_votes double"


def facts(spark, rows):
    return spark.createDataFrame(rows, "year int, office string, method string")


def test_choose_methods_takes_the_first_of_the_ladder(spark):
    rows = [(2000, "p", "county_share"), (2000, "p", "vtd00_overlay"), (2004, "p", "county_share"), (2008, "p", "block_direct"), (2008, "p", "precinct_shatter"), (2008, "g", "precinct_shatter"), (2008, "g", "unheard of"), (2012, "p", "unheard of"), (2000, "p", "county_share")]
    got = {(r.year, r.office): r.method for r in H.choose_methods(facts(spark, rows)).collect()}
    assert got == {(2000, "p"): "vtd00_overlay", (2004, "p"): "county_share", (2008, "p"): "block_direct", (2008, "g"): "precinct_shatter"}


@pytest.fixture
def files(spark, tmp_path):
    """Each method's district rows by year, votes that tell the method; precincts' file has every year."""
    for n, method in enumerate(("block_direct", "precinct_shatter", "county_share")):
        rows = [(y, o, "house", "1", float(n), 1.0, 0.0) for y in (2000, 2004, 2008) for o in "pg"]
        spark.createDataFrame(rows, f"year int, office string, scope string, district string, {VOTES}").write.partitionBy("year").parquet(str(tmp_path / method))
    asked = []

    def source(method):
        def read(years):
            asked.append((method, years))
            return spark.read.parquet(str(tmp_path / method)).where(F.col("year").isin(years))

        return read

    return {m: source(m) for m in ("block_direct", "legacy_direct", "precinct_shatter", "county_share")}, asked


def test_rejected_sources_stay_unread(spark, files):
    sources, asked = files
    known = facts(spark, [(y, o, "county_share") for y in (2000, 2004, 2008) for o in "pg"] + [(2008, "p", "block_direct"), (2004, "p", "county_share"), (2008, "g", "precinct_shatter"), (2004, "g", "precinct_shatter")])
    out = H.best_results(known, sources)
    assert asked == [("block_direct", [2008]), ("precinct_shatter", [2004, 2008]), ("county_share", [2000, 2004])]
    plan = out._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 3 and all("year#" in s.split("PartitionFilters: [")[1].split("]")[0] for s in scans)
    got = {(r.year, r.office): (r.method, r.dem_votes) for r in out.collect()}
    assert got == {(2000, "p"): ("county_share", 2.0), (2000, "g"): ("county_share", 2.0), (2004, "p"): ("county_share", 2.0), (2004, "g"): ("precinct_shatter", 1.0), (2008, "p"): ("block_direct", 0.0), (2008, "g"): ("precinct_shatter", 1.0)}


def test_no_contest_and_no_source(spark, files):
    sources, _ = files
    empty = H.best_results(facts(spark, []), sources)
    assert empty.columns == ["year", "office", "scope", "district", "dem_votes", "rep_votes", "other_votes", "method"] and empty.count() == 0
    with pytest.raises(ValueError, match="vtd10_overlay"):
        H.best_results(facts(spark, [(2000, "p", "vtd10_overlay")]), sources)


def test_available_needs_a_precinct_that_reaches_a_district(spark):
    rows = spark.createDataFrame([(2000, "p", "A - 1"), (2004, "p", "A - 2"), (2004, "p", None)], "year int, office string, precinct_id string")
    reached = spark.createDataFrame([("A - 1",), ("A - 9",)], "precinct_id string")
    assert [tuple(r) for r in H.available(rows, "precinct_shatter", reached).collect()] == [(2000, "p", "precinct_shatter")]


def test_hybrid_report_without_benchmark(spark):
    rows = spark.createDataFrame([(2000, "37", "m", 40.0, 60.0, 0.0), (2000, "1", "m", 10.0, 0.0, 0.0), (2004, "1", "k", 1.0, 0.0, 0.0)], f"year int, district string, method string, {VOTES}")
    expected = spark.createDataFrame([(2000, 51.0, 60.0, 0.0, "log")], f"year int, {VOTES}, benchmark string")
    sources = spark.createDataFrame([(2004, "file")], "year int, calibration_source string")
    got = {r.year: r for r in hybrid_report(rows, expected, sources, ["37", "59"], ["year"]).collect()}
    assert (got[2000].margin_pct_37, got[2000].margin_pct_59, got[2000].benchmark, got[2000].ok, got[2000].calibration_source) == (20.0, None, "log", True, None)
    assert 98 < got[2000].accuracy_pct < 100
    assert (got[2004].margin_pct_37, got[2004].benchmark, got[2004].accuracy_pct, got[2004].ok, got[2004].calibration_source) == (None, None, None, False, "file")


def test_votes_of_blocks_are_written_without_a_sort_of_all_years(spark, monkeypatch):
    """A write by partitions sorts what a task makes, which for a file of blocks is all its blocks in all years and contests."""
    from pyspark.sql.readwriter import DataFrameWriter

    from votealloc.plans.method_queries import YEARS, ladder_sources

    sorted_files, plain = [], DataFrameWriter.partitionBy
    monkeypatch.setattr(DataFrameWriter, "partitionBy", lambda self, *by: sorted_files.append(self._df.columns) or plain(self, *by))
    facts, _ = ladder_sources(spark, "/root/testdata/sf0.001")
    assert sorted_files and not any("block" in columns for columns in sorted_files)
    assert sorted(r.year for r in facts.where("method = 'legacy_bridge'").select("year").distinct().collect()) == YEARS["legacy_bridge"]
