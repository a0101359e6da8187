"""Range joins and growth of the alias index against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from votealloc.operators.ranges import first_range
from votealloc.operators.resolve import enrich_alias_index, grow_alias_index
from votealloc.sources.readers import vintage_by_year


@pytest.mark.parametrize("width", [1.0, 0.01, 50.0])
def test_first_range(spark, width):
    rng = random.Random(int(width))
    ranges = []
    for i in range(300):
        low = rng.uniform(-500, 500)
        high = low + rng.choice([0, 0.5, 3, 80, 900, -1])
        ranges.append((rng.choice([low, low, low, None]), rng.choice([high, high, high, None]), rng.randint(0, 50), rng.choice("ab"), f"n{i % 40}"))
    ranges.append((5.0, 5.0, -1, "a", "point"))
    values = [(rng.choice("abc"), rng.choice([5.0, 0.0, None, rng.uniform(-600, 600)])) for _ in range(500)]
    table = spark.createDataFrame(ranges, "low double, high double, place int, g string, name string")
    rows = spark.createDataFrame(values, "g string, v double")

    def best(g, v):
        fit = [(place, float("-inf") if low is None else low, float("inf") if high is None else high, name) for low, high, place, h, name in ranges if v is not None and g == h and (low is None or low <= v) and (high is None or v <= high)]
        return min(fit)[-1] if fit else None

    got = first_range(rows, table, "v", ["g"], width, "left").collect()
    assert sorted(((r.g, r.v, r.name) for r in got), key=str) == sorted(((g, v, best(g, v)) for g, v in values), key=str)
    assert first_range(rows, table, "v", ["g"], width).count() == sum(best(g, v) is not None for g, v in values)
    assert first_range(rows, table.where("false"), "v", ["g"], width).count() == 0


def test_many_ranges_need_no_nested_loop(spark):
    ranges = spark.range(10_000).select(F.col("id").alias("low"), (F.col("id") + F.when(F.col("id") % 2 == 0, 3).otherwise(4000)).alias("high"), F.lit(0).alias("place"), F.col("id").alias("name"))
    out = first_range(spark.range(20_000), ranges, "id")
    assert "NestedLoop" not in out._jdf.queryExecution().executedPlan().toString() and "Cartesian" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == out.select("id").distinct().count() == 14_000


def test_vintages_that_overlap_take_a_row_once(spark):
    rows = spark.createDataFrame([(2000,), (2005,), (1990,), (None,)], "year int")
    assert sorted(map(tuple, vintage_by_year(rows, [(2000, 2005, "a"), (2004, 2010, "b")]).collect())) == [(2000, "a"), (2005, "a")]


def test_growth_equals_passes_one_by_one(spark):
    rng = random.Random(3)
    index = spark.createDataFrame([("C", f"{k}", f"C - {k}") for k in range(100, 130)], "county string, alias string, canonical string")
    vintages = []
    for n in range(3):
        code = lambda k, n: str(k + 100) if n == 0 else f"NAME{n} {k}"
        vintages.append(spark.createDataFrame([("c ", code(rng.randrange(30), n), f"name{n + 1} {rng.randrange(30)}") for _ in range(25)] + [("D", "1", "2"), ("C", None, None)], "county string, code string, name string"))
    added, counts = grow_alias_index(index, vintages)
    known, want = index, []
    for n, vintage in enumerate(vintages, 1):
        more = enrich_alias_index(known, vintage).collect()
        want += [(n, r.county, r.alias, r.canonical) for r in more]
        known = known.unionByName(spark.createDataFrame(more, index.schema))
    assert sorted(map(tuple, added.select("pass", "county", "alias", "canonical").collect())) == sorted(want)
    assert {r["pass"]: r.added for r in counts.collect()} == {n: sum(w[0] == n for w in want) for n in (1, 2, 3)}
    assert len({w[0] for w in want}) == 3
