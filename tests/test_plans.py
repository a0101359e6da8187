"""Shuffles of the flagship's plans without broadcasts, and one pass over the blocks against the operators that it stands for."""

import random
import re

import pytest

from votealloc.operators import allocate as R
from votealloc.operators import geometry as G
from votealloc.operators import resolve as X
from votealloc.operators.ranges import first_range
from votealloc.plans import QUERIES

SF = "/root/testdata/sf0.001"


def shuffles(df):
    """Shuffles of the plan that ran, reused ones not counted."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    return len(re.findall(r"(?<!Reused)(?<!Broadcast)Exchange (?:hash|single|range|Rou)", plan)) - plan.count("ReusedExchange")


@pytest.mark.parametrize("name,most", [("r1_precinct_party_votes", 12), ("r3_allocate_non_geo_by_candidate", 11), ("r11_party_to_scope", 30), ("r13_area_weight_allocate", 25), ("r30_batch_contests", 31)])
def test_shuffles_without_broadcasts(spark, name, most):
    settings = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    try:
        for key in settings:
            spark.conf.set(key, "-1")
        assert shuffles(QUERIES[name](spark, SF)) <= most
    finally:
        for key in settings:
            spark.conf.unset(key)


def counted_rows(df, operator, metric):
    """Rows that the operators of a kind counted in the plan that ran."""
    df.collect()

    def under(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return under(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return under(node.plan())
        rows = node.metrics().apply(metric).value() if kind == operator else 0
        return rows + sum(under(node.children().apply(i)) for i in range(node.children().size()))

    return under(df._jdf.queryExecution().executedPlan())


def shuffled_rows(df):
    return counted_rows(df, "ShuffleExchangeExec", "shuffleRecordsWritten")


def made_rows(df):
    return counted_rows(df, "GenerateExec", "numOutputRows")


def test_votes_of_blocks_are_in_no_shuffle(spark):
    """300 blocks with 40 contests: 12,000 votes of blocks, that only the result holds."""
    blocks = spark.range(300).selectExpr("concat('b', id) as block", "concat('p', id % 3) as precinct_id", "id % 50 as vap")
    votes = spark.range(120).selectExpr("cast(id div 3 as int) as year", "'gov' as office", "concat('p', id % 3) as precinct_id", *[f"cast(id * {n} + 1 as double) as {c}" for n, c in enumerate(R.VOTES)])
    dmap = spark.range(300).selectExpr("concat('b', id) as block", "inline(array(struct('x' as scope, cast(id % 7 as string) as district), struct('y' as scope, cast(id % 2 as string) as district)))")
    shattered, audit = R.shatter(votes, blocks)
    direct = R.shatter_to_districts(votes, blocks, dmap)
    assert shattered.count() == 12000 and shuffled_rows(shattered) < 3000
    assert shuffled_rows(direct) < 6000 and shuffled_rows(audit) < 4000
    assert sorted(map(tuple, direct.collect())) == sorted(map(tuple, R.to_districts(shattered, dmap).collect()))
    marked = R.shatter(votes, blocks, with_largest=True)[0].where("largest").select("block").distinct().collect()
    assert sorted(r.block for r in marked) == ["b149", "b199", "b249"]


def test_forms_and_tests_of_keys_are_made_once_a_distinct_label(spark):
    """20,000 rows of 8 labels: neither their forms nor the tests of keys are made row by row, and no more rows come to the explode."""
    rows = spark.range(20000, numPartitions=4).selectExpr("'WAKE' as county", "concat(id % 8, ' OAK_HILL') as code", "'ELM' as description", "'ELM' as name")
    index = X.alias_index(rows)
    more = X.enrich_alias_index(index, rows)
    keys = rows.selectExpr("concat(county, ' - ', code) as key")
    for df, most in ((index, 4 * 200), (more, 4 * 500), (X.resolve_keys(keys, index), 4 * 500)):
        assert made_rows(df) < most
    assert sorted(map(tuple, X.resolve_keys(keys, index).collect())) == [(f"WAKE - {n} OAK_HILL", None, "ambiguous") for n in range(8)]
    # The keys' own aggregation stays in the plan, so the tests come after it.
    assert "count(1) AS rows" in X.resolve_keys(keys, index)._jdf.queryExecution().optimizedPlan().toString()


def test_keys_are_read_once(spark):
    """Nulls among the keys too: they are a status of their own, and both uses of the keys come from one pass over their rows."""
    keys = spark.range(20000, numPartitions=4).selectExpr("if(id % 9 = 8, null, concat('WAKE - ', id % 9, ' OAK_HILL')) as key")
    index = spark.createDataFrame([("WAKE", f"{n}", f"WAKE - {n}") for n in range(5)], "county string, alias string, canonical string")
    found = X.resolve_keys(keys, index)
    assert counted_rows(found, "RangeExec", "numOutputRows") == 20000
    expected = [(f"WAKE - {n} OAK_HILL", f"WAKE - {n}" if n < 5 else None, "matched" if n < 5 else "unmatched") for n in range(8)]
    assert sorted(tuple(r) for r in found.where("key is not null").collect()) == expected


def test_ranges_with_the_same_ends_meet_values_once(spark):
    """3,000 ranges with 6 different ends over 100 values: pairs grow with the ends, not with the ranges."""
    ranges = spark.range(3000).selectExpr("id % 3 * 10 as low", "id % 3 * 10 + if(id % 2 = 0, 60, 70) as high", "(id * 7 + 5) % 1000 as place", "concat('r', id) as name")
    values = spark.range(100).selectExpr("id as k")
    found = first_range(values, ranges, "k")
    assert counted_rows(found, "SortMergeJoinExec", "numOutputRows") + counted_rows(found, "BroadcastHashJoinExec", "numOutputRows") < 3000
    listed = [tuple(r) for r in ranges.collect()]
    want = {k: min((place, low, high, name) for low, high, place, name in listed if low <= k <= high)[-1] for k in range(91)}
    assert {r.k: r.name for r in found.collect()} == want


def test_edges_of_short_rings_are_in_no_shuffle(spark):
    """200 squares over four of 264 districts each: rings are shuffled by their four cells, and common areas, but no edges."""
    square = lambda x, y, width: [[[(x, y), (x + width, y), (x + width, y + width), (x, y + width)]]]
    small = spark.createDataFrame([(i, square(i % 20 + 0.5, i // 20 + 0.5, 1.0)) for i in range(200)], "id long, parts array<array<array<struct<x:double,y:double>>>>")
    districts = spark.createDataFrame([(f"{x}-{y}", square(float(x), float(y), 1.0)) for x in range(22) for y in range(12)], "district string, parts array<array<array<struct<x:double,y:double>>>>")
    found = G.overlay(small, districts, ["id"], 1.0)
    assert shuffled_rows(found) <= 4 * 200 + 4 * 264 + 800
    assert [round(r["area"], 9) for r in found.collect()] == [0.25] * 800


@pytest.mark.parametrize("seed", range(3))
def test_placed_weights_are_those_of_the_single_operators(spark, seed):
    """Precincts without people, blocks that a scope or the whole map lacks, buckets without people, nulls, unknown precincts and counties."""
    rng = random.Random(seed)
    blocks, dmap = [], []
    for n in range(60):
        county = rng.choice(["A", "B", "C"])
        precinct = f"{county} - {rng.choice(['EAST', 'WEST', '01'])}-{rng.randrange(3)}" if rng.random() > 0.05 else None
        blocks.append((f"b{n:03}", county if rng.random() > 0.05 else None, precinct, rng.choice([0, 0, 3, 10]) if county != "C" else 0))
        if rng.random() > 0.1:
            dmap += [(f"b{n:03}", scope, str(rng.randrange(3))) for scope in ("x", "y") if rng.random() > 0.2]
    crosswalk = spark.createDataFrame(blocks, "block string, county string, precinct_id string, vap long")
    district_map = spark.createDataFrame(dmap, "block string, scope string, district string")
    names = sorted({(c, p) for _, c, p, _ in blocks if c and p} | {("A", "A - EAST-9"), ("A", "A - NORTH"), ("B", "B - WEST-8"), ("C", "C - EAST-9"), ("D", "D - 1")})
    precincts = spark.createDataFrame(names + names[:2], "county string, precinct_id string")

    weights = R.block_weights(crosswalk).join(district_map, "block").groupBy("precinct_id", "scope", "district").agg({"weight": "sum"}).toDF("precinct_id", "scope", "district", "weight")
    direct = R.precinct_district_weights(crosswalk, district_map)
    rows = {tuple(r)[:3]: r.weight for r in weights.collect()}
    got = {tuple(r)[:3]: r.weight for r in direct.collect()}
    assert got == pytest.approx(rows) and len(got) == direct.count()

    by_bucket = R.area_shares(crosswalk.withColumn("bucket", R.bucket_of(crosswalk["precinct_id"])), district_map, ["county", "bucket"])
    fallback = R.fallback_weights(precincts, direct, R.area_shares(crosswalk, district_map, ["county"]), by_bucket, district_map.select("scope").distinct())
    named = {p for _, p in names}
    want = {(*k, "map"): w for k, w in rows.items() if k[0] in named} | {(r.precinct_id, r.scope, r.district, r.method): r.weight for r in fallback.collect()}
    placed = [tuple(r) for r in R.placed_weights(precincts, crosswalk, district_map).select("precinct_id", "scope", "district", "method", "weight").collect()]
    assert {r[:4]: r[4] for r in placed} == pytest.approx(want) and len(placed) == len(want)
    assert R.placed_weights(precincts.where("false"), crosswalk, district_map).count() == 0
    assert R.placed_weights(precincts, crosswalk.where("false"), district_map).count() == 0
