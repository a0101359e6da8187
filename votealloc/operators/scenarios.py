"""A contest that wasn't held, by precinct: votes that fit modelled margins and turnout of counties."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from votealloc.operators.analytics import modeled_contest, with_margin
from votealloc.operators.ranks import apportion
from votealloc.sources.scratch import remove, written

#: A county fits when the sum of its precincts' votes is so near to its target.
NEAR = 1e-7
#: Every third round halves the bracket of a county's factor, so so many rounds narrow it by 2**-66.
ROUNDS = 200


def fit_odds(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """rows (county, seed, turnout) with dem: turnout * odds / (1 + odds), all odds of a county times the one factor that sums dem to its target.

    targets: (county, dem, rep), whose sum is the county's turnout; seeds lie between 0 and 1,
    ends excluded. That is where scaling precincts to their turnout and counties to their votes
    in turn (iterative proportional fitting) ends. The factor's logarithm is found by Newton
    steps, and by bisection where a step leaves its bracket or in every third round; sums of a
    round are partial before the shuffle. A target of 0 for a party leaves it none.
    """
    rows = written(rows)
    odds = F.ln(F.col("seed") / (1 - F.col("seed")))
    wanted = F.ln(F.col("dem") / F.col("rep"))
    ends = rows.groupBy("county").agg(F.min(odds).alias("low"), F.max(odds).alias("high"))
    state = targets.where("dem > 0 and rep > 0").join(ends, "county").select("county", "dem", (wanted - F.col("high") - 1e-9).alias("from"), (wanted - F.col("low") + 1e-9).alias("to"), F.lit(0.0).alias("x"), F.lit(float("inf")).alias("error"))
    state = written(state.withColumn("x", (F.col("from") + F.col("to")) / 2))
    for n in range(ROUNDS):
        share = 1 / (1 + F.exp(-(odds + F.col("x"))))
        sums = rows.join(state.select("county", "x"), "county").groupBy("county").agg(F.sum(F.col("turnout") * share).alias("s"), F.sum(F.col("turnout") * share * (1 - share)).alias("slope"))
        over = F.col("s") - F.col("dem")
        step = state.join(sums, "county").withColumns({"from": F.when(over < 0, F.col("x")).otherwise(F.col("from")), "to": F.when(over > 0, F.col("x")).otherwise(F.col("to")), "error": F.abs(over)})
        newton, middle = F.col("x") - F.try_divide(over, F.col("slope")), (F.col("from") + F.col("to")) / 2
        kept = F.col("error") <= NEAR
        inside = newton.between(F.col("from"), F.col("to")) if n % 3 < 2 else F.lit(False)
        after = written(step.withColumn("x", F.when(kept, F.col("x")).when(inside, newton).otherwise(middle)).select("county", "dem", "from", "to", "x", "error"))
        remove(state)
        state = after
        if not state.where(F.col("error") > NEAR).take(1):
            break
    found = rows.join(state.select("county", "x"), "county", "left").join(targets.select("county", F.col("dem").alias("__dem")), "county", "left")
    share = F.when(F.col("x").isNotNull(), 1 / (1 + F.exp(-(odds + F.col("x"))))).when(F.col("__dem") > 0, 1.0).otherwise(0.0)
    return found.withColumn("dem", F.col("turnout") * share).drop("x", "__dem")


def modeled_precincts(rows: DataFrame, precincts: DataFrame, first: tuple[int, str], second: tuple[int, str], **model) -> DataFrame:
    """The contest of modeled_contest (rows: by county, with votes that have no precinct) by precinct: (county, precinct_id, votes, margin).

    A county's turnout goes to its precincts by their two-party votes in the second contest, so
    votes without a precinct are spread as well; each precinct's lean is that of its votes in
    both (half a vote is added to either party), shifted by its county's common factor until
    the county's margin holds. Turnout and DEM votes are whole numbers that sum to the county's,
    by largest remainder, ties to the first precinct. Counties without a modelled contest or
    without precinct votes in the second have no rows. precincts: (year, office, county,
    precinct_id, dem_votes, rep_votes).
    """
    county = modeled_contest(rows, first, second, **model).select("county", F.col("dem_votes").alias("dem"), F.col("rep_votes").alias("rep"))
    is_first, is_second = ((F.col("year") == year) & (F.col("office") == office) for year, office in (first, second))
    two = F.col("dem_votes") + F.col("rep_votes")
    base = precincts.where(is_first | is_second).groupBy("county", "precinct_id").agg(F.sum("dem_votes").alias("d"), F.sum(two).alias("n"), F.sum(F.when(is_second, two).otherwise(0.0)).alias("size"))
    total = base.groupBy("county").agg(F.sum("size").alias("all"))
    placed = base.join(total.where("all > 0"), "county").join(county, "county")
    placed = placed.select("county", "precinct_id", ((F.col("d") + 0.5) / (F.col("n") + 1)).alias("seed"), ((F.col("dem") + F.col("rep")) * F.col("size") / F.col("all")).alias("part"), (F.col("dem") + F.col("rep")).alias("size"), F.col("dem").alias("county_dem"))
    sized = apportion(placed, ["county"], "part", "size", [F.col("precinct_id")], "turnout")
    fitted = fit_odds(sized.select("county", "precinct_id", "seed", "turnout", "county_dem"), county)
    whole = apportion(fitted, ["county"], "dem", "county_dem", [F.col("precinct_id")], "dem_votes")
    return with_margin(whole.select("county", "precinct_id", F.col("dem_votes").cast("double").alias("dem_votes"), (F.col("turnout") - F.col("dem_votes")).cast("double").alias("rep_votes"), F.lit(0.0).alias("other_votes")))
