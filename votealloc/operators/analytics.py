"""Trends, scenarios and labels over result rows (geography, contest, year, votes, margin_pct).

Cut-offs that nothing fixes are parameters with defaults of our own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from votealloc.functions.measures import half_even, margin_pct, winner
from votealloc.operators.aggregate import VOTES, top_per_key
from votealloc.operators.identity import with_identity

GEO = ["county", "office"]


def with_margin(rows: DataFrame) -> DataFrame:
    """Votes with total, margin_pct (4 digits) and winner."""
    total = sum(F.col(c) for c in VOTES)
    return rows.withColumns({"total_votes": total, "margin_pct": F.round(margin_pct(F.col("dem_votes"), F.col("rep_votes"), total), 4), "winner": winner(F.col("dem_votes"), F.col("rep_votes"))})


def rollup(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Sums of all rows, with and without a place, by keys."""
    return with_margin(rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in VOTES]))


def region_rollup(counties: DataFrame, regions: DataFrame) -> DataFrame:
    """By year and office: each region of (county, region) and the whole state (region null). A county may be in several regions."""
    inside = counties.join(regions, "county").groupBy("year", "office", "region").agg(*[F.sum(c).alias(c) for c in VOTES])
    state = counties.groupBy("year", "office").agg(*[F.sum(c).alias(c) for c in VOTES]).withColumn("region", F.lit(None).cast("string"))
    return with_margin(inside.unionByName(state))


def contested(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of contests in which both major parties have votes."""
    both = rows.groupBy(*keys).agg(F.sum("dem_votes").alias("d"), F.sum("rep_votes").alias("r")).where("d > 0 and r > 0").select(*keys)
    return rows.join(both, keys, "left_semi")


def flips(rows: DataFrame, keys: list[str] = GEO) -> DataFrame:
    """Change of margin since the cycle before, and whether the winner changed."""
    w = Window.partitionBy(*keys).orderBy("year")
    before, who = F.lag("margin_pct").over(w), F.lag("winner").over(w)
    return rows.withColumns({"shift": F.round(F.col("margin_pct") - before, 4), "flipped": F.coalesce(who != F.col("winner"), F.lit(False))})


def split_ticket(rows: DataFrame, first: str, second: str) -> DataFrame:
    """Two contests of a year side by side: margins of each geography and their difference."""
    sums = rows.groupBy("county", "year").agg(*[F.max(F.when(F.col("office") == o, F.col(c))).alias(f"{n}_{c}") for n, o in (("first", first), ("second", second)) for c in ("margin_pct", "winner")])
    out = sums.where("first_margin_pct is not null and second_margin_pct is not null")
    return out.withColumns({"gap": F.round(F.col("first_margin_pct") - F.col("second_margin_pct"), 4), "split": F.col("first_winner") != F.col("second_winner")})


def swing(rows: DataFrame, points: float) -> DataFrame:
    """points of the two-party vote moved to DEM (from it if negative), not beyond either party's votes."""
    two = F.col("dem_votes") + F.col("rep_votes")
    dem = F.least(F.greatest(F.col("dem_votes") + two * points / 100, F.lit(0.0)), two)
    return with_margin(rows.withColumns({"dem_votes": half_even(dem), "rep_votes": two - half_even(dem)}))


def recounts(rows: DataFrame, within: float = 0.5) -> DataFrame:
    return rows.where((F.abs("margin_pct") < within) & (F.col("total_votes") > 0))


def versus_state(rows: DataFrame) -> DataFrame:
    """Margin beside the state's in the same contest and year."""
    state = rollup(rows, ["office", "year"]).select("office", "year", F.col("margin_pct").alias("state_margin_pct"))
    return rows.join(state, ["office", "year"]).withColumn("lean", F.round(F.col("margin_pct") - F.col("state_margin_pct"), 4))


def barometer(rows: DataFrame, cycles: int = 3, k: int = 5) -> DataFrame:
    """The k geographies of each contest whose margin was closest to the state's over the last cycles."""
    recent = top_per_key(versus_state(rows), GEO, [F.desc("year")], cycles)
    score = recent.groupBy(*GEO).agg(F.round(F.avg(F.abs("lean")), 4).alias("distance"), F.count("*").alias("cycles"))
    return top_per_key(score.where(F.col("cycles") == cycles), ["office"], [F.asc("distance"), F.asc("county")], k)


def realignment(rows: DataFrame, k: int = 10) -> DataFrame:
    """The k largest shifts of each contest and year."""
    moved = flips(rows).where("shift is not null")
    return top_per_key(moved, ["office", "year"], [F.desc(F.abs(F.col("shift"))), F.asc("county")], k)


def ghosts(keys: DataFrame, shapes: DataFrame, key: str = "precinct_id") -> DataFrame:
    """Result keys that no shape has."""
    return keys.select(key).distinct().join(shapes.select(key), key, "left_anti")


def turnout_intensity(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Votes over the most votes of any geography in the same view."""
    most = rows.groupBy(*keys).agg(F.max("total_votes").alias("most"))
    return rows.join(most, keys).withColumn("intensity", F.round(F.coalesce(F.try_divide("total_votes", "most"), F.lit(0.0)), 6)).drop("most")


def growth(rows: DataFrame, keys: list[str] = GEO) -> DataFrame:
    """Votes of each major party more (or fewer) than a cycle before."""
    w = Window.partitionBy(*keys).orderBy("year")
    return rows.withColumns({f"{p}_growth": F.col(f"{p}_votes") - F.lag(f"{p}_votes").over(w) for p in ("dem", "rep")})


#: Lower cuts of the position in points; our own, chosen so that the published examples hold.
POSITIONS = ((20.0, "Stronghold"), (10.0, "Advantage"), (4.0, "Edge"), (0.5, "Tilt"))
#: Points that count as movement, and as a break.
MOVED, BROKE = 2.0, 8.0


def _history(rows: DataFrame, keys: list[str]) -> DataFrame:
    """First, previous and latest margin of each geography."""
    ends = rows.groupBy(*keys).agg(F.min_by("margin_pct", "year").alias("first"), F.max_by("margin_pct", "year").alias("latest"), F.count("*").alias("cycles"), F.max("year").alias("year"))
    before = rows.withColumn("p", F.lag("margin_pct").over(Window.partitionBy(*keys).orderBy("year"))).groupBy(*keys).agg(F.max_by("p", "year").alias("previous"))
    return ends.join(before, keys)


def trajectory(rows: DataFrame, keys: list[str] = GEO) -> DataFrame:
    """Origin, side, position and status of each geography's history of signed margins.

    Realigned: the lean flipped against the first cycle by less than a strong margin or is long
    settled; Emerging: a lean that the history doesn't carry, new since the first cycle and
    still close, or one that movement works against; Reinforcing: moving further with its lean;
    Durable: the rest.
    """
    h = _history(rows, keys)
    latest, first = F.col("latest"), F.col("first")
    size = F.abs(latest)
    position = F.lit("Battleground")
    for cut, name in reversed(POSITIONS):
        position = F.when(size >= cut, name).otherwise(position)
    side = F.when(latest > 0, "Republican").otherwise("Democratic")
    moved = latest - first
    flipped = F.signum(first) != F.signum(latest)
    with_lean = moved * F.signum(latest)
    origin = F.when(flipped & (size < 10), "Emerging").when(flipped, "Realigned").when(with_lean <= -MOVED, "Emerging").when(with_lean >= MOVED, "Reinforcing").otherwise("Durable")
    out = h.withColumns({"origin": origin, "side": side, "position": position})
    return out.withColumn("status", F.when(F.col("position") == "Battleground", "Battleground").otherwise(F.concat_ws(" ", "origin", "side", "position")))


def momentum(rows: DataFrame, keys: list[str] = GEO) -> DataFrame:
    """Direction of movement (right is to REP) and a pattern label, from the whole history and the last cycle."""
    h = _history(rows, keys)
    whole, last, latest = F.col("latest") - F.col("first"), F.col("latest") - F.col("previous"), F.col("latest")
    pace = F.try_divide(whole, F.col("cycles") - 1)

    def direction(sign: int, name: str) -> Column:
        w, x, p = whole * sign, last * sign, pace * sign
        return F.when((w >= MOVED) & (x >= MOVED) & (x > p), f"Moving {name} faster").when((w >= MOVED) & (x >= MOVED), f"Moving {name}").when(w >= BROKE, f"Long-run move {name}").when(x >= MOVED, f"Moving {name}")

    call = F.coalesce(direction(1, "right"), direction(-1, "left"), F.lit("Stable"))
    subtype = (
        F.when((whole <= -BROKE) & (latest > 0) & (latest < 10) & (last <= 0), "Active Suburban Transition")
        .when((whole >= BROKE) & (latest < 0) & (latest > -10) & (last >= 0), "Active Republican Transition")
        .when((whole <= -BROKE) & (last > 0), "Suburbanizing (Lagging)")
        .when((whole >= BROKE) & (last < 0), "Counter-Suburbanizing (Lagging)")
        .when(whole >= BROKE, "Breaking right")
        .when(whole <= -BROKE, "Breaking left")
        .when((latest > 0) & (last <= -MOVED), "Red-leaning, cooling")
        .when((latest < 0) & (last >= MOVED), "Blue-leaning, cooling")
        .when((whole >= MOVED) & (last > 0), "Moving right")
        .when((whole <= -MOVED) & (last < 0), "Moving left")
        .otherwise("Stable / Mixed")
    )
    return h.withColumns({"momentum": call, "subtype": subtype})


def confidence(rows: DataFrame, keys: list[str] = GEO, strong: float = 10.0, spread: float = 8.0) -> DataFrame:
    """High, Medium or Low: by the latest margin's size and how steady sign and size were."""
    stats = rows.groupBy(*keys).agg(F.max_by("margin_pct", "year").alias("latest"), F.stddev_pop("margin_pct").alias("sd"), F.abs(F.sum(F.signum("margin_pct"))).alias("net"), F.count("*").alias("cycles"))
    agree = F.col("net") == F.col("cycles")
    level = F.when((F.abs("latest") >= strong) & agree & (F.col("sd") <= spread), "High").when(agree | (F.abs("latest") >= strong), "Medium").otherwise("Low")
    return stats.select(*keys, "latest", F.round("sd", 4).alias("sd"), level.alias("confidence"))


def backfill(rows: DataFrame, shapes: DataFrame, counties: DataFrame, until: int = 2020) -> DataFrame:
    """Precincts without a result in years up to until get their county's totals, tagged; later years get nothing.

    rows: (year, office, county, precinct_id, votes); shapes: (county, precinct_id).
    """
    contests = counties.where(F.col("year") <= until)
    asked = shapes.select("county", "precinct_id").distinct().join(contests, "county")
    extra = asked.join(rows.select("year", "office", "precinct_id"), ["year", "office", "precinct_id"], "left_anti")
    tagged = extra.select("year", "office", "county", "precinct_id", *VOTES).withColumns({"scope": F.lit("county"), "reason": F.lit("historical_unmatched_precinct")})
    own = rows.select("year", "office", "county", "precinct_id", *VOTES).withColumns({"scope": F.lit("precinct"), "reason": F.lit(None).cast("string")})
    return with_margin(own.unionByName(tagged))


#: The words that are shown for a trajectory's origin; sides and positions are shown as they are.
SHOWN = {"Durable": "Stable", "Reinforcing": "Strengthening", "Emerging": "Emerging", "Realigned": "Shifted"}


def shown_status(rows: DataFrame, words: dict[str, str] | None = None) -> DataFrame:
    """Rows of trajectory with shown: its status in words for readers, as in Stable Democratic (Edge); Battleground alone, unknown origins as they are."""
    table = SHOWN if words is None else words
    origin = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), F.col("origin")), F.col("origin")) if table else F.col("origin")
    return rows.withColumn("shown", F.when(F.col("position") == "Battleground", F.col("position")).otherwise(F.concat(origin, F.lit(" "), "side", F.lit(" ("), "position", F.lit(")"))))


#: Share of the reference turnout that a modelled contest is set to.
TURNOUT = 0.575


def modeled_contest(rows: DataFrame, first: tuple[int, str], second: tuple[int, str], weight: float = 0.5, bonus: float = 0.0, turnout: float = TURNOUT, need_both: bool = True) -> DataFrame:
    """A contest that wasn't held: two past ones blended by county, turnout scaled, margins kept.

    weight is the first's part of the two-party share; bonus in points goes to DEM. Both, and
    the blend itself, are parameters of ours. A county without two-party votes in one of the two gets
    no row; without need_both, the blend counts as 0 for DEM there.
    """
    def share(which: tuple[int, str], name: str) -> DataFrame:
        picked = rows.where((F.col("year") == which[0]) & (F.col("office") == which[1]))
        two = F.col("dem_votes") + F.col("rep_votes")
        return picked.select("county", F.try_divide("dem_votes", two).alias(f"{name}_share"), two.alias(f"{name}_two"))

    both = share(first, "a").join(share(second, "b"), "county")
    blend = F.col("a_share") * weight + F.col("b_share") * (1 - weight) + bonus / 100
    dem = F.least(F.greatest(blend, F.lit(0.0)), F.lit(1.0))  # greatest skips nulls
    if need_both:
        both = both.where(blend.isNotNull())
    size = half_even(F.greatest("a_two", "b_two") * turnout)
    out = both.select("county", half_even(size * dem).alias("dem_votes"), (size - half_even(size * dem)).alias("rep_votes"), F.lit(0.0).alias("other_votes")).where("dem_votes is not null")
    return with_margin(out)


def census_check(trend: DataFrame, people: DataFrame, fast: float = 5.0) -> DataFrame:
    """Population growth since the base and in the last year beside the trend, with a note. people: (county, base, before, latest)."""
    since, last = (F.round(F.try_divide(F.col("latest_people") - F.col(c), c) * 100, 4) for c in ("base", "before"))
    rows = trend.join(people.withColumnRenamed("latest", "latest_people"), "county").withColumns({"growth_pct": since, "last_year_pct": last})
    note = F.when((F.col("growth_pct") >= fast) & (F.col("latest") > F.col("first")), "fast growth, moving right").when((F.col("growth_pct") >= fast) & (F.col("latest") < F.col("first")), "fast growth, moving left").when(F.col("growth_pct") < 0, "declining").otherwise("mixed growth")
    return rows.withColumn("note", note)


def trend_series(rows: DataFrame, precinct_rows: DataFrame, names: DataFrame, roots: DataFrame | None = None) -> DataFrame:
    """Margin history of each precinct by contest (year and margin_pct in order); the county's where it has none of its own in that contest.

    names (county, precinct_id) are the precincts asked for; those of precinct_rows with a
    county count as asked for too. With roots (county, name, root; see identity.identities), a
    precinct's history is that of all its spellings, votes of one year added up.
    """
    point = F.array_sort(F.collect_list(F.struct("year", "margin_pct")))
    county = rows.groupBy("county", "office").agg(point.alias("series"))
    wanted = names.select("county", "precinct_id")
    if roots is None:
        own = precinct_rows.groupBy("precinct_id", "office").agg(point.alias("series"))
        if "county" in precinct_rows.columns:
            wanted = wanted.unionByName(precinct_rows.select("county", "precinct_id"))
        wanted = wanted.distinct()
    else:
        by_root = with_identity(precinct_rows, roots)
        sums = with_margin(by_root.groupBy("county", "root", "office", "year").agg(*[F.sum(c).alias(c) for c in VOTES]))
        wanted = wanted.unionByName(precinct_rows.select("county", "precinct_id")).distinct()
        series = sums.groupBy("county", "root", "office").agg(point.alias("series"))
        own = with_identity(wanted, roots).join(series, ["county", "root"]).select("precinct_id", "office", "series")
    asked = wanted.join(county, "county")
    lost = asked.join(own.select("precinct_id", "office"), ["precinct_id", "office"], "left_anti").select("precinct_id", "office", "series", F.lit("county").alias("level"))
    return own.withColumn("level", F.lit("precinct")).select("precinct_id", "office", "series", "level").unionByName(lost)
