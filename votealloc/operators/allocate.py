"""Votes from precincts, blocks and counties to districts: every ballot is placed once or reported as not placed.

All operators take all years, contests, scopes and parties at once, as columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from votealloc.functions.keys import canonical_candidate, candidate_or_default, is_non_geographic, party_group, precinct_bucket, ticket_head, vtd_code
from votealloc.functions.measures import half_even, largest_remainder, split_pair, with_measures
from votealloc.operators.aggregate import PARTIES, VOTES, party_columns, share_of_group, sum_by, top_candidate

CONTEST = ["year", "office"]


def override_party(results: DataFrame, rules: DataFrame | None = None) -> DataFrame:
    """party_group of each row, replaced by the first rule (year, candidate_like, office_like, to_group) that fits; rows stay one each.

    Rules come by place, then by their patterns, where both columns are optional: place, and token, a
    word in capitals that the candidate's name holds. Distinct names are tried, and a rule with a
    token only meets the names that have the word, so thousands of such rules are an equi-join.
    """
    rows = results.withColumn("party_group", party_group(F.col("party")))
    if rules is None:
        return rows
    place = F.coalesce(F.col("place").cast("double"), F.lit(float("inf"))) if "place" in rules.columns else F.lit(0.0)
    token = F.col("token") if "token" in rules.columns else F.lit(None).cast("string")
    order = F.struct(place.alias("place"), "candidate_like", "office_like", "to_group")
    r = rules.select(F.col("year"), token.alias("token"), "candidate_like", "office_like", "to_group", order.alias("order"))
    names = results.select("year", "candidate", "office").distinct()
    words = F.array_distinct(F.regexp_extract_all(F.upper("candidate"), F.lit(r"[^\s]+"), F.lit(0)))
    by_word = names.withColumn("token", F.explode(words)).join(r.where("token is not null"), ["year", "token"]).drop("token")
    by_year = names.join(r.where("token is null").drop("token"), "year")
    fits = by_word.unionByName(by_year).where(F.expr("upper(candidate) rlike candidate_like") & F.expr("office rlike office_like"))
    first = fits.groupBy("year", "candidate", "office").agg(F.min_by("to_group", "order").alias("__to_group"))
    return rows.join(first, ["year", "candidate", "office"], "left").withColumn("party_group", F.coalesce("__to_group", "party_group")).drop("__to_group").select(*rows.columns)


def spread_non_geographic(results: DataFrame, contest: list[str] = CONTEST, keep_candidate: bool = False) -> tuple[DataFrame, DataFrame]:
    """Absentee and early votes of each candidate over the candidate's precincts in the county.

    A candidate without votes in any precinct of the county goes by the county's votes: with
    keep_candidate to the candidate's own row of each precinct, else
    within each precinct by its candidates' shares. Returns (contest, county, precinct_id,
    candidate, votes) and the votes that have no precinct at all: (contest, county, candidate,
    unallocated).
    """
    county = [*contest, "county"]
    plain, candidates = _candidate_rows(results, contest)
    homeless = candidates.where("homeless").select(*county, "candidate", "loose", "there")
    unplaced = homeless.where("there is null or there <= 0").select(*county, "candidate", F.col("loose").alias("unallocated"))
    if keep_candidate:
        shares = plain.groupBy(*county, "precinct_id").agg((F.sum("here") / F.max("there")).alias("share"), F.max("there").alias("there")).where("there > 0").drop("there")
        own_rows = shares.join(homeless.drop("there"), county).select(*county, "precinct_id", "candidate", (F.col("loose") * F.col("share")).alias("votes"))
        return sum_by(plain.select(*county, "precinct_id", "candidate", "votes").unionByName(own_rows), [*county, "precinct_id", "candidate"], "votes"), unplaced
    precinct = Window.partitionBy(*county, "precinct_id")
    extra = F.when(F.col("there") > 0, F.col("pool") * F.sum("here").over(precinct) / F.col("there"))
    added = plain.withColumns({"extra": extra, "all": F.sum("votes").over(precinct)})
    return added.select(*county, "precinct_id", "candidate", (F.col("votes") + F.coalesce(F.col("extra") * F.try_divide("votes", "all"), F.lit(0.0))).alias("votes")), unplaced


def _candidate_rows(results: DataFrame, contest: list[str]) -> tuple[DataFrame, DataFrame]:
    """Geographic rows with the county's votes of their candidate added, and the candidates by county.

    Rows: contest, county, precinct_id, candidate, here (own votes), votes (with the spread ones),
    pool (votes of the county's candidates without own ones), there (the county's own votes), and
    party, the candidate's first in the contest, if results have party_group. Both read one shuffle
    of the rows' sums: keys that are null go first and the flag is an aggregate, so that no filter
    reaches one side alone. Windows hold the candidates of a county, or the counties of a candidate.
    """
    county = [*contest, "county"]
    keys = [*county, "candidate"]
    has_party = "party_group" in results.columns
    rows = results.withColumns({"precinct_id": F.concat_ws(" - ", "county", "precinct"), "__loose": is_non_geographic(F.col("precinct"), F.col("county"))})
    for key in (*keys, "__loose"):
        rows = rows.where(F.col(key).isNotNull())
    party = [F.min("party_group").alias("__party")] if has_party else []
    sums = rows.groupBy(*county, "precinct_id", "candidate").agg(F.sum("votes").alias("here"), F.max("__loose").alias("__loose"), *party)

    totals = [F.sum(F.when(~F.col("__loose"), F.col("here"))).alias("own"), F.sum(F.when(F.col("__loose"), F.col("here"))).alias("loose"), F.max("__loose").alias("has_loose")]
    candidates = sums.groupBy(*keys).agg(*totals, *([F.min("__party").alias("party")] if has_party else []))
    candidates = candidates.withColumn("homeless", F.col("has_loose") & ~F.coalesce(F.col("own") > 0, F.lit(False)))
    in_county = Window.partitionBy(*county)
    candidates = candidates.withColumns({"pool": F.sum(F.when(F.col("homeless"), F.col("loose"))).over(in_county), "there": F.sum("own").over(in_county)})
    if has_party:
        candidates = candidates.withColumn("party", F.min("party").over(Window.partitionBy(*contest, "candidate")))

    plain = sums.where("not __loose").join(candidates.select(*keys, "own", "loose", "pool", "there", *(["party"] if has_party else [])), keys)
    votes = F.col("here") + F.coalesce(F.col("loose") * F.try_divide("here", "own"), F.lit(0.0))
    # least() is the candidate's party either way; it keeps the column on this side, so that the shuffle is the same.
    return plain.select(*county, "precinct_id", "candidate", "here", votes.alias("votes"), "pool", "there", *([F.least("__party", "party").alias("party")] if has_party else [])), candidates


def precinct_party_votes(results: DataFrame, contest: list[str] = CONTEST, rules: DataFrame | None = None) -> DataFrame:
    """Precinct rows of three parties, with absentee and early votes spread by candidate.

    A candidate's party is that of the candidate's first row by party name.
    A candidate's part of the county's loose votes is in proportion to the candidate's own, so
    parties are summed before those votes are added.
    """
    rows = override_party(results, rules).withColumn("candidate", canonical_candidate(ticket_head(F.col("candidate"))))
    plain, _ = _candidate_rows(rows, contest)
    keys = [*contest, "county", "precinct_id"]
    group = party_group(F.col("party"))
    parts = [F.sum(F.when(group == p, F.col("votes")).otherwise(0.0)).alias(f"{p}_votes") for p in PARTIES]
    sums = plain.groupBy(*keys).agg(*parts, F.sum("here").alias("here"), F.sum("votes").alias("all"), F.max("pool").alias("pool"), F.max("there").alias("there"))
    extra = F.when(F.col("there") > 0, F.col("pool") * F.col("here") / F.col("there"))
    grown = F.lit(1.0) + F.coalesce(F.try_divide(extra, F.col("all")), F.lit(0.0))
    return sums.select(*keys, *[(F.col(c) * grown).alias(c) for c in VOTES])


def contest_candidates(results: DataFrame, contest: list[str] = CONTEST) -> DataFrame:
    """The leading dem and rep candidate of each contest."""
    rows = results.withColumn("party_group", party_group(F.col("party"))).where("party_group <> 'other'")
    top = top_candidate(rows, [*contest, "party_group"])
    return top.groupBy(*contest).agg(*[F.max(F.when(F.col("party_group") == p, F.col("candidate"))).alias(f"{p}_candidate") for p in ("dem", "rep")])


def county_non_geographic(results: DataFrame, contest: list[str] = CONTEST) -> DataFrame:
    """County rows of the votes that no precinct stands for."""
    return party_columns(results.where(is_non_geographic(F.col("precinct"), F.col("county"))), [*contest, "county"])


def block_weights(crosswalk: DataFrame) -> DataFrame:
    """weight of each block (block, precinct_id, vap) in its precinct; where all have no people, the first block has all."""
    totals = crosswalk.groupBy("precinct_id").agg(F.sum("vap").alias("people"), F.min("block").alias("first_block"))
    rows = crosswalk.join(totals, "precinct_id")
    weight = F.when(F.col("people") > 0, F.try_divide(F.col("vap").cast("double"), F.col("people").cast("double"))).otherwise((F.col("block") == F.col("first_block")).cast("double"))
    return rows.withColumn("weight", weight).drop("first_block")


def _cut(row: str, columns: list[str]) -> dict[str, Column]:
    """Each column of the struct row times the block's part of the people: multiplied before it is divided."""
    people = [F.col(c).cast("decimal(12,0)") for c in ("vap", "people")]
    return {c: F.coalesce(F.try_divide(F.col(f"{row}.{c}") * people[0], people[1]).cast("decimal(26,12)"), F.lit(0).cast("decimal(26,12)")) for c in columns}


def _contests_to_place(precincts: DataFrame, crosswalk: DataFrame, columns: list[str], contest: list[str]) -> DataFrame:
    """(precinct_id, people, largest, contests): once a precinct, its contests with exact votes and with what rounding leaves (__left_...).

    Blocks meet their precinct's list of contests, so that a block with all its contests is one
    row in every shuffle; what is summed over them is summed in each task first.
    """
    people = crosswalk.groupBy("precinct_id").agg(F.sum("vap").alias("people"), F.min_by("block", F.struct(-F.col("vap"), "block")).alias("largest"))
    lists = precincts.groupBy("precinct_id").agg(F.array_sort(F.collect_list(F.struct(*contest, *[F.col(c).cast("decimal(18,6)").alias(c) for c in columns]))).alias("contests"))
    held = people.join(lists, "precinct_id")
    rows = crosswalk.select("precinct_id", "vap").join(held.select("precinct_id", "people", "contests"), "precinct_id").select("precinct_id", "vap", "people", F.posexplode("contests").alias("at", "c"))
    parts = rows.select("precinct_id", "at", "c.*", *[cut.alias(f"__{c}") for c, cut in _cut("c", columns).items()])
    sums = parts.groupBy("precinct_id", "at", *contest, *columns).agg(*[F.sum(f"__{c}").alias(f"__{c}") for c in columns])
    left = sums.groupBy("precinct_id").agg(F.collect_list(F.struct(*contest, *columns, *[(F.col(c) - F.col(f"__{c}")).alias(f"__left_{c}") for c in columns])).alias("contests"))
    return people.join(left, "precinct_id")


def _on_blocks(crosswalk: DataFrame, lists: DataFrame, columns: list[str], contest: list[str], *keep: str) -> DataFrame:
    """Votes of every block in every contest of its precinct, and largest: whether the block took what rounding left. keep: other columns of crosswalk."""
    rows = crosswalk.select("precinct_id", "block", "vap", *keep).join(lists, "precinct_id")
    rows = rows.select("precinct_id", "block", "vap", "people", (F.col("block") == F.col("largest")).alias("largest"), *keep, F.explode("contests").alias("c"))
    votes = [(cut + F.when(F.col("largest"), F.col(f"c.__left_{c}")).otherwise(F.lit(0))).cast("decimal(26,12)").alias(c) for c, cut in _cut("c", columns).items()]
    return rows.select(*[f"c.{k}" for k in contest], "precinct_id", "block", *votes, "largest", *keep)


def shatter(precincts: DataFrame, crosswalk: DataFrame, columns: list[str] = VOTES, contest: list[str] = CONTEST, with_largest: bool = False) -> tuple[DataFrame, DataFrame]:
    """Precinct votes on blocks by people, exactly: each precinct's blocks sum to its votes.

    Decimals are multiplied before they are divided; what rounding leaves goes to the block with
    most people (ties: the first), which column largest marks if with_largest. Returns the
    blocks and an audit (votes, block sum, delta).
    """
    marked = _on_blocks(crosswalk, _contests_to_place(precincts, crosswalk, columns, contest), columns, contest)
    blocks = marked.drop("largest")
    whole = blocks.groupBy(*contest, "precinct_id").agg(*[F.sum(c).alias(f"block_{c}") for c in columns])
    exact = {c: F.col(c).cast("decimal(18,6)") for c in columns}
    audit = precincts.join(whole, [*contest, "precinct_id"]).select(*contest, "precinct_id", *columns, *[F.col(f"block_{c}").cast("double").alias(f"block_{c}") for c in columns], *[(F.col(f"block_{c}") - exact[c]).cast("double").alias(f"delta_{c}") for c in columns])
    return marked if with_largest else blocks, audit


def to_districts(blocks: DataFrame, district_map: DataFrame, columns: list[str] = VOTES, contest: list[str] = CONTEST) -> DataFrame:
    """District sums of block votes in every scope of the map, unrounded."""
    rows = blocks.join(district_map, "block")
    return rows.groupBy(*contest, "scope", "district").agg(*[F.sum(c).cast("double").alias(c) for c in columns])


def shatter_to_districts(precincts: DataFrame, crosswalk: DataFrame, district_map: DataFrame, columns: list[str] = VOTES, contest: list[str] = CONTEST) -> DataFrame:
    """to_districts of shatter's blocks, with the same sums: blocks find their districts before they have contests, so votes of blocks are in no shuffle."""
    to = district_map.groupBy("block").agg(F.collect_list(F.struct("scope", "district")).alias("to"))
    lists = _contests_to_place(precincts, crosswalk, columns, contest)
    rows = _on_blocks(crosswalk.join(to, "block"), lists, columns, contest, "to").select(*contest, *columns, F.explode("to").alias("to"))
    return rows.groupBy(*contest, "to.scope", "to.district").agg(*[F.sum(c).cast("double").alias(c) for c in columns])


def precinct_district_weights(crosswalk: DataFrame, district_map: DataFrame) -> DataFrame:
    """(precinct_id, scope, district, weight): block weights summed, so votes never go through blocks when only districts are asked for."""
    pieces = _pieces(crosswalk.where("precinct_id is not null"), district_map, ["precinct_id"])
    here = Window.partitionBy("precinct_id")
    rows = pieces.withColumns({"total": F.sum(F.when(F.col("whole"), F.col("people"))).over(here), "first_of_all": F.min(F.when(F.col("whole"), F.col("first"))).over(here)})
    alone = (F.col("first") == F.col("first_of_all")).cast("double")
    weight = F.when(F.col("total") > 0, F.try_divide(F.col("people").cast("double"), F.col("total").cast("double"))).otherwise(alone)
    return rows.where(~F.col("whole")).select("precinct_id", "scope", "district", weight.alias("weight"))


def _pieces(crosswalk: DataFrame, district_map: DataFrame, keys: list[str]) -> DataFrame:
    """people and first block by keys, scope and district, and by keys alone (whole), from one pass over the blocks."""
    scope, district = (district_map.schema[c].dataType for c in ("scope", "district"))
    to = district_map.groupBy("block").agg(F.collect_list(F.struct("scope", "district", F.lit(False).alias("whole"))).alias("to"))
    whole = F.array(F.struct(F.lit(None).cast(scope).alias("scope"), F.lit(None).cast(district).alias("district"), F.lit(True).alias("whole")))
    rows = crosswalk.select("block", *keys, "vap").join(to, "block", "left")
    rows = rows.withColumn("to", F.explode(F.when(F.col("to").isNull(), whole).otherwise(F.concat(whole, "to"))))
    return rows.groupBy(*keys, "to.scope", "to.district", "to.whole").agg(F.sum("vap").alias("people"), F.min("block").alias("first"))


def area_shares(crosswalk: DataFrame, district_map: DataFrame, keys: list[str]) -> DataFrame:
    """Share of each district in the people of a county or bucket; none where nobody lives."""
    rows = crosswalk.join(district_map, "block").groupBy(*keys, "scope", "district").agg(F.sum("vap").alias("people"))
    return share_of_group(rows, [*keys, "scope"], "people").where("share is not null").drop("people")


def override_shares(shares: DataFrame, manual: DataFrame, least: float = 0.01) -> DataFrame:
    """County shares replaced by manual ones (scope, county, district, share) for the counties that have any.

    Shares under least go and the rest are scaled to 1; a county left with none has no shares.
    """
    kept = share_of_group(manual.where(F.col("share") >= least), ["scope", "county"], "share", "scaled").select("scope", "county", "district", F.col("scaled").alias("share"))
    listed = manual.select("scope", "county").distinct()
    return shares.join(listed, ["scope", "county"], "left_anti").unionByName(kept.where("share is not null"))


def bucket_of(precinct_id: Column) -> Column:
    return precinct_bucket(F.split_part(precinct_id, F.lit(" - "), F.lit(2)))


def fallback_weights(precincts: DataFrame, matched: DataFrame, county_shares: DataFrame, bucket_shares: DataFrame, scopes: DataFrame) -> DataFrame:
    """Weights of precincts (county, precinct_id) that the map lacks: by bucket where it has people, else by county.

    Every scope is decided by itself; a precinct may be left without (see unallocated).
    """
    lost = precincts.select("county", "precinct_id").distinct().join(matched.select("precinct_id").distinct(), "precinct_id", "left_anti")
    lost = lost.withColumn("bucket", bucket_of(F.col("precinct_id")))
    out = ["precinct_id", "scope", "district", F.col("share").alias("weight")]
    by_bucket = lost.join(bucket_shares.join(scopes, "scope", "left_semi"), ["county", "bucket"]).select(*out, F.lit("bucket").alias("method"))
    by_county = lost.join(county_shares.join(scopes, "scope", "left_semi"), "county").select(*out, F.lit("county").alias("method"))
    by_county = by_county.join(by_bucket.select("precinct_id", "scope").distinct(), ["precinct_id", "scope"], "left_anti").select(by_bucket.columns)
    return by_bucket.unionByName(by_county)


LEVELS = ("map", "bucket", "county")


def _places(county: Column, precinct_id: Column) -> Column:
    """The places that may stand for a precinct: itself (level 0), its bucket (1), its county (2)."""
    bucket = F.concat(county, F.lit("\u0001"), bucket_of(precinct_id))
    levels = [F.struct(F.lit(n).alias("level"), place.alias("place")) for n, place in enumerate((precinct_id, bucket, county))]
    return F.filter(F.array(*levels), lambda level: level["place"].isNotNull())


def place_weights(crosswalk: DataFrame, district_map: DataFrame) -> DataFrame:
    """(level, place, scope, district, weight) of precincts, buckets and counties, from one pass over the blocks.

    Weights of precincts are those of precinct_district_weights, the others those of area_shares.
    A precinct's people count in blocks without a district too. Sums are made to precincts first,
    then to the wider places; windows hold the districts of one place.
    """
    pieces = _pieces(crosswalk, district_map, ["county", "precinct_id"])
    places = F.filter(_places(F.col("county"), F.col("precinct_id")), lambda p: ~F.col("whole") | (p["level"] == 0))
    sums = pieces.withColumn("at", F.explode(places)).groupBy("at.level", "at.place", "scope", "district", "whole").agg(F.sum("people").alias("people"), F.min("first").alias("first"))
    here = Window.partitionBy("level", "place")
    own = F.col("level") == 0
    total = F.when(own, F.sum(F.when(F.col("whole"), F.col("people"))).over(here)).otherwise(F.sum("people").over(Window.partitionBy("level", "place", "scope")))
    rows = sums.withColumns({"total": total, "first_of_all": F.min(F.when(F.col("whole"), F.col("first"))).over(here)})
    alone = F.when(own, (F.col("first") == F.col("first_of_all")).cast("double"))
    weight = F.when(F.col("total") > 0, F.try_divide(F.col("people").cast("double"), F.col("total").cast("double"))).otherwise(alone)
    return rows.withColumn("weight", weight).where(~F.col("whole") & (own | F.col("weight").isNotNull())).select("level", "place", "scope", "district", "weight")


def placed_weights(precincts: DataFrame, crosswalk: DataFrame, district_map: DataFrame) -> DataFrame:
    """(precinct_id, scope, district, weight, method) of precincts (county, precinct_id): by the map, else by bucket, else by county.

    As precinct_district_weights with fallback_weights, in one pass over the blocks: each precinct
    asks for its three places at once and keeps the first that answers. One that the map has
    doesn't fall back in any scope; for others, every scope is decided by itself.
    """
    names = precincts.groupBy("precinct_id").agg(F.min("county").alias("county"))
    asked = names.select("precinct_id", F.inline(_places(F.col("county"), F.col("precinct_id"))))
    found = asked.join(place_weights(crosswalk, district_map), ["level", "place"])
    least = F.min("level").over(Window.partitionBy("precinct_id", "scope"))
    on_map = F.min("level").over(Window.partitionBy("precinct_id")) == 0
    kept = found.withColumns({"least": least, "on_map": on_map}).where((F.col("level") == F.col("least")) & (~F.col("on_map") | (F.col("level") == 0)))
    method = F.element_at(F.array(*[F.lit(name) for name in LEVELS]), F.col("level") + 1)
    return kept.select("precinct_id", "scope", "district", "weight", method.alias("method"))


def allocate(precincts: DataFrame, weights: DataFrame, columns: list[str] = VOTES, contest: list[str] = CONTEST) -> DataFrame:
    """District sums of precinct votes by weights (precinct_id, scope, district, weight), unrounded."""
    rows = precincts.join(weights, "precinct_id")
    return rows.groupBy(*contest, "scope", "district").agg(*[F.sum(F.col(c) * F.col("weight")).alias(c) for c in columns])


def unallocated(precincts: DataFrame, weights: DataFrame, scopes: DataFrame, columns: list[str] = VOTES, contest: list[str] = CONTEST) -> DataFrame:
    """Votes of precincts that no weight places, by scope: with the districts they make up all votes."""
    asked = precincts.crossJoin(F.broadcast(scopes))
    return asked.join(weights.select("precinct_id", "scope").distinct(), ["precinct_id", "scope"], "left_anti").groupBy(*contest, "scope").agg(*[F.sum(c).alias(c) for c in columns])


def coverage(precincts: DataFrame, weights: DataFrame, contest: list[str] = CONTEST) -> DataFrame:
    """By contest and scope: precincts, those that the map has, those that any weight places."""
    placed = weights.groupBy("precinct_id", "scope").agg(F.max(F.when(F.col("method") == "map", 1).otherwise(0)).alias("direct"))
    rows = precincts.select(*contest, "precinct_id").distinct()
    total = rows.groupBy(*contest).agg(F.count("*").alias("total_precincts"))
    hit = rows.join(placed, "precinct_id").groupBy(*contest, "scope").agg(F.sum("direct").alias("matched_precincts"), F.count("*").alias("placed_precincts"))
    return hit.join(total, contest)


def district_results(results: DataFrame, crosswalk: DataFrame, district_map: DataFrame, contest: list[str] = CONTEST, compat_rounding: bool = False) -> DataFrame:
    """What every district of every scope would have voted in every contest: the flagship.

    Absentee votes go to precincts, precincts to districts by people, precincts that the map
    lacks by bucket, then county; rounded once, half to even, at the end. With
    compat_rounding, what the map places and what falls back are rounded each before they are
    added, as in files made so; sums can then be off by a vote.
    """
    precincts = precinct_party_votes(results, contest)
    # The precincts' keys come from the rows themselves: their votes aren't needed to tell which the map lacks.
    named = results.where(~is_non_geographic(F.col("precinct"), F.col("county"))).select("county", F.concat_ws(" - ", "county", "precinct").alias("precinct_id"))
    weights = placed_weights(named, crosswalk, district_map)
    if compat_rounding:
        stages = weights.withColumn("scope", F.struct("scope", (F.col("method") == "map").alias("by_map")))
        parts = allocate(precincts, stages, contest=contest).withColumns({"scope": F.col("scope.scope"), **{c: half_even(F.col(c)) for c in VOTES}})
        return with_measures(sum_by(parts, [*contest, "scope", "district"], *VOTES))
    sums = allocate(precincts, weights, contest=contest)
    return with_measures(sums.withColumns({c: half_even(F.col(c)) for c in VOTES}))


def add_county_pool(districts: DataFrame, pool: DataFrame, county_shares: DataFrame, contest: list[str] = CONTEST, compat_rounding: bool = False) -> DataFrame:
    """District votes plus county votes without a place, by county shares; with compat_rounding both are rounded before they are added."""
    if compat_rounding:
        pool_parts = add_county_pool(districts.where("false"), pool, county_shares, contest)
        both = [rows.select(*contest, "scope", "district", *[half_even(F.col(c)).alias(c) for c in VOTES]) for rows in (districts, pool_parts)]
        return sum_by(both[0].unionByName(both[1]), [*contest, "scope", "district"], *VOTES)
    extra = pool.join(county_shares, "county").groupBy(*contest, "scope", "district").agg(*[F.sum(F.col(c) * F.col("share")).alias(c) for c in VOTES])
    return districts.unionByName(extra).groupBy(*contest, "scope", "district").agg(*[F.sum(c).alias(c) for c in VOTES])


def fallback_diagnostic(precincts: DataFrame, matched: DataFrame, county_shares: DataFrame, contest: list[str] = CONTEST) -> DataFrame:
    """By contest and county: votes of unmatched precincts, and what county shares place or leave in each scope."""
    total = sum(F.col(c) for c in VOTES)
    lost = precincts.join(matched.select("precinct_id").distinct(), "precinct_id", "left_anti").groupBy(*contest, "county").agg(F.sum(total).alias("unmatched_votes"))
    covered = county_shares.groupBy("county").pivot("scope", ["congressional", "state_house", "state_senate"]).agg(F.sum("share"))
    rows = lost.join(covered, "county", "left")
    return rows.select(*contest, "county", "unmatched_votes", *[F.round(F.col("unmatched_votes") * F.coalesce(s, F.lit(0.0)), 4).alias(f"{s}_allocated") for s in ("congressional", "state_house", "state_senate")], *[F.round(F.col("unmatched_votes") * (1 - F.coalesce(s, F.lit(0.0))), 4).alias(f"{s}_left") for s in ("congressional", "state_house", "state_senate")])


def ladder_allocate(rows: DataFrame, splits: DataFrame, fixed: DataFrame | None = None, bucket_before: int = 2016, contest: list[str] = CONTEST, legacy_until: int = 2020, legacy_overwrite: bool = False) -> DataFrame:
    """Key-resolved rows to districts by area weights, with a declared ladder for rows without a split.

    rows: contest, county, key, status and three vote columns. splits: (key, district,
    area_weight). In order: own split; share of the bucket's matched votes (years before
    bucket_before, placed statuses only); share of the county's matched votes; fixed county
    shares (kind non_geo for such rows, then county, then legacy for years up to legacy_until).
    With legacy_overwrite a county's matched votes come before the bucket's, as in files made so.
    Candidates carry a priority and the least one of a row counts: no step looks at another's
    outcome, and both figures of coverage are given. Rows are one a (contest, key). Shares come
    from the sums by county, bucket and district that the own splits make; only rows without a
    split meet them. A bucket or county whose matched votes sum to 0 has no shares.
    """
    total = sum(F.col(c) for c in VOTES)
    lists = splits.groupBy("key").agg(F.collect_list(F.struct("district", F.col("area_weight").alias("weight"))).alias("to"))
    keyed = rows.select(*contest, "county", "key", "status", *VOTES).join(lists, "key", "left")
    bucket = bucket_of(F.col("key"))

    # Outer, and without a filter on the split: so that rows with and without one read the same shuffle.
    own = keyed.select(*contest, "county", bucket.alias("bucket"), "status", *VOTES, "to", F.posexplode_outer("to").alias("pos", "split"))
    first = F.coalesce(F.array_position("to.district", F.col("split.district")) == F.col("pos") + 1, F.lit(True))
    counts = F.when(F.col("to").isNotNull(), first.cast("long"))
    weight = F.col("split.weight")
    matched = F.when((F.col("status") != "non_geographic") & (total > 0), total * weight)
    sums = own.groupBy(*contest, "county", "bucket", F.col("split.district").alias("district")).agg(*[F.sum(F.col(c) * weight).alias(c) for c in VOTES], F.sum(matched).alias("v"), F.sum(counts).alias("direct_rows")).where("direct_rows is not null")

    levels = F.array(F.struct(F.lit(False).alias("by_bucket"), F.lit("").alias("bucket")), F.struct(F.lit(True).alias("by_bucket"), F.col("bucket").alias("bucket")))
    level = [*contest, "county", "by_bucket", "bucket"]
    wide = sums.where("v is not null").select(*contest, "county", "district", "v", F.explode(levels).alias("at")).groupBy(*contest, "county", "at.by_bucket", "at.bucket", "district").agg(F.sum("v").alias("v"))
    # One struct as key: single columns would bring filters that part the shuffles of rows with and without a split.
    at = F.struct(*level)
    shares = wide.select(at.alias("at"), "district", F.try_divide("v", F.sum("v").over(Window.partitionBy(*level))).alias("weight")).where("weight is not null")

    lost = keyed.where("to is null").drop("to").withColumn("bucket", bucket)
    late = F.col("status").isin("unmatched", "ambiguous", "no_county", "bad_key")
    ask = {
        "bucket": (late & (F.col("year") < bucket_before) & (F.col("bucket") != ""), F.struct(F.lit(3 if legacy_overwrite else 1).alias("priority"), F.lit(True).alias("by_bucket"), F.col("bucket").alias("bucket"))),
        "county": (late | (F.col("status") == "non_geographic"), F.struct(F.lit(2).alias("priority"), F.lit(False).alias("by_bucket"), F.lit("").alias("bucket"))),
    }
    asks = F.filter(F.array(*[F.when(when & F.col("county").isNotNull(), to) for when, to in ask.values()]), lambda x: x.isNotNull())
    plain = [*contest, "county", "key", "status", *VOTES]
    out = [*contest, "key", *VOTES, "district", "weight", "priority"]
    steps = [lost.select(*plain, F.inline(asks)).withColumn("at", at).join(shares, "at").select(out)]
    if fixed is not None:
        limits = {"non_geo": (F.col("status") == "non_geographic", 4), "county": (F.lit(True), 5), "legacy": (late & (F.col("year") <= legacy_until), 6)}
        kinds = F.filter(F.array(*[F.when(when, F.struct(F.lit(kind).alias("kind"), F.lit(priority).alias("priority"))) for kind, (when, priority) in limits.items()]), lambda x: x.isNotNull())
        steps.append(lost.select(*plain, F.inline(kinds)).join(fixed.select("county", "kind", "district", F.col("share").alias("weight")), ["county", "kind"]).select(out))
    every = steps[0] if len(steps) == 1 else steps[0].unionByName(steps[1])
    row = [*contest, "key"]
    chosen = every.withColumn("least", F.min("priority").over(Window.partitionBy(*row))).where("priority = least")
    chosen = chosen.withColumn("n", F.row_number().over(Window.partitionBy(*row, "district").orderBy("weight")))
    fallen = chosen.select(*contest, "district", *[(F.col(c) * F.col("weight")).alias(c) for c in VOTES], F.lit(0).cast("long").alias("direct_rows"), (F.col("n") == 1).cast("long").alias("placed_rows"))
    placed = sums.select(*contest, "district", *VOTES, "direct_rows", F.col("direct_rows").alias("placed_rows")).unionByName(fallen)
    return sum_by(placed, [*contest, "district"], *VOTES, "direct_rows", "placed_rows")


def dominant_shares(shares: DataFrame, least: float | None = 0.995) -> DataFrame:
    """County shares where one district has at least least of the county, as all of it; all shares if least is None."""
    if least is None:
        return shares
    return shares.where(F.col("share") >= least).withColumn("share", F.lit(1.0))


def vtd_totals(results: DataFrame, contest: list[str] = CONTEST) -> tuple[DataFrame, DataFrame]:
    """(contest, county, vtd, party_group) sums of rows with a place, and county sums of the others."""
    rows = results.withColumn("party_group", party_group(F.col("party")))
    loose = is_non_geographic(F.col("precinct"))
    geo = sum_by(rows.where(~loose).withColumn("vtd", vtd_code(F.col("precinct"))), [*contest, "county", "vtd", "party_group"], "votes")
    return geo, sum_by(rows.where(loose), [*contest, "county", "party_group"], "votes")


def spread_to_vtds(geo: DataFrame, loose: DataFrame, people: DataFrame | None = None, contest: list[str] = CONTEST) -> DataFrame:
    """County votes on VTDs, by people (county, vtd, vap) where the county has any, else by the party's votes.

    A VTD without a result row gets nothing; its people's part is lost, as the totals show.
    """
    pool = loose.withColumnRenamed("votes", "pool")
    by_votes = share_of_group(geo, [*contest, "county", "party_group"], "votes", "vote_share")
    rows = by_votes.join(pool, [*contest, "county", "party_group"], "left")
    if people is not None:
        part = share_of_group(people, ["county"], "vap", "people_share").where("people_share is not null")
        listed = part.select("county").distinct().withColumn("has_people", F.lit(True))
        rows = rows.join(part.select("county", "vtd", "people_share"), ["county", "vtd"], "left").join(listed, "county", "left")
        share = F.when(F.col("has_people"), F.coalesce("people_share", F.lit(0.0))).otherwise(F.col("vote_share"))
    else:
        share = F.col("vote_share")
    return rows.select(*contest, "county", "vtd", "party_group", (F.col("votes") + F.coalesce(F.col("pool") * share, F.lit(0.0))).alias("votes"))


def vtd_to_district(votes: DataFrame, splits: DataFrame, scales: DataFrame | None = None, contest: list[str] = CONTEST) -> DataFrame:
    """VTD votes by area share (and county scale, 1 where there is none) as district rows of three parties."""
    rows = votes.join(splits, ["county", "vtd"])
    if scales is not None:
        rows = rows.join(scales, [*contest, "county", "party_group"], "left").withColumn("area_share", F.col("area_share") * F.coalesce("scale", F.lit(1.0)))
    sums = [F.sum(F.when(F.col("party_group") == p, F.col("votes") * F.col("area_share")).otherwise(0.0)).alias(f"{p}_votes") for p in ("dem", "rep", "other")]
    return rows.groupBy(*contest, "scope", "district").agg(*sums)


def county_scales(actual: DataFrame, target: DataFrame, contest: list[str] = CONTEST) -> DataFrame:
    """target over actual votes by county and party, 1 where there are none."""
    keys = [*contest, "county", "party_group"]
    rows = target.withColumnRenamed("votes", "target").join(actual.withColumnRenamed("votes", "actual"), keys, "left")
    return rows.select(*keys, F.coalesce(F.try_divide("target", "actual"), F.lit(1.0)).alias("scale"))


def compose_bridge(first: DataFrame, second: DataFrame) -> DataFrame:
    """Two weighted hops (source, middle, weight) and (middle, target, weight) as one, scaled to 1 by source."""
    paths = first.join(second.withColumnRenamed("weight", "weight2"), "middle").groupBy("source", "target").agg(F.sum(F.col("weight") * F.col("weight2")).alias("w"))
    return share_of_group(paths, ["source"], "w", "weight").where("weight is not null").drop("w")


def apply_bridge(votes: DataFrame, bridge: DataFrame, columns: list[str] = VOTES, contest: list[str] = CONTEST) -> DataFrame:
    """Votes of old blocks on new ones."""
    rows = votes.join(bridge, votes["block"] == bridge["source"]).drop("block")
    return rows.groupBy(*contest, F.col("target").alias("block")).agg(*[F.sum(F.col(c) * F.col("weight")).alias(c) for c in columns])


def vintage_probe(ids: DataFrame, lookup: DataFrame, least: float = 0.8) -> DataFrame:
    """The share of distinct ids (block) that a lookup has, and whether they are of its vintage."""
    rows = ids.select("block").distinct().join(lookup.select("block", F.lit(1).alias("hit")).distinct(), "block", "left")
    return rows.agg(F.round(F.avg(F.coalesce("hit", F.lit(0))), 6).alias("hit_share")).withColumn("same_vintage", F.col("hit_share") >= least)


def best_method(candidates: DataFrame, keys: list[str]) -> DataFrame:
    """Of rows tagged with priority and method, those of the least priority by keys."""
    least = candidates.groupBy(*keys).agg(F.min("priority").alias("__least"))
    return candidates.join(least, keys).where("priority = __least").drop("__least")


def block_file_districts(wide: DataFrame, district_map: DataFrame) -> DataFrame:
    """A wide block file (block, E_YY_OFFICE_Total/Dem/Rep) as district rows of every contest that has all three columns."""
    import re

    found: dict[str, set[str]] = {}
    for c in wide.columns:
        if m := re.fullmatch(r"(E_\d\d_\w+)_(Total|Dem|Rep)", c):
            found.setdefault(m[1], set()).add(m[2])
    contests = sorted(c for c, parts in found.items() if len(parts) == 3)
    if not contests:
        raise ValueError("no contest has Total, Dem and Rep columns")
    rows = [F.struct(F.lit(c).alias("contest"), *[F.coalesce(F.col(f"{c}_{p}").cast("double"), F.lit(0.0)).alias(p) for p in ("Total", "Dem", "Rep")]) for c in contests]
    long = wide.select("block", F.explode(F.array(*rows)).alias("r")).select("block", "r.*")
    sums = long.join(district_map, "block").groupBy("contest", "scope", "district").agg(F.sum("Dem").alias("dem_votes"), F.sum("Rep").alias("rep_votes"), F.sum(F.greatest(F.col("Total") - F.col("Dem") - F.col("Rep"), F.lit(0.0))).alias("other_votes"))
    return with_measures(sums)


def direct_contests(results: DataFrame, keys: list[str]) -> DataFrame:
    """Races whose rows name their district: sums, leading candidates, names where there is none, measures."""
    sums = party_columns(results, keys, loose=True)
    rows = results.withColumn("party_group", party_group(F.col("party"), loose=True))
    top = top_candidate(rows.where("party_group <> 'other'"), [*keys, "party_group"])
    names = top.groupBy(*keys).agg(*[F.max(F.when(F.col("party_group") == p, F.col("candidate"))).alias(f"{p}_candidate") for p in ("dem", "rep")])
    out = with_measures(sums.join(names, keys, "left")).where("total_votes > 0")
    return out.withColumns({f"{p}_candidate": candidate_or_default(F.col(f"{p}_candidate"), F.col(f"{p}_votes"), name) for p, name in (("dem", "Democratic"), ("rep", "Republican"))})


def calibrate(districts: DataFrame, stats: DataFrame, keys: list[str]) -> DataFrame:
    """District totals split anew by reference shares (dem_share, rep_share, other_share), whole votes, total kept.

    A district without reference shares keeps its votes (calibrated is false).
    """
    total = sum(F.col(c) for c in VOTES)
    rows = districts.join(stats, keys, "left")
    parts = largest_remainder(total, [F.col(f"{p}_share") for p in ("dem", "rep", "other")])
    has = F.col("dem_share").isNotNull()
    old = F.col("rep_votes") - F.col("dem_votes")
    rows = rows.withColumn("old_margin", old).withColumns({c: F.when(has, x.cast("double")).otherwise(F.col(c)) for c, x in zip(VOTES, parts, strict=True)})
    out = with_measures(rows.withColumn("calibrated", has).drop("dem_share", "rep_share", "other_share"))
    return out.withColumn("margin_delta", F.abs(F.col("margin") - F.col("old_margin"))).drop("old_margin")


def split_precinct(rows: DataFrame, source: str, target: str, share: float, keys: list[str]) -> DataFrame:
    """Rows of precinct source as two, source and target by share, in the groups (keys) that have no target yet."""
    done = rows.where(F.col("precinct_id") == target).select(*keys).distinct().withColumn("__has", F.lit(True))
    tagged = rows.join(done, keys, "left")
    split = (F.col("precinct_id") == source) & F.col("__has").isNull()
    first, second = split_pair(F.col("votes"), F.lit(share))
    parts = F.when(split, F.array(F.struct(F.lit(source).alias("p"), first.cast("double").alias("v")), F.struct(F.lit(target).alias("p"), second.cast("double").alias("v")))).otherwise(F.array(F.struct(F.col("precinct_id").alias("p"), F.col("votes").alias("v"))))
    return tagged.withColumn("__part", F.explode(parts)).withColumns({"precinct_id": F.col("__part.p"), "votes": F.col("__part.v")}).drop("__part", "__has")


def precinct_results(results: DataFrame, keys: list[str]) -> DataFrame:
    """Precinct rows of every contest with leading candidates, total, margin, winner and colour."""
    names = results.withColumn("party_group", party_group(F.col("party"))).groupBy(*keys).agg(*[F.min(F.when(F.col("party_group") == p, F.col("candidate"))).alias(f"{p}_candidate") for p in ("dem", "rep")])
    return with_measures(party_columns(results, keys)).join(names, keys)


def batch_summary(precincts: DataFrame, weights: DataFrame, contest: list[str] = CONTEST) -> DataFrame:
    """By contest and scope: precincts, those placed, coverage, districts reached, votes placed by fallback."""
    total = sum(F.col(c) for c in VOTES)
    rows = precincts.join(weights, "precinct_id")
    reached = rows.groupBy(*contest, "scope").agg(F.count_distinct("district").alias("districts"), F.round(F.sum(F.when(F.col("method") != "map", total * F.col("weight")).otherwise(0.0)), 4).alias("fallback_votes"))
    found = coverage(precincts, weights, contest)
    return found.join(reached, [*contest, "scope"]).withColumn("coverage_pct", F.round(100.0 * F.col("matched_precincts") / F.col("total_precincts"), 2))
