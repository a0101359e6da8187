"""Precinct keys of result files resolved to the keys of maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from votealloc.functions import keys as K
from votealloc.sources.scratch import remove, written


#: The forms of codes that rules look for.
NUMBER = r"^0*([0-9]{1,4})([A-Z]?)$"
NUMBER_OR_FIRST_PART = r"^0*([0-9]+)(?:-1)?$"
PLAIN_CODE = "^[A-Z0-9]+$"
WAKE_PAIR = r"\b(\d{2}-\d{2})\b"

#: Kinds of rules, the first ones first.
KINDS = ("manual", "auto")


def _of_any_year(year: Column) -> Column:
    return F.trim(F.coalesce(year, F.lit(""))).isin("", "*")


def _rank(rules: DataFrame) -> Column:
    """The order in which rules for one key come: of the year, manual, by place; what is left ties by name."""
    kind = F.col("kind") if "kind" in rules.columns else F.lit(None).cast("string")
    place = F.col("place").cast("double") if "place" in rules.columns else F.lit(0.0)
    later = F.when(kind == KINDS[-1], 1).otherwise(0)
    return F.struct(_of_any_year(F.col("year")).cast("int").alias("any"), later.alias("kind"), F.coalesce(place, F.lit(float("inf"))).alias("place"), F.col("canonical").alias("name"))


def load_overrides(rules: DataFrame, year: int) -> DataFrame:
    """(raw, canonical) of a year, once a key: from rules (year, raw, canonical) of that year or of all (blank, null or *).

    Where several rules fit a key, one of the year comes before one of all years, manual (kind)
    before auto, the lower place before the higher, then the first canonical key. kind and
    place are optional columns. Rules with a null key go.
    """
    rows = rules.where((_of_any_year(F.col("year")) | (F.trim("year") == str(year))) & F.col("raw").isNotNull() & F.col("canonical").isNotNull())
    rows = rows.withColumns({"raw": K.norm(F.col("raw")), "canonical": K.norm(F.col("canonical"))})
    return rows.groupBy("raw").agg(F.min_by("canonical", _rank(rows)).alias("canonical"))


def rules_by_year(rules: DataFrame, years: DataFrame) -> DataFrame:
    """(year, raw, canonical) once a year and key, of the given years (year): each year's own rules and those of all years, by precedence.

    Rules: year, raw, canonical; kind (manual or auto) and place are optional.
    """
    rules = rules.where("raw is not null and canonical is not null")
    rules = rules.withColumn("rank", _rank(rules)).select("year", "raw", "canonical", "rank")
    own = rules.where(~_of_any_year(F.col("year"))).select(F.trim("year").try_cast("int").alias("year"), "raw", "canonical", "rank").join(years, "year", "left_semi")
    always = rules.where(_of_any_year(F.col("year"))).select(F.lit(1).alias("one"), "raw", "canonical", "rank")
    every = years.select("year", F.lit(1).alias("one")).join(always, "one").select("year", "raw", "canonical", "rank")
    return own.unionByName(every).groupBy("year", "raw").agg(F.min_by("canonical", "rank").alias("canonical"))


def follow_overrides(rules: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Rules (year, raw, canonical, one a year and key) as (year, raw, canonical) with canonical where their chains end.

    With known (precinct_id: the keys of the map), a rule holds only where its key isn't known,
    and a chain ends at the first known key; one that ends elsewhere is left out. A chain that
    never ends, as a pair in both directions, is left out too, so two keys never swap. Each
    round jumps twice as far as the last; rounds stop when one ends no more chains.
    """
    keys = ["year", "raw"]
    edges = rules.select(*keys, F.col("canonical").alias("to")).where("raw <> to")
    ends = None
    if known is not None:
        ends = known.select(F.col("precinct_id").alias("to")).distinct()
        edges = edges.join(ends.withColumnRenamed("to", "raw"), "raw", "left_anti")
    jumps, endless = written(edges), None
    while True:
        onward = jumps.select("year", F.col("raw").alias("to"), F.col("to").alias("further"))
        ahead = jumps.join(onward, ["year", "to"], "left").select(*keys, F.coalesce("further", "to").alias("to"), F.col("further").isNotNull().alias("open"))
        further = written(ahead)
        remove(jumps)
        still = further.where("open").count()
        if still in (0, endless):
            break
        jumps, endless = further, still
    found = further.where("not open").select(*keys, F.col("to").alias("canonical"))
    return found if ends is None else found.join(ends.withColumnRenamed("to", "canonical"), "canonical", "left_semi").select(*keys, "canonical")


def apply_overrides(rows: DataFrame, rules: DataFrame, key: str = "precinct_id", known: DataFrame | None = None) -> DataFrame:
    """rows (year, key) with keys replaced by rules (year, raw, canonical; optional kind, place): one key a row, so no vote is lost or counted twice.

    Rules of the row's year come before those of all years (see rules_by_year), chains are
    followed to their end, and with known, keys of the map stay (see follow_overrides).
    """
    years = rows.select("year").where("year is not null").distinct()
    found = follow_overrides(rules_by_year(rules, years), known).withColumnsRenamed({"raw": key, "canonical": "__canonical"})
    return rows.join(found, ["year", key], "left").withColumn(key, F.coalesce("__canonical", key)).drop("__canonical")


def auto_overrides(raw: DataFrame, canonical: DataFrame, official: DataFrame | None = None) -> DataFrame:
    """(precinct_id, canonical_id, rule) for raw keys that a rule maps to a key that exists; the first rule that fits.

    raw, canonical: precinct_id as COUNTY - CODE. official: (county, label, code) of the state
    board. Rules: 1 official label; 2 county alias; 3 clean-up of the label; 4 without a final A;
    5 n or n-1 as nA; 6 X as X-1; 7 other zero-padding, 8 same letters and digits, 9 the only one
    that begins with them (three at least); 7 to 9 only where one key fits. Candidates of all
    rules are rows, checked by one semi-join, so distinct keys decide and no rule waits for another.
    """
    known = canonical.select(K.norm(F.col("precinct_id")).alias("id")).distinct()
    part = lambda x, i: F.trim(F.split_part(x, F.lit(" - "), F.lit(i)))
    keys = raw.select(K.norm(F.col("precinct_id")).alias("raw")).distinct().where(F.col("raw").contains(" - "))
    keys = keys.join(known, F.col("raw") == F.col("id"), "left_anti").select("raw", part(F.col("raw"), 1).alias("county"), part(F.col("raw"), 2).alias("p"))
    p, county = F.col("p"), F.col("county")
    n, suffix = F.regexp_extract(p, NUMBER, 1).try_cast("int"), F.regexp_extract(p, NUMBER, 2)
    one = F.regexp_extract(p, NUMBER_OR_FIRST_PART, 1).try_cast("bigint").cast("string")
    cleaned = K.clean_precinct(p, county)
    guesses = [
        (2, K.county_alias(p, county)),
        (3, F.when(cleaned != p, cleaned)),
        (4, F.when(p.endswith("A"), F.substring(p, F.lit(1), F.length(p) - 1))),
        (5, F.when(p.rlike(NUMBER_OR_FIRST_PART), F.concat(one, F.lit("A")))),
        (6, F.when(p.rlike(PLAIN_CODE), F.concat(p, F.lit("-1")))),
        *[(7, F.when(p.rlike(NUMBER), F.concat(K.pad_number(n, width), suffix))) for width in (1, 2, 3, 4)],
    ]
    rows = keys.select("raw", "county", F.explode(F.array(*[F.struct(F.lit(rule).alias("rule"), code.alias("code")) for rule, code in guesses])).alias("g")).select("raw", "county", "g.*")
    if official is not None:
        listed = official.select(K.norm(F.col("county")).alias("county"), K.norm_spaces(F.col("label")).alias("label"), F.col("code"))
        by_label = keys.withColumn("label", K.norm_spaces(p)).join(listed, ["county", "label"]).select("raw", "county", F.lit(1).alias("rule"), K.norm(F.col("code")).alias("code"))
        rows = rows.unionByName(by_label)
    direct = rows.where(F.col("code").isNotNull()).select("raw", "rule", F.concat_ws(" - ", "county", "code").alias("id")).join(known, "id", "left_semi")
    tokens = known.select("id", part(F.col("id"), 1).alias("county"), K.compact(part(F.col("id"), 2)).alias("token")).where("token <> ''")
    short = keys.withColumn("token", K.compact(p)).where("token <> ''")
    same = short.join(tokens, ["county", "token"]).select("raw", F.lit(8).alias("rule"), "id")
    head = lambda c: F.substring(c, 1, 3).alias("head")
    longer = tokens.select("county", head("token"), F.col("token").alias("longer"), "id")
    begins = short.where(F.length("token") >= 3).select("*", head("token")).join(longer, ["county", "head"]).where(F.col("longer").startswith(F.col("token"))).select("raw", F.lit(9).alias("rule"), "id")
    found = direct.unionByName(same).unionByName(begins).distinct()
    alone = found.groupBy("raw", "rule").agg(F.count("*").alias("n"), F.min("id").alias("canonical_id")).where("rule < 7 or n = 1")
    return alone.groupBy(F.col("raw").alias("precinct_id")).agg(F.min_by("canonical_id", "rule").alias("canonical_id"), F.min("rule").alias("rule"))


def alias_index(features: DataFrame) -> DataFrame:
    """(county, alias, canonical) from features (county, code, description): every form of code, description and both, once a distinct feature."""
    distinct = features.select(*[K.norm(F.col(c)).alias(c) for c in ("county", "code", "description")]).distinct()
    county, code, description = (F.col(c) for c in distinct.columns)
    texts = F.array(code, description, F.concat_ws("_", code, description), F.concat_ws(" ", code, description))
    rows = distinct.select("county", F.concat_ws(" - ", county, code).alias("canonical"), F.explode(texts).alias("text")).distinct()
    return rows.select("county", F.explode(K.alias_variants(F.col("text"))).alias("alias"), "canonical").distinct()


def _feature_forms(more: DataFrame, *keep: str) -> DataFrame:
    """(keep, county, feature, alias): every form of the code, the name and both, of features (county, code, name)."""
    texts = F.array(K.norm(F.col("code")), K.norm(F.col("name")), F.concat_ws(" ", K.norm(F.col("code")), K.norm(F.col("name"))))
    distinct = more.select(*keep, K.norm(F.col("county")).alias("county"), "code", "name").distinct()
    rows = distinct.select(*keep, "county", F.struct("code", "name").alias("feature"), F.explode(texts).alias("text"))
    return rows.select(*keep, "county", "feature", F.explode(K.alias_variants(F.col("text"))).alias("alias")).distinct()


def _new_aliases(forms: DataFrame, hits: DataFrame) -> DataFrame:
    """(county, alias, canonical): forms of the features whose hits name one canonical key, where one such key has the form."""
    owner = hits.groupBy("county", "feature").agg(F.count_distinct("canonical").alias("n"), F.min("canonical").alias("canonical")).where("n = 1").drop("n")
    fresh = forms.join(owner, ["county", "feature"]).select("county", "alias", "canonical").distinct()
    return fresh.groupBy("county", "alias").agg(F.count("*").alias("n"), F.min("canonical").alias("canonical")).where("n = 1").drop("n")


def enrich_alias_index(index: DataFrame, more: DataFrame) -> DataFrame:
    """New aliases of more (county, code, name) that point to exactly one canonical key, to add to index.

    A feature belongs to the keys that its code or name already stands for. All features are
    judged against the index as it was, so their order doesn't matter.
    """
    forms = _feature_forms(more)
    return _new_aliases(forms, forms.join(index, ["county", "alias"])).join(index.select("county", "alias"), ["county", "alias"], "left_anti")


def grow_alias_index(index: DataFrame, vintages: list[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """New aliases (pass, county, alias, canonical) of vintages (county, code, name) in turn, and how many each pass (from 1) added.

    A pass judges its features against the index and what earlier passes added, as
    enrich_alias_index does. The index is joined once, with the forms of all vintages; after
    that, a pass joins only the few aliases that passes before it added. Each pass's aliases are
    written, so plans don't grow.
    """
    tagged = [v.select(F.lit(n).alias("pass"), "county", "code", "name") for n, v in enumerate(vintages, 1)]
    every = tagged[0]
    for more in tagged[1:]:
        every = every.unionByName(more)
    forms = written(_feature_forms(every, "pass"))
    at_first = written(forms.join(index, ["county", "alias"]).select("pass", "county", "feature", "canonical", "alias"))
    # Aliases that the index has already are known by the first join.
    known = at_first.select("county", "alias").distinct()
    added = None
    for n in range(1, len(vintages) + 1):
        own, hits = forms.where(F.col("pass") == n).drop("pass"), at_first.where(F.col("pass") == n).select("county", "feature", "canonical")
        old = known
        if added is not None:
            hits = hits.unionByName(own.join(added, ["county", "alias"]).select("county", "feature", "canonical"))
            old = known.unionByName(added.select("county", "alias"))
        fresh = written(_new_aliases(own, hits).join(old, ["county", "alias"], "left_anti").select(F.lit(n).alias("pass"), "county", "alias", "canonical"))
        added = fresh if added is None else added.unionByName(fresh)
    counts = added.groupBy("pass").agg(F.count("*").alias("added"))
    passes = added.sparkSession.range(1, len(vintages) + 1).select(F.col("id").cast("int").alias("pass"))
    return added, passes.join(counts, "pass", "left").select("pass", F.coalesce("added", F.lit(0).cast("long")).alias("added"))


def resolve_keys(keys: DataFrame, index: DataFrame) -> DataFrame:
    """(key, canonical, status) of distinct keys: bad_key, non_geographic, no_county, matched, ambiguous, unmatched."""
    # A count that is asked for keeps the keys' own aggregation: a mere distinct() would be dropped as one with the next, and the tests made on every row.
    # Named by that count, so that no filter on what is made from a key goes below: both uses of the keys read them by the same plan, once.
    distinct = keys.groupBy("key").agg(F.count("*").alias("rows")).where("rows > 0").select(F.when(F.col("rows") > 0, F.col("key")).alias("key"))
    rows = distinct.withColumn("county", K.norm(F.split_part("key", F.lit(" - "), F.lit(1)))).withColumn("p", K.norm(F.split_part("key", F.lit(" - "), F.lit(2))))
    # As results of an aggregation the two tests stay here: pushed below distinct(), they would be spelled out in terms of what keys is made from.
    tests = [F.bool_or(F.col("key").contains(" - ")).alias("good"), F.bool_or(K.is_non_geographic(F.col("p"), F.col("county"), "lines")).alias("loose")]
    rows = rows.groupBy("key", "county", "p").agg(*tests)
    good, loose = F.col("good"), F.col("loose")
    wake = F.when(F.col("county") == "WAKE", K.part(F.col("p"), WAKE_PAIR))
    rows = rows.withColumn("p", F.coalesce(wake, "p"))
    forms = rows.where(good & ~loose).select("key", "county", F.explode(K.alias_variants(F.col("p"))).alias("alias"))
    hits = forms.join(index, ["county", "alias"]).groupBy("key").agg(F.count_distinct("canonical").alias("n"), F.min("canonical").alias("one"))
    counties = index.select("county").distinct().withColumn("known", F.lit(True))
    out = rows.join(hits, "key", "left").join(counties, "county", "left")
    status: Column = F.when(~good, "bad_key").when(F.col("loose"), "non_geographic").when(F.col("known").isNull(), "no_county").when(F.col("n") == 1, "matched").when(F.col("n") > 1, "ambiguous").otherwise("unmatched")
    return out.select("key", F.when(status == "matched", F.col("one")).alias("canonical"), status.alias("status"))


def bridge_to_vtd(canonical: DataFrame, overlaps: DataFrame) -> DataFrame:
    """canonical keys (precinct_id) with the VTD of their largest overlap (precinct_id, vtd, area)."""
    best = overlaps.groupBy("precinct_id").agg(F.min_by("vtd", F.struct(-F.col("area"), "vtd")).alias("vtd"))
    return canonical.join(best, "precinct_id", "left")


def two_way(pairs: DataFrame) -> DataFrame:
    """Bridge pairs (county, a, b, both) as override rows; pairs with both hold in either direction.

    Given to apply_overrides with the map's keys, only the direction towards a known key holds.
    """
    rows = pairs.select("county", F.col("a").alias("raw"), F.col("b").alias("canonical"))
    back = pairs.where("both").select("county", F.col("b").alias("raw"), F.col("a").alias("canonical"))
    return rows.unionByName(back).select(F.lit("*").alias("year"), F.concat_ws(" - ", "county", "raw").alias("raw"), F.concat_ws(" - ", "county", "canonical").alias("canonical"))
