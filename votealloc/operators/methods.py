"""The best of seven ways to bring a contest's votes to districts, chosen by what is there before any votes are read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from votealloc.operators.aggregate import VOTES

#: From the best: votes of blocks; of older files' blocks as they are, or through a bridge of vintages; of precincts
#: by their blocks' people; of voting districts by overlays of two vintages; of counties by their districts' shares.
METHODS = ("block_direct", "legacy_direct", "legacy_bridge", "precinct_shatter", "vtd10_overlay", "vtd00_overlay", "county_share")

#: Reads a method's votes of the given years as district rows (year, office, scope, district, votes).
Source = Callable[[list[int]], DataFrame]


def available(rows: DataFrame, method: str, reached: DataFrame | None = None, on: str = "precinct_id") -> DataFrame:
    """The contests (year, office) that a method has rows for; with reached (on), only those with a row that reaches a district. Votes aren't read."""
    hit = rows if reached is None else rows.join(reached.select(on).distinct(), on, "left_semi")
    return hit.select("year", "office").distinct().withColumn("method", F.lit(method))


def choose_methods(facts: DataFrame, methods: tuple[str, ...] = METHODS) -> DataFrame:
    """(year, office, method) once a contest: the first of methods that facts (year, office, method) has for it; other methods count for nothing."""
    place = F.array_position(F.array(*map(F.lit, methods)), F.col("method"))
    return facts.where(place > 0).groupBy("year", "office").agg(F.min_by("method", place).alias("method"))


def best_results(facts: DataFrame, sources: dict[str, Source], methods: tuple[str, ...] = METHODS) -> DataFrame:
    """District rows of every contest by its chosen method, with the method's name.

    Which years each method serves is found first, from facts alone (a year and a name a row go
    through the driver). A source is only asked for those years, so that partitions of other
    years stay unread, and one that serves none isn't asked at all. Contests of a year that
    went to a better method are taken out by a semi-join on the chosen ones. Without any
    contest the result is empty.
    """
    chosen = choose_methods(facts, methods)
    years: dict[str, list[int]] = {}
    for method, year in sorted(map(tuple, chosen.select("method", "year").distinct().collect())):
        years.setdefault(method, []).append(year)
    if missing := sorted(set(years) - set(sources)):
        raise ValueError(f"no source for {', '.join(missing)}")
    parts = []
    for method in methods:
        if method in years:
            rows = sources[method](years[method]).join(chosen.where(F.col("method") == method).select("year", "office"), ["year", "office"], "left_semi")
            parts.append(rows.select("year", "office", "scope", "district", *[F.col(c).cast("double").alias(c) for c in VOTES]).withColumn("method", F.lit(method)))
    if not parts:
        columns = ["cast(null as int) year", *[f"cast(null as string) {c}" for c in ("office", "scope", "district")], *[f"cast(null as double) {c}" for c in VOTES], "cast(null as string) method"]
        return facts.limit(0).selectExpr(*columns)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
