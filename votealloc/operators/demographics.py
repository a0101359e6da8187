"""Population groups by precinct, district and county."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from votealloc.functions.measures import percent


def precinct_demographics(blocks: DataFrame, groups: list[str], total: str = "vap") -> DataFrame:
    """Sums of groups by precinct_id and their percentages of total (2 digits, 0 where nobody lives); a group that is null everywhere stays null."""
    sums = blocks.groupBy("precinct_id").agg(F.sum(total).alias(total), *[F.sum(g).alias(g) for g in groups])
    return sums.withColumns({f"{g}_pct": F.when(F.col(g).isNotNull(), F.round(percent(F.col(g), F.col(total)), 2)) for g in groups})


def district_demographics(people: DataFrame, crosswalk: DataFrame, labels: DataFrame, groups: list[str], total: str = "vap") -> DataFrame:
    """Values of areas (key) by area weight on districts; a row for each label, 0 where no area reaches it."""
    rows = people.join(crosswalk, "key").groupBy(F.col("district").cast("int").alias("number")).agg(*[F.sum(F.col(c) * F.col("area_weight")).alias(c) for c in [total, *groups]])
    out = labels.select("district", F.col("district").try_cast("int").alias("number")).join(rows, "number", "left").drop("number")
    pct = {f"{g}_pct": F.round(percent(F.col(g), F.col(total)), 1) for g in groups}
    return out.select("district", F.bround(F.coalesce(total, F.lit(0.0)), 0).cast("long").alias("total_population"), *[c.alias(n) for n, c in pct.items()])


def county_demographics(counts: DataFrame, groups: list[str], total: str) -> DataFrame:
    """Counts with their percentages of the county's total."""
    return counts.withColumns({f"{g}_pct": F.round(percent(F.col(g), F.col(total)), 2) for g in groups})


def plurality_group(rows: DataFrame, groups: list[str], tie: float = 1.0) -> DataFrame:
    """The group with the largest share: mixed if the next is within tie points, none if no group has any. tie is our own default."""
    ordered = F.reverse(F.array_sort(F.filter(F.array(*[F.struct(F.col(f"{g}_pct").alias("pct"), F.lit(g).alias("name")) for g in groups]), lambda x: x["pct"].isNotNull())))
    first, second = F.get(ordered, 0), F.get(ordered, 1)
    label = F.when(first.isNull() | (first["pct"] <= 0), "no data").when(second.isNotNull() & (first["pct"] - second["pct"] < tie), "mixed").otherwise(first["name"])
    return rows.withColumn("plurality", label)
