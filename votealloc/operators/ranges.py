"""The first range that holds a value, by equi-joins on buckets of the range's own size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A level's buckets are so many times as wide as those of the level before.
STEP = 4


def first_range(rows: DataFrame, ranges: DataFrame, value: str, by: list[str] | None = None, width: float = 1.0, how: str = "inner") -> DataFrame:
    """rows with the other columns of the first range that holds their value: one range a row, however many overlap.

    ranges: (low, high, place, by..., others), both ends included, null for an open end; the lowest place wins,
    ties go by the ends and the other columns. A range is entered in the two buckets at most
    that it touches at the level whose buckets are as wide as it, a value in one bucket of each level there is, so
    neither narrow nor wide ranges make a nested loop. Distinct values are looked up and joined
    back. how: inner, or left to keep rows that no range holds (null values among them).
    """
    by = by or []
    others = [c for c in ranges.columns if c not in ("low", "high", "place", *by)]
    size = F.greatest(F.col("high") - F.col("low"), F.lit(width)) / width
    level = F.when(F.col("low").isNull() | F.col("high").isNull(), -1).otherwise(F.ceil(F.log(float(STEP), size)).cast("int"))
    # Of ranges with the same ends only the first can be any value's, so no others meet values.
    firsts = ranges.where("low is null or high is null or low <= high").groupBy(*by, "low", "high").agg(F.min(F.struct("place", *others)).alias("__first"))
    entered = firsts.select(*by, "low", "high", "__first.*").withColumn("__level", level)
    wide = F.pow(F.lit(float(STEP)), F.col("__level")) * width
    ends = [F.floor(F.col(c) / wide).cast("long") for c in ("low", "high")]
    entered = entered.withColumn("__bucket", F.explode(F.when(F.col("__level") < 0, F.array(F.lit(0).cast("long"))).otherwise(F.sequence(*ends))))
    levels = sorted(r[0] for r in entered.select("__level").distinct().collect())
    found = rows.select(*by, F.col(value).alias("__value")).where("__value is not null").distinct()
    keys = [F.struct(F.lit(k).alias("__level"), (F.floor(F.col("__value") / (width * STEP**k)).cast("long") if k >= 0 else F.lit(0).cast("long")).alias("__bucket")) for k in levels or [-1]]
    found = found.withColumn("__k", F.explode(F.array(*keys))).select(*by, "__value", "__k.*")
    inside = (F.col("low").isNull() | (F.col("low") <= F.col("__value"))) & (F.col("high").isNull() | (F.col("__value") <= F.col("high")))
    order = F.struct("place", F.coalesce(F.col("low").cast("double"), F.lit(float("-inf"))), F.coalesce(F.col("high").cast("double"), F.lit(float("inf"))), *others)
    hits = found.join(entered, [*by, "__level", "__bucket"]).where(inside).groupBy(*by, "__value").agg(F.min_by(F.struct(*others), order).alias("__r"))
    out = rows.withColumn("__value", F.col(value)).join(hits, [*by, "__value"], how)
    return out.select(*rows.columns, *[F.col(f"__r.{c}").alias(c) for c in others])
