"""Places of rows within groups of any size, and whole votes by largest remainder over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from votealloc.sources.scratch import written


def positions(rows: DataFrame, keys: list[str], order: list[Column], name: str = "position") -> DataFrame:
    """rows with 0, 1, 2... among those of the same keys, by order.

    One sort by ranges, written once; a row's place is its number in its part plus the rows of
    its group in earlier parts, so a group is never one task's. Windows run over one row for each
    part and group.
    """
    lined = written(rows.orderBy(*keys, *order).withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftright("__at", 33)
    groups = lined.groupBy(part.alias("__part"), *keys).agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    shifts = groups.select("__part", *[F.col(k).alias(f"__of_{k}") for k in keys], (F.coalesce(before, F.lit(0)) - F.col("__first")).alias("__shift"))
    same = part == F.col("__part")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__of_{k}"))
    return lined.join(shifts, same).withColumn(name, F.col("__at") + F.col("__shift")).select(*rows.columns, name)


def apportion(rows: DataFrame, keys: list[str], exact: str, total: str, order: list[Column], name: str) -> DataFrame:
    """rows with whole parts of their group's total: floors of exact, and one more for the largest fractions, ties by order.

    exact is each row's part as it would be (9 digits count), total a whole number, the same in
    all rows of a group and about the sum of exact. Rows are neither gathered nor sorted by group.
    """
    value = F.round(F.col(exact), 9)
    cut = rows.withColumns({"__floor": F.floor(value).cast("long"), "__fraction": F.round(value - F.floor(value), 9)})
    left = cut.groupBy(*keys).agg((F.max(total).cast("long") - F.sum("__floor")).alias("__left"))
    placed = positions(cut, keys, [F.col("__fraction").desc(), *order], "__place").join(left, keys)
    return placed.withColumn(name, F.col("__floor") + (F.col("__place") < F.col("__left")).cast("long")).select(*rows.columns, name)
