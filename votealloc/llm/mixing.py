"""Mixing sources to target weights by hash thresholds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from votealloc.llm.shared import discard, free_name, materialise

WORD = r"[^\x20\x09-\x0D]+"
HASH_BITS = 60
#: Bits of the hash that each refinement of the histogram looks at.
LEVEL_BITS = (16, 16, 14, 14)
#: Tables of this many sources at most are broadcast (a row is some tens of bytes); larger ones are joined by shuffle.
BROADCAST_SOURCES = 20_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unit_hash(key: Column) -> Column:
    """60 bits of the MD5 of the key's text; null as the empty text."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, HASH_BITS // 4), 16, 10).cast("long")


def _small(df: DataFrame) -> DataFrame:
    """Broadcast df if it has BROADCAST_SOURCES rows at most."""
    return F.broadcast(df) if df.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES else df


def targets(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """sources (source, source_size), one row a source, with target: shares of all sizes by weight.

    Sources in code point order, null last, take the weights in turn. No target exceeds most
    times the source's size; what is above goes to the others by weight until none is above.
    The windows here are over one row a source.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    cycle = F.element_at(F.array(*[F.lit(w) for w in weights]), ((rank - 1) % len(weights) + 1).cast("int"))
    rows = sources.withColumn("weight", cycle).withColumn("most", F.col("source_size") * most)
    everything = Window.partitionBy()
    before = Window.orderBy((F.col("most") / F.col("weight")), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({
        "all_size": F.sum("source_size").over(everything),
        "all_weight": F.sum("weight").over(everything),
        "full_before": F.coalesce(F.sum("most").over(before), F.lit(0)),
        "weight_before": F.coalesce(F.sum("weight").over(before), F.lit(0)),
    })
    level = (F.col("all_size") - F.col("full_before")).cast("double") / (F.col("all_weight") - F.col("weight_before")).cast("double")
    rows = rows.withColumn("capped", F.col("most").cast("double") / F.col("weight") < level)
    full = F.sum(F.when(F.col("capped"), F.col("most")).otherwise(0)).over(everything)
    used = F.sum(F.when(F.col("capped"), F.col("weight")).otherwise(0)).over(everything)
    rest = F.try_divide((F.col("all_size") - full).cast("double"), (F.col("all_weight") - used).cast("double"))
    return rows.select("source", "source_size", F.when(F.col("capped"), F.col("most").cast("double")).otherwise(rest * F.col("weight")).alias("target"))


def hash_cuts(sized: DataFrame, budgets: DataFrame) -> DataFrame:
    """For each (source, part, budget): cut, such that rows with h < cut have sizes summing to about budget.

    Sums sizes by source and hash bucket, walks the sums to the bucket where the budget ends,
    and refines only that bucket, with the next bits. At the last bit the bucket is one hash
    value; it is taken if that comes nearer. Cuts of one source are nested: a smaller budget's
    rows are among a larger one's. No row is sorted; windows run over at most 65,536 sums of a
    (source, part).
    """
    state = budgets.select("source", "part", F.col("budget").cast("double").alias("budget"), F.lit(0).cast("long").alias("below"), F.lit(0).cast("long").alias("prefix"))
    shift = HASH_BITS
    ended = None
    for bits in LEVEL_BITS:
        open_bucket = _small(state.withColumnsRenamed({"source": "of", "prefix": "at"}))
        rows = sized.join(open_bucket, F.col("source").eqNullSafe(F.col("of")) & (F.shiftright("h", shift) == F.col("at")))
        shift -= bits
        sums = rows.groupBy("of", "part", "budget", "below", F.shiftright("h", shift).alias("bucket")).agg(F.sum("size").alias("in_bucket"))
        walk = Window.partitionBy("of", "part").orderBy("bucket")
        walked = sums.withColumn("upto", F.col("below") + F.sum("in_bucket").over(walk))
        over = walked.where("upto > budget").groupBy("of", "part").agg(F.min_by(F.struct("budget", "bucket", "in_bucket", "upto"), "bucket").alias("at"))
        state = materialise(over.select(F.col("of").alias("source"), "part", "at.budget", (F.col("at.upto") - F.col("at.in_bucket")).alias("below"), F.col("at.bucket").alias("prefix"), F.col("at.upto").alias("upto")), "mix-cuts")
        ended = state
        state = state.drop("upto")
    nearer = F.col("upto") - F.col("budget") <= F.col("budget") - F.col("below")
    cuts = ended.select("source", "part", F.when(nearer, F.col("prefix") + 1).otherwise(F.col("prefix")).alias("cut"))
    every = budgets.alias("b").join(cuts.alias("c"), F.col("b.source").eqNullSafe(F.col("c.source")) & (F.col("b.part") == F.col("c.part")), "left")
    return every.select("b.source", "b.part", F.coalesce("cut", F.lit(1 << HASH_BITS)).alias("cut"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """How often each document is taken so that sources meet their target weights.

    Returns docs with, appended (underscores are added to a name that docs has already): size
    (words of the text), source_size, target (of its source), taken (words the mix takes: the
    size times 0 to most copies). Every row of a source is taken floor(target / source_size)
    times, and rows whose hash is under the source's cut once more.

    Null text has size 0; a null source is a source of its own, the last one. The hash is of
    doc_id alone, so runs agree; rows that repeat a doc_id are taken alike. A source of size 0
    has target 0. An empty table gives no rows. One source may hold most rows: only sums by
    source and bucket are shuffled.
    """
    sized = docs.select(docs[source_col].cast("string").alias("source"), word_count(docs[text_col]).alias("size"), unit_hash(docs[id_col]).alias("h"))
    sized = materialise(sized, "mix-sized")
    table = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    table = table.withColumn("whole", F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)))
    table = materialise(table.withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size")), "mix-targets")
    cuts = hash_cuts(sized, table.where("budget > 0").select("source", F.lit(0).alias("part"), "budget"))
    named = cuts.select(F.col("source").alias("of"), "cut")
    table = table.join(named, F.col("source").eqNullSafe(F.col("of")), "left").select("source", "source_size", "target", "whole", F.coalesce("cut", F.lit(0)).alias("cut"))
    table = materialise(table, "mix-plan")
    discard(sized)

    out, names = docs, {}
    for wanted in ("size", "source_size", "target", "taken"):
        names[wanted] = name = free_name(out, wanted)
        out = out.withColumn(name, word_count(docs[text_col]) if wanted == "size" else F.lit(None).cast("double" if wanted == "target" else "long"))
    plan = free_name(out, "plan")
    of = {c: F.col(f"`{plan}`.{c}") for c in table.columns}
    out = out.join(_small(table.select(F.struct(*table.columns).alias(plan))), docs[source_col].cast("string").eqNullSafe(of["source"]), "left")
    copies = of["whole"] + (unit_hash(docs[id_col]) < of["cut"]).cast("long")
    return out.withColumns({names["source_size"]: of["source_size"], names["target"]: of["target"], names["taken"]: F.col(f"`{names['size']}`") * copies}).drop(plan)


#: The query's rows in DuckDB: the same targets; the cut is found by sorting hashes.
MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, 3 * sum(size)::BIGINT AS most,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM sized GROUP BY source),
walked AS (
  SELECT *, sum(source_size) OVER () AS all_size, sum(weight) OVER () AS all_weight,
         coalesce(sum(most) OVER w, 0) AS full_before, coalesce(sum(weight) OVER w, 0) AS weight_before
  FROM sources WINDOW w AS (ORDER BY most::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
capped AS (
  SELECT *, most::DOUBLE / weight < (all_size - full_before)::DOUBLE / (all_weight - weight_before)::DOUBLE AS is_capped FROM walked),
rests AS (
  SELECT *, (all_size - sum(CASE WHEN is_capped THEN most ELSE 0 END) OVER ())::DOUBLE
            / nullif(all_weight - sum(CASE WHEN is_capped THEN weight ELSE 0 END) OVER (), 0)::DOUBLE AS rest FROM capped),
plan AS (
  SELECT source, source_size, CASE WHEN is_capped THEN most::DOUBLE ELSE rest * weight END AS target FROM rests),
plan2 AS (
  SELECT *, coalesce(floor(target / nullif(source_size, 0)), 0)::BIGINT AS whole FROM plan),
plan3 AS (
  SELECT *, target - whole * source_size AS budget FROM plan2),
ordered AS (
  SELECT d.doc_id, d.size, d.h, p.source_size, p.target, p.whole, p.budget,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
         sum(d.size) OVER (PARTITION BY d.source, d.h) AS here
  FROM sized d JOIN plan3 p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
       (size * (whole + CASE WHEN budget > 0 AND (upto <= budget OR (upto - here <= budget AND upto - budget <= budget - (upto - here))) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM ordered
"""
