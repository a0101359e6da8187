"""Chat formatting: collapse of cumulative snapshots, then rendering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"


def _turn_hash(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), "role", "text", F.col("role").isNull(), F.col("text").isNull())


def maximal_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Logged conversations that no longer one begins with, rendered: conv_id, n_turns, text.

    Turns are ordered by turn (null last; ties by a hash of role and text). Conversation A goes
    if the turns of another one, B, begin with all of A's, same roles and texts; of equal ones
    the smallest conv_id stays. A rendered turn is <|im_start|>role, line feed, text,
    <|im_end|>, line feed; null role or text is empty there (but differs from empty in
    comparisons).

    Method: the rolling prefix hash after turn i is the running xor of two 64-bit hashes of
    (i, role, text); full hashes are anti-joined with the distinct proper prefixes' hashes, so
    a first turn that very many conversations share is one row. Only hashes move until texts of
    conversations that stay are brought together, once, for rendering.

    Rows with null conv_id are conversations of one turn each (equal ones are one). Repeated
    rows are turns of their own. One conversation's turns are one value in the end, so they must
    fit a task.
    """
    rows = turns.select(turns[conv_col].alias("conv_id"), turns[turn_col].alias("turn"), turns[role_col].cast("string").alias("role"), turns[text_col].cast("string").alias("text"))
    hashed = rows.select("conv_id", "turn", _turn_hash(1).alias("one"), _turn_hash(2).alias("two"))
    named = hashed.where("conv_id is not null")
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), "one", "two")
    ranked = named.select("conv_id", "one", "two", F.row_number().over(order).alias("i"), F.lead(F.lit(1)).over(order).isNull().alias("is_last"))
    running = Window.partitionBy("conv_id").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    rolled = ranked.select("conv_id", "i", "is_last", F.bit_xor(F.xxhash64("i", "one")).over(running).alias("h1"), F.bit_xor(F.xxhash64("two", "i")).over(running).alias("h2"))
    prefixes = rolled.where("not is_last").select("i", "h1", "h2").distinct()
    single = hashed.where("conv_id is null").select("conv_id", F.lit(1).alias("i"), F.xxhash64(F.lit(1), "one").alias("h1"), F.xxhash64("two", F.lit(1)).alias("h2"))
    full = rolled.where("is_last").select("conv_id", "i", "h1", "h2").unionByName(single)
    kept = full.groupBy("i", "h1", "h2").agg(F.min("conv_id").alias("conv_id")).join(prefixes, ["i", "h1", "h2"], "left_anti")

    turn_text = F.concat(F.lit(START), F.coalesce("role", F.lit("")), F.lit("\n"), F.coalesce("text", F.lit("")), F.lit(END + "\n"))
    lines = rows.where("conv_id is not null").join(kept.where("conv_id is not null").select("conv_id"), "conv_id", "left_semi")
    lines = lines.select("conv_id", F.struct(F.col("turn").isNull().alias("no_turn"), "turn", _turn_hash(1).alias("one"), _turn_hash(2).alias("two"), turn_text.alias("line")).alias("at"))
    whole = lines.groupBy("conv_id").agg(F.count("*").alias("n_turns"), F.array_sort(F.collect_list("at")).alias("ats"))
    out = whole.select("conv_id", "n_turns", F.array_join(F.transform("ats", lambda x: x["line"]), "").alias("text"))
    lone = rows.where("conv_id is null").withColumns({"h1": F.xxhash64(F.lit(1), _turn_hash(1)), "h2": F.xxhash64(_turn_hash(2), F.lit(1)), "i": F.lit(1)})
    lone = lone.join(kept.where("conv_id is null").select("i", "h1", "h2"), ["i", "h1", "h2"], "left_semi").select("conv_id", turn_text.alias("text")).distinct()
    return out.unionByName(lone.select("conv_id", F.lit(1).cast("long").alias("n_turns"), "text"))


CHAT_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, role, text, row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS n,
         md5(string_agg(md5(coalesce(role, 'null:')) || md5(coalesce(text, 'null:')), '') OVER w) AS prefix
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
kept AS (
  SELECT min(conv_id) AS conv_id FROM t
  WHERE i = n AND NOT EXISTS (SELECT 1 FROM t p WHERE p.i < p.n AND p.i = t.i AND p.prefix = t.prefix)
  GROUP BY i, prefix)
SELECT conv_id, count(*) AS n_turns,
       string_agg('<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), '' ORDER BY turn) AS text
FROM t WHERE conv_id IN (SELECT conv_id FROM kept) GROUP BY conv_id
"""
