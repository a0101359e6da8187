"""Jump consistent hashing in DataFrame functions: stable keys to shards without a table of the ring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from votealloc.llm.shared import numbered

#: Fixed value: the multiplier of the method's generator, as four numbers of 16 bits, lowest first.
MULTIPLIER = 2862933555777941757
_PARTS = [MULTIPLIER >> 16 * k & 0xFFFF for k in range(4)]
#: Jumps that every row is given steps for; a key that needs more (a key makes about ln(shards) of them) goes on in a second loop.
JUMPS = 96


def _next(state: Column) -> Column:
    """The state after one jump: the generator's 64 bits are two halves, since a product of longs would overflow."""
    high, low = state["high"], state["low"]
    second = low * _PARTS[1]
    sums = low * _PARTS[0] + F.shiftleft(second.bitwiseAND(0xFFFF), 16) + 1
    low = sums.bitwiseAND(0xFFFFFFFF)
    above = F.shiftright(sums, 32) + F.shiftright(second, 16) + state["low"] * _PARTS[2] + F.shiftleft((state["low"] * _PARTS[3]).bitwiseAND(0xFFFF), 16)
    above = above + high * _PARTS[0] + F.shiftleft((high * _PARTS[1]).bitwiseAND(0xFFFF), 16)
    high = above.bitwiseAND(0xFFFFFFFF)
    jump = (state["to"] + 1).cast("double") * (F.lit(float(1 << 31)) / (F.shiftright(high, 1) + 1).cast("double"))
    return F.struct(state["to"].alias("shard"), F.floor(jump).cast("long").alias("to"), high.alias("high"), low.alias("low"))


def jump(key: Column, shards: int) -> Column:
    """(shard, to): the shard, of 0 to shards - 1, of a key's text, and the number of shards beyond which the key moves on.

    While there are no more than `to` shards, the key stays; with to + 1 shards it is in shard
    `to`, the new one. The generator starts from the first 64 bits of the MD5 of the key's text.
    """
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    half = lambda at: F.conv(F.substring(digest, at, 8), 16, 10).cast("long")
    start = F.struct(F.lit(-1).cast("long").alias("shard"), F.lit(0).cast("long").alias("to"), half(1).alias("high"), half(9).alias("low"))
    step = lambda state, _: F.when(state["to"] < shards, _next(state)).otherwise(state)
    state = F.aggregate(F.sequence(F.lit(1), F.lit(min(shards, JUMPS))), start, step)
    if shards > JUMPS:
        state = F.when(state["to"] < shards, F.aggregate(F.sequence(F.lit(JUMPS + 1), F.lit(shards)), state, step)).otherwise(state)
    return F.struct(state["shard"].alias("shard"), state["to"].alias("to"))


def with_shards(docs: DataFrame, shards: int, id_col: str = "doc_id", name: str = "shard") -> DataFrame:
    """docs with the shard of each row appended under name: a projection, without a shuffle."""
    if shards < 1:
        raise ValueError("there must be at least one shard")
    return docs.withColumn(name, jump(docs[id_col], shards)["shard"].cast("int"))


def write_shards(docs: DataFrame, path: str, shards: int, id_col: str = "doc_id", *, files: int = 1) -> None:
    """All columns of docs as Parquet in a folder for each shard (shard=k), in about `files` files each.

    Rows are dealt by shard and a hash of the row's key, so a shard isn't one task's unless it is to be one file.
    """
    lot = F.pmod(F.xxhash64(docs[id_col]), F.lit(files))
    placed = with_shards(docs, shards, id_col)
    placed.repartition(shards * files, "shard", lot).write.partitionBy("shard").parquet(path)


def assign_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law ('key'), shard, slot, grown_shard of every row.

    The key and the number of shards decide the shard; with one more shard (grown_shard), a row
    stays or moves to the new one. size is the text's UTF-8 bytes plus 1, null text counting as
    empty; text_crc32 is unsigned, of the same bytes. Slots number a shard's rows without gaps
    from 0, by doc_id, checksum and size.

    A null id has the key of the empty text. Rows that repeat an id share its shard, with a slot
    each, however many they are: equal keys are no task of their own. Empty and very long texts
    differ in size alone; an empty table gives no rows. Only doc_id, size and checksum are
    shuffled; other columns aren't read, so their names don't matter.
    """
    if shards < 1:
        raise ValueError("there must be at least one shard")
    text = F.coalesce(docs[text_col], F.lit(""))
    rows = docs.select(docs[id_col].alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), jump(docs[id_col], shards).alias("jump"))
    moved = F.when(F.col("jump.to") == shards, F.lit(shards)).otherwise(F.col("jump.shard"))
    rows = rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), F.col("jump.shard").cast("int").alias("shard"), moved.cast("int").alias("grown_shard"))
    placed = numbered(rows, "shard", [F.col("doc_id"), F.col("text_crc32"), F.col("size")], "shards")
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", F.col("position").alias("slot"), "grown_shard")


#: The query's rows in DuckDB: the same jumps with 128-bit integers, checksums bit by bit from their polynomial.
SHARD_SQL = r"""
WITH RECURSIVE bits AS (
  SELECT b::BIGINT AS b, b::BIGINT AS c, 0 AS i FROM range(256) AS r(b)
  UNION ALL SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i + 1 FROM bits WHERE i < 8),
tab AS (SELECT list(c ORDER BY b) AS crc FROM bits WHERE i = 8),
jumps AS (
  SELECT DISTINCT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 16))::UBIGINT::HUGEINT AS key, -1::BIGINT AS shard, 0::BIGINT AS goal FROM documents
  UNION ALL
  SELECT doc_id, next, goal, floor((goal + 1)::DOUBLE * (2147483648::DOUBLE / (next // 8589934592 + 1)::DOUBLE))::BIGINT
  FROM (SELECT doc_id, goal, (key * 2862933555777941757::HUGEINT + 1) % 18446744073709551616::HUGEINT AS next FROM jumps WHERE goal < 8)),
texts AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size, hex(encode(coalesce(text, ''))) AS x FROM documents),
sums AS (
  SELECT doc_id, size::BIGINT AS size,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(x, '..'), lambda v: ('0x' || v)::BIGINT)),
                         lambda a, v: xor(a >> 8, crc[xor(a & 255, v) + 1])), 4294967295)::BIGINT AS text_crc32
  FROM texts, tab)
SELECT s.doc_id, size, text_crc32, 'key' AS law, shard::INTEGER AS shard,
       (row_number() OVER (PARTITION BY shard ORDER BY s.doc_id NULLS FIRST, text_crc32, size) - 1)::BIGINT AS slot,
       (CASE WHEN goal = 8 THEN 8 ELSE shard END)::INTEGER AS grown_shard
FROM sums s JOIN jumps j ON s.doc_id IS NOT DISTINCT FROM j.doc_id AND j.goal >= 8
"""
