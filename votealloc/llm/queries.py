"""The operators applied to whole tables, with production parameters: one query each.

Queries that need tables on the way return a written one, with all others removed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from votealloc.llm import language_id
from votealloc.llm.chat import CHAT_SQL, maximal_conversations
from votealloc.llm.decontaminate import contaminated
from votealloc.llm.exact_dedup import exact_duplicates
from votealloc.llm.mixing import MIX_SQL, mix
from votealloc.llm.near_dedup import near_duplicates
from votealloc.llm.resampling import RESAMPLE_SQL, importance_ranks
from votealloc.llm.runs import periodic_runs
from votealloc.llm.secret_scan import scan_secrets
from votealloc.llm.sentence_dedup import remove_repeated_sentences
from votealloc.llm.shared import finished
from votealloc.llm.sharding import SHARD_SQL, assign_shards
from votealloc.llm.suffix_dedup import remove_repeats
from votealloc.llm.token_counts import count_tokens


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finished(lambda: remove_repeats(_table(spark, sf_dir, "documents")).drop("row_key"), "op1_suffix_dedup")


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maximal_conversations(_table(spark, sf_dir, "conversations"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return finished(lambda: mix(docs).select("doc_id", "size", "source_size", "target", "taken"), "op3_mixing")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    out = language_id.held_out(F.col("doc_id"))
    dictionaries = language_id.fit(docs.where(~out))
    found = docs.select("doc_id", out.alias("held_out"), language_id.language_of(F.col("text"), dictionaries).alias("found"))
    return found.select("doc_id", "held_out", "found.*")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finished(lambda: exact_duplicates(_table(spark, sf_dir, "documents")).drop("row_key"), "op6_exact_dedup")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finished(lambda: contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("text_hash"), "op7_decontamination")


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finished(lambda: near_duplicates(_table(spark, sf_dir, "documents")).drop("row_key"), "op8_near_duplicates")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(_table(spark, sf_dir, "documents"))


def op10_sentence_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finished(lambda: remove_repeated_sentences(_table(spark, sf_dir, "documents"), grow=True).drop("kept_text"), "op10_sentence_dedup")


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finished(lambda: importance_ranks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")), "op11_importance_resampling")


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(_table(spark, sf_dir, "documents"), repeat=True, texts=False)


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finished(lambda: assign_shards(_table(spark, sf_dir, "documents")), "op13_sharding")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_chat_formatting": op2_chat_formatting,
    "op3_mixing": op3_mixing,
    "op4_token_counts": op4_token_counts,
    "op5_language_id": op5_language_id,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_decontamination": op7_decontamination,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_secret_scan": op9_secret_scan,
    "op10_sentence_dedup": op10_sentence_dedup,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_sharding": op13_sharding,
}

#: DuckDB SQL for the queries that SQL can express.
ORACLES: dict[str, str] = {
    "op2_chat_formatting": CHAT_SQL,
    "op3_mixing": MIX_SQL,
    "op11_importance_resampling": RESAMPLE_SQL,
    "op13_sharding": SHARD_SQL,
    "op6_exact_dedup": r"""
WITH normal AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM normal WINDOW w AS (PARTITION BY norm)
""",
}
