"""Importance resampling towards a target distribution, by hashed runs of words."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import islice, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from votealloc.llm.kernels import SLICE_BYTES, text_slices
from votealloc.llm.shared import keyed, numbered

#: Once A-Z are lower-case, this byte is in no text.
SENTINEL = b"A"
#: UTF-8 of words: digits, a to z and all that isn't ASCII; a sentinel is a find of its own.
FOUND = re.compile(rb"[0-9a-z\x80-\xff]+|A")
#: Words of a longer text that are held at once.
LONG_WORDS = 1 << 17


def _runs(words: list[bytes], rows: np.ndarray, longest: int, skip: int = 0) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each length: (length, row, crc32) of all runs of words within a row that end at word skip or later."""
    spaced = [b" " + w for w in words]
    crc = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
    yield 1, rows[skip:], crc[skip:]
    for length in range(2, longest + 1):
        last = spaced[length - 1 :]
        # The checksum of a run goes on from that of the run without its last word.
        crc = np.fromiter(map(zlib.crc32, last, crc[: len(last)].tolist()), np.uint32, len(last))
        ends = np.arange(length - 1, length - 1 + len(last))
        own = (rows[: len(last)] == rows[length - 1 :]) & (ends >= skip)
        yield length, rows[: len(last)][own], crc[own]


def features(column: pa.Array, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row, crc32) arrays of all runs of 1 to longest words of the column's texts; null texts have none.

    The texts of a slice are joined with sentinels and one pass of the pattern finds the words
    of all; a word's row is found by searching the rows' offsets among the words, and runs whose
    first and last word lie in different rows are masked. A text of more than a slice is read in
    stretches of words that carry the last ones over.
    """
    for i, j, data, offsets in text_slices(column):
        low = data.tobytes().lower()
        if j - i == 1 and len(low) > SLICE_BYTES:
            found, carry = (m[0] for m in FOUND.finditer(low)), []
            while fresh := list(islice(found, LONG_WORDS)):
                words = carry + fresh
                yield from _runs(words, np.full(len(words), i), longest, len(carry))
                carry = words[len(words) - (longest - 1) :] if longest > 1 else []
            continue
        found = FOUND.findall(SENTINEL.join([low[a:b] for a, b in pairwise(offsets.tolist())]))
        marks = np.flatnonzero(np.fromiter(map(SENTINEL.__eq__, found), bool, len(found)))
        words = [w for w in found if w != SENTINEL]
        starts = marks - np.arange(len(marks))
        yield from _runs(words, i + np.searchsorted(starts, np.arange(len(words)), "right"), longest)


def _counting(longest: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, crc in features(batch.column("text"), longest):
                counts += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], ["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, longest: int, buckets: int) -> np.ndarray:
    """How many features of all texts fall into each bucket. A task sends one row a bucket at most, the driver gets as many."""
    sums = texts.mapInArrow(_counting(longest, buckets), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(buckets, np.int64)
    for bucket, n in sums.collect():
        counts[bucket] = n
    return counts


def gains(ours: np.ndarray, theirs: np.ndarray) -> np.ndarray:
    """Of each bucket: how much likelier the target's features are to fall into it than the documents', in thousandths of a log."""
    s, t = ours.astype(float), theirs.astype(float)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + len(s)) / ((s + 1) * (t.sum() + len(t)))))


def _weighing(gain: np.ndarray, longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = len(batch)
            words, count, total = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n)
            for length, rows, crc in features(batch.column("text"), longest):
                each = np.bincount(rows, minlength=n)
                count += each
                if length == 1:
                    words += each
                total += np.bincount(rows, weights=gain[crc % np.uint32(len(gain))], minlength=n)
            weight = total.astype(np.int64) // np.maximum(count, 1)
            columns = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in columns], *map(pa.array, (words, count, weight))], [*columns, "n_words", "n_features", "weight"])

    return run


def _noise(key: Column, seed: int) -> Column:
    """A Gumbel variable in thousandths, from the hash of the key's text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0)))


def importance_ranks(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", *, longest: int = 2, buckets: int = 10_000, least_words: int = 20, share: int = 25, seed: int = 7, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_features, weight, score, rank (1, 2, 3... of the drawn, else null) of every row, and the columns of docs named in keep.

    Features are all runs of 1 to longest words, by bucket of their checksum. A document's
    weight is the floored mean of its features' gains (how much likelier the target's texts are
    to have the bucket than docs); its score adds Gumbel noise from a hash of its id, so
    that the highest scores are a draw without replacement in proportion to the weights. Of
    the N documents with least_words or more, floor(share * N / 100) are drawn; ties go to the
    smaller doc_id, null last.

    Null and empty texts have no features and weight 0, and can't be drawn unless least_words is
    0. A null id is hashed as the empty text. Rows that repeat an id have the same noise and a
    rank each. Empty docs give no rows; an empty target weighs all buckets as never seen in it.
    Texts are read twice, whole, in slices; a text of any length is held a stretch of words at a
    time. Only counts by bucket and one small row a document are shuffled, and `buckets` numbers
    go through the driver.
    """
    rows = docs.select(docs[id_col].alias("doc_id"), *[docs[c].alias(f"keep_{i}") for i, c in enumerate(keep)], docs[text_col].cast("string").alias("text"))
    gain = gains(bucket_counts(rows.select("text"), longest, buckets), bucket_counts(target.select(target[target_col].cast("string").alias("text")), longest, buckets))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.drop("text").schema]
    weighed = rows.mapInArrow(_weighing(gain, longest), ", ".join([*fields, "n_words long, n_features long, weight long"]))
    scored = weighed.select("*", (F.col("weight") + _noise(F.col("doc_id"), seed)).alias("score"), (F.col("n_words") >= least_words).alias("eligible"))
    lined = numbered(scored, "eligible", [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features")], "resample")
    drawn = lined.where("eligible").count() * share // 100
    rank = F.when(F.col("eligible") & (F.col("position") < drawn), F.col("position") + 1)
    return lined.select("doc_id", *[F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)], "n_features", "weight", "score", rank.alias("rank"))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The drawn rows of docs, all columns as they were: what importance_ranks draws with the same options."""
    rows = keyed(docs, {f"c{i}": c for i, c in enumerate(docs.columns)}, "resample-docs")
    place = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    ranks = importance_ranks(rows, target, place[id_col], place[text_col], keep=("row_key",), **options)
    drawn = rows.join(ranks.where("rank is not null").select("row_key"), "row_key", "left_semi")
    return drawn.select(*[F.col(new).alias(old) for old, new in place.items()])


#: The query's rows in DuckDB: checksums of distinct features bit by bit from their polynomial.
RESAMPLE_SQL = r"""
WITH RECURSIVE bits AS (
  SELECT b::BIGINT AS b, b::BIGINT AS c, 0 AS i FROM range(256) AS r(b)
  UNION ALL SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i + 1 FROM bits WHERE i < 8),
tab AS (SELECT list(c ORDER BY b) AS crc FROM bits WHERE i = 8),
texts AS (
  SELECT doc_id, text, 'd' AS side FROM documents UNION ALL SELECT item_id, text, 'b' FROM benchmark),
split AS (
  SELECT doc_id, side, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM texts),
feats AS (
  SELECT r, side, unnest(w || list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1])) AS f FROM split),
names AS (SELECT DISTINCT f, hex(encode(f)) AS x FROM feats),
buckets AS (
  SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, len(x), 2), lambda i: ('0x' || substr(x, i, 2))::BIGINT)),
                            lambda a, v: xor(a >> 8, crc[xor(a & 255, v) + 1])), 4294967295) % 10000 AS bucket
  FROM names, tab),
placed AS (SELECT r, side, bucket FROM feats JOIN buckets USING (f)),
sums AS (
  SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t FROM placed GROUP BY bucket),
gain AS (
  SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE) / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE))) AS g FROM sums),
means AS (
  SELECT r, count(*) AS n_features, floor(sum(g) / count(*))::BIGINT AS weight FROM placed JOIN gain USING (bucket) WHERE side = 'd' GROUP BY r),
scored AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM split LEFT JOIN means USING (r) WHERE side = 'd'),
lined AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place, count(*) FILTER (n_words >= 20) OVER () AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= n * 25 // 100 THEN place END::BIGINT AS rank FROM lined
"""
