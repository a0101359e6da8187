"""Repeated passages by sliding spans of sentences."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from votealloc.llm import kernels
from votealloc.llm.shared import join_parted, materialise

SLICE_BYTES = 1 << 20
#: Spans of so many consecutive sentences, and the words that a span of that many must have to tell texts apart.
LEAST_WORDS = {1: 25, 2: 12, 3: 12}
#: In scripts without spaces, quarters of a word that a character counts, by its first byte and the range of its second:
#: Tibetan, Thai and Lao; Burmese; Khmer; kana, Han.
QUARTERS = [(0xE0, 0xB8, 0xBF, 1), (0xE1, 0x80, 0x82, 1), (0xE1, 0x9E, 0x9F, 1), *((b, 0x80, 0xBF, 2) for b in range(0xE3, 0xEA)), (0xF0, 0xA0, 0xB3, 2)]
#: Characters that end a sentence without a space after them.
STOPS = np.array([int.from_bytes(c.encode(), "big") for c in "。｡！？།။។"])
_STOP_LEADS = np.isin(np.arange(256), STOPS >> 16)
_BASE = np.uint64(0xC2B2AE3D27D4EB4F)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _split_at_stops(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """kernels.words(), where words also end after STOPS; and which words do."""
    starts, ends, rows = kernels.words(data, offs)
    lead = np.flatnonzero(_STOP_LEADS[data[:-2]])
    code = (data[lead].astype(np.int64) << 16) | (data[lead + 1].astype(np.int64) << 8) | data[lead + 2]
    stops = lead[np.isin(code, STOPS)] + 3
    if not len(stops):
        return starts, ends, rows, np.zeros(len(starts), bool)
    inner = np.setdiff1d(stops, ends, assume_unique=True)
    starts, ends = np.sort(np.concatenate([starts, inner])), np.sort(np.concatenate([ends, inner]))
    return starts, ends, np.searchsorted(offs, starts, "right") - 1, np.isin(ends, stops)


def _sizes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """What each word counts: 1, or more where it is a stretch of a script without spaces."""
    if not len(starts) or data.max() < 0xE0:
        return np.ones(len(starts), np.int64)
    quarters = np.zeros(len(data), np.int64)
    lead = np.flatnonzero(data[:-1] >= 0xE0)
    one, two = data[lead], data[lead + 1]
    for first, low, high, count in QUARTERS:
        quarters[lead[(one == first) & (two >= low) & (two <= high)]] = count
    sums = np.concatenate([[0], np.cumsum(quarters)])
    return np.maximum(1, (sums[ends] - sums[starts]) // 4)


def _sentences(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
    """First and one-past-last word, start byte and row of each sentence, a running hash over words, and running sizes of words.

    A sentence ends with a word that ends in . ! or ?, after one of STOPS, before a line break, or with its text.
    """
    starts, ends, rows, stopped = _split_at_stops(data, offs)
    word = kernels.SpanHasher(kernels.LOWER[data]).spans(starts, ends)
    n = len(starts)
    last = np.ones(n, bool)
    if n > 1:
        breaks = np.concatenate([[0], np.cumsum((data == 0x0A) | (data == 0x0D))])
        last[:-1] = (rows[1:] != rows[:-1]) | (breaks[starts[1:]] > breaks[ends[:-1]]) | np.isin(data[ends[:-1] - 1], np.frombuffer(b".!?", np.uint8)) | stopped[:-1]
    stop = np.flatnonzero(last) + 1
    first = np.concatenate([[0], stop[:-1]]).astype(np.int64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(word * kernels.powers(_BASE, n + 1)[:n], out=sums[1:])
    return first[: len(stop)], stop, starts, np.stack([sums, kernels.powers(_INVERSE, n + 1)]), rows, np.concatenate([[0], np.cumsum(_sizes(data, starts, ends))])


def _grown(row: np.ndarray, sizes: np.ndarray, most: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """First sentence and number of sentences, over most, of the shortest spans of the given size from each sentence on, and up to each.

    Together with the spans of most sentences or fewer, they cover every sentence of any run of that size.
    """
    n = len(row)
    sums = np.concatenate([[0], np.cumsum(sizes)])
    head = np.arange(n)
    end = np.searchsorted(sums, sums[:-1] + least)
    on = (end <= np.searchsorted(row, row, "right")) & (end - head > most)
    start = np.searchsorted(sums, sums[1:] - least, "right") - 1
    back = (start >= np.searchsorted(row, row)) & (head + 1 - start > most)
    back &= end[np.maximum(start, 0)] != head + 1
    return np.concatenate([head[on], start[back]]), np.concatenate([(end - head)[on], (head + 1 - start)[back]])


def _spans(sentences: tuple[np.ndarray, ...], least: dict[int, int], grow: bool) -> tuple[np.ndarray, ...]:
    """Row, first sentence within the row, number of sentences, and hash of each span of _sentences()."""
    first, stop, _, (sums, unshift), rows, total = sentences
    n = len(first)
    if not n:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    row = rows[first]
    place = np.arange(n) - np.searchsorted(row, row)
    spans = []
    enough_before = None
    for k in sorted(least):
        if n < k:
            break
        head = np.arange(n - k + 1)
        whole = (row[head] == row[head + k - 1]) & (total[stop[head + k - 1]] - total[first[head]] >= least[k])
        # A longer span adds nothing where both shorter ones inside it stand.
        take = whole & ~(enough_before[: n - k + 1] & enough_before[1 : n - k + 2]) if k > 1 and enough_before is not None else whole
        enough_before = whole
        spans.append((head[take], np.full(int(take.sum()), k)))
    if grow:
        spans.append(_grown(row, total[stop] - total[first], max(least), least[max(least)]))
    if not spans:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    at, k = (np.concatenate(c) for c in zip(*spans, strict=True))
    h = (sums[stop[at + k - 1]] - sums[first[at]]) * unshift[first[at]]
    return row[at], place[at], k, kernels.mix(h)


def _hash_spans(least: dict[int, int], grow: bool):
    """Arrow function: the distinct spans of each row, once each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offs in kernels.text_slices(batch.column("text"), SLICE_BYTES):
                row, place, k, h = _spans(_sentences(data, offs), least, grow)
                order = np.lexsort((place, h, row))
                row, place, k, h = row[order], place[order], k[order], h[order]
                fresh = np.ones(len(h), bool)
                fresh[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
                row, h = row[fresh], h[fresh]
                keys = pa.array(row)
                yield pa.RecordBatch.from_arrays([batch.column(c).slice(i, j - i).take(keys) for c in ("doc_id", "text_hash")] + [pa.array(h.view(np.int64))], ["doc_id", "text_hash", "span"])

    return run


def _cuts(sentences: tuple[np.ndarray, ...], spans: tuple[np.ndarray, ...], later_row: np.ndarray, later: np.ndarray) -> np.ndarray:
    """Which sentences go: those of spans that are later ones of their row, or not the first of their kind in it."""
    row, place, k, h = spans
    of_row = sentences[4][sentences[0]]
    order = np.lexsort((place, h, row))
    row, place, k, h = row[order], place[order], k[order], h[order]
    gone = np.zeros(len(h), bool)
    gone[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    if len(later):
        known, code = np.unique(later, return_inverse=True)
        at = np.minimum(np.searchsorted(known, h), len(known) - 1)
        gone |= (known[at] == h) & np.isin(row * len(known) + at, later_row * len(known) + code)
    start = np.searchsorted(of_row, row[gone]) + place[gone]
    n = len(of_row)
    depth = np.bincount(start, minlength=n + 1) - np.bincount(start + k[gone], minlength=n + 1)
    return np.cumsum(depth)[:n] > 0


def _removed(least: dict[int, int], grow: bool):
    """Arrow function: each text without the sentences of its repeated spans.

    later: span hashes that an earlier document has. Within a text, a span's first place stays
    unless it is one of those. A sentence goes with the space after it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = pc.fill_null(batch.column("later"), pa.scalar([], batch.column("later").type))
            bounds, later = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).view(np.uint64)
            for i, j, data, offs in kernels.text_slices(batch.column("text"), SLICE_BYTES):
                sentences = _sentences(data, offs)
                first, _, starts, _, rows, _ = sentences
                later_row = np.repeat(np.arange(j - i), np.diff(bounds[i : j + 1]))
                cut = _cuts(sentences, _spans(sentences, least, grow), later_row, later[bounds[i] : bounds[j]])
                of_row = rows[first]
                low = starts[first]
                high = np.append(low[1:], len(data))
                ends_row = np.append(of_row[1:] != of_row[:-1], True)[: len(first)]
                high = np.where(ends_row, offs[of_row + 1], high[: len(first)])
                size = len(data)
                stays = np.cumsum(np.bincount(low[cut], minlength=size + 1) - np.bincount(high[cut], minlength=size + 1))[:size] == 0
                kept = data[stays]
                ends = np.concatenate([[0], np.cumsum(stays)])[offs].astype(np.int32)
                texts = pa.StringArray.from_buffers(j - i, pa.py_buffer(ends), pa.py_buffer(kept))
                raw = memoryview(kept)
                n_bytes = np.diff(offs)
                columns = [np.bincount(of_row, minlength=j - i), np.bincount(of_row[cut], minlength=j - i), n_bytes, n_bytes - np.diff(ends)]
                digests = [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), *[pa.array(c.astype(np.int64)) for c in columns], texts, pa.array(digests, pa.string())],
                    ["doc_id", "n_sentences", "n_removed", "n_bytes", "bytes_removed", "kept_text", "kept_sha256"],
                )

    return run


def _after(a: Column, b: Column) -> Column:
    """Does id a come after id b, null last?"""
    return F.coalesce(a > b, a.isNull() & b.isNotNull())


def remove_repeated_sentences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, least_words: dict[int, int] | None = None, grow: bool = False) -> DataFrame:
    """Removes the sentences that a non-first occurrence of a repeated span covers.

    A span is a run of 1 to 3 consecutive sentences with at least least_words[number of
    sentences] words (so that chance repeats of short sentences don't count). With grow,
    where 3 sentences have fewer (verse, lists), the shortest longer run that has as many, from
    a sentence on or up to it, is a span too, so that all of a longer repeated run goes. In scripts without spaces, 2 Han characters or kana, or 4 of Thai,
    Lao, Khmer, Burmese or Tibetan, count as a word. Spans are equal when their words are, case
    of A-Z and white space aside. The first occurrence is in the smallest doc_id, and within a
    text the earliest; it stays.

    Returns for each row of docs: doc_id, n_sentences, n_removed, n_bytes, bytes_removed,
    kept_text, kept_sha256. Sentences go with the white space after them.

    Method: every span is hashed (64 bits, of words of 64 bits) in Arrow functions; distinct
    spans of each text are pre-aggregated to (count, smallest id) before the shuffle and joined
    back by hash; a passage that a third of all documents share is one row there, and is joined
    in parts. Texts are cut slice by slice, where hits are. Rows are known by (doc_id, hash of text): no numbering is needed, and a
    lost task is simply run again. Rows that repeat a doc_id are parts of one document, of which
    none is later than another; null doc_ids are one document, after all others. Null or empty
    texts have no sentences. Other columns aren't read.
    """
    least = least_words or LEAST_WORDS
    kind = docs.schema[id_col].dataType.simpleString()
    table = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).withColumn("text_hash", F.xxhash64("text"))
    spans = table.mapInArrow(_hash_spans(least, grow), f"doc_id {kind}, text_hash long, span long")
    firsts = materialise(spans.groupBy("span").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id")).where("n > 1"), "sentence-firsts")
    held = join_parted(spans, firsts, ["span"], "text_hash")
    later = held.where(_after(F.col("doc_id"), F.col("first_id"))).groupBy("doc_id", "text_hash").agg(F.collect_set("span").alias("later"))
    later = later.withColumnsRenamed({"doc_id": "of", "text_hash": "of_hash"})
    found = table.join(later, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_hash") == F.col("of_hash")), "left").select("doc_id", "text", "later")
    return found.mapInArrow(_removed(least, grow), f"doc_id {kind}, n_sentences long, n_removed long, n_bytes long, bytes_removed long, kept_text string, kept_sha256 string")
