"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from votealloc.llm import kernels
from votealloc.llm.mixing import word_count
from votealloc.llm.shared import discard, materialise

SLICE_BYTES = 1 << 20
#: Words of benchmark items that are sent to the tasks at once (some 50 bytes each); a larger benchmark is taken in blocks, with a scan each.
BLOCK_WORDS = 1 << 20
#: Pairs of a seed's place and an item that are looked at together, and words of passages that are aligned together.
PAIRS = 1 << 18
ALIGN_WORDS = 1 << 16
#: Alignment scores, and the share of a full match that counts as contamination.
MATCH, MISMATCH, GAP = 2, -1, -1
LEAST_SCORE = 0.5


def _pair_hashes(word: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every two consecutive words inside a row, and the place of the first."""
    at = np.flatnonzero(row[:-1] == row[1:])
    return kernels.mix(word[at] * np.uint64(0xA24BAED4963EE407) + kernels.mix(word[at + 1])), at


def least_shared(n_words: np.ndarray, least_score: float) -> np.ndarray:
    """Pairs of consecutive words that an item shares with any passage that it aligns to with least_score or more.

    m words, k of them matched, e edits (each -1): the score is 2k - e, of 2m. Matched words stand
    in e + 1 runs at most, so k - e - 1 pairs are shared. Substitutions and deletions use up words of the item: k + e <= m,
    so e <= (2 - 2 * least_score) * m / 3, and with (2 * least_score * m + e) / 2 <= k the shared pairs are
    least_score * m - e / 2 - 1 or more. Insertions count like the others up to that number of edits.
    """
    most_edits = (2 - 2 * least_score) * n_words / 3
    return np.maximum(1, np.ceil(least_score * n_words - most_edits / 2 - 1 - 1e-9)).astype(np.int64)


class Block:
    """Some items as flat arrays: their words, and the items that hold each pair of words."""

    def __init__(self, items: list[int], texts: list[str]):
        data, offs = _buffer(texts)
        _, _, row, word = kernels.word_hashes(data, offs)
        self.items = np.array(items, np.int64)
        self.first = np.searchsorted(row, np.arange(len(items) + 1))
        self.size = np.diff(self.first)
        self.word = word
        h, at = _pair_hashes(word, row)
        self.pairs, code = np.unique(h, return_inverse=True)
        self.held = np.unique(code * np.int64(max(1, len(items))) + row[at])  # (pair, item)
        # The words of each item once, with their numbers, in order of (item, word).
        order = np.lexsort((word, row))
        row, word = row[order], word[order]
        fresh = np.ones(len(word), bool)
        fresh[1:] = (row[1:] != row[:-1]) | (word[1:] != word[:-1])
        starts = np.flatnonzero(fresh)
        self.known, codes = np.unique(word, return_inverse=True)
        self.of_item = row[starts] * max(1, len(self.known)) + codes[starts]
        self.times = np.diff(np.append(starts, len(word)))

    def pick(self, found: np.ndarray, least_score: float) -> None:
        """Keep as seeds of each item its rarest pairs, by the places found in all texts.

        An item with n different pairs that must share t of them with a passage shares one of
        its n - t + 1 rarest: no passage is lost by leaving out the t - 1 most frequent. (A pair that an
        item holds twice may be shared twice, so t is less by the repeats.)
        """
        n_items = max(1, len(self.items))
        code, item = self.held // n_items, self.held % n_items
        order = np.lexsort((code, found[code], item))
        item, code = item[order], code[order]
        n = np.bincount(item, minlength=n_items)
        rank = np.arange(len(item)) - (np.cumsum(n) - n)[item]
        repeats = np.maximum(self.size - 1, 0) - n[: len(self.size)]
        needed = np.maximum(1, least_shared(self.size, least_score) - repeats)
        seed = rank < (n[: len(needed)] - needed + 1)[item]
        at = np.argsort(code[seed], kind="stable")
        self.seed_item = item[seed][at]
        self.seed_from = np.searchsorted(code[seed][at], np.arange(len(self.pairs) + 1))


def _buffer(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)


def _ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (count[0] of them), start[1], ..."""
    total = int(count.sum())
    return np.repeat(start - (np.cumsum(count) - count), count) + np.arange(total)


def _count_pairs(block: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow function: how many places of a task's texts hold each pair of the block (pair, n)."""
    pairs = block.value.pairs
    n = np.zeros(len(pairs), np.int64)
    for batch in batches:
        for _, _, data, offs in kernels.text_slices(batch.column("text"), SLICE_BYTES):
            _, _, row, word = kernels.word_hashes(data, offs)
            h, _ = _pair_hashes(word, row)
            at = np.minimum(np.searchsorted(pairs, h), len(pairs) - 1)
            n += np.bincount(at[pairs[at] == h], minlength=len(pairs))
    some = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some])], ["pair", "n"])


def align(items: list[np.ndarray], passages: list[np.ndarray]) -> np.ndarray:
    """Best Smith-Waterman local alignment score of each item and its passage, as sequences of word hashes."""
    best = np.zeros(len(items), np.int64)
    deep = np.array([len(x) for x in items], np.int64)
    wide = np.array([len(p) for p in passages], np.int64)
    order = np.lexsort((-deep, -wide))
    order = order[(deep[order] > 0) & (wide[order] > 0)]
    i = 0
    while i < len(order):
        width = int(wide[order[i]])
        rows = order[i : i + max(1, ALIGN_WORDS // width)]
        i += len(rows)
        rows = rows[np.argsort(-deep[rows], kind="stable")]
        grid, item = np.zeros((len(rows), width), np.uint64), np.zeros((len(rows), int(deep[rows[0]])), np.uint64)
        inside = np.arange(width) < wide[rows][:, None]
        grid[inside] = np.concatenate([passages[r] for r in rows])
        item[np.arange(item.shape[1]) < deep[rows][:, None]] = np.concatenate([items[r] for r in rows])
        before = np.zeros((len(rows), width + 1), np.int32)
        slope = np.arange(1, width + 1, dtype=np.int32) * np.int32(GAP)
        top = np.zeros(len(rows), np.int64)
        for k in range(item.shape[1]):
            n = int(np.searchsorted(-deep[rows], -k, "left"))  # rows whose item has a word k
            score = np.where((grid[:n] == item[:n, k : k + 1]) & inside[:n], np.int32(MATCH), np.int32(MISMATCH))
            score += before[:n, :-1]
            np.maximum(score, before[:n, 1:] + np.int32(GAP), out=score)
            np.maximum(score, 0, out=score)
            # A gap along the passage carries a score on, less GAP a word: a running maximum.
            score -= slope
            np.maximum.accumulate(score, axis=1, out=score)
            score += slope
            top[:n] = np.maximum(top[:n], score.max(axis=1))
            before[:n, 1:] = score
        best[rows] = top
    return best


def _stretches(block: Block, row: np.ndarray, place: np.ndarray, code: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Row, item, first and one-past-last word of each stretch of a text around seeds of an item, PAIRS at most at once.

    row, place, code: where a slice's texts hold pairs of the block; ends: where each row's words
    end. A passage that aligns with LEAST_SCORE or more spans twice the item's words at most.
    Items are taken in turns so that one frequent seed of very many items fits memory; all places
    of an item in a text are in one turn.
    """
    n_items = len(block.items)
    start, stop = block.seed_from[code], block.seed_from[code + 1]
    low = 0
    while low < n_items:
        high = n_items
        while True:
            # Items of a seed are in order: those from low to high are a range of its list.
            a = start + _within(block, start, stop, low)
            b = start + _within(block, start, stop, high)
            if (b - a).sum() <= PAIRS or high == low + 1:
                break
            high = low + max(1, (high - low) // 2)
        low = high
        count = b - a
        item = block.seed_item[_ranges(a, count)]
        r, p = np.repeat(row, count), np.repeat(place, count)
        order = np.lexsort((p, item, r))
        r, p, item = r[order], p[order], item[order]
        reach = 2 * block.size[item]
        new = np.ones(len(p), bool)
        new[1:] = (r[1:] != r[:-1]) | (item[1:] != item[:-1]) | (p[1:] - p[:-1] > reach[1:])
        head = np.flatnonzero(new)
        if not len(head):
            continue
        tail = np.append(head[1:], len(p)) - 1
        r, item, reach = r[head], item[head], reach[head]
        yield r, item, np.maximum(ends[r], p[head] - reach), np.minimum(ends[r + 1], p[tail] + 2 + reach)


def _within(block: Block, start: np.ndarray, stop: np.ndarray, item: int) -> np.ndarray:
    """How many of the items in each list seed_item[start:stop] are under item."""
    if item <= 0:
        return np.zeros(len(start), np.int64)
    if item >= len(block.items):
        return stop - start
    low, high = start.copy(), stop.copy()
    while (open_ := low < high).any():
        mid = (low + high) // 2
        less = open_ & (block.seed_item[np.minimum(mid, len(block.seed_item) - 1)] < item)
        low = np.where(less, mid + 1, low)
        high = np.where(open_ & ~less, mid, high)
    return low - start


def _may_score(block: Block, item: np.ndarray, low: np.ndarray, high: np.ndarray, word: np.ndarray, least_score: float) -> np.ndarray:
    """Whether enough of an item's words stand between low and high: matches alone must reach the score."""
    enough = np.zeros(len(item), bool)
    size = high - low
    i = 0
    while i < len(item):
        j = max(i + 1, i + int(np.searchsorted(np.cumsum(size[i:]), PAIRS, "right")))
        each = np.repeat(np.arange(i, j), size[i:j])
        here = word[_ranges(low[i:j], size[i:j])]
        code = np.minimum(np.searchsorted(block.known, here), len(block.known) - 1)
        common = block.known[code] == here
        key = np.unique(each[common] * np.int64(len(block.known)) + code[common])
        each, code = key // len(block.known), key % len(block.known)
        at = np.minimum(np.searchsorted(block.of_item, want := item[each] * len(block.known) + code), len(block.of_item) - 1)
        times = np.where(block.of_item[at] == want, block.times[at], 0)
        enough[i:j] = np.bincount(each - i, times, j - i) >= least_score * block.size[item[i:j]]
        i = j
    return enough


def _aligned(block: Broadcast, least_score: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow function: the pairs of a text and an item of the block that reach least_score (doc_id, text_hash, item, score)."""
    items = block.value
    for batch in batches:
        for i, j, data, offs in kernels.text_slices(batch.column("text"), SLICE_BYTES):
            _, _, row, word = kernels.word_hashes(data, offs)
            ends = np.searchsorted(row, np.arange(j - i + 1))
            h, place = _pair_hashes(word, row)
            code = np.minimum(np.searchsorted(items.pairs, h), len(items.pairs) - 1)
            hit = (items.pairs[code] == h) & (items.seed_from[code] < items.seed_from[code + 1])
            place, code = place[hit], code[hit]
            found = []
            for r, item, low, high in _stretches(items, row[place], place, code, ends):
                some = _may_score(items, item, low, high, word, least_score)
                r, item, low, high = r[some], item[some], low[some], high[some]
                scores = align([items.word[items.first[k] : items.first[k + 1]] for k in item], [word[a:b] for a, b in zip(low, high, strict=True)])
                scores = scores / (MATCH * items.size[item])
                some = scores >= least_score
                found.append((r[some], items.items[item[some]], scores[some]))
            r, item, score = (np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3
            at = pa.array(r + i)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(at), batch.column("text_hash").take(at), pa.array(item.astype(np.int64)), pa.array(score.astype(float))], ["doc_id", "text_hash", "item", "score"])


def _blocks(items: DataFrame, block_words: int) -> Iterator[Block]:
    """The items (item, text), block_words words or one item at a time; never more reach the driver at once."""
    sized = items.withColumn("n", word_count(F.col("text")))
    held: list[tuple[int, str]] = []
    words = 0
    for r in sized.toLocalIterator():
        if held and words + r.n > block_words:
            yield Block(*map(list, zip(*held, strict=True)))
            held, words = [], 0
        held.append((r["item"], r.text))
        words += r.n
    if held:
        yield Block(*map(list, zip(*held, strict=True)))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, item_col: str = "item_id", item_text_col: str = "text", least_score: float = LEAST_SCORE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Documents that hold benchmark items, whole or edited.

    Returns a row for each row of docs: doc_id, n_items (items that the text holds with a score
    of least_score or more), best_item, best_score (0 to 1; 0 where no item reaches least_score; ties:
    the smallest item_id, null last), contaminated (n_items > 0); and text_hash.

    Method: a first scan counts where texts hold pairs of consecutive words (case of A-Z aside)
    of items. The seeds of an item are its rarest pairs: all but as many of the most frequent as
    a passage could do without (see least_shared), so that no passage with as few edits is lost.
    A second scan looks up seeds, and aligns each stretch of a text around seeds of an item,
    with room for the item on both sides, to it word by word (Smith-Waterman: match 2, mismatch
    and gap -1), unless the stretch has too few of the item's words to reach least_score. The
    score is that of the best stretch over that of a full match. Only pairs that reach
    least_score are shuffled. The items of block_words words are looked for in one pair of scans;
    a larger benchmark takes a pair of scans a block.

    Every text and item is read whole. A match shares two consecutive words with its item at
    least. Items or texts of fewer than 2 words, null and empty ones match nothing. Rows are known by (doc_id, hash of text); repeated rows get the same figures.
    Null ids are passed through. Items are the distinct (item_id, text) pairs: an id may repeat
    or be null, and each of its texts is an item. Other columns are not read. An empty benchmark
    leaves every text clean. What it can miss: passages with more edits than a third of the item's words, which
    must be insertions for the most part to reach 0.5 all the same, and items of three words with the middle one changed.
    """
    id_kind = docs.schema[id_col].dataType.simpleString()
    table = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).withColumn("text_hash", F.xxhash64("text"))
    items = benchmark.select(benchmark[item_col].alias("item_id"), F.coalesce(benchmark[item_text_col], F.lit("")).alias("text")).distinct()
    items = materialise(items.withColumn("item", F.monotonically_increasing_id()), "leak-items")
    context = docs.sparkSession.sparkContext
    scores = None
    for block in _blocks(items.select("item", "text"), block_words):
        if not len(block.pairs):
            continue
        sent = context.broadcast(block)
        counted = table.select("text").mapInArrow(partial(_count_pairs, sent), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
        found = np.zeros(len(block.pairs), np.int64)
        counts = counted.toArrow()  # a row for each of the block's pairs at most
        found[counts["pair"].to_numpy()] = counts["n"].to_numpy()
        sent.unpersist()
        block.pick(found, least_score)
        sent = context.broadcast(block)
        here = materialise(table.mapInArrow(partial(_aligned, sent, least_score), f"doc_id {id_kind}, text_hash long, item long, score double"), "leak-scores")
        sent.unpersist()
        scores = here if scores is None else scores.unionByName(here)
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_hash") == F.col("of_hash"))
    if scores is None:
        discard(items)
        return table.select("doc_id", F.lit(0).cast("long").alias("n_items"), F.lit(None).cast(items.schema["item_id"].dataType).alias("best_item"), F.lit(0.0).alias("best_score"), F.lit(False).alias("contaminated"), "text_hash")
    best = scores.groupBy("doc_id", "text_hash", "item").agg(F.max("score").alias("score")).join(items.select("item", "item_id"), "item")
    best = best.groupBy(F.col("doc_id").alias("of"), F.col("text_hash").alias("of_hash")).agg(
        F.count("*").alias("n_items"),
        F.max("score").alias("best_score"),
        F.min_by("item_id", F.struct(-F.col("score"), F.col("item_id").isNull(), "item_id")).alias("best_item"),
    )
    out = table.select("doc_id", "text_hash").join(best, same, "left")
    return out.select("doc_id", F.coalesce("n_items", F.lit(0)).alias("n_items"), "best_item", F.coalesce("best_score", F.lit(0.0)).alias("best_score"), F.col("n_items").isNotNull().alias("contaminated"), "text_hash")
