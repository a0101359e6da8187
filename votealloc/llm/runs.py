"""Periodic runs of words: Lyndon arrays from the grouping phase of a suffix sorter, roots extended to runs."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from votealloc.llm.kernels import mix, text_slices

_SPACE = re.compile(rb"[\x20\x09-\x0D]")
#: Bytes of a text that are split into words at once, and words that are joined at once.
PIECE_BYTES, PIECE_WORDS = 1 << 20, 1 << 16
#: Periods up to this are looked for by comparing words, longer ones by runs of as many words that come again.
GRAM = 4
#: Times that places are narrowed down; stopping early keeps more of them and changes no result.
ROUNDS = 32


def lyndon_lengths(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The length of the longest Lyndon word that starts at each place of each piece of x (pieces begin where first is true).

    Phase one of Baier's suffix sorter: places are grouped by the Lyndon word that they are
    known to start with, at first their symbol. Groups are taken from the greatest to the least.
    What a group's word is then is the longest for its places, and the nearest lesser place on
    the left of each stretch of them takes the whole stretch over: it moves to a new group, just
    above its old one, in the order of how many words it took. A word that ends its piece is
    less than its extensions. Time and memory are linear but for the sorting of symbols and counts.
    """
    n = len(x)
    symbols, group = np.unique(x, return_inverse=True)
    top = len(symbols)
    order = np.argsort(group, kind="stable")
    members = [m.tolist() for m in np.split(order, np.cumsum(np.bincount(group, minlength=top))[:-1])] if n else []
    below, above = list(range(-1, top - 1)), [*range(1, top), -1]
    group, length = group.tolist(), [1] * n
    left = np.arange(-1, n - 1)
    left[first] = -1
    left = left.tolist()
    g = top - 1
    while g >= 0:
        grown: dict[tuple[int, int], list[int]] = {}
        for i in members[g]:
            if group[i] != g:
                continue
            taker, size = left[i], length[i]
            if taker >= 0 and group[taker] == g:
                continue
            last, count, after = i, 1, i + size
            while after < n and left[after] == last and group[after] == g:
                last, count, after = after, count + 1, after + size
            if after < n and left[after] == last:
                left[after] = taker
            if taker >= 0:
                length[taker] += after - i
                grown.setdefault((group[taker], count), []).append(taker)
        members[g] = []
        for old, count in sorted(grown, reverse=True):
            new, over = len(members), above[old]
            places = grown[old, count]
            members.append(places)
            for place in places:
                group[place] = new
            below.append(old)
            above.append(over)
            above[old] = new
            below[over] = new
        g = below[g]
    return np.array(length, np.int64)


def _stretches(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first and the number of each stretch of consecutive numbers."""
    cuts = np.flatnonzero(np.diff(places) != 1) + 1
    starts = np.concatenate([[0], cuts]) if len(places) else cuts
    return places[starts], np.diff(np.concatenate([starts, [len(places)]]))


def _candidates(x: np.ndarray, begin: np.ndarray, end: np.ndarray, least: int, times: int) -> np.ndarray:
    """Marks places so that every run (length >= least and times periods) lies within one stretch of marks.

    begin and end are those of each place's text. Periods up to GRAM show as stretches of words
    equal to that many words before. A longer one, q, shows as a stretch of (times - 1) * q -
    GRAM + 1 places or more whose next GRAM words were there at most q places earlier; places
    whose last such place is further off than their stretch allows go, until none does.
    """
    n = len(x)
    cover = np.zeros(n + 1, np.int64)

    def mark(starts: np.ndarray, ends: np.ndarray) -> None:
        np.add.at(cover, starts, 1)
        np.add.at(cover, ends, -1)

    at = np.arange(n)
    for q in range(1, min(GRAM, n - 1) + 1):
        same = np.flatnonzero((x[q:] == x[:-q]) & (at[q:] - q >= begin[q:])) + q
        starts, sizes = _stretches(same)
        long = sizes >= max(least - q, (times - 1) * q)
        mark(starts[long] - q, starts[long] + sizes[long])
    if n > GRAM:
        named = mix(x.astype(np.uint64) + np.uint64(1))
        gram = np.zeros(n - GRAM + 1, np.uint64)
        for k in range(GRAM):
            gram = mix(gram + named[k : n - GRAM + 1 + k])
        order = np.argsort(gram, kind="stable")
        again = np.flatnonzero(gram[order[1:]] == gram[order[:-1]])
        back = np.full(len(gram), n, np.int64)
        back[order[again + 1]] = order[again + 1] - order[again]
        heads = at[: len(gram)]
        places = np.flatnonzero((heads - back >= begin[: len(gram)]) & (heads + GRAM <= end[: len(gram)]))
        for _ in range(ROUNDS):
            starts, sizes = _stretches(places)
            most = (sizes + GRAM - 1) // (times - 1)
            keep = np.repeat(np.where(most > GRAM, most, 0), sizes) >= back[places]
            if keep.all():
                break
            places = places[keep]
        starts, sizes = _stretches(places)
        most = (sizes + GRAM - 1) // (times - 1)
        if len(starts):
            mark(np.maximum(starts - most, begin[starts]), starts + sizes + GRAM - 1)
    return np.cumsum(cover[:-1]) > 0


def _common(data: bytes, i: int, j: int, end: int) -> int:
    """How many symbols (of 4 bytes) from i and from j on are the same, i < j, none at or after end: the longest common extension."""
    n, step, wider = 0, 16, True
    while step:
        size = min(step, end - j - n)
        if size <= 0:
            return n
        if data[4 * (i + n) : 4 * (i + n + size)] == data[4 * (j + n) : 4 * (j + n + size)]:
            n += size
            step = step * 2 if wider else step // 2
        else:
            wider, step = False, size // 2
    # A step of one failed, or the narrowing steps summed to where the texts part.
    while j + n < end and data[4 * (i + n) : 4 * (i + n + 1)] == data[4 * (j + n) : 4 * (j + n + 1)]:
        n += 1
    return n


def find_runs(x: np.ndarray, begin: np.ndarray, end: np.ndarray, *, least: int = 6, times: int = 4) -> list[tuple[int, int, int]]:
    """(start, length, period), ascending, of all runs of at least `least` symbols and `times` (3 or more) periods in texts side by side.

    x holds symbols (numbers from 0), begin and end each symbol's text. A run's smallest
    period is the length of its Lyndon roots, and a run of three periods or more holds, under the
    order or its reverse, two equal roots side by side whose first is the longest Lyndon word at its
    start: so squares of Lyndon words, extended to both sides, give all runs, and nothing else.
    """
    marked = np.flatnonzero(_candidates(x, begin, end, least, times))
    if not len(marked):
        return []
    x = x[marked].astype(np.int32)
    first = np.concatenate([[True], (np.diff(marked) != 1) | (np.diff(begin[marked]) != 0)])
    starts = np.flatnonzero(first)
    piece = np.cumsum(first) - 1
    stop = np.append(starts[1:], len(x))[piece]
    start = starts[piece]
    ahead, behind, n = x.tobytes(), x[::-1].tobytes(), len(x)
    # Sums of random numbers tell most unequal halves apart, whatever the order within them.
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(x.astype(np.uint64) + np.uint64(1)))])
    found: set[tuple[int, int, int]] = set()
    for order in (x, x.max() - x):
        root = lyndon_lengths(order, first)
        at = np.flatnonzero(np.arange(n) + 2 * root <= stop)
        size = root[at]
        at = at[(sums[at + size] - sums[at]) == (sums[at + 2 * size] - sums[at + size])]
        reached: dict[int, int] = {}
        for i, p, lo, hi in zip(at.tolist(), root[at].tolist(), start[at].tolist(), stop[at].tolist(), strict=True):
            if reached.get(p, -1) >= i + 2 * p:
                continue
            right = i + p + _common(ahead, i, i + p, hi)
            if right < i + 2 * p:
                continue
            reached[p] = right
            left = i - _common(behind, n - i - p, n - i, n - lo)
            if right - left >= max(least, times * p):
                found.add((int(marked[left]), right - left, p))
    return sorted(found, key=lambda run: (run[0], run[2]))


def _word_ids(text: bytes, ids: dict[bytes, int]) -> np.ndarray:
    """The words of a text as numbers that ids gives and grows by."""
    out, at = [], 0
    while at < len(text):
        cut = _SPACE.search(text, at + PIECE_BYTES)
        to = cut.start() if cut else len(text)
        words = text[at:to].split()
        out.append(np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words)))
        at = to
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def repeat_tail(key: object, n: int) -> np.ndarray:
    """The word numbers of a text of n words as the query takes it: for a tenth of the keys, words repeat from some place on.

    That place and the period come from the checksum of the key's text; null is the empty text.
    """
    h = zlib.crc32(b"" if key is None else str(key).encode())
    at = np.arange(n)
    if h % 10 or not n:
        return at
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.where(at < a, at, a + (at - a) % p)


def _digest(ids: np.ndarray, words: list[bytes]) -> str:
    out = hashlib.sha256()
    for at in range(0, len(ids), PIECE_WORDS):
        out.update((b" " if at else b"") + b" ".join([words[k] for k in ids[at : at + PIECE_WORDS].tolist()]))
    return out.hexdigest()


def _best(runs: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    """The run with the greatest length / period, compared in whole numbers; the first by start, then period."""
    best = runs[0]
    for run in runs[1:]:
        if run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


FIELDS = [("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()), ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())]


def _scanning(least: int, times: int, repeat: bool, texts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, keys = batch.column("text"), batch.column("doc_id")
            for i, j, data, offsets in text_slices(column):
                raw, ids, parts = data.tobytes(), {}, []
                for k, key in enumerate(keys.slice(i, j - i).to_pylist()):
                    x = _word_ids(raw[offsets[k] : offsets[k + 1]], ids)
                    parts.append(x[repeat_tail(key, len(x))] if repeat else x)
                words, sizes = list(ids), np.array([len(x) for x in parts])
                ends = np.cumsum(sizes)
                x = np.concatenate(parts)
                found: list[list] = [[] for _ in parts]
                begin = np.repeat(ends - sizes, sizes)
                owner = np.repeat(np.arange(len(parts)), sizes)
                for start, length, period in find_runs(x, begin, np.repeat(ends, sizes), least=least, times=times):
                    found[owner[start]].append((int(start - begin[start]), length, period))
                rows, kept_texts = [], []
                for x, runs in zip(parts, found, strict=True):
                    kept = np.ones(len(x), bool)
                    for start, length, period in runs:
                        kept[start + period : start + length] = False
                    listed = hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()).hexdigest()
                    start, length, period = _best(runs) if runs else (None, None, None)
                    rows.append((len(runs), start, length, period, 1000 * length // period if runs else None, listed, _digest(x[kept], words)))
                    if texts:
                        kept_texts.append(b" ".join([words[k] for k in x[kept].tolist()]).decode())
                columns = [pa.array(values, kind) for values, (_, kind) in zip(zip(*rows, strict=True), FIELDS, strict=True)]
                more = {"runs": pa.array([[{"start": s, "length": n, "period": p} for s, n, p in runs] for runs in found], RUNS), "collapsed": pa.array(kept_texts, pa.string())} if texts else {}
                yield pa.RecordBatch.from_arrays([keys.slice(i, j - i), *columns, *more.values()], ["doc_id", *[name for name, _ in FIELDS], *more])

    return run


RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, least: int = 6, times: int = 4, repeat: bool = False, texts: bool = True) -> DataFrame:
    """Runs of consecutive words with a smallest period, of every row's whole text, and the text without their repeats.

    doc_id, n_runs; start (word number), length, period, exponent_milli of the run with the
    greatest length / period (ties: first start, then least period; no run: nulls); runs_sha256
    (of all runs as start,length,period lines), collapsed_sha256 (of the words that are in no run
    after its first period, joined by a space); with texts also runs (all, by start and period)
    and collapsed, the words themselves. Runs have at least `least` words and `times` (3 or
    more) periods. repeat makes words of a tenth of the rows periodic first (repeat_tail).

    Words are separated by ASCII white space. Null, empty and blank texts have no words: no run, and
    the digests of nothing. Repeated rows have a result each, null ids are passed through, equal
    words are equal wherever they are, and other columns aren't read. An empty table gives no rows. No
    shuffle: texts go through in slices, a longer text alone, and places that can't be in a run
    are left out before Lyndon words are grouped; a text's words must fit in one task as numbers.
    """
    if times < 3:
        raise ValueError("runs of under three periods may have no root that begins after their start")
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    more = ", runs array<struct<start: long, length: long, period: long>>, collapsed string" if texts else ""
    fields = ", ".join(f"{name} {'string' if kind_ == pa.string() else 'long'}" for name, kind_ in FIELDS)
    return rows.mapInArrow(_scanning(least, times, repeat, texts), f"doc_id {kind}, {fields}{more}")
