"""Repeated substrings by refining buckets of sampled suffixes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from votealloc.llm import kernels
from votealloc.llm.shared import discard, join_parted, keyed, materialise

#: The kernels keep some dozen 8-byte numbers for each byte of a slice.
SLICE_BYTES = 1 << 20


def _owned(gram: np.ndarray, least: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions that are the first least q-gram of some window, and the first and last start of these windows.

    least: of each window of reach + 1 q-grams, by start; 0 where there is no window. Every
    window has one owner, whatever stands around it. The windows of an owner follow each other.
    """
    edge = np.zeros(reach, np.uint64)
    chosen = np.flatnonzero((kernels.sliding(np.concatenate([edge, least, edge]), reach + 1, np.maximum, 0) == gram) & (gram > 0))
    run = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    run_end = np.concatenate([run[1:], [len(least)]]) - 1
    run_end, run = run_end[least[run] > 0], run[least[run] > 0]
    if not len(run):
        return (np.zeros(0, np.int64),) * 3
    values, rank = np.unique(least[run], return_inverse=True)
    size = len(gram) + 1
    by_value = np.argsort(rank * size + run)
    chosen_rank = np.searchsorted(values, gram[chosen])
    key = chosen_rank * size + chosen
    at = by_value[np.searchsorted((rank * size + run)[by_value], key, "right") - 1]
    order = np.argsort(key)
    before = np.full(len(chosen), -1)
    same = chosen_rank[order][1:] == chosen_rank[order][:-1]
    before[order[1:][same]] = chosen[order[:-1][same]]
    first = np.maximum(np.maximum(run[at], before + 1), chosen - reach)
    last = np.minimum(run_end[at], chosen)
    some = first <= last
    return chosen[some], first[some], last[some]


def _sampler(length: int, q: int):
    """Arrow function: the sampled suffixes (row_key, pos, a, b) with their q-gram bucket and their bucket at full context.

    Of every string of length bytes, the first of the least hashes of its q-grams is sampled, so
    that the string has a sampled suffix at the same place wherever it stands: about two in
    length - q positions. a to b: how far before pos the strings start that pos is sampled for.
    """
    reach = length - q

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offs in kernels.text_slices(batch.column("text"), SLICE_BYTES):
                hasher = kernels.SpanHasher(data)
                gram = hasher.grams(q)
                least = kernels.sliding(gram, reach + 1, np.minimum, (1 << 64) - 1)
                if not len(least):
                    continue
                row_of = np.searchsorted(offs, np.arange(len(least)), "right") - 1
                least[np.arange(len(least)) + length > offs[row_of + 1]] = 0
                pos, first, last = _owned(gram, least, reach)
                row = np.searchsorted(offs, pos, "right") - 1
                # The context is hashed by a function that has nothing to do with that of the q-grams.
                raw = memoryview(data)
                full = np.fromiter((xxh3_64_intdigest(raw[a:b]) for a, b in zip(first.tolist(), (last + length).tolist(), strict=True)), np.uint64, len(pos))
                full = kernels.mix(full ^ kernels.mix((pos - first).astype(np.uint64) * np.uint64(1 << 32) + (pos - last).astype(np.uint64)))
                keys = batch.column("row_key").slice(i, j - i).take(pa.array(row))
                columns = [pos - offs[row], pos - last, pos - first, gram[pos].view(np.int64), full.view(np.int64)]
                yield pa.RecordBatch.from_arrays([keys, *[pa.array(c.astype(np.int64)) for c in columns]], ["row_key", "pos", "a", "b", "bucket", "full"])

    return sample


def _contexts(length: int):
    """Arrow function: for each wanted suffix of a text, the bytes of the strings that it is sampled for."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            held = 0
            for key, text, wanted in zip(batch.column("row_key").to_pylist(), batch.column("text"), batch.column("wanted"), strict=True):
                data = text.as_py().encode()
                for w in wanted.as_py():
                    out.append((key, w["pos"], w["bucket"], w["done"], w["b"], data[w["pos"] - w["b"] : w["pos"] - w["a"] + length]))
                    held += 2 * length
                if held > SLICE_BYTES:
                    yield _rows(out)
                    out, held = [], 0
            yield _rows(out)

    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.binary()]

    def _rows(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) if out else [[]] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], ["row_key", "pos", "bucket", "done", "before", "context"])

    return cut


def _refine(suffixes: DataFrame, length: int, q: int, parts: int = 5) -> DataFrame:
    """(row_key, pos, a, b): the strings of length bytes that start a to b bytes before pos occur elsewhere.

    suffixes: one for each distinct full context (done: there are several of it) in buckets with
    several, with their contexts. A node [a, b] stands for the starts a to b before the q-gram.
    All of them share the bytes from a before it to length - b after its start: a bucket's
    suffixes are refined by the bucket identifiers of these later (and earlier) offsets, and one
    that is alone in its refined bucket is settled. One that has company as far as b before and
    length - a after settles the whole node. What is left open is split and refined again within
    the buckets just made. Of suffixes that agree over the whole node one goes on, as company
    for the others; so each round holds few more than the places where repeats end.
    """
    reach = length - q
    opened = suffixes.withColumns({"a": F.lit(0), "b": F.lit(reach)})
    found = None
    width = reach + 1
    while width > 1:
        width = -(-width // parts) if width > 2 * parts else 1
        after = F.length("context") - F.col("before")
        kids = opened.withColumn("low", F.explode(F.sequence(F.col("a"), F.col("b"), F.lit(width)))).withColumn("high", F.least(F.col("b"), F.col("low") + width - 1))
        kids = kids.where((F.col("before") >= F.col("low")) & (after >= length - F.col("high")))
        shared = F.xxhash64("bucket", F.substring("context", F.col("before") - F.col("low") + 1, length - (F.col("high") - F.col("low"))))
        fits = (F.col("before") >= F.col("high")) & (after >= length - F.col("low"))
        wide = F.when(fits, F.xxhash64(F.substring("context", F.col("before") - F.col("high") + 1, length + (F.col("high") - F.col("low")))))
        kids = kids.select("sid", "done", F.col("a").alias("parent"), "low", "high", shared.alias("shared"), F.coalesce(wide, F.lit(0)).alias("wide"))
        node = ["low", "shared"]
        agree = (F.col("wide") != 0) & (F.col("n") > 1) if width > 1 else F.lit(True)
        each = kids.groupBy(*node, "wide").agg(F.count("*").alias("n"), F.min("sid").alias("goes_on"), F.min("done").alias("all_done"))
        each = each.withColumn("agree", agree)
        groups = each.groupBy(node).agg(F.sum("n").alias("total"), F.min(F.col("agree") | F.col("all_done")).alias("closed")).where("total > 1").drop("total")
        state = kids.join(each.drop("all_done", "n").join(groups, node), [*node, "wide"])
        state = materialise(state.select("sid", "done", "parent", "low", "high", "agree", "closed", (~F.col("agree") | (F.col("sid") == F.col("goes_on"))).alias("stays")), "suffix-state")
        hits = materialise(state.where("agree and not done").select("sid", F.col("low").alias("a"), F.col("high").alias("b")), "suffix-hits")
        found = hits if found is None else found.unionByName(hits)
        if width > 1:
            further = state.where("stays and not closed").select("sid", "parent", "low", "high", (F.col("done") | F.col("agree")).alias("done"))
            carried = opened.select("sid", F.col("a").alias("parent"), "bucket", "before", "context")
            onward = further.join(carried, ["sid", "parent"]).select("sid", "bucket", "before", "context", "done", F.col("low").alias("a"), F.col("high").alias("b"))
            before, opened = opened, materialise(onward, "suffix-open")
            discard(before)
        discard(state)
    return found.join(suffixes.select("sid", "row_key", "pos"), "sid").select("row_key", "pos", "a", "b")


def _remover(length: int):
    """Arrow function: the figures of each text after its covered bytes are removed."""

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_bytes, n_removed, n_spans, digests = [], [], [], []
            for text, cuts in zip(pc.fill_null(batch.column("text"), ""), batch.column("cuts"), strict=True):
                data = text.as_py().encode()
                runs: list[list[int]] = []
                for c in sorted((c["pos"] - c["b"], c["pos"] - c["a"] + length) for c in cuts.as_py() or []):
                    if runs and c[0] <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], c[1])
                    else:
                        runs.append(list(c))
                sha, at = hashlib.sha256(), 0
                for low, high in runs:
                    sha.update(data[at:low])
                    at = high
                sha.update(data[at:])
                n_bytes.append(len(data))
                n_removed.append(sum(high - low for low, high in runs))
                n_spans.append(len(runs))
                digests.append(sha.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(digests, pa.string()), batch.column("row_key")], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "row_key"])

    return remove


def repeated_ranges(table: DataFrame, length: int = 200, q: int = 40) -> DataFrame:
    """(row_key, pos, a, b) of table (row_key, text): strings of length bytes that start a to b bytes before pos occur elsewhere too."""
    samples = materialise(table.mapInArrow(_sampler(length, q), "row_key long, pos long, a long, b long, bucket long, full long"), "suffix-samples")
    crowded = materialise(samples.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"), "suffix-crowded")
    members = materialise(join_parted(samples, crowded, ["bucket"], "row_key"), "suffix-members")
    discard(samples)
    discard(crowded)
    contexts = members.groupBy("bucket", "full").agg(F.count("*").alias("n"), F.min(F.struct("row_key", "pos", "a", "b")).alias("first"))
    contexts = materialise(contexts.select("bucket", "full", "n", "first.*"), "suffix-contexts")
    whole = join_parted(members, contexts.where("n > 1").select("bucket", "full", "n"), ["bucket", "full"], "row_key").select("row_key", "pos", "a", "b")
    whole = materialise(whole, "suffix-whole")
    discard(members)
    mixed = contexts.groupBy("bucket").agg(F.count("*").alias("k")).where("k > 1").select("bucket")
    wanted = contexts.join(mixed, "bucket").groupBy("row_key").agg(F.collect_list(F.struct("pos", "bucket", "a", "b", (F.col("n") > 1).alias("done"))).alias("wanted"))
    suffixes = table.join(wanted, "row_key").mapInArrow(_contexts(length), "row_key long, pos long, bucket long, done boolean, before int, context binary")
    suffixes = materialise(suffixes.withColumn("sid", F.xxhash64("row_key", "pos")), "suffix-rows")
    discard(contexts)
    return whole.unionByName(_refine(suffixes, length, q))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, length: int = 200, q: int = 40) -> DataFrame:
    """Removes every byte of a text that lies in a string of length bytes which starts anywhere else too.

    Texts are UTF-8 bytes; strings don't cross rows, may overlap, may repeat within a row, and
    are judged on the input. Returns for each row of docs: doc_id, n_bytes, n_removed, n_spans
    (maximal removed runs), kept_sha256 (of the bytes that stay, concatenated), row_key.

    Method: initial buckets are q-grams, and a bucket's suffixes are refined by hashes of the bytes
    after and before the q-gram, over narrowing ranges, until each is alone or agrees with another
    over length bytes. This departs from bucket-pointer refinement: it looks up no identifiers of
    buckets at later offsets, and a round starts from the first bucket again. Only
    sampled suffixes are put into buckets: every string of length bytes chooses one by its own
    bytes, so at the same place wherever it occurs. Copies are
    settled at once as a bucket of equal full contexts, of which one goes on.

    Null text is empty; texts under length bytes lose nothing. Repeated rows are separate texts
    (both lose what they share). Null ids are passed through, other columns aren't read, an
    empty table gives no rows.
    """
    table = keyed(docs, {"doc_id": id_col, "text": text_col}, "suffix-docs")
    ranges = repeated_ranges(table.select("row_key", F.coalesce("text", F.lit("")).alias("text")), length, q)
    cuts = ranges.groupBy("row_key").agg(F.collect_list(F.struct("pos", "a", "b")).alias("cuts"))
    kind = docs.schema[id_col].dataType.simpleString()
    return table.join(cuts, "row_key", "left").mapInArrow(_remover(length), f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, row_key long")
