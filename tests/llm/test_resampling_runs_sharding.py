"""Importance resampling, periodic runs and sharding against plain loops: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import collections
import hashlib
import math
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from votealloc.llm import resampling
from votealloc.llm.resampling import importance_ranks, resample
from votealloc.llm.runs import find_runs, lyndon_lengths, periodic_runs
from votealloc.llm.shared import numbered
from votealloc.llm.sharding import assign_shards, jump, with_shards, write_shards

SCHEMA = "doc_id long, text string, at long, shard int, weight long, position int, c0 string"
TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def frame(spark, rows):
    """rows (doc_id, text) with columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, 1, 2, 3, 4, "z") for i, t in rows], SCHEMA)


def counted(rows):
    return collections.Counter(tuple(r) for r in rows)


def text(rng, n, k=30):
    return rng.choice(["", " "]).join([]) + "".join(f"{rng.choice(['w', 'W', 'é', 'Ä'])}{rng.randrange(k)}{rng.choice([' ', '  ', ', ', chr(0), '-A-', chr(10)])}" for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    out = [(i, text(rng, rng.randint(0, 60))) for i in range(120)]
    out += [(500, None), (501, ""), (502, " \n "), (None, "one two"), (None, None), (503, "a b " * 15), (503, "a b " * 15), (504, "a c " * 15), (504, "d b " * 15)]
    return [*out, (600, text(rng, 300_000, 5000))]


def plain_ranks(rows, target, longest=2, buckets=10_000, least=20, share=25):
    def feats(t):
        w = TOKEN.findall((t or "").translate(LOW))
        return len(w), [zlib.crc32(" ".join(w[i : i + k]).encode()) % buckets for k in range(1, longest + 1) for i in range(len(w) - k + 1)]

    own = [(i, *feats(t)) for i, t in rows]
    s, t = collections.Counter(b for _, _, f in own for b in f), collections.Counter(b for x in target for b in feats(x)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    scored = []
    for i, n, f in own:
        gains = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in f]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        scored.append((i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    line = sorted((x for x in scored if x[1] >= least), key=lambda x: (-x[4], x[0] is None, x[0] or 0, x[2]))
    drawn = {id(x): k + 1 for k, x in enumerate(line[: share * len(line) // 100])}
    return [(i, nf, w, sc, drawn.get(id(x))) for x in scored for i, _, nf, w, sc in [x]]


@pytest.mark.parametrize("options", [{}, {"longest": 3, "buckets": 97, "least": 1, "share": 60}, {"longest": 1, "least": 0, "share": 100}])
def test_importance_ranks(spark, rows, options, monkeypatch):
    monkeypatch.setattr(resampling, "LONG_WORDS", 1000)
    target = [text(random.Random(9), 50, 12), None, "", "w1 w2 w1"]
    target_rows = spark.createDataFrame([(t,) for t in target], "text string")
    named = {"least": "least_words"}
    got = importance_ranks(frame(spark, rows).repartition(5), target_rows, **{named.get(k, k): v for k, v in options.items()})
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"] and {t for _, t in got.dtypes} == {"bigint"}
    assert counted(got.collect()) == counted(plain_ranks(rows, target, **options))


def test_features_of_long_texts_in_stretches(monkeypatch):
    import pyarrow as pa

    rng = random.Random(8)
    long = text(rng, 400_000, 900)
    assert len(long) > 1 << 20

    def found(stretch):
        monkeypatch.setattr(resampling, "LONG_WORDS", stretch)
        out = collections.Counter()
        for length, at, crc in resampling.features(pa.array(["a b", long, None, "", "c"]), 3):
            out.update(zip([length] * len(at), at.tolist(), crc.tolist(), strict=True))
        return out

    assert found(7919) == found(1 << 30)


def test_resampling_of_empty_tables(spark, rows):
    target, docs = spark.createDataFrame([], "text string"), frame(spark, rows)
    assert importance_ranks(frame(spark, []), target).count() == 0
    assert importance_ranks(docs, target).where("rank is not null").count() == 25 * sum(len(TOKEN.findall((t or "").translate(LOW))) >= 20 for _, t in rows) // 100
    drawn, ranks = resample(docs, target), importance_ranks(docs, target).where("rank is not null")
    assert drawn.columns == docs.columns
    assert sorted(r.doc_id for r in drawn.collect()) == sorted(r.doc_id for r in ranks.collect())


def plain_runs(s, least, times):
    n, out = len(s), []
    for q in range(1, n // times + 1):
        k = q
        while k < n:
            if s[k] != s[k - q]:
                k += 1
                continue
            a = k
            while k < n and s[k] == s[k - q]:
                k += 1
            start, length = a - q, k - a + q
            if length >= max(least, times * q) and not any(all(s[z] == s[z - r] for z in range(start + r, start + length)) for r in range(1, q)):
                out.append((start, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_lyndon_lengths():
    rng = random.Random(1)
    for _ in range(300):
        pieces = [[rng.randrange(rng.randint(1, 4)) for _ in range(rng.randint(1, 14))] for _ in range(rng.randint(1, 4))]
        want = [max(size for size in range(1, len(p) - i + 1) if all(p[i : i + size] < p[i + k : i + size] for k in range(1, size))) for p in pieces for i in range(len(p))]
        first = np.array([i == 0 for p in pieces for i in range(len(p))])
        assert lyndon_lengths(np.array(sum(pieces, [])), first).tolist() == want


def periodic(rng, most):
    out, goal = [], rng.randint(0, most)
    while len(out) < goal:
        out += [rng.randrange(5) for _ in range(rng.randint(1, 12))] * rng.randint(1, 7)
        out = out[: len(out) - rng.randint(0, 2)]
    return out


@pytest.mark.parametrize(("least", "times"), [(6, 4), (1, 3), (6, 5)])
def test_find_runs(least, times):
    rng = random.Random(times)
    for _ in range(400):
        texts = [periodic(rng, 70) for _ in range(rng.randint(1, 4))]
        sizes = np.array([len(s) for s in texts])
        ends = np.cumsum(sizes)
        got = find_runs(np.array(sum(texts, []), np.int64), np.repeat(ends - sizes, sizes), np.repeat(ends, sizes), least=least, times=times)
        assert got == [(a + int(e) - len(s), n, q) for s, e in zip(texts, ends, strict=True) for a, n, q in plain_runs(s, least, times)]


def test_find_runs_in_long_texts():
    n = 200_000
    whole = lambda x, **o: find_runs(x, np.zeros(len(x), np.int64), np.full(len(x), len(x)), **o)
    assert whole(np.zeros(n, np.int64)) == [(0, n, 1)]
    assert whole(np.arange(n)) == []
    root = np.random.default_rng(2).permutation(7000)
    assert whole(np.concatenate([[9000], np.tile(root, 20), [9001]])) == [(1, 140_000, 7000)]


def plain_periodic(i, t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    h = zlib.crc32(b"" if i is None else str(i).encode())
    if h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
    runs = plain_runs(w, 6, 4)
    dropped = {k for a, n, q in runs for k in range(a + q, a + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    kept = " ".join(x for k, x in enumerate(w) if k not in dropped)
    return (i, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha("".join(f"{a},{n},{q}\n" for a, n, q in runs)), sha(kept)), runs, kept


def test_periodic_runs(spark, rows):
    rng = random.Random(4)
    short = [(i, t if t is None or len(t) < 9000 else t[:4000]) for i, t in rows]
    short += [(1000 + k, rng.choice([" ", "\t\n", "　 "]).join(f"é{s}" for s in periodic(rng, 90))) for k in range(150)]
    short += [(2000, "x " * 500), (2001, "x x " * 9), (2002, "same row " * 7), (2002, "same row " * 7)]
    docs = frame(spark, short).repartition(3)
    got = periodic_runs(docs, repeat=True, texts=False)
    assert [t for _, t in got.dtypes] == ["bigint"] * 6 + ["string"] * 2
    want = [plain_periodic(i, t) for i, t in short]
    assert counted(got.collect()) == counted(w[0] for w in want)
    assert sum(w[0][1] for w in want) > 100
    full = periodic_runs(docs, repeat=True).select("doc_id", "runs", "collapsed").collect()
    assert counted((r.doc_id, tuple(map(tuple, r.runs)), r.collapsed) for r in full) == counted((w[0][0], tuple(w[1]), w[2]) for w in want)
    assert periodic_runs(frame(spark, [])).count() == 0


def test_periodic_runs_of_a_long_text(spark):
    words = [f"word{k % 1013:04d}" for k in range(300_000)]
    row = periodic_runs(frame(spark, [(3, "lead " + " \n".join(words) + " tail")])).first()
    assert (row.n_runs, row.start, row.length, row.period) == (1, 1, 300_000, 1013)
    assert row.collapsed == " ".join(["lead", *words[:1013], "tail"])


def plain_jump(key, shards):
    digest = hashlib.md5(("" if key is None else str(key)).encode()).digest()
    state, b, j = int.from_bytes(digest[:8], "big"), -1, 0
    while j < shards:
        b = j
        state = (state * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / ((state >> 33) + 1)))
    return b, j


@pytest.mark.parametrize("shards", [1, 2, 8, 9, 1000, 2_000_000])
def test_jump(spark, shards, monkeypatch):
    monkeypatch.setattr("votealloc.llm.sharding.JUMPS", 5 if shards == 1000 else 96)
    keys = spark.createDataFrame([(k,) for k in [*range(400), -5, 2**63 - 1, None]], "k long")
    if shards > 1000:
        keys = keys.where("k % 40 = 0")
    assert all((r.j.shard, r.j.to) == plain_jump(r.k, shards) for r in keys.select("k", jump(F.col("k"), shards).alias("j")).collect())


def test_assign_shards(spark, rows):
    many = rows + [(7000, "same")] * 300
    got = assign_shards(frame(spark, many).repartition(5))
    assert got.dtypes == [("doc_id", "bigint"), ("size", "bigint"), ("text_crc32", "bigint"), ("law", "string"), ("shard", "int"), ("slot", "bigint"), ("grown_shard", "int")]
    found = got.collect()
    of = lambda i, t: (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), "key", plain_jump(i, 8)[0])
    assert counted(r[:5] for r in found) == counted(of(i, t) for i, t in many)
    assert all(r.grown_shard == plain_jump(r.doc_id, 9)[0] and r.grown_shard in (r.shard, 8) for r in found)
    for shard in range(8):
        line = sorted((r for r in found if r.shard == shard), key=lambda r: r.slot)
        assert [r.slot for r in line] == list(range(len(line)))
        order = [(r.doc_id is not None, r.doc_id or 0, r.text_crc32, r.size) for r in line]
        assert order == sorted(order)
    assert assign_shards(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        assign_shards(frame(spark, rows), shards=0)


def test_appended_shards_take_rows_and_no_others_move(spark):
    docs = spark.range(20_000).withColumnRenamed("id", "doc_id")
    before, after = with_shards(docs, 8), with_shards(docs, 12, name="later")
    moves = before.join(after, "doc_id").groupBy("shard", "later").count().collect()
    moved = sum(r["count"] for r in moves if r.shard != r.later)
    assert all(r.later >= 8 for r in moves if r.shard != r.later)
    assert abs(moved / 20_000 - 4 / 12) < 0.02
    assert all(abs(n - 2500) < 200 for n in collections.Counter({s: sum(r["count"] for r in moves if r.shard == s) for s in range(8)}).values())


def test_sharding_needs_no_python(spark, rows):
    plan = with_shards(frame(spark, rows), 8).select("shard")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_write_shards(spark, rows, tmp_path):
    write_shards(frame(spark, rows).drop("shard"), str(tmp_path / "out"), 8, files=2)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert all(r.shard == plain_jump(r.doc_id, 8)[0] for r in back.collect())
    assert counted((r.doc_id, r.text) for r in back.collect()) == counted(rows)


def test_numbered_splits_equal_keys(spark):
    """Of 20,000 rows with one group and key, no part numbers more than a share."""
    rows = spark.range(20_000).select((F.col("id") % 2 == 3).alias("g"), F.lit(1).alias("k"))
    got = numbered(rows, "g", [F.col("k")], "test")
    assert sorted(r.position for r in got.collect()) == list(range(20_000))
