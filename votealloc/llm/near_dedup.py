"""MinHash near-duplicates with min-max signatures."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from votealloc.llm import kernels
from votealloc.llm.components import connected_components
from votealloc.llm.shared import discard, join_parted, keyed, materialise

#: Copies of one row of sets that a join spreads the links of a hot document over, by so many links each.
LINKS_PER_COPY = 256
#: Members of a bucket on either side that one task pairs; larger ones are paired in squares of this side.
SIDE = 4096
#: Sets of so many shingles at most are candidates by their least shingles too.
SMALL = 32


def _permutations(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 64, n, np.uint64) | np.uint64(1)


def _list_array(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def _signer(k: int, percent: int, permutations: int, rows_per_band: int, seed: int):
    """Arrow function: row_key, set size, two hashes of the set, one key a band, and the least shingles of a small set.

    Each permutation (a multiplication by an odd number, then the top bits count) is evaluated
    once a shingle and gives two signature values, the least and the greatest image. A set with
    similarity s agrees in either with probability s, and the two are all but independent, so
    permutations/2 evaluations stand for permutations values. Not so in small sets, where least
    and greatest depend on each other; two of SMALL shingles at most that are alike by percent
    share one of their size - percent of size + 1 least shingles.
    """
    factors = _permutations(permutations, seed)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, text = batch.column("row_key"), batch.column("text")
            for i, j, data, offs in kernels.text_slices(text):
                _, _, row, word = kernels.word_hashes(data, offs)
                row, h = kernels.shingles(word, row, j - i, k)
                n = np.bincount(row, minlength=j - i)
                full = np.flatnonzero(n)
                firsts = (np.cumsum(n) - n)[full]
                bands = np.zeros((len(full), 2 * permutations // rows_per_band), np.uint64)
                one = np.zeros(j - i, np.uint64)
                two = np.zeros(j - i, np.uint64)
                if len(full):
                    one[full] = np.add.reduceat(kernels.mix(h), firsts)
                    two[full] = np.add.reduceat(kernels.mix(h ^ np.uint64(seed)), firsts)
                    for p in range(permutations):
                        image = h * factors[p]
                        for side, ufunc in enumerate((np.minimum, np.maximum)):
                            at = (2 * p + side) // rows_per_band
                            bands[:, at] = kernels.mix(bands[:, at] + ufunc.reduceat(image, firsts))
                # Of a small set also its least shingles, of which sets that are alike share one.
                size = n[full]
                few = np.where(size <= SMALL, size - -(-size * percent // 100) + 1, 0)
                inner = np.arange(int(few.sum())) - np.repeat(np.cumsum(few) - few, few)
                counts = np.zeros(j - i, np.int64)
                counts[full] = bands.shape[1] + few
                at = np.repeat(np.cumsum(counts[full]) - counts[full], few) + bands.shape[1] + inner
                values = np.zeros(int(counts.sum()), np.uint64)
                values[at] = h[np.repeat(firsts, few) + inner]
                rest = np.ones(len(values), bool)
                rest[at] = False
                values[rest] = bands.reshape(-1)
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(i, j - i), pa.array(n.astype(np.int64)), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), _list_array(values, counts)],
                    ["row_key", "n_shingles", "one", "two", "bands"],
                )

    return sign


def _setter(k: int):
    """Arrow function: row_key and the sorted set of shingle hashes."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offs in kernels.text_slices(batch.column("text")):
                _, _, row, word = kernels.word_hashes(data, offs)
                row, h = kernels.shingles(word, row, j - i, k)
                yield pa.RecordBatch.from_arrays([batch.column("row_key").slice(i, j - i), _list_array(h, np.bincount(row, minlength=j - i))], ["row_key", "shingles"])

    return sets


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow function: of two sorted sets in each row, the size of the intersection, both sizes, and what a has beside it."""
    for batch in batches:
        (oa, va), (ob, vb) = ((batch.column(c).offsets.to_numpy(), batch.column(c).values.to_numpy(zero_copy_only=False)) for c in ("set_a", "set_b"))
        rests = [np.setdiff1d(va[oa[r] : oa[r + 1]], vb[ob[r] : ob[r + 1]], assume_unique=True) for r in range(batch.num_rows)]
        left = np.array([len(x) for x in rests], np.int64)
        n_a, n_b = np.diff(oa).astype(np.int64), np.diff(ob).astype(np.int64)
        rest = _list_array(np.concatenate(rests) if rests else np.zeros(0, np.int64), left)
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(n_a - left), pa.array(n_a), pa.array(n_b), rest], ["a", "b", "common", "n_a", "n_b", "rest"])


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with the size common of their intersection, the rest of A, and linked: 100 * common >= percent * |A or B|.

    b is the side that may stand in very many pairs: its set is copied once for every
    LINKS_PER_COPY of them, so that no task gets all links of a hot document.
    """
    copies = materialise(pairs.groupBy("b").agg(F.ceil(F.count("*") / LINKS_PER_COPY).alias("copies"), F.count("*").alias("n")), "near-copies")
    right = sets.withColumnsRenamed({"row_key": "b", "shingles": "set_b"}).join(copies.drop("n"), "b")
    right = right.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))).drop("copies")
    left = join_parted(pairs, copies, ["b"], "a").withColumn("copy", F.pmod(F.xxhash64("a"), "copies")).drop("copies")
    left = left.join(sets.withColumnsRenamed({"row_key": "a", "shingles": "set_a"}), "a")
    both = left.join(right, ["b", "copy"]).select("a", "b", "set_a", "set_b").mapInArrow(_common, "a long, b long, common long, n_a long, n_b long, rest array<long>")
    linked = F.col("common") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("common")) * percent
    return materialise(both.select("a", "b", "common", "rest", linked.alias("linked")), "near-links")


def _paired(x: DataFrame, y: DataFrame, keys: list[str], n_x: str, n_y: str, condition: Column) -> DataFrame:
    """Structs x and y of rows that share keys and meet condition; n_x and n_y (in both tables) say how many a key has on either side.

    A key with many is split into squares of SIDE by SIDE, each a task's work.
    """
    over = {"part_x": (x, "x", n_x, "part_y", n_y), "part_y": (y, "y", n_y, "part_x", n_x)}
    sides = []
    for own, (side, name, n, other, n_other) in over.items():
        dealt = side.withColumn(own, F.pmod(F.xxhash64(f"{name}.node"), F.ceil(F.col(n) / SIDE)))
        dealt = dealt.withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col(n_other) / SIDE) - 1)))
        sides.append(dealt.select(*keys, name, "part_x", "part_y"))
    return sides[0].join(sides[1], [*keys, "part_x", "part_y"]).where(condition)


def _open_pairs(member: DataFrame, hubs: DataFrame, seen: DataFrame, alone: DataFrame, bucket: list[str], percent: int) -> DataFrame:
    """The pairs (a, b) of members of a bucket in different components that may be alike.

    All members have been compared with their bucket's hub. The core of a hub is its set and
    every shingle that a fifth of its members have beside it. |A and B| is what A and B share in
    the core, at most min(|A and core|, |B and core|), and what they share outside. So either that
    minimum is enough for a link by itself, or they share shingles outside the core (that neither
    has alone): those pairs are found by an equi-join on such shingles. Members of a hub's
    largest component aren't paired among each other.
    """
    compared = seen.select(F.col("a").alias("node"), F.col("b").alias("hub"), "common", "rest")
    known = join_parted(member, hubs, bucket, "node", "rows").select("node", "hub", "n", "label").distinct().join(compared, ["node", "hub"])
    lists = alone.join(known.select("node").distinct(), "node", "left_semi").groupBy("node").agg(F.collect_list("shingle").alias("own_set"))
    known = known.join(lists, "node", "left").withColumn("rest", F.array_except("rest", F.coalesce("own_set", F.array().cast("array<long>")))).drop("own_set")
    known = materialise(known, "near-known")
    sized = known.groupBy("hub", "label").agg(F.count("*").alias("size"), F.min("n").alias("least"))
    per_hub = sized.groupBy("hub").agg(F.max_by("label", F.struct("size", "label")).alias("largest"), F.max("size").alias("most"), F.sum("size").alias("members"), F.min("least").alias("least"))
    per_hub = per_hub.withColumn("strays", F.col("members") - F.col("most")).withColumn("held", F.col("members")).drop("most").where("strays > 0")
    known = join_parted(known, materialise(per_hub, "near-hubs"), ["hub"], "node", "held").withColumn("stray", F.col("label") != F.col("largest"))
    known = materialise(known.drop("largest"), "near-known")

    outside = known.select("hub", "node", "members", "stray", F.explode("rest").alias("shingle"))
    shingles = outside.groupBy("hub", "shingle").agg(F.count("*").alias("holders"), F.count_if("stray").alias("stray_holders"), F.max("members").alias("members"))
    is_core = (F.col("holders") * 5 >= F.col("members")) & (F.col("holders") > 2)
    shingles = materialise(shingles.where("holders > 1").select("hub", "shingle", "stray_holders", "holders", F.col("holders").alias("held"), is_core.alias("core")), "near-shingles")
    outside = materialise(join_parted(outside.drop("members", "stray"), shingles, ["hub", "shingle"], "node", "held"), "near-outside")
    in_core = outside.where("core").groupBy("hub", "node").agg(F.count("*").alias("more"))
    known = materialise(known.drop("rest").join(in_core, ["hub", "node"], "left").withColumn("common", F.col("common") + F.coalesce("more", F.lit(0))).drop("more"), "near-core")

    columns = ("node", "n", "label", "common")
    x, y = ({c: F.col(f"{side}.{c}") for c in columns} for side in "xy")
    row = F.struct(*columns)
    pair = [F.least(x["node"], y["node"]).alias("a"), F.greatest(x["node"], y["node"]).alias("b")]
    smallest = F.greatest(F.col("least").cast("double"), F.col("n") * percent / 100)
    strays = known.where("stray").where(F.col("common") * (100 + percent) >= (F.col("n") + smallest) * percent).withColumn("x", row)
    enough = F.least(x["common"], y["common"]) * (100 + percent) >= (x["n"] + y["n"]) * percent
    by_hub = _paired(strays, known.withColumn("y", row), ["hub"], "strays", "members", (x["label"] != y["label"]) & enough).select(pair)

    rests = outside.where("not core and stray_holders > 0").select("hub", "node", "shingle", "holders", "stray_holders")
    rests = materialise(rests.join(known.select("hub", "node", "stray", row.alias("at")), ["hub", "node"]).drop("node"), "near-rests")
    sides = [rests.where("stray").withColumnRenamed("at", "x"), rests.withColumnRenamed("at", "y")]
    shared = _paired(*sides, ["hub", "shingle"], "stray_holders", "holders", x["label"] != y["label"]).groupBy("x", "y", "hub").agg(F.count("*").alias("beside"))
    by_rest = shared.where((F.least(x["common"], y["common"]) + F.col("beside")) * (100 + percent) >= (x["n"] + y["n"]) * percent).select(pair)
    return by_hub.unionByName(by_rest).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, row_col: str | None = None, k: int = 5, percent: int = 75, permutations: int = 64, rows_per_band: int = 4, seed: int = 20240229, star_rounds: int = 1) -> DataFrame:
    """Groups of documents whose sets of k-word shingles are alike by percent or more (Jaccard).

    Returns a row for each row of docs: doc_id, n_shingles, component_id (the smallest doc_id
    that links reach, itself included), kept (doc_id = component_id); and row_key, the row_col
    of docs or else a number of our own.

    Method: min-max hashing. permutations evaluations a shingle give 2 * permutations signature
    values (least and greatest image), cut into bands of rows_per_band. Texts with equal sets
    become one node. Nodes that share a band's key are candidates; every link is confirmed on
    the full sets. A pair can only be alike if the shingles of either that any candidate shares
    would make it so; nodes with too many shingles of their own for their bucket drop out, so
    the many edited copies of one text don't meet each other in vain. Nor are all pairs of a
    bucket formed: star_rounds times, one member of each bucket (first the one with the least
    share of own shingles, then by hash) is compared with the members of other components so
    far, and confirmed links merge components, and again as long as a bucket has more than SIDE
    members outside its largest component and a round at least halves the pairs that are open;
    then every pair of members that still lie in different components and may be alike, by bounds
    from their comparison with that first one, is compared too. So no link between components is lost that any band proposes: at 0.75 the
    32 default bands of 4 miss a pair with a probability under 0.00001. Where the smaller set has
    24 shingles or fewer, the pair is a candidate by its least shingles in any case.

    A text with fewer than k words has one shingle, all its words; a null text or one without
    words has none and links with nothing. A null doc_id is never the smallest unless all of the
    group are null; then component_id is null and kept is true. Rows that repeat a doc_id each
    get their group's row. An empty table gives no rows. Other columns of docs are not read.
    """
    table = keyed(docs, {"doc_id": id_col, "text": text_col}, "near-docs") if row_col is None else docs.select(docs[row_col].alias("row_key"), docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    signed = table.select("row_key", "text").mapInArrow(_signer(k, percent, permutations, rows_per_band, seed), "row_key long, n_shingles long, one long, two long, bands array<long>")
    signed = materialise(signed, "near-signed")
    slim = signed.select("row_key", "n_shingles", "one", "two").join(table.select("row_key", "doc_id"), "row_key")
    # Equal sets are one node, known by the row that comes first.
    same = ["n_shingles", "one", "two"]
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key")).alias("first")
    classes = materialise(slim.where("n_shingles > 0").groupBy(same).agg(first, F.count("*").alias("rows")).withColumn("node", F.col("first.row_key")), "near-classes")
    banded = signed.join(classes.select(F.col("node").alias("row_key")), "row_key", "left_semi").select(F.col("row_key").alias("node"), F.posexplode("bands").alias("band", "key"))
    banded = banded.withColumn("band", F.least("band", F.lit(2 * permutations // rows_per_band)))
    bucket = ["band", "key"]
    crowded = materialise(banded.groupBy(bucket).agg(F.count("*").alias("n")).where("n > 1"), "near-crowded")
    buckets = materialise(join_parted(banded, crowded, bucket, "node"), "near-buckets")
    candidates = buckets.select(F.col("node").alias("row_key")).distinct()
    sets = materialise(table.select("row_key", "text").join(candidates, "row_key", "left_semi").mapInArrow(_setter(k), "row_key long, shingles array<long>"), "near-sets")

    # Shingles that no other candidate has can't be in an intersection: |A and B| <= n - own.
    places = sets.select("row_key", F.explode("shingles").alias("shingle")).groupBy("shingle").agg(F.count("*").alias("n"), F.min("row_key").alias("node"))
    alone = materialise(places.where("n = 1").select("node", "shingle"), "near-own")
    own = alone.groupBy("node").agg(F.count("*").alias("own"))
    figures = sets.select(F.col("row_key").alias("node"), F.size("shingles").cast("long").alias("n")).join(own, "node", "left").withColumn("own", F.coalesce("own", F.lit(0)))

    def may_link(n, own, n_other):
        return (n - own) * (100 + percent) >= (n + n_other) * percent

    member = materialise(buckets.join(figures, "node"), "near-members")
    discard(buckets)
    sizes = materialise(member.groupBy(bucket).agg(F.min("n").alias("least"), F.count("*").alias("rows")), "near-sizes")
    smallest = F.greatest(F.col("least").cast("double"), F.col("n") * percent / 100)
    every = join_parted(member, sizes, bucket, "node", "rows").where(may_link(F.col("n"), F.col("own"), smallest)).drop("least")
    every = materialise(every, "near-members")
    discard(member)

    links, seen, hubs, open_pairs, turn = None, None, None, None, 0
    member, star = every.withColumn("label", F.col("node")), True
    while True:
        if turn:
            labels = connected_components(links)
            member = every.join(labels, "node", "left").withColumn("label", F.coalesce("component", "node")).drop("component")
            sizes = member.groupBy(*bucket, "label").agg(F.count("*").alias("size")).groupBy(bucket).agg(F.sum("size").alias("rows"), (F.sum("size") - F.max("size")).alias("strays"))
            split = materialise(sizes.where("strays > 0"), "near-split")
            most, left = split.agg(F.max("strays"), F.sum(F.col("strays").cast("double") * F.col("rows"))).first()
            if most is None:
                break
            member = materialise(join_parted(member, split.drop("strays"), bucket, "node", "rows"), "near-open")
            star = turn < star_rounds or (most > SIDE and (open_pairs is None or left * 2 <= open_pairs))
            open_pairs = left
        if star:
            order = F.struct(F.col("own") / F.col("n"), "node") if turn == 0 else F.xxhash64("node", F.lit(turn))
            hub = member.groupBy(bucket).agg(F.min_by(F.struct("node", "n", "own", "label"), order).alias("hub"), F.count("*").alias("rows"))
            hub = materialise(hub, "near-hub")
            pairs = join_parted(member, hub, bucket, "node", "rows").where(F.col("label") != F.col("hub.label"))
            pairs = pairs.select(F.col("node").alias("a"), F.col("hub.node").alias("b")).distinct()
            if turn == 0:
                hubs = hub.select(*bucket, F.col("hub.node").alias("hub"), "rows")
        else:
            pairs = _open_pairs(member, hubs, seen, alone, bucket, percent)
        if seen is not None:
            pairs = pairs.join(seen, ["a", "b"], "left_anti").join(seen.select(F.col("b").alias("a"), F.col("a").alias("b")), ["a", "b"], "left_anti")
        pairs = materialise(pairs, "near-candidates")
        found = _confirm(pairs, sets, percent)
        seen = found if seen is None else seen.unionByName(found)
        links = seen.where("linked").select("a", "b")
        if not star:
            break
        turn += 1
    # Components of rows in the order of their ids: the least is the component's id, so that no join by component is needed.
    names = classes.select("node", "first")
    named = links.join(names.withColumnsRenamed({"node": "a", "first": "first_a"}), "a").join(names.withColumnsRenamed({"node": "b", "first": "first_b"}), "b")
    labels = connected_components(named.select(F.col("first_a").alias("a"), F.col("first_b").alias("b"))).withColumnRenamed("node", "first")
    placed = classes.join(labels, "first", "left").select(*same, F.coalesce("component", "first").alias("component"), "rows")
    out = join_parted(slim, materialise(placed, "near-placed"), same, "row_key", "rows", "left")
    out = out.withColumn("component_id", F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component.doc_id")))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "row_key")
