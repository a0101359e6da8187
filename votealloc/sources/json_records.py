"""Objects of one depth out of JSON files of any size, without a task or a value that holds a whole file.

The text is cut at closing braces, so Spark can split a file wherever it likes. A piece's place in
the document follows from what comes before it: whether it begins within a string, and how many
objects are open there. Both are running sums over the pieces of a block, and over blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_INNER = r'(?:[^"\\]++|\\.)*+'
#: An opening brace (group 1) with its key (group 2), if it has one; else a string, to its end or that of the piece.
_TOKEN = rf'(?s)(?:"({_INNER})"\s*+:\s*+)?(\{{)|"{_INNER}(?:"|$)'
_BEFORE = rf'(?:[^"{{]++|"{_INNER}(?:"|$))*+'


def _tokens(text: Column, group: int) -> Column:
    return F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(group))


def _opened(text: Column) -> Column:
    """How many objects a piece opens."""
    return F.size(F.filter(_tokens(text, 2), lambda t: t == "{"))


def _keys(text: Column) -> Column:
    """The key of each object that a piece opens; empty for those without."""
    pairs = F.filter(F.arrays_zip(_tokens(text, 2).alias("brace"), _tokens(text, 1).alias("key")), lambda t: t["brace"] == "{")
    return F.transform(pairs, lambda t: t["key"])


def json_records(spark: SparkSession, path: str | list[str], depth: int, keys: bool = False) -> DataFrame:
    """(file, value): the text of every object that lies within depth - 1 others, in files of JSON documents.

    With keys, also the keys that lead to the object, from depth 2 on, as an array; an object of
    an array has an empty key. Arrays count for nothing in depth. White space, line ends, braces
    and quotes within strings may be as they like; what isn't JSON gives unforeseen rows. Blocks
    are read twice, three times with keys; an object is put together in one task, a file isn't.
    """
    pieces = spark.read.option("lineSep", "}").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value")
    quotes = F.length(bare := F.regexp_replace("value", r"(?s)\\.", "")) - F.length(F.replace(bare, F.lit('"'), F.lit("")))
    in_block = Window.partitionBy("file", "block").orderBy("at")
    earlier, so_far = in_block.rowsBetween(Window.unboundedPreceding, -1), in_block.rowsBetween(Window.unboundedPreceding, 0)
    before = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0))
    pieces = pieces.withColumn("quotes", quotes).withColumn("odd", before("quotes") % 2)

    # Either way a block may begin, outside a string (0) or within (1): its braces, and the fewest that are open after a piece.
    whole, torn = _opened(F.col("value")), _opened(F.concat(F.lit('"'), "value"))
    tried = pieces.withColumns({"whole": whole, "torn": torn})
    for start in (0, 1):
        opens = F.when((F.col("odd") + start) % 2 == 0, F.col("whole")).otherwise(F.col("torn"))
        closes = ((F.col("odd") + start + F.col("quotes")) % 2 == 0).cast("int")
        tried = tried.withColumn(f"net_{start}", opens - closes)
    tried = tried.withColumns({f"run_{start}": F.sum(f"net_{start}").over(so_far) for start in (0, 1)})
    blocks = tried.groupBy("file", "block").agg(F.sum("quotes").alias("quotes"), *[f(f"{c}_{start}").alias(f"{name}_{start}") for start in (0, 1) for f, c, name in ((F.sum, "net", "net"), (F.min, "run", "low"))])
    in_file = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    over_file = lambda c: F.coalesce(F.sum(c).over(in_file), F.lit(0))
    blocks = blocks.withColumn("torn", over_file("quotes") % 2)
    net, low = (F.when(F.col("torn") == 0, F.col(f"{c}_0")).otherwise(F.col(f"{c}_1")) for c in ("net", "low"))
    blocks = blocks.withColumns({"net": net, "low": low}).withColumn("deep", over_file("net"))
    # The object that is open where a block begins was begun in the last block that came out of all such objects.
    came_out = F.when((F.col("deep") < depth) | (F.col("deep") + F.col("low") < depth), F.col("block"))
    blocks = blocks.select("file", "block", "torn", "deep", F.last(came_out, ignorenulls=True).over(in_file).alias("began"))

    rows = pieces.join(blocks, ["file", "block"])
    rows = rows.withColumn("torn", (F.col("odd") + F.col("torn")) % 2)
    rows = rows.withColumn("text", F.when(F.col("torn") == 1, F.concat(F.lit('"'), "value")).otherwise(F.col("value")))
    rows = rows.withColumn("opens", _opened(F.col("text"))).withColumn("net", F.col("opens") - ((F.col("torn") + F.col("quotes")) % 2 == 0).cast("int"))
    rows = rows.withColumn("deep", F.col("deep") + before("net"))
    starts = (F.col("deep") < depth) & (F.col("deep") + F.col("opens") >= depth)
    later = in_block.rowsBetween(1, Window.unboundedFollowing)
    rows = rows.withColumn("starts", starts).withColumns({"to_come": F.coalesce(F.sum(F.col("starts").cast("int")).over(later), F.lit(0)), "begun": F.sum(F.col("starts").cast("int")).over(so_far)})
    if keys:
        rows = _with_keys(rows, depth, so_far, in_file)
    record = [F.when(F.col("begun") > 0, F.col("block")).otherwise(F.col("began")).alias("of"), F.when(F.col("begun") > 0, F.col("to_come")).otherwise(0).alias("no")]
    # The pattern cuts what comes before the object's own brace: so many others first.
    ahead = F.concat(F.lit("(?s)^(?:" + _BEFORE + r"\{){"), (F.lit(depth - 1) - F.col("deep")).cast("string"), F.lit("}" + _BEFORE))
    text = F.when(F.col("starts"), F.regexp_replace("text", ahead, F.lit(""))).otherwise(F.col("value"))
    part = F.struct("block", "at", F.concat(text, F.lit("}")).alias("text"), *(["keys"] if keys else []))
    inside = rows.where("starts or deep >= %d" % depth).select("file", *record, part.alias("part"))
    found = inside.groupBy("file", "of", "no").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    return found.select("file", *([F.get("parts", F.lit(0))["keys"].alias("keys")] if keys else []), F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("value"))


def _with_keys(rows: DataFrame, depth: int, so_far, in_file) -> DataFrame:
    """rows with the keys of the objects that are open after each piece has opened its own: the last at each depth, here or in an earlier block."""
    here = _keys(F.col("text"))
    rows = rows.withColumn("here", here)
    rows = rows.withColumns({f"key_{d}": F.get("here", (F.lit(d - 1) - F.col("deep")).cast("int")) for d in range(2, depth + 1)})
    names = [f"key_{d}" for d in range(2, depth + 1)]
    ends = rows.groupBy("file", "block").agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("at"))).alias(c) for c in names])
    carried = ends.select("file", "block", *[F.last(c, ignorenulls=True).over(in_file).alias(f"{c}_before") for c in names])
    known = rows.withColumns({c: F.last(c, ignorenulls=True).over(so_far) for c in names}).join(carried, ["file", "block"])
    plain = [F.get(F.from_json(F.concat(F.lit('["'), F.coalesce(c, f"{c}_before"), F.lit('"]')), "array<string>"), 0) for c in names]
    return known.withColumn("keys", F.array(*plain)).drop("here", *names, *[f"{c}_before" for c in names])
