"""One identity for the spellings of a precinct: connected components over links within counties."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from votealloc.functions import keys as K
from votealloc.sources.scratch import remove, written


def alias_links(names: DataFrame) -> DataFrame:
    """Links (county, a, b) between names (county, precinct_id as COUNTY - CODE) that share a form of their code: each name with the first of the form."""
    code = F.element_at(F.split("precinct_id", " - ", 2), -1)
    forms = names.select("county", "precinct_id", F.explode(K.alias_variants(K.norm(code))).alias("form")).distinct()
    first = forms.groupBy("county", "form").agg(F.min("precinct_id").alias("b"))
    return forms.join(first, ["county", "form"]).select("county", F.col("precinct_id").alias("a"), "b").where("a <> b").distinct()


def _toward_least(edges: DataFrame, upward: bool) -> DataFrame:
    """Edges (county, u, v), u > v, with each name's neighbours moved to the least of them: those above it (upward), or those below."""
    near = edges.select("county", F.col("u").alias("x"), F.col("v").alias("y"))
    if upward:
        near = near.unionByName(edges.select("county", F.col("v").alias("x"), F.col("u").alias("y")))
    least = near.groupBy("county", "x").agg(F.min("y").alias("m")).withColumn("m", F.least("x", "m"))
    moved = near.join(least, ["county", "x"])
    moved = moved.where("y > x").select("county", F.col("y").alias("u"), F.col("m").alias("v")) if upward else moved.select("county", F.explode(F.array(F.struct(F.col("x").alias("u"), F.col("m").alias("v")), F.struct(F.col("y").alias("u"), F.col("m").alias("v")))).alias("e")).select("county", "e.*")
    return moved.where("u <> v").distinct()


def identities(links: DataFrame) -> DataFrame:
    """(county, name, root): the least name that links (county, a, b) lead to, of every name in a link; others are their own root.

    Neighbours move to the least of theirs, those above a name and those below it in turn, until
    every name hangs on its root. Each round's edges are written and the last round's removed. There are never
    more than the first round's, and no name's neighbours are gathered; rounds are few, as
    distances shrink by halves.
    """
    edges = links.where("a <> b").select("county", F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now, last = written(edges), None
    while True:
        after = written(_toward_least(_toward_least(now, True), False))
        remove(now)
        mark = tuple(after.agg(F.count("*"), F.bit_xor(F.xxhash64("county", "u", "v"))).first())
        now = after
        if mark == last:
            return now.select("county", F.col("u").alias("name"), F.col("v").alias("root")).unionByName(now.select("county", F.col("v").alias("name"), F.col("v").alias("root"))).distinct()
        last = mark


def with_identity(rows: DataFrame, roots: DataFrame, name: str = "precinct_id", out: str = "root") -> DataFrame:
    """rows (county, name) with the root of their name; their own name where no link has it."""
    found = roots.select("county", F.col("name").alias(name), F.col("root").alias("__root"))
    return rows.join(found, ["county", name], "left").withColumn(out, F.coalesce("__root", name)).drop("__root")
