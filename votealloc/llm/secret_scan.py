"""Secret scans with multipart credential linking, by DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Base kinds, in the order that breaks ties of start.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
LEAST_ASSIGNED = 6
#: Parts of credentials that are weak alone: account names, places to log in, strings that could be keys. Every pattern
#: tries a run of its characters once, from the run's start, so that time grows with a text's length and no faster.
NAME = r"""(?i)(?<![a-z0-9_])(?:user(?:name)?|login|account|client_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}"""
ENDPOINT = r"""(?<![A-Za-z0-9+.-])[0-9+.-]*+[A-Za-z][A-Za-z0-9+.-]*+://[^\x20\x09-\x0D"'<>]+|(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?::[0-9]+)?(?![0-9.])"""
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])(?=[0-9+/_=-]*+[A-Za-z])[A-Za-z0-9+/_=-]{16,}"
KINDS = ("assign", "access", "hex", "name", "endpoint", "candidate")
#: Code points between parts of one credential at most.
SCOPE = 200


def _found(text: Column, kind: int, pattern: str, also: Column | None = None) -> Column:
    """Matches in order as (kind, i, gap, size, value_size): the text between matches gives their places."""
    gaps = F.split(text, pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if kind == 0 else hits
    rows = F.transform(
        F.arrays_zip(F.slice(gaps, 1, F.size(hits)).alias("gap"), hits.alias("hit"), values.alias("value")),
        lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("i"), F.char_length(x["gap"]).alias("gap"), F.char_length(x["hit"]).alias("size"), F.char_length(x["value"]).alias("value_size")),
    )
    asked = text.rlike(pattern) if also is None else also & text.rlike(pattern)
    return F.when(asked, rows).otherwise(F.array().cast("array<struct<kind:int,i:int,gap:int,size:int,value_size:int>>"))


def _near(side: Column, window) -> tuple[Column, Column]:
    """The last end of a span so far and the first start of one to come, where side holds."""
    back = F.max(F.when(side, F.col("end"))).over(window.rowsBetween(Window.unboundedPreceding, -1))
    ahead = F.min(F.when(side, F.col("start"))).over(window.rowsBetween(1, Window.unboundedFollowing))
    return back, ahead


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, scope: int = SCOPE) -> DataFrame:
    """Secrets in every row's whole text: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked.

    spans is kind:start:end of every span, by start, then kind in the order of KINDS, joined by
    commas (code points, end exclusive); base_sha256 is the SHA-256 of the same string for the
    kinds assign, access and hex alone. n_linked counts the weak parts that were reported.

    Base kinds are leftmost, non-overlapping matches, dropped when they are too short. Linking
    joins the parts of a text by their intervals: a candidate key (16 or more characters with a
    letter and a digit, overlapping no base span) is reported only with an access identifier,
    or with an account name and an endpoint, at most scope code points away; a name or endpoint
    only next to a reported candidate or a base secret, and the other of the two. The nearest
    part on either side decides, so the join never forms pairs.

    DataFrame functions only. A row travels as the lengths of its matches; all rows of a text
    meet in one task (a text is one row to begin with). Null text is empty: no spans. Null or
    repeated ids are passed through; other columns aren't read; an empty table gives no rows.
    """
    text = F.coalesce(docs[text_col], F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row_key"), docs[id_col].alias("doc_id"), text.alias("text"))
    named = F.col("text").rlike(ACCESS) | (F.col("text").rlike(NAME) & F.col("text").rlike(ENDPOINT))
    rows = rows.withColumn("linkable", named)
    base = [_found(F.col("text"), k, p) for k, p in enumerate((ASSIGN, ACCESS, HEX))]
    weak = [_found(F.col("text"), 3 + k, p, F.col("linkable")) for k, p in enumerate((NAME, ENDPOINT, CANDIDATE))]
    parts = rows.select("row_key", "doc_id", F.explode_outer(F.concat(*base, *weak)).alias("m")).select("row_key", "doc_id", "m.*").repartition("row_key")
    run = Window.partitionBy("row_key", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    placed = parts.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(run)).withColumn("start", F.col("end") - F.col("size"))
    short = (F.col("kind") == 0) & (F.col("value_size") < LEAST_ASSIGNED)
    placed = placed.withColumn("kind", F.when(~short, F.col("kind")))  # a text whose matches all fall away keeps its row
    by_place = Window.partitionBy("row_key").orderBy("start", "kind")
    is_base = F.col("kind") < 3
    base_back, base_ahead = _near(is_base, by_place)
    placed = placed.withColumns({"base_back": base_back, "base_ahead": base_ahead})
    clear = (F.coalesce(F.col("base_back"), F.lit(0)) <= F.col("start")) & (F.coalesce(F.col("base_ahead"), F.col("end")) >= F.col("end"))
    placed = placed.withColumn("free", (F.col("kind") == 5) & clear)

    def close(df: DataFrame, name: str, side: Column) -> DataFrame:
        back, ahead = _near(side, by_place)
        df = df.withColumns({"__back": back, "__ahead": ahead})
        near = (F.col("start") - F.col("__back") <= scope) | (F.col("__ahead") - F.col("end") <= scope)
        return df.withColumn(name, F.coalesce(near, F.lit(False))).drop("__back", "__ahead")

    placed = close(placed, "by_access", F.col("kind") == 1)
    placed = close(placed, "by_name", F.col("kind") == 3)
    placed = close(placed, "by_endpoint", F.col("kind") == 4)
    placed = placed.withColumn("linked", F.col("free") & (F.col("by_access") | (F.col("by_name") & F.col("by_endpoint"))))
    placed = close(placed, "by_secret", F.col("linked") | F.col("kind").isin(0, 2))
    partner = ((F.col("kind") == 3) & F.col("by_endpoint")) | ((F.col("kind") == 4) & (F.col("by_name") | F.col("by_access")))
    shown = is_base | F.col("linked") | (partner & F.col("by_secret"))

    span = F.struct("start", "kind", "end")
    found = placed.groupBy("row_key", "doc_id").agg(
        *[F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{name}") for k, name in enumerate(KINDS[:3])],
        F.array_sort(F.collect_list(F.when(is_base, span))).alias("base"),
        F.array_sort(F.collect_list(F.when(shown, span))).alias("all"),
    )

    def listed(name: str) -> Column:
        return F.array_join(F.transform(name, lambda x: F.concat_ws(":", F.element_at(F.array(*[F.lit(k) for k in KINDS]), x["kind"] + 1), x["start"], x["end"])), ",")

    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(listed("base"), 256).alias("base_sha256"), listed("all").alias("spans"), (F.size("all") - F.size("base")).cast("long").alias("n_linked"))
