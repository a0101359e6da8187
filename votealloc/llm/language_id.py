"""Language identification by compression."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNDETERMINED = "und"
#: The bound of what is learned from: so many labelled rows a language, chosen among those of so many characters at most where there are enough.
SAMPLE_ROWS = 96
ROW_CHARS = 2500
#: Parts of a language's hashes whose lowest are found apart.
PARTS = 64
#: Texts are compressed in pieces of this many bytes, each with the bare dictionary.
PIECE_BYTES = 2048
#: Zstandard's fast mode: short matches against the dictionary decide, not the text's own repeats.
COMPRESSION_LEVEL = -1
#: The smallest must be smaller than the next by this share of it, or the text is rejected.
LEAST_MARGIN = 0.01


_WORD = re.compile(r"[^\W\d_]+")


def folded(text: str) -> bytes:
    """The text's distinct words in lower case, in order: upper case, digits, marks and lines repeated over and over say nothing of the language."""
    return (" " + " ".join(dict.fromkeys(_WORD.findall(text.lower()))) + " ").encode()


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", *, rows: int = SAMPLE_ROWS, row_chars: int = ROW_CHARS) -> dict[str, bytes]:
    """A raw-content dictionary for every language of labelled rows (null labels and texts without letters are left out).

    Learns from a bounded sample: the rows distinct texts of each language that have the lowest
    hashes, of those with row_chars characters at most (longer ones only where a language has too few).
    All of a sampled text goes into the dictionary. The sample is the same in every run. Each
    task keeps the lowest of its own texts, by language and part of the hash, before the shuffle.
    """
    named = labelled.select(labelled[lang_col].alias("lang"), labelled[text_col].alias("text")).where(F.col("lang").isNotNull() & has_letter(F.col("text")))
    hashed = named.select("lang", (F.length("text") > row_chars).alias("long"), F.xxhash64("text").alias("h")).withColumn("part", F.pmod("h", F.lit(PARTS)))
    order = ["long", "h"]
    by_part = Window.partitionBy("lang", "part").orderBy(*order)
    lowest = hashed.groupBy("lang", "part", *order).count().withColumn("n", F.row_number().over(by_part)).where(F.col("n") <= rows)
    lowest = lowest.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("n") <= rows).select("lang", "h")
    chosen = lowest.collect()  # languages * rows hashes
    if not chosen:
        return {}
    sample = named.withColumn("h", F.xxhash64("text")).where(F.col("h").isin([r.h for r in chosen])).dropDuplicates(["lang", "h"])
    wanted = {(r.lang, r.h) for r in chosen}
    texts: dict[str, list[tuple[int, str]]] = {}
    for r in sample.collect():
        if (r.lang, r.h) in wanted:
            texts.setdefault(r.lang, []).append((r.h, r.text))
    return {lang: b"\n".join(folded(t) for _, t in sorted(found)) for lang, found in sorted(texts.items())}


def _pieces(data: bytes) -> list[bytes]:
    return [data[i : i + PIECE_BYTES] for i in range(0, len(data), PIECE_BYTES)]


def _classifier(dictionaries: dict[str, bytes], least_margin: float) -> Callable[[Iterator[pa.Array]], Iterator[pa.Array]]:
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import zstandard

        langs = sorted(dictionaries)
        coders = []
        for lang in langs:
            content = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=COMPRESSION_LEVEL)
            coders.append(zstandard.ZstdCompressor(level=COMPRESSION_LEVEL, dict_data=content, write_checksum=False, write_content_size=False, write_dict_id=False))
        for batch in batches:
            preds, scores, sure = [], [], []
            for text in batch:
                if not text.is_valid or not langs:
                    preds.append(UNDETERMINED)
                    scores.append(0.0)
                    sure.append(False)
                    continue
                pieces = _pieces(folded(text.as_py()))
                sizes = sorted((sum(len(c.compress(p)) for p in pieces), lang) for c, lang in zip(coders, langs, strict=True))
                margin = 1 - sizes[0][0] / sizes[1][0] if len(sizes) > 1 else 1.0
                preds.append(sizes[0][1])
                scores.append(margin)
                sure.append(margin >= least_margin)
            yield pa.StructArray.from_arrays([pa.array(preds, pa.string()), pa.array(scores, pa.float64()), pa.array(sure, pa.bool_())], ["lang_pred", "score", "accepted"])

    return run


def language_of(text: Column, dictionaries: dict[str, bytes], *, least_margin: float = LEAST_MARGIN) -> Column:
    """struct (lang_pred, score, accepted) of each whole text.

    The text's distinct words are compressed with each language's dictionary, piece by piece, so
    that the whole of a long text counts; the smallest sum wins (ties: the first name). score is the margin, 1
    - smallest / next, from 0 to 1; under least_margin the text is rejected (accepted is
    false). A null text or one without letters is UNDETERMINED with score 0 and rejected, as is
    every text if nothing was learned. Only the text is looked at. No shuffle.
    """
    letters = F.when(has_letter(text), text)
    return F.arrow_udf(_classifier(dictionaries, least_margin), "lang_pred string, score double, accepted boolean")(letters)


def held_out(key: Column) -> Column:
    """Rows that nothing is learned from: crc32 of the key's text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(False))
