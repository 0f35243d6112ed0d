"""Language identification by compression.

Each language has a raw-content zstandard dictionary made of training text.
A text is compressed with each of them, in pieces of ``piece_bytes`` so that
a long text keeps drawing on the dictionary and not on itself; the language
with the smallest sum of bytes wins.  The whole text is compressed.  The margin
is the runner-up's extra bytes for each byte of the winner's output, so neither
the text's length nor its repetitions change it.  A text whose margin is at
most ``min_margin`` is marked ``rejected``; the winner is still named.

A null text, or one without a letter, is ``und`` with score 0 and rejected.
So is every text when no training row has a language.  Ties are rejected; their
name is settled in pieces of ``SHORT_PIECE`` bytes, then by code point.  Repeated rows give repeated results; other columns
may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

UNDETERMINED = "und"
SHORT_PIECE = 24        # bytes of the pieces that settle ties
#: the margin that 0.5 % of labelled training rows outside the dictionaries do not exceed
#: (0.0606 on sf0.1: 5,848 rows named rightly)
MIN_MARGIN = 0.06
_LETTER = re.compile(r"[^\W\d_]")
_OTHER = bytes(b for b in range(128) if not 97 <= b <= 122)
_TABLE = bytes.maketrans(_OTHER, b" " * len(_OTHER))


def letters(text: str) -> bytes:
    """UTF-8 of the lower-cased text, with one space for each run of other ASCII characters."""
    return b" ".join(text.lower().encode("utf-8").translate(_TABLE).split())


def language_samples(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
                     docs_per_language: int = 400, chars_per_doc: int = 1500,
                     dictionary_bytes: int = 112 << 10) -> dict[str, bytes]:
    """The dictionary content of each language, from a bounded sample.

    Per language at most ``docs_per_language`` rows, the first by a hash of
    the id, with ``chars_per_doc`` characters each, cut to
    ``dictionary_bytes``: the driver holds that much for each language.
    """
    rows = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.xxhash64(F.col(id_col).cast("string"), F.lit("langid")).alias("h"),
        F.substring(text_col, 1, chars_per_doc).alias("t"))
    # the hashes alone are ranked, by language; the rows up to each language's last one follow
    first = Window.partitionBy("lang").orderBy("h")
    last = (rows.select("lang", "h").withColumn("k", F.row_number().over(first)).filter(F.col("k") <= docs_per_language)
            .groupBy("lang").agg(F.max("h").alias("last")).collect())
    if not last:
        return {}
    bounds = docs.sparkSession.createDataFrame([(r["lang"], r["last"]) for r in last], "of string, last long")
    found = rows.join(F.broadcast(bounds), F.col("lang") == F.col("of")).filter(F.col("h") <= F.col("last")).select("lang", "h", "t")
    chosen: dict[str, list[str]] = {}
    for r in sorted(found.collect()):
        chosen.setdefault(r["lang"], []).append(r["t"])
    return {lang: b" ".join(map(letters, texts[:docs_per_language]))[:dictionary_bytes] for lang, texts in chosen.items()}


class Compressors:
    """One zstandard compressor per language, built once per Python worker."""

    def __init__(self, samples: dict[str, bytes], level: int, piece_bytes: int):
        import zstandard

        self.names, self.piece = sorted(samples), piece_bytes
        self.compress = []
        for name in self.names:
            d = zstandard.ZstdCompressionDict(samples[name] or b"\n" * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            self.compress.append(zstandard.ZstdCompressor(level=level, dict_data=d, write_content_size=False,
                                                          write_checksum=False, write_dict_id=False).compress)

    def sizes(self, data: bytes, piece: int | None = None) -> list[int]:
        piece = piece or self.piece
        pieces = [data[i:i + piece] for i in range(0, len(data), piece)]
        return [sum(len(c(p)) for p in pieces) for c in self.compress]

    def judge(self, text: str, min_margin: float) -> tuple[str, float, float, bool]:
        data = letters(text)
        found = judge(self.names, self.sizes(data), min_margin)
        if found[2] > 0:
            return found
        name, score, _, _ = judge(self.names, self.sizes(data, SHORT_PIECE), min_margin)
        return name, score, *found[2:]


def judge(names: list[str], sizes: list[int], min_margin: float) -> tuple[str, float, float, bool]:
    """Language, score, margin and rejection for the compressed sizes."""
    best = min(sizes)
    at = sizes.index(best)
    others = sizes[:at] + sizes[at + 1:]
    margin = (min(others) - best) / best if others else 1.0
    # sizes are code lengths: a byte is 8 bits; tempered, as pieces repeat the overhead
    score = 1 / sum(2.0 ** (-min(64.0, 2.0 * (s - best))) for s in sizes)
    return names[at], score, margin, margin <= min_margin


def identify_languages(docs: DataFrame, samples: dict[str, bytes], text_col: str = "text", level: int = 5,
                       piece_bytes: int = 2048, min_margin: float = 0.0) -> DataFrame:
    """``docs`` with ``langid``: a struct of language, score, margin and rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(samples)
    schema = "language string, score double, margin double, rejected boolean"

    @F.pandas_udf(schema)
    def langid(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tools = Compressors(shared.value, level, piece_bytes)
        for texts in batches:
            rows = []
            for t in texts:
                if not t or not tools.names or not _LETTER.search(t):
                    rows.append((UNDETERMINED, 0.0, 0.0, True))
                else:
                    rows.append(tools.judge(t, min_margin))
            yield pd.DataFrame(rows, columns=["language", "score", "margin", "rejected"])

    return docs.withColumn("langid", langid(F.col(text_col)))
