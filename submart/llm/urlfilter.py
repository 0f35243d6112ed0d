"""URL filters: longest-prefix rules, and a Bloom filter cascade for a key list.

The cascade answers "is this key listed?" exactly for every key of the corpus
without a join.  Level 1 encodes the listed keys; level 2 the unlisted keys
that level 1 wrongly passes; level 3 the listed keys that level 2 wrongly
passes; and so on until a level passes nothing wrongly.  It is built over the
corpus's complete key universe, so no key of the corpus is left undecided.

Null, empty and repeated urls, and an empty list, are ordinary input: a null
url has an empty host and path, and an empty list gives a cascade of no level,
which lists nothing.  Only the named columns are read, so other columns may
have any name.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, staged


def url_host(url: Column) -> Column:
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    url = F.coalesce(url, F.lit(""))
    return F.when(F.instr(url, "://") > 0,
                  ascii_lower(F.regexp_extract(_rest(url), r"^[^/?#]*", 0))).otherwise(F.lit(""))


def url_path(url: Column) -> Column:
    """Text after the host up to ``?``, ``#`` or the end."""
    url = F.coalesce(url, F.lit(""))
    return F.when(F.instr(url, "://") > 0,
                  F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))


def _rest(url: Column) -> Column:
    return F.substr(url, F.instr(url, "://") + F.lit(3))


@dataclass(frozen=True)
class UrlRule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def matching_rule(rules: list[UrlRule], host: Column, path: Column) -> Column:
    """The longest rule that fits (struct of text and verdict), or null.

    A rule fits its host and all subdomains when the path starts with its own.
    """
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


@dataclass(frozen=True)
class Level:
    bits: np.ndarray          # int64 words
    size: int                 # number of bits
    hashes: int

    def passes(self, h1: np.ndarray, h2: np.ndarray, level: int) -> np.ndarray:
        out = np.ones(len(h1), dtype=bool)
        for j in range(self.hashes):
            at = _bit(h1, h2, level, j, self.size)
            out &= (self.bits[at >> 6] >> (at & 63)) & 1 == 1
        return out


def _bit(h1, h2, level: int, j: int, size: int) -> np.ndarray:
    """The bit that hash ``j`` of a level sets for a key's two hashes."""
    x = h1.astype(np.uint64) + np.uint64(16 * level + j + 1) * (h2.astype(np.uint64) | np.uint64(1))
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x9E3779B97F4A7C15)
    return ((x >> np.uint64(16)) % np.uint64(size)).astype(np.int64)


def in_levels(levels: list[Level], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Membership: the first level that does not pass a key decides, by its parity."""
    open_, member = np.ones(len(h1), dtype=bool), np.zeros(len(h1), dtype=bool)
    for i, level in enumerate(levels):
        ok = level.passes(h1, h2, i)
        member[open_ & ~ok] = i % 2 == 1
        open_ &= ok
    member[open_] = len(levels) % 2 == 1
    return member


class BloomCascade:
    """Exact membership of a key list over a known universe of keys.

    ``keys`` has a row per distinct key with ``h1``, ``h2`` (two hashes of the
    key) and ``listed``.  A level takes about 1.44 log2(1/rate) bits a key; the
    list, not the corpus, sets the size of level 1, and each later level holds
    a fraction of the one before.  ``max_bytes`` bounds a level, as it is sent
    to every executor; a longer list raises and has to be split by key.
    """

    def __init__(self, keys: DataFrame, max_bytes: int = 64 << 20, max_levels: int = 64):
        self._spark = keys.sparkSession
        self.levels: list[Level] = []
        total, listed = keys.agg(F.count(F.lit(1)), F.count(F.when(F.col("listed"), 1))).first()
        encode, against, wanted = listed, total - listed, True
        while encode:
            if len(self.levels) == max_levels:
                raise ValueError("two keys share both hashes; the cascade can't tell them apart")
            rate = min(0.5, max(1e-4, 0.7071 * encode / max(against, 1))) if not self.levels else 0.5
            self.levels.append(self._level(keys, wanted, encode, rate, max_bytes))
            # the keys of the other kind that come through every level so far
            wrong = keys.filter(F.col("listed") != F.lit(wanted)).filter(self._passes_all()("h1", "h2")).count()
            wanted, encode, against = not wanted, wrong, encode

    def _level(self, keys: DataFrame, wanted: bool, n: int, rate: float, max_bytes: int) -> Level:
        size = max(64, -(-int(n * -math.log(rate) / math.log(2) ** 2) // 64) * 64)
        if size // 8 > max_bytes:
            raise ValueError(f"a level needs {size // 8} bytes, over max_bytes={max_bytes}; split the list by key")
        hashes, level = max(1, round(size / n * math.log(2))) if n * 16 > size else 11, len(self.levels)
        hashes = min(hashes, 11)
        mine = keys.filter(F.col("listed") == F.lit(wanted))
        if self.levels:
            mine = mine.filter(self._passes_all()("h1", "h2"))

        def bits(frames):
            for f in frames:
                h1, h2 = f["h1"].to_numpy(np.int64), f["h2"].to_numpy(np.int64)
                at = np.unique(np.concatenate([_bit(h1, h2, level, j, size) for j in range(hashes)] or [h1]))
                yield pd.DataFrame({"w": at >> 6, "v": np.left_shift(np.int64(1), at & 63)})

        words = (mine.select("h1", "h2").mapInPandas(bits, "w long, v long")
                 .groupBy("w").agg(F.bit_or("v").alias("v")).collect())
        out = np.zeros(size // 64, dtype=np.int64)
        for row in words:
            out[row["w"]] = row["v"]
        return Level(out, size, hashes)

    def _passes_all(self):
        levels = self._spark.sparkContext.broadcast(list(self.levels))

        @F.pandas_udf("boolean")
        def passes(h1: pd.Series, h2: pd.Series) -> pd.Series:
            a, b = h1.to_numpy(np.int64), h2.to_numpy(np.int64)
            out = np.ones(len(a), dtype=bool)
            for i, level in enumerate(levels.value):
                out &= level.passes(a, b, i)
            return pd.Series(out)

        return passes

    def listed(self, key: Column) -> Column:
        levels = self._spark.sparkContext.broadcast(list(self.levels))

        @F.pandas_udf("boolean")
        def member(h1: pd.Series, h2: pd.Series) -> pd.Series:
            return pd.Series(in_levels(levels.value, h1.to_numpy(np.int64), h2.to_numpy(np.int64)))

        return member(*key_hashes(key))


def key_hashes(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(key), F.xxhash64(F.lit("second"), key)


def judge_urls(pages: DataFrame, rules: list[UrlRule], listed: Callable[[Column], Column],
               id_col: str = "page_id", url_col: str = "url", max_bytes: int = 64 << 20) -> DataFrame:
    """Rules first; a host that no rule decides is blocked when it is listed.

    ``listed(host)`` marks the listed keys in the table of the corpus's
    distinct hosts (a condition, or a look-up the caller has joined).  Returns
    the id, host, path, rule, verdict and listed, one row per input row.
    """
    url = F.col(url_col)
    rows = pages.select(F.col(id_col), url_host(url).alias("host"), url_path(url).alias("path"))
    h1, h2 = key_hashes(F.col("host"))
    keys = staged(rows.groupBy("host").agg(F.lit(1).alias("one")).select(
        h1.alias("h1"), h2.alias("h2"), F.coalesce(listed(F.col("host")), F.lit(False)).alias("listed")), "hosts")
    cascade = BloomCascade(keys, max_bytes=max_bytes)
    rows = rows.withColumn("listed", cascade.listed(F.col("host")))
    rule = matching_rule(rules, F.col("host"), F.col("path"))
    return rows.withColumn("fit", rule).select(
        id_col, "host", "path", F.col("fit.rule").alias("rule"),
        F.coalesce(F.col("fit.verdict"), F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"),
        "listed")
