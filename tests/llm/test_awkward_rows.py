"""Column names that operators use themselves, ids at the edge, copies of one text and long texts."""

from __future__ import annotations

import collections
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from submart.llm import langid, mixing, suffixdedup, toxicity
from submart.llm.components import connected_components
from submart.llm.textbytes import utf8

CLASHING = ["__copies", "__id", "__hash2", "__copy", "row", "id", "hash", "copies", "its_source", "doc_id2", "text_hash"]


def _text(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randrange(1, 5))) for _ in range(n))


def test_mix_keeps_columns_of_any_name(spark):
    rng = random.Random(3)
    rows = [(i, _text(rng, 30), ["s", "t", None][i % 3]) for i in range(60)]
    rows += [(100, rows[0][1], "s"), (100, rows[0][1], "t")]           # equal id and text in two sources
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    df = df.select("*", *[F.concat(F.lit(c), F.col("doc_id")).alias(c) for c in CLASHING])
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    got = out.collect()
    assert all(r[c] == f"{c}{r.doc_id}" for r in got for c in CLASHING)
    source = {(i, s) for i, _, s in rows}
    assert {(r.doc_id, r.source) for r in got} <= source
    # the source with the highest cap takes each of its documents twice, this one among them
    taken = {r.source: r.n for r in out.groupBy("source").agg(F.count("*").alias("n")).collect()}
    full = max((s for s in taken if s in ("s", "t")), key=lambda s: taken[s])
    if taken[full] == 2 * sum(s == full for _, _, s in rows):
        assert sum(r.doc_id == 100 and r.source == full for r in got) == 2


def test_mixed_sources_by_id_and_text(spark):
    """Rows equal in id and text keep their own source."""
    rows = [(1, "one two three four", s) for s in ("a", "b")] + [(2, "five six seven eight", s) for s in ("a", "b")]
    out = mixing.mixed_documents(spark.createDataFrame(rows, "doc_id long, text string, source string"), share=2.0, cap=2.0)
    assert collections.Counter((r.doc_id, r.source) for r in out.collect()) == {(i, s): 2 for i in (1, 2) for s in ("a", "b")}


def test_the_largest_id_is_no_null(spark):
    big = (1 << 63) - 1
    t = _text(random.Random(1), 40)
    df = spark.createDataFrame([(big, t), (5, t), (None, t)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_removed) for r in suffixdedup.remove_repeats(df).collect())
    assert got == [(0, len(t)), (5, 0), (big, len(t))]


def test_parts_of_phrases_are_even():
    """Triggers are minima of many hashes; their parts must not follow that."""
    rng = np.random.default_rng(3)
    triggers = rng.integers(0, 1 << 64, (200_000, 27), dtype=np.uint64).min(axis=1)
    doc, th = np.zeros(len(triggers), np.int64), np.zeros(len(triggers), np.int64)
    batches = list(suffixdedup._phrases_out(triggers, triggers, doc, th, 20))
    rows = [len(x.as_py()) for b in batches if b.num_rows and b.column(0)[0].as_py() == "phrase" for x in b.column(2)]
    assert len(rows) == 20 and max(rows) < 1.2 * min(rows)


def test_copies_of_one_text_spread_over_parts():
    doc = np.arange(5000, dtype=np.int64)
    parts = suffixdedup._dealt(doc, np.full(5000, 77, np.int64), 10)
    assert np.bincount(parts, minlength=10).min() > 400


@pytest.mark.parametrize("long", [False, True])
def test_toxic_spans_are_characters(long):
    rng = random.Random(5)
    clean, toxic = [_text(rng, 30) for _ in range(150)], [_text(rng, 15) + " schnurfelwix " + _text(rng, 10) for _ in range(150)]
    field = toxicity.fit(clean + toxic, [0] * 150 + [1] * 150)
    text = "é ünï " + " ".join([_text(rng, 20) + " schnurfelwix ñ"] * (20_000 if long else 3))
    t0 = time.time()
    _, spans = toxicity.score_texts(field, *utf8(__import__("pyarrow").array(["à schnurfelwix", text])))
    for t, found in zip(("à schnurfelwix", text), spans):
        assert sum(t[s["start"]:s["stop"]] == "schnurfelwix" for s in found) == t.count("schnurfelwix")
    assert time.time() - t0 < 60


def test_language_samples_are_the_first_by_hash(spark):
    rng = random.Random(9)
    rows = [(i, _text(rng, 4), ["en", "de", "fr", None][i % 4] if i % 5 else "en") for i in range(300)] + [(None, "x y", "de"), (7, None, "fr")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    got = langid.language_samples(df, docs_per_language=20, chars_per_doc=12)
    hashed = df.filter("lang is not null and text is not null").select(
        "lang", F.xxhash64(F.col("doc_id").cast("string"), F.lit("langid")).alias("h"), F.substring("text", 1, 12).alias("t")).collect()
    for lang in ("en", "de", "fr"):
        mine = sorted((r.h, r.t) for r in hashed if r.lang == lang)[:20]
        assert got[lang] == b" ".join(langid.letters(t) for _, t in mine)
    assert set(got) == {"en", "de", "fr"}


def test_components_of_a_long_chain(spark):
    n = 3000
    links = spark.range(n).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert connected_components(links).filter("component <> 0").count() == 0
