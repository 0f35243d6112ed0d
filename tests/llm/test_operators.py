"""Each operator against a brute-force version on a small corpus with the awkward cases."""

from __future__ import annotations

import collections
import hashlib
import pathlib
import random
import re
import time
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from submart.llm import common, jaccard, langid, licenses, mixing, sharding, suffixdedup, toxicity, urlfilter
from submart.llm.cws import edited_fingerprints
from submart.llm.decontam import benchmark_items, find_contamination
from submart.llm.textbytes import utf8
from submart.llm.words import words_of

LOWER = {i: i + 32 for i in range(65, 91)}


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def _shingles(text, k):
    w = _words(text)
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


# ---- n-gram Jaccard join

def _components(rows, k, num, den):
    sets = [_shingles(t, k) for _, t in rows]
    best = [i for i, _ in rows]
    moved = True
    while moved:
        moved = False
        for x in range(len(rows)):
            for y in range(x):
                both = len(sets[x] & sets[y])
                if both and den * both >= num * len(sets[x] | sets[y]) and best[x] != best[y]:
                    best[x] = best[y] = min(best[x], best[y])
                    moved = True
    return collections.Counter((i, len(s), b) for (i, _), s, b in zip(rows, sets, best))


@pytest.mark.parametrize("k,num,den", [(4, 85, 100), (5, 80, 100), (2, 50, 100)])
def test_jaccard_components(docs, k, num, den):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = jaccard.jaccard_components(docs, jaccard.Threshold(k, num, den)).select(
        "doc_id", "n_shingles", "component_id").collect()
    assert collections.Counter(map(tuple, got)) == _components(rows, k, num, den)


def test_jaccard_changed_allocation_loses_nothing(docs, monkeypatch):
    """Weights of 0 and 2 everywhere: deletion neighbourhoods make up for the segments left out."""
    def allocate(stats, threshold):
        scheme = jaccard.Scheme(threshold)
        _, m, _ = scheme.segments(10_000)
        scheme.changes = {b: (list(range(0, int(n) // 3)), list(range(int(n) // 3, 2 * (int(n) // 3))))
                          for b, n in enumerate(m) if n >= 3}
        return scheme

    monkeypatch.setattr(jaccard, "_allocate", allocate)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = jaccard.jaccard_components(docs, jaccard.Threshold(4, 80, 100)).select(
        "doc_id", "n_shingles", "component_id").collect()
    assert collections.Counter(map(tuple, got)) == _components(rows, 4, 80, 100)


def test_jaccard_similar_sets_share_what_they_need():
    """Random pairs at the threshold share a signature, and as many as both need."""
    rng = np.random.default_rng(5)
    t = jaccard.Threshold(1, 80, 100)
    signer = jaccard.Signer(jaccard.Scheme(t), 3000)
    for _ in range(150):
        n = int(rng.integers(1, 400))
        words = [f"w{x}" for x in rng.choice(10_000, 2 * n, replace=False)]
        edits = int(rng.integers(0, max(1, n // 9) + 1))
        a, b = words[:n], words[edits:n] + words[n:n + int(rng.integers(0, edits + 1))]
        both, union = len(set(a) & set(b)), len(set(a) | set(b))
        if 100 * both < 80 * union:
            continue
        s = jaccard.Shingles(pa.array([" ".join(a), " ".join(b)]), 1)
        keys, nodes = signer.signatures(s)
        common = set(keys[nodes == s.nodes[0]]) & set(keys[nodes == s.nodes[1]])
        needs = signer.needs(s)
        x, y = np.searchsorted(signer.starts, s.counts, side="right") - 1
        for band in {x, x + 1} & {y, y + 1}:
            of_band = [c for c in common if int(c) & 1 == band & 1]
            assert len(of_band) >= max(needs[band & 1]) or s.nodes[0] == s.nodes[1]
        differ = sum(int(x ^ y).bit_count() for x, y in zip(*(r.view(np.uint64).tolist() for r in s.sketches())))
        assert differ <= union - both
        assert jaccard.sketch_distance(s.wide_sketch(0), s.wide_sketch(1)) <= union - both


def test_jaccard_templates_do_not_form_all_pairs(spark, monkeypatch):
    """Documents of 80 shared and 20 own words (similarity 0.66): the pairs that meet grow no faster than they do."""
    tables = {}

    def staged(df, name):
        return tables.setdefault(name, common.staged(df, name))

    monkeypatch.setattr(jaccard, "staged", staged)
    shared = " ".join(f"t{i}" for i in range(80))
    for n in (250, 500, 1000):
        rng = random.Random(n)
        rows = [(i, shared + " " + " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(20))) for i in range(n)]
        rows.append((n, rows[5][1] + " end"))                                # one near copy is still found
        tables.clear()
        found = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4),
                                           jaccard.Threshold(4, 85, 100))
        assert found.filter("component_id <> doc_id").select("doc_id", "component_id").collect() == [(n, 5)]
        met = tables["jaccard-met"].groupBy("sig").count().agg(F.sum(F.col("count") * F.col("count"))).first()[0]
        assert (met or 0) <= 2 * n


@pytest.mark.parametrize("crowd", [1, 4])
def test_jaccard_crowded_signatures_lose_nothing(spark, monkeypatch, crowd):
    """Templates with few and many own words, with every signature taken as crowded."""
    monkeypatch.setattr(jaccard, "CROWD", crowd)
    rng = random.Random(3)
    rows = []
    for i in range(120):
        words = [f"t{i % 4}x{j}" for j in range(60)]
        for _ in range(rng.choice([0, 1, 2, 3, 5, 9])):
            words[rng.randrange(len(words))] = f"w{rng.randrange(40)}"
        rows.append((i, " ".join(words[:rng.choice([60, 60, 55, 50])])))
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3),
                                     jaccard.Threshold(2, 80, 100)).select("doc_id", "n_shingles", "component_id")
    assert collections.Counter(map(tuple, got.collect())) == _components(rows, 2, 80, 100)


def test_keep_one_of_each(docs):
    t = jaccard.Threshold(5, 80, 100)
    comps = jaccard.jaccard_components(docs, t).collect()
    want = collections.Counter({r.component_id: 1 for r in comps if r.n_shingles})
    want += collections.Counter(r.doc_id for r in comps if not r.n_shingles)
    kept = jaccard.keep_one_of_each(docs.withColumn("set", F.lit(1)).withColumn("node", F.lit("x")), t)
    assert kept.columns == [*docs.columns, "set", "node"]
    assert collections.Counter(r.doc_id for r in kept.collect()) == want


def test_keep_one_of_each_builds_no_set_twice(spark):
    """The rows that stay are met by id and text in the JVM: that stage starts no Python workers beside the others'."""
    rng = random.Random(12)
    t, u = _plain(rng, 40), _plain(rng, 40)
    rows = [(1, t, "a"), (1, t.upper(), "b"), (1, t, "c"), (2, t + " end", "d"), (1, u, "e"), (3, " \t\x0b\r\n", "f"), (3, "", "g"),
            (3, None, "h"), (None, None, "i"), (4, "\u00a0", "j"), (5, "\u00a0", "k"), (6, " \n x", "l")]
    df = spark.createDataFrame(rows, "doc_id long, text string, row string")
    kept = jaccard.keep_one_of_each(df, jaccard.Threshold(5, 80, 100))
    got = sorted(r.row for r in kept.collect())
    assert len(set(got) & set("abc")) == 1
    assert [x for x in got if x not in "abc"] == list("efghijl")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in ("Python", "Pandas", "MapInArrow") if x in plan]


def test_keep_one_of_each_without_ids(spark):
    """Components of null ids alone, or of one repeated id, stay apart; a component's smallest id that is there stays."""
    rng = random.Random(8)
    texts = [f"t{k} " + _plain(rng, 40) for k in range(6)]
    rows = [(None, t) for t in texts[:4]] + [(None, texts[0]), (None, texts[1] + " z"), (None, texts[4]), (8, texts[4]),
                                             (6, texts[4] + " z"), (5, texts[4]), (5, texts[5]), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = jaccard.keep_one_of_each(df, jaccard.Threshold(5, 80, 100)).collect()
    first = collections.Counter((r.doc_id, (r.text or "").split(" ")[0]) for r in kept)
    assert first == {(None, "t0"): 1, (None, "t1"): 1, (None, "t2"): 1, (None, "t3"): 1, (5, "t4"): 1, (5, "t5"): 1,
                     (None, ""): 1}


# ---- fingerprints

def test_fingerprints(docs):
    rows = sorted({(r.doc_id, r.text or "") for r in docs.collect()}, reverse=True)
    distinct = docs.dropDuplicates(["doc_id"])
    got = {r.doc_id: r for r in edited_fingerprints(distinct, samples=16, range_bytes=2000).collect()}
    assert len(got) == len(rows)
    prints = {}
    for k, (i, t) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        edited = t[:len(t) - half] + following[:half]
        assert got[i].n_chars == len(t)
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert prints.setdefault(t, got[i].fingerprint) == got[i].fingerprint
        parts = [got[i].fingerprint[j:j + 4] for j in range(0, 64, 4)]
        parts2 = [got[i].edited_fingerprint[j:j + 4] for j in range(0, 64, 4)]
        assert got[i].near_edited == sum(map(str.__eq__, parts, parts2)) / 16
        nxt = got[rows[(k + 1) % len(rows)][0]].fingerprint
        assert got[i].near_next == sum(nxt[j:j + 4] == got[i].fingerprint[j:j + 4] for j in range(0, 64, 4)) / 16


def test_fingerprint_collisions_estimate_generalised_jaccard(spark):
    a = " ".join(["x"] * 6 + ["y"] * 2 + [f"a{i}" for i in range(12)])
    b = " ".join(["x"] * 3 + ["y"] * 4 + [f"a{i}" for i in range(6)] + [f"b{i}" for i in range(5)])
    p, q = collections.Counter(a.split()), collections.Counter(b.split())
    true = sum(min(p[w], q[w]) for w in p) / sum(max(p[w], q[w]) for w in {*p, *q})
    df = spark.createDataFrame([(2, a), (1, b)], "doc_id long, text string")
    near = {r.doc_id: r.near_next for r in edited_fingerprints(df, samples=48).collect()}
    assert near[1] == near[2]
    assert abs(near[1] - true) < 4 * (true * (1 - true) / 48) ** 0.5


# ---- mixing

def test_mixing(docs):
    rows = docs.collect()
    mix = mixing.mix_sources(docs, block_words=16, output_shards=5, bucket_rows=10)
    got = mix.taken().collect()
    size = collections.Counter()
    for r in rows:
        size[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    targets = mixing.water_fill([size[s] for s in order], [3, 1, 2, 3][:len(order)], 1.5, 2.0)
    assert abs(sum(targets) - min(1.5, 2) * sum(size.values())) < 1e-6
    assert collections.Counter((r.doc_id, r.size) for r in got) == collections.Counter(
        (r.doc_id, len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))) for r in rows)
    taken = collections.Counter()
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        taken[(r.source_size, round(r.target, 3))] += r.taken
    assert taken == collections.Counter({(size[s], round(t, 3)): int(t + 0.5) for s, t in zip(order, targets)})
    again = mixing.mix_sources(docs.repartition(2), block_words=16, output_shards=5, bucket_rows=10).taken().collect()
    assert collections.Counter(map(tuple, again)) == collections.Counter(map(tuple, got))


def test_mix_slots_are_dealt_to_all_shards(docs):
    mix = mixing.mix_sources(docs, block_words=16, output_shards=5)
    slots = mix.slots().collect()
    assert {r.shard for r in slots} == set(range(5))
    per_block = collections.Counter((r.source_ix, r.block) for r in slots)
    assert max(per_block.values()) <= 2


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000])
def test_permutation(n):
    p = mixing.Permutation(n, 7, 3)
    x = p(np.arange(n))
    assert sorted(x) == list(range(n)) and (p.inverse(x) == np.arange(n)).all()


@pytest.mark.parametrize("size,words", [(1000, 500), (1000, 1900), (1025, 1), (1283, 712), (10, 15), (512, 1024)])
def test_source_plan_takes_exactly(size, words):
    plan = mixing.SourcePlan(0, size, words, 256, 7)
    assert plan.take(np.arange(plan.slots))[1].sum() == words


def test_mixed_documents_keep_all_columns(docs):
    out = mixing.mixed_documents(docs.withColumn("size", F.lit("s")).withColumn("taken", F.lit(1)))
    assert out.columns == [*docs.columns, "size", "taken"]
    texts = {r.doc_id: r.text for r in docs.collect()}
    counts = collections.Counter(r.doc_id for r in out.collect())
    assert counts and all(_words(texts[i]) for i in counts)


# ---- decontamination

def test_decontamination(spark, docs):
    rows = docs.collect()
    passage = next(r.text for r in rows if r.doc_id == 21).split("\n")[1]
    items = [(3, passage), (12, " ".join(passage.split()[4:20]).upper()), (7, "alpha beta"), (8, None), (9, ""),
             (None, "niño ÜBER"), (12, "gamma1 delta")]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = find_contamination(docs.withColumn("found2", F.lit(1)), benchmark_items(table)).collect()
    windows = []
    for i, t in items:
        w = words_of(t)
        windows += [(i, w[k:k + 10]) for k in range(max(1, len(w) - 9) if w else 0)]
    for r in got:
        w = words_of(r.text)
        hit, found = set(), set()
        for i, win in windows:
            for k in range(len(w) - len(win) + 1):
                if w[k:k + len(win)] == win:
                    hit |= set(range(k, k + len(win)))
                    found.add(i)
        assert (r.found.n_words, r.found.n_hit) == (len(w), len(hit))
        assert r.found["items"] == sorted(str(i) for i in found if i is not None)
        inside = b" ".join(b" ".join(words_of(r.text[s.start:s.stop])) for s in r.found.spans)
        assert inside == b" ".join(w[k] for k in sorted(hit))
    assert any(r.found.n_hit for r in got)


# ---- url filters

def test_cascade_is_exact(spark):
    keys = spark.range(4000).select(
        *(c.alias(n) for c, n in zip(urlfilter.key_hashes(F.concat(F.lit("k"), "id")), ("h1", "h2"))),
        (F.col("id") % 17 == 0).alias("listed"))
    cascade = urlfilter.BloomCascade(keys)
    assert len(cascade.levels) > 1
    wrong = spark.range(4000).select(F.col("id"), cascade.listed(F.concat(F.lit("k"), "id")).alias("in")).filter(
        F.col("in") != (F.col("id") % 17 == 0)).count()
    assert wrong == 0
    assert not urlfilter.BloomCascade(keys.filter("not listed")).levels


def test_judge_urls(spark):
    rules = [urlfilter.UrlRule("org", "/", "allow"), urlfilter.UrlRule("example.org", "/es/", "block")]
    urls = [None, "", "no scheme", "http://", "http://A.Example.ORG/es/1?x", "http://xexample.org/es/1", "http://org",
            "x://b.spam.net/p#f://c", "http://ok.net", "http://ok.net", "http://org?/es/", "a://b.org/x\ny"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = urlfilter.judge_urls(pages, rules, lambda h: h.contains("spam")).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in got] == [
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"),
        ("a.example.org", "/es/1", "example.org/es/", "block"), ("xexample.org", "/es/1", "org/", "allow"),
        ("org", "", None, "allow"), ("b.spam.net", "/p", None, "block"), ("ok.net", "", None, "allow"),
        ("ok.net", "", None, "allow"), ("org", "", None, "allow"), ("b.org", "/x\ny", "org/", "allow")]
    assert urlfilter.judge_urls(pages.limit(0), rules, lambda h: F.lit(True)).count() == 0


# ---- toxicity

def test_toxicity_field_finds_stems(docs):
    rng = random.Random(4)
    texts, labels = [], []
    for i in range(400):
        w = _plain(rng, rng.randrange(5, 80)).split()
        if i % 5 == 0:
            for _ in range(rng.randrange(1, 4)):
                w.insert(rng.randrange(len(w)), rng.choice(["Grumblex", "snarfoid"]) + rng.choice(["", "s", "ish"]))
        texts.append(" ".join(w))
        labels.append(int(i % 5 == 0))
    field = toxicity.fit(texts[:300], labels[:300])
    test = pa.array([*texts[300:], None, "", "!!"])
    score, spans = toxicity.score_texts(field, *utf8(test))
    assert ((score[:100] >= 0.7) == (np.array(labels[300:]) == 1)).mean() > 0.97
    assert list(score[100:]) == [0, 0, 0]
    for t, s in zip(texts[300:], spans):
        for x in s:
            assert t[x["start"]:x["stop"]].lower().startswith(("grumblex", "snarfoid"))
    untrained = toxicity.fit(texts[:5], [0] * 5)
    out = toxicity.tag_toxicity(docs, untrained).select("toxicity.score").collect()
    assert len(out) == docs.count() and {r.score for r in out} == {0.0}
    assert toxicity.tag_toxicity(docs, field).count() == docs.count()


def _plain(rng, n):
    return " ".join("".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randrange(1, 5)))
                    for _ in range(n))


def test_field_marginals_match_enumeration():
    rng = np.random.default_rng(2)
    t = rng.normal(size=(2, 2))
    e = rng.normal(size=(3, 5))
    used = np.array([[1, 1, 1, 1, 1], [1, 1, 1, 0, 0], [1, 0, 0, 0, 0]], bool)
    p, joint = toxicity.Field(None, 0.0, t).marginals(e, used, pairs=True)
    total = np.zeros((2, 2))
    for r in range(3):
        n = used[r].sum()
        weight, marginal, pairs = 0.0, np.zeros(n), np.zeros((2, 2))
        for code in range(1 << n):
            y = [(code >> i) & 1 for i in range(n)]
            s = np.exp(sum(e[r, i] * y[i] for i in range(n)) + sum(t[y[i - 1], y[i]] for i in range(1, n)))
            weight += s
            marginal += s * np.array(y)
            for i in range(1, n):
                pairs[y[i - 1], y[i]] += s
        assert np.allclose(p[r, :n], marginal / weight)
        total += pairs / weight
    assert np.allclose(joint, total)


# ---- repeated passages

@pytest.mark.parametrize("span", [50, 30])
def test_repeats(docs, span):
    rows = docs.collect()
    first: dict[bytes, int] = {}
    for r in rows:
        b = (r.text or "").encode()
        for k in range(len(b) - span + 1):
            first[b[k:k + span]] = min(first.get(b[k:k + span], r.doc_id), r.doc_id)
    want = collections.Counter()
    for r in rows:
        b = (r.text or "").encode()
        off = bytearray(len(b))
        for k in range(len(b) - span + 1):
            if first[b[k:k + span]] < r.doc_id:
                off[k:k + span] = b"\1" * span
        kept = bytes(x for x, o in zip(b, off) if not o)
        spans = sum(1 for k in range(len(b)) if off[k] and not (k and off[k - 1]))
        want[(r.doc_id, len(b), sum(off), spans, hashlib.sha256(kept).hexdigest())] += 1
    got = suffixdedup.remove_repeats(docs, span=span, part_bytes=4000, chunk_bytes=3000, chunk_strings=200)
    assert collections.Counter(tuple(r)[:5] for r in got.collect()) == want
    assert sum(k[2] for k in want) > 0


@pytest.mark.parametrize("i", [None, 7])
def test_repeats_of_one_id_in_a_chunk(spark, i):
    """Texts of one id (or of none) in one chunk lose a passage that a smaller id has in another chunk, or the same one."""
    rng = random.Random(21)
    for split in (1, 3):
        shared = [_plain(rng, 120) for _ in range(3)]
        later = [(i, f"{_plain(rng, 20)} {shared[0]} {shared[1]} {_plain(rng, 20)}") for _ in range(4)]
        first = (5, f"{_plain(rng, 9)} {shared[0]} {shared[2]} {shared[1][40:300]} {_plain(rng, 9)}")
        rows = [first, (6, _plain(rng, 50)), *later] if split == 1 else [*later, (6, _plain(rng, 50)), first]
        known = {first[1].encode()[k:k + 50] for k in range(len(first[1].encode()) - 49)}
        want = collections.Counter()
        for x, t in rows:
            b, off = t.encode(), set()
            for k in range(len(b) - 49):
                if x == i and b[k:k + 50] in known:
                    off |= set(range(k, k + 50))
            kept = bytes(c for k, c in enumerate(b) if k not in off)
            want[(x, len(b), len(off), hashlib.sha256(kept).hexdigest())] += 1
        # two partitions, so two chunks: the smaller ids are in one and the four texts in the other
        parts = [rows[:2], rows[2:]] if split == 1 else [rows[:4], rows[4:]]
        table = spark.createDataFrame(spark.sparkContext.parallelize(parts, 2).flatMap(list),
                                      "doc_id long, text string")
        got = suffixdedup.remove_repeats(table)
        assert collections.Counter((r.doc_id, r.n_bytes, r.n_removed, r.kept_sha256) for r in got.collect()) == want


def test_phrases_of_one_trigger_are_told_apart(spark):
    """Two texts of one trigger whose phrase hashes agree in 32 bits lose nothing."""
    rng = np.random.default_rng(6)
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz", np.uint8)
    grams = letters[rng.integers(0, 26, (200_000, 24))]
    at = np.arange(len(grams)) * 24
    least = suffixdedup.Hashes(grams.reshape(-1), suffixdedup._GRAM).of(at, at + 24).argmin()
    texts = np.concatenate([np.tile(grams[least], (300_000, 1)), letters[rng.integers(0, 26, (300_000, 26))]], axis=1)
    at = np.arange(len(texts)) * 50
    top = suffixdedup.Hashes(texts.reshape(-1), suffixdedup._FIRST).of(at, at + 50) >> np.uint64(32)
    order = np.argsort(top, kind="stable")
    same = np.flatnonzero(top[order][1:] == top[order][:-1])
    assert len(same)
    pairs = [(int(order[k]), int(order[k + 1])) for k in same]
    rows = [(i, texts[x].tobytes().decode()) for i, x in enumerate(x for p in pairs for x in p)]
    assert len({t for _, t in rows}) == len(rows)
    parse = suffixdedup.Parse(pa.array([t for _, t in rows]), 50, 24)
    assert len(parse.run) == len(rows) > len(set(parse.trigger.tolist()))
    out = suffixdedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r.n_removed for r in out] == [0] * len(rows)


def test_codes_of_texts_go_by_bucket():
    """A part puts out a row a bucket of texts, however many texts it has codes for; each text gets its own back."""
    rng = np.random.default_rng(4)
    n, parts = 4000, 3
    trigger, phrase = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for _ in "ab")
    trigger, phrase = np.concatenate((trigger, trigger)), np.concatenate((phrase, phrase))
    doc, th = np.arange(2 * n), rng.integers(-1 << 62, 1 << 62, 2 * n)
    _, (a, b, c, d, e) = suffixdedup._with_ids(np.zeros(2 * n, np.int64), [trigger, phrase], doc, th)
    frame = pd.DataFrame({"kind": ["phrase"], "part": [0], "a": a, "b": b, "c": c, "d": d, "e": e})
    settled = suffixdedup._settle(frame, parts)
    assert sorted(settled["bucket"]) == list(range(parts))
    got = {(r.doc, r.th): np.frombuffer(r.codes, np.uint64).tolist()
           for _, f in settled.groupby("bucket") for r in suffixdedup._by_text(f).itertuples()}
    code = suffixdedup.known_code(trigger, phrase)
    assert got == {(i, int(th[i])): [int(code[i])] for i in range(n, 2 * n)}
    packed = pa.array([b"", np.array([5, 6], np.uint64).tobytes(), b"", np.array([7], np.uint64).tobytes()], pa.binary())
    assert [x.tolist() for x in suffixdedup._codes_of(packed[1:])] == [[5, 6, 7], [0, 0, 2]]
    assert [x.tolist() for x in suffixdedup._codes_of(packed[:1])] == [[], []]


def test_repeats_leave_no_shuffle_files_behind(spark, docs, monkeypatch):
    """Each written step frees the shuffle files it made: they do not pile up until the driver collects its garbage."""
    disks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return {f.name for d in disks.localDirs() for f in pathlib.Path(str(d)).rglob("shuffle_*")}

    left, real = {}, suffixdedup.staged

    def staged(df, name, *args, **named):
        before = files()
        out = real(df, name, *args, **named)
        for _ in range(30):
            left[name] = files() - before
            if not left[name]:
                break
            time.sleep(0.1)
        return out

    monkeypatch.setattr(suffixdedup, "staged", staged)
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    conf = spark.conf.get(setting)
    got = suffixdedup.remove_repeats(docs, part_bytes=4000, chunk_bytes=3000, chunk_strings=200)
    assert got.filter("n_removed > 0").count() > 0
    assert left == {"parse-codes": set(), "removed-ranges": set(), "removed": set()}
    assert spark.conf.get(setting) == conf


def test_phrases_are_packed_to_compress():
    """The high bytes of places and of sorted hashes lie side by side, so a shuffle writes them in a few bytes."""
    rng = np.random.default_rng(8)
    doc = np.repeat(np.arange(8000), 50)
    th = np.repeat(rng.integers(-1 << 62, 1 << 62, 8000), 50)
    trigger, phrase = (rng.integers(0, 1 << 64, len(doc), dtype=np.uint64) for _ in "ab")
    out = [b for b in suffixdedup._phrases_out(trigger, phrase, doc, th, 8) if b.num_rows]
    frame = pd.concat([b.to_pandas() for b in out if b.column(0)[0].as_py() == "phrase"])
    ids = suffixdedup._ids_of(frame, "c", "d", "e")
    got = zip(suffixdedup._join(frame, "a", np.uint64), suffixdedup._join(frame, "b", np.uint64), *ids)
    assert sorted(got) == sorted(zip(trigger, phrase, doc, th))
    size = sum(len(pa.compress(x, "lz4", asbytes=True)) for c in "abc" for x in frame[c])
    assert size < 18 * len(doc)                              # 20 bytes each as they are


# ---- sharding

def test_sharding(docs):
    rows = docs.collect()
    got = sharding.shard_documents(docs, shards=5, bucket_groups=8, slot_rows=3).collect()
    want = collections.Counter((r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode()))
                               for r in rows)
    assert collections.Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    of_text = collections.defaultdict(set)
    slots = collections.defaultdict(list)
    for r in got:
        of_text[r.text_crc32].add(r.shard)
        slots[r.shard].append(r.slot)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 5
    assert all(len(s) == 1 for s in of_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_differencing_balances():
    rng = np.random.default_rng(0)
    sizes = np.sort(rng.integers(100, 10_000, 2000))[::-1]
    loads = np.bincount(sharding.difference_sizes(sizes, 8), weights=sizes, minlength=8)
    assert loads.max() - loads.min() <= 10
    tuples = np.sort(rng.integers(0, 1000, (30, 8)), axis=1)
    place = sharding.difference(tuples)
    assert all(sorted(p) == list(range(8)) for p in place)
    total = np.zeros(8, int)
    np.add.at(total, place, tuples)
    assert total.max() - total.min() < np.ptp(tuples.sum(axis=0))


# ---- language identification

def test_language_id(spark):
    rng = random.Random(9)
    syllables = {"xx": "ka to ri mu ne sha".split(), "yy": "brel gund opf wach leit ein".split()}
    make = lambda l, n: " ".join("".join(rng.choice(syllables[l]) for _ in range(rng.randrange(1, 4))) for _ in range(n))
    rows = [(i, make("xx" if i % 2 else "yy", 30), "xx" if i % 2 else "yy") for i in range(120)]
    odd = [(900, None, "xx"), (901, "", "yy"), (902, "12 !! 3", None), (903, rows[5][1], None), (903, rows[5][1], None)]
    df = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string")
    samples = langid.language_samples(df.filter("doc_id < 80"))
    got = langid.identify_languages(df.drop("lang"), samples).collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r.doc_id].append(r.langid)
    held = [by[i][0].language == l for i, _, l in rows if i >= 80]
    assert sum(held) / len(held) > 0.95
    for i in (900, 901, 902):
        assert (by[i][0].language, by[i][0].score, by[i][0].rejected) == ("und", 0.0, True)
    assert len(by[903]) == 2 and by[903][0] == by[903][1]
    none = langid.identify_languages(df, {}).select("langid.language").distinct().collect()
    assert [r.language for r in none] == ["und"]


def test_language_id_rejects_mixed_and_unlearned(spark):
    """Texts of half and half, of an unlearned language and of random letters go; clean ones stay, long or short."""
    rng = random.Random(19)
    syllables = {"xx": "ka to ri mu ne sha".split(), "yy": "brel gund opf wach leit ein".split(),
                 "zz": "quio jaz vexy pho duc lym".split()}
    make = lambda l, n: ["".join(rng.choice(syllables[l]) for _ in range(rng.randrange(1, 4))) for _ in range(n)]
    junk = lambda n: ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(n)]
    train = [(i, " ".join(make("xx" if i % 2 else "yy", 60)), "xx" if i % 2 else "yy") for i in range(80)]
    samples = langid.language_samples(spark.createDataFrame(train, "doc_id long, text string, lang string"))
    clean = [" ".join(make(l, n)) for l in ("xx", "yy") for n in (20, 60, 2000) for _ in range(10)]
    mixed = [" ".join(w for p in zip(make("xx", n), make("yy", n)) for w in p) for n in (30, 1000) for _ in range(10)]
    odd = [" ".join(make("zz", n)) for n in (60, 2000) for _ in range(10)] + [" ".join(junk(60)) for _ in range(10)]
    table = spark.createDataFrame(list(enumerate(clean + mixed + odd)), "doc_id long, text string")
    got = langid.identify_languages(table, samples, min_margin=langid.MIN_MARGIN).orderBy("doc_id").collect()
    rejected = [r.langid.rejected for r in got]
    of_mixed, of_odd = rejected[len(clean):-len(odd)], rejected[-len(odd):]
    assert not any(rejected[:len(clean)])
    assert sum(of_mixed) >= 0.5 * len(mixed) and sum(of_odd) >= 0.9 * len(odd), (of_mixed, of_odd)
    assert all(r.langid.rejected == (r.langid.margin <= langid.MIN_MARGIN) for r in got)


def test_language_stage_uses_the_margin(spark):
    """Texts of languages without training rows go in the pipeline's first stage; the others stay."""
    import corpus_pipeline
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    docs = docs.filter("length(text) > 100")
    learned = F.col("lang").isin("en", "de")
    kept = corpus_pipeline.language(spark, docs.withColumn("lang", F.when(learned, F.col("lang"))), "")
    kept = {r.doc_id for r in kept.select("doc_id").collect()}
    stay = [r.doc_id in kept for r in docs.filter(learned).collect()]
    go = [r.doc_id not in kept for r in docs.filter(~learned).collect()]
    assert sum(stay) >= 0.97 * len(stay) and sum(go) >= 0.8 * len(go), (len(stay), sum(stay), len(go), sum(go))


# ---- licence scans

def test_license_scan(docs):
    words = ["the", "mit", "license", "apache", "cc", "by", "gnu", "general", "public", "x"]
    scanner = licenses.LicenseScanner(licenses.PHRASES, licenses.TEMPLATES, 3, 0.8)
    rng = np.random.default_rng(1)
    for _ in range(200):
        text = " ".join(rng.choice(words, rng.integers(0, 40)))
        w = text.split()
        places = [(k, label) for p, label in licenses.PHRASES.items() for k in range(len(w))
                  if w[k:k + len(p.split())] == p.split()]
        n, n_base, first, last, base, labels, score, _ = scanner.scan(text)
        assert (n, n_base) == (len(w), len(places))
        assert (first, last) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert base == sorted({b for _, b in places}) and set(base) <= set(labels) and 0 <= score <= 1
    for label, template in licenses.TEMPLATES:
        found = scanner.scan("Zzz, qqq " + template.title() + "! qqq")
        assert label in found[5] and found[6] == 1.0
        assert any(s[0] == label and s[1] == 2 for s in found[7])
    out = licenses.scan_licenses(docs).select("text", "scan.n_words").collect()
    assert len(out) == docs.count()
    assert all(r.n_words == len(words_of(r.text)) for r in out)


# ---- empty tables

def test_empty_tables(empty):
    assert jaccard.jaccard_components(empty, jaccard.Threshold(4, 85, 100)).count() == 0
    assert jaccard.keep_one_of_each(empty, jaccard.Threshold(5, 80, 100)).count() == 0
    assert edited_fingerprints(empty, samples=4).count() == 0
    assert mixing.mix_sources(empty).taken().count() == 0
    assert mixing.mixed_documents(empty).count() == 0
    assert find_contamination(empty, []).count() == 0
    assert suffixdedup.remove_repeats(empty).count() == 0
    assert sharding.shard_documents(empty).count() == 0
    assert langid.identify_languages(empty, langid.language_samples(empty)).count() == 0
    assert licenses.scan_licenses(empty).count() == 0


def test_null_ids(spark):
    t = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(None, t), (5, t), (None, t + " z"), (None, None), (9, "")], "doc_id long, text string")
    got = jaccard.jaccard_components(df, jaccard.Threshold(4, 85, 100)).collect()
    assert sorted((r.doc_id is None, r.component_id or 0) for r in got if r.n_shingles) == [
        (False, 5), (True, 5), (True, 5)]
    gone = sorted((r.doc_id or 0, r.n_removed) for r in suffixdedup.remove_repeats(df).collect())
    assert gone[0][1] == 0 and gone[-1] == (9, 0) and (5, 0) in gone and max(g[1] for g in gone) == len(t)
    assert edited_fingerprints(df, samples=4).count() == 5
    assert sharding.shard_documents(df, shards=2).count() == 5
    assert mixing.mix_sources(df.withColumn("source", F.lit(None).cast("string"))).taken().count() == 5
