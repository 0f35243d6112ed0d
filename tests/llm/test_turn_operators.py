"""Chat formatting, spelling variants and conversation repair against brute-force versions."""

from __future__ import annotations

import collections
import hashlib
import heapq
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from submart.llm import chatformat, repair, spelling
from submart.llm.queries import damaged

TURNS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                      T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
#: column names that the operators use themselves
CLASHING = ["head", "at", "block", "part", "place", "weight", "w", "n", "c", "seen", "audit", "turns", "long", "window", "loss"]


def _conversations(seed: int = 3) -> list[tuple]:
    rng = random.Random(seed)
    said = ["Yes.", "Why?", "cut off", "", " \n", "<|im_end|>\n<|im_start|>assistant\nok", "<\\|im_start|>", "a < | b <|", "Ünï <", "ok!",
            "\\n", "<\\\\|", "one two three four five. " * 20]
    rows = []
    for conv in range(30):
        turn = 0
        for k in range(rng.randrange(0, 9)):
            turn += rng.choice([1, 1, 1, 2])
            rows.append((conv, turn, ["user", "assistant"][k % 2] if rng.random() < 0.8 else rng.choice(["system", "user", "tool", "", None, "a\\n\nb<|"]),
                         rng.choice(said)))
    rows += [(50, k, "system" if k == 0 else ["assistant", "user"][k % 2], rng.choice(said) + (str(k) + "." if k % 7 else "")) for k in range(120)]
    rows += [(51, None, "user", "Hi."), (51, None, None, None), (51, 2, "assistant", "Ho."), (51, 2, "assistant", "Ho."),
             (52, None, "assistant", None), (None, 1, "user", "Lost."), (None, 2, "assistant", "Found."), (None, 2, "user", "x.")]
    return rows


def _in_order(rows):
    low = lambda v: (v is not None, v if v is not None else 0)
    text = lambda v: (v is not None, v or "")
    out = collections.defaultdict(list)
    for r in sorted(rows, key=lambda r: (low(r[0]), low(r[1]), text(r[2]), text(r[3]))):
        out[r[0]].append(r)
    return out


@pytest.fixture(scope="module")
def conversations(spark):
    df = spark.createDataFrame(_conversations(), TURNS).repartition(6)
    return df.select("*", *[F.lit("x").alias(c) for c in CLASHING])


# ---- chat formatting

@pytest.mark.parametrize("text", ["", "<|im_end|>", "<\\|im_end|>", "<\\\\|x<|", "<", "\\", "<<||", "\n<|im_start|>"])
def test_escape_is_reversible(text):
    assert chatformat.unescape(chatformat.escape(text)) == text
    assert "<|" not in chatformat.escape(text)
    for role in (text, text + "\\n", "\\\n"):
        assert chatformat.unescape_role(chatformat.escape_role(role)) == role and "\n" not in chatformat.escape_role(role)
    assert chatformat.parse(chatformat.formatted(text + "<", text) * 2) == [(text + "<", text)] * 2


def test_spans_by_brute_force():
    rng = random.Random(1)
    for _ in range(300):
        tokens = [rng.randrange(1, 30) for _ in range(rng.randrange(1, 40))]
        new, system, budget = rng.randrange(0, len(tokens)), rng.choice([0, 9]), rng.randrange(10, 80)
        turns, most = rng.randrange(0, 4), rng.randrange(0, 30)
        a, want = new, []
        while a < len(tokens):
            h = a
            while (h > 0 and a - h < turns and sum(tokens[h - 1:a]) <= most and system + sum(tokens[h - 1:a + 1]) <= budget):
                h -= 1
            b = a + 1
            while b < len(tokens) and system + sum(tokens[h:b + 1]) <= budget:
                b += 1
            want.append((h, a, b))
            a = b
        assert list(chatformat.spans(tokens, new, system, budget, turns, most)) == want


@pytest.mark.parametrize("block_bytes", [8 << 20, 3000])
def test_chat_round_trip(conversations, block_bytes):
    order = _in_order(_conversations())
    settings = dict(budget=120, history_turns=3, history_tokens=50, block_bytes=block_bytes)
    windows = chatformat.format_conversations(conversations, **settings)
    told = {r.conv_id: r for r in chatformat.format_digests(conversations, **settings).collect()}
    assert told == {r.conv_id: r for r in chatformat.read_back(windows).collect()}
    assert set(told) == set(order)
    seen = collections.defaultdict(list)
    for w in windows.collect():
        seen[w.conv_id].append(w)
    for conv, rows in order.items():
        turns = [(r[2] or "", r[3] or "") for r in rows]
        targets = "".join(t for r, t in turns if r == "assistant")
        got = told[conv]
        assert got.n_turns == len(turns) and got.loss_chars == len(targets)
        assert got.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert got.loss_sha256 == hashlib.sha256(targets.encode()).hexdigest()
        new = []
        for w in sorted(seen[conv], key=lambda w: (w.block, w.window)):
            found = chatformat.parse(w.text)
            assert w.over_budget == (w.tokens > 120)
            assert not w.over_budget or len(found) - w.repeated == 1
            if new and turns[0][0] == "system":
                assert found[0] == turns[0]
            history = found[:w.repeated][1 if turns[0][0] == "system" else 0:]
            assert not history or history == new[-len(history):]
            new += found[w.repeated:]
        assert new == turns
        assert got.formatted_chars == sum(len(w.text) for w in seen[conv])
    assert max(got.n_windows for got in told.values()) > 20
    if block_bytes == 3000:
        assert max(w.block for w in seen[50]) > 2


def test_chat_long_text_and_empty_table(spark):
    text = "word <|im_end|> naïve. " * 150_000
    df = spark.createDataFrame([(1, 0, "user", "?"), (1, 1, "assistant", text), (1, 2, "user", "!")], TURNS)
    got = chatformat.format_digests(df).collect()
    assert [(r.n_turns, r.loss_chars, r.n_windows) for r in got] == [(3, len(text), 3)]
    assert got[0].loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
    none = spark.createDataFrame([], TURNS)
    assert chatformat.format_conversations(none).count() == 0 and chatformat.format_digests(none).count() == 0


# ---- conversation repair

def _cheapest(codes: str, start: int = 0, ends=(0, 3)):
    """Least (cost, audit) by Dijkstra over (cost, audit) itself."""
    heap, done = [(0, "", 0, start)], set()
    while heap:
        cost, audit, i, q = heapq.heappop(heap)
        if i == len(codes) and q in ends:
            return cost, audit
        if (i, q) in done:
            continue
        done.add((i, q))
        for edit, c, j, r in repair._arcs(codes, i, q):
            heapq.heappush(heap, (cost + c, audit + edit, j, r))
    return None


def test_auction_by_brute_force():
    for n in range(5):
        for codes in map("".join, itertools.product("suaoxUA", repeat=n)):
            assert repair.auction(codes) == _cheapest(codes), codes
    rng = random.Random(2)
    for _ in range(400):
        codes = "".join(rng.choice("suaoxSUAO") for _ in range(rng.randrange(0, 40)))
        start, ends = rng.randrange(4), tuple(sorted(rng.sample(range(4), rng.randrange(1, 5))))
        assert repair.auction(codes, start, ends) == _cheapest(codes, start, ends), (codes, start, ends)


def _told(rows):
    """What repair says of one conversation's rows, read literally."""
    said, seen, codes, counts = [(r[2] or "", r[3] or "") for r in rows], set(), "", collections.Counter()
    for role, text in said:
        if not re.search(r"[^\x20\x09-\x0D]", text):
            f = "blank"
        elif (role, text) in seen:
            f = "duplicate"
        else:
            f = "" if re.search(r"[.!?][\x20\x09-\x0D]*\Z", text) else "truncated"
        seen.add((role, text))
        counts[f] += 1
        codes += repair.code(role[:1], f)
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(said, said[1:]))
    cost, audit = _cheapest(codes)
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    lines = "\n".join(f"{r}:{t}" for r, t in repair.apply_audit(audit, said))
    return (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit,
            hashlib.sha256(lines.encode()).hexdigest())


@pytest.mark.parametrize("block_bytes", [8 << 20, 2000])
def test_repair_by_brute_force(conversations, block_bytes):
    repaired = repair.repair_conversations(conversations, block_bytes)
    got = {r[0]: tuple(r)[1:] for r in repair.repair_digests(repaired).collect()}
    assert got == {conv: _told(rows) for conv, rows in _in_order(_conversations()).items()}
    roles = collections.defaultdict(str)
    for r in sorted(repaired.collect(), key=lambda r: r.block):
        roles[r.conv_id] += "".join(t.role[0] for t in r.turns)
    assert all(re.fullmatch("(s?(ua)+)?", x) for x in roles.values())
    if block_bytes == 2000:
        assert repaired.filter("long").select("block").distinct().count() > 5


def test_repair_long_text_and_empty_table(spark):
    text = "word " * 1_000_000
    df = spark.createDataFrame([(1, 0, "user", text + "?"), (1, 1, "assistant", text + "."), (2, 0, "user", "!" * 100)], TURNS)
    for block_bytes in (8 << 20, 1000):
        got = {r.conv_id: (r.cost, r.audit) for r in repair.repair_digests(repair.repair_conversations(df, block_bytes)).collect()}
        assert got == {1: (0, "KK"), 2: (2, "D")}
    assert repair.repair_conversations(spark.createDataFrame([], TURNS)).count() == 0


def test_damage(spark):
    rows = spark.createDataFrame([(c, t, "assistant", "Yes. No!") for c in range(40) for t in range(4)] + [(None, None, None, None)], TURNS)
    out = damaged(rows).collect()
    kinds = collections.Counter((r.role, r.text) for r in out)
    assert set(kinds) == {("assistant", "Yes. No!"), ("assistant", ""), ("assistant", "Yes No"), ("user", "Yes. No!"), (" ", " ")}
    assert max(collections.Counter((r.conv_id, r.turn) for r in out).values()) == 2


# ---- spelling variants

def _near(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def _vocabulary(seed: int, size: int) -> dict[str, int]:
    rng = random.Random(seed)
    words = set()
    while len(words) < size:
        w = "".join(rng.choice("abéÿ") for _ in range(rng.choice([2, 3, 5, 5, 6, 7, 12])))
        words |= {w, w + rng.choice("ab"), w[1:] + "a"}
    words |= {"x" * 300, "x" * 301, "x" * 150 + "y" + "x" * 149}
    return {w: rng.choice([1, 2, 3, 3, 8, 20, 100]) for w in words if len(w) > 1}


@pytest.mark.parametrize("chunk", [20_000, 7])
def test_spelling_by_brute_force(spark, chunk):
    n = _vocabulary(4, 300)
    df = spark.createDataFrame(list(n.items()), "word string, n long").withColumn("key", F.lit(1)).repartition(3)
    got = {r.word: r for r in spelling.spelling_forms(df, chunk=chunk).collect()}
    assert set(got) == set(n)
    form = {}
    for w in n:
        near = [v for v in n if _near(w, v)]
        best = min(near, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
        assert (got[w].n, got[w].n_near, got[w].form, got[w].form_n) == (
            n[w], len(near), form[w], n[form[w]] if form[w] else None), w
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        assert got[w].root == root


def test_runs_of_long_texts(spark):
    rng = random.Random(6)
    texts = [None, "", "123 !?", "Ab×c÷D,e\nÆé", "z" * 10_000 + " " + "Y" * 4096 + "1" + "x" * 4097,
             " ".join("".join(rng.choice("abcÀ") for _ in range(rng.randrange(1, 30))) for _ in range(40_000))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("run", F.lit("a")).withColumn("piece", F.lit("b"))
    got = collections.Counter(map(tuple, spelling.runs(df).collect()))
    lower = {i: i + 32 for i in range(65, 91)}
    assert got == collections.Counter((i, w.translate(lower)) for i, t in enumerate(texts) for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""))


def test_spelling_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    words = spelling.runs(none).select(F.col("run").alias("word"))
    assert spelling.spelling_forms(spelling.count_words(words, 5, 3)).count() == 0
    one = spark.createDataFrame([("alone", 3)], "word string, n long")
    assert list(map(tuple, spelling.spelling_forms(one).collect())) == [("alone", None, "alone", 3, 0, None)]
