"""Chat formatting in windows of a token budget.

A turn is written as ``<|im_start|>role\\ntext<|im_end|>\\n``.  In role and text
every ``<``, backslashes, ``|`` gets one backslash more, so no text can open
or close a turn and taking one away gives the text back; a role also has its
backslashes doubled and its line breaks written ``\\n``.

Windows are spans of whole turns.  Prefix sums of the turns' tokens give each
window's last turn by binary search: the largest that keeps the window within
the budget.  A window after the first starts with the conversation's system
turn (its first turn, if that has the role ``system``) and up to
``history_turns`` turns of at most ``history_tokens`` tokens that came before;
these are repeated and not under the loss mask, so each assistant text is a
target once.  History gives way to the next new turn; a turn that is over the
budget with the system turn alone has a window of its own, ``over_budget``.

A conversation of more than ``block_bytes`` is cut into blocks (see
``turns.py``); each block is windowed by itself, with the system turn and the
history from before it.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import turns
from .common import reach_workers

START, END = "<|im_start|>", "<|im_end|>"
_MARK = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + "\n", re.DOTALL)
SYSTEM, ASSISTANT = "system", "assistant"
#: byte-pair ranks of a public tokenizer, and (fixed value) how its texts are cut before merging
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

WINDOW = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("block", T.LongType()), T.StructField("window", T.IntegerType()),
    T.StructField("repeated", T.IntegerType()), T.StructField("tokens", T.LongType()),
    T.StructField("over_budget", T.BooleanType()), T.StructField("text", T.StringType()),
    T.StructField("loss", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())])))])
READ = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("n_turns", T.LongType()),
    T.StructField("turns_sha256", T.StringType()), T.StructField("loss_chars", T.LongType()),
    T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType()),
    T.StructField("n_windows", T.LongType())])


def escape(text: str) -> str:
    return _MARK.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def formatted(role: str | None, text: str | None) -> str:
    return f"{START}{escape_role(role or '')}\n{escape(text or '')}{END}\n"


def spans(tokens: list[int], new: int, system: int, budget: int, history_turns: int,
          history_tokens: int) -> Iterator[tuple[int, int, int]]:
    """(history from, new from, new to) of each window over the turns from ``new`` on.

    ``tokens`` are the turns' without the system turn, which takes ``system``
    tokens of every window.
    """
    sums = np.concatenate(([0], np.cumsum(tokens, dtype=np.int64)))
    room, n, a = budget - system, len(tokens), new
    while a < n:
        h = max(0, a - history_turns, int(np.searchsorted(sums, sums[a] - history_tokens)),
                int(np.searchsorted(sums, sums[a + 1] - room)))
        h = min(h, a)
        b = max(a + 1, int(np.searchsorted(sums, sums[h] + room, side="right")) - 1)
        yield h, a, b
        a = b


class _Tokens:
    """Token counts of whole turns; the vocabulary is read once per worker."""

    _kept: dict = {}

    def __init__(self, vocabulary):
        self.vocabulary = vocabulary

    def __call__(self, texts: list[str]) -> list[int]:
        import tiktoken
        found = self._kept.get(self.vocabulary.id)
        if found is None:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, self.vocabulary.value.splitlines())}
            found = tiktoken.Encoding(self.vocabulary.id, pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})
            self._kept.clear()
            self._kept[self.vocabulary.id] = found
        return [len(found.encode_ordinary(t)) for t in texts]


class _Vocabulary:
    """A broadcast file of byte-pair ranks (a few MB, whatever the data)."""

    def __init__(self, spark: SparkSession, path: str):
        if "://" in path:
            content = bytes(spark.read.format("binaryFile").load(path).first()["content"])
        else:
            with open(path, "rb") as f:
                content = f.read()
        self.id = hashlib.sha256(content).hexdigest()
        self._sent = spark.sparkContext.broadcast(content)

    @property
    def value(self) -> bytes:
        return self._sent.value


def _windows(count, budget: int, history_turns: int, history_tokens: int):
    """Windows of the groups of a stream; rows are (conv_id, block, context, role, text).

    ``context`` is 0 for a block's own turns, 1 for history from before the
    block and 2 for the system turn from before it.
    """
    def work(groups):
        for (conv, block), rows in groups:
            rows = list(rows)
            texts = [formatted(r[3], r[4]) for r in rows]
            tokens = count(texts)
            first = 1 if rows[0][2] == 2 or (rows[0][2] == 0 and block == 0 and rows[0][3] == SYSTEM) else 0
            context = sum(r[2] == 1 for r in rows)
            if first == len(rows):                      # nothing but the system turn
                yield conv, block, 0, 0, tokens[0], tokens[0] > budget, texts[0], []
                continue
            own_system = first and rows[0][2] == 0
            system = tokens[0] if first else 0
            for k, (h, a, b) in enumerate(spans(tokens[first:], context, system, budget, history_turns, history_tokens)):
                shown = [0] * first + list(range(first + h, first + b))
                repeated = (first if k or not own_system else 0) + a - h
                loss, at = [], 0
                for place, i in enumerate(shown):
                    if place >= repeated and rows[i][3] == ASSISTANT and rows[i][4]:
                        start = at + len(START) + len(ASSISTANT) + 1
                        loss.append({"start": start, "stop": at + len(texts[i]) - len(END) - 1})
                    at += len(texts[i])
                total = sum(tokens[i] for i in shown)
                yield conv, block, k, repeated, total, total > budget, "".join(texts[i] for i in shown), loss
    return work


def _formatted(rows: DataFrame, tokenizer: str, budget: int, history_turns: int, history_tokens: int,
               block_bytes: int) -> tuple[DataFrame, DataFrame | None]:
    reach_workers(rows.sparkSession)
    count = _Tokens(_Vocabulary(rows.sparkSession, tokenizer))
    work = _windows(count, budget, history_turns, history_tokens)
    short, long = turns.split_long(turns.turn_rows(rows), block_bytes)
    columns = ["conv_id", "block", "context", "role", "text"]
    whole = turns.whole(short).select("conv_id", F.lit(0).cast("bigint").alias("block"), F.lit(0).alias("context"), "role", "text")
    out = turns.stream(whole, 2, WINDOW, work)
    if long is None:
        return out, None
    own = turns.in_blocks(long, block_bytes)
    starts = own.groupBy("conv_id", "block").agg(F.min("at").alias("first")).filter("block > 0")
    starts = starts.select(F.col("conv_id").alias("c"), F.col("block").alias("later"), "first")
    wanted = starts.withColumn("want", F.explode(F.sequence(F.greatest(F.lit(0), F.col("first") - history_turns), F.col("first") - 1)))
    is_system = (F.col("at") == 0) & F.col("role").eqNullSafe(SYSTEM)
    same = F.col("conv_id").eqNullSafe(F.col("c"))
    history = own.join(wanted, same & (F.col("at") == F.col("want"))).filter(~is_system)
    system = own.filter(is_system).join(starts, same)
    pieces = (own.select(*columns[:2], F.lit(0).alias("context"), "role", "text", "at")
              .unionByName(history.select("conv_id", F.col("later").alias("block"), F.lit(1).alias("context"), "role", "text", "at"))
              .unionByName(system.select("conv_id", F.col("later").alias("block"), F.lit(2).alias("context"), "role", "text", "at")))
    return out, turns.stream(turns.by_block(pieces, "at").select(*columns), 2, WINDOW, work)


def format_conversations(rows: DataFrame, tokenizer: str = TOKENIZER, budget: int = 2048, history_turns: int = 4,
                         history_tokens: int = 512, block_bytes: int = turns.BLOCK_BYTES) -> DataFrame:
    """One row per window: ``conv_id, block, window, repeated, tokens, over_budget, text, loss``.

    ``rows`` has ``conv_id, turn, role, text``; other columns may have any
    name and are not read.  Turns are ordered by ``turn``, null first, rows of
    equal turn by role and then text.  A null role or text is
    empty; rows with a null ``conv_id`` are one conversation.  Repeated rows
    are turns of their own.  An empty table has no windows.  ``repeated``
    turns at the front of a window are history; ``loss`` spans are code points
    of ``text`` and cover each assistant text once.
    """
    short, long = _formatted(rows, tokenizer, budget, history_turns, history_tokens, block_bytes)
    return short if long is None else short.unionByName(long)


def parse(text: str) -> list[tuple[str, str]]:
    """The turns of a window, as they were."""
    found, at = [], 0
    for m in _TURN.finditer(text):
        if m.start() != at:
            raise ValueError(f"no turn at {at}")
        found.append((unescape_role(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(text):
        raise ValueError(f"no turn at {at}")
    return found


def _read(groups):
    for (conv,), windows in groups:
        turns_hash, loss_hash = hashlib.sha256(), hashlib.sha256()
        n = loss_chars = chars = k = 0
        for _, repeated, text, loss in windows:
            for role, said in parse(text)[repeated:]:
                turns_hash.update(f"{role}\n{said}\n".encode())
                n += 1
            for span in loss:
                target = unescape(text[span["start"]:span["stop"]])
                loss_hash.update(target.encode())
                loss_chars += len(target)
            chars += len(text)
            k += 1
        yield conv, n, turns_hash.hexdigest(), loss_chars, loss_hash.hexdigest(), chars, k


def read_back(windows: DataFrame, in_order: bool = False) -> DataFrame:
    """Per conversation, what its windows hold: turns, targets and lengths.

    The digests chain a conversation's texts, so one task passes over its
    windows; it holds one window at a time.  ``in_order`` says that a
    conversation's windows already follow each other.
    """
    if not in_order:
        windows = turns.by_conversation(windows, "block", "window")
    return turns.stream(windows.select("conv_id", "repeated", "text", "loss"), 1, READ, _read)


def format_digests(rows: DataFrame, **settings) -> DataFrame:
    """``read_back`` of ``format_conversations``; short conversations are shuffled once."""
    settings = {"tokenizer": TOKENIZER, "budget": 2048, "history_turns": 4, "history_tokens": 512,
                "block_bytes": turns.BLOCK_BYTES, **settings}
    short, long = _formatted(rows, **settings)
    out = read_back(short, in_order=True)
    return out if long is None else out.unionByName(read_back(long))
