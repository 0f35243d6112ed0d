"""Words that differ by one edit, by dynamic programming along a sorted list.

A vocabulary is sorted, and a prefix that several words share is a node of the
sorted list: the words from the first that has it to the next whose longest
common prefix (LCP) with its predecessor is shorter.  A query's row of the edit
matrix at a prefix is computed once, from the row at the prefix one shorter,
and serves all words of the range; it is banded to three cells, as one edit is
all that is allowed.  Where a row has no cell of at most one the range is
skipped.  A word's last row has its distance.  Rows of all queries of a chunk
advance together, one prefix length at a time, as arrays.

Spark deals out the lists.  Two words within one edit share the first half of
the shorter one's code points or the last half, so a word of length L goes to
the lists of the shorter lengths L and L - 1, once by its first half and once,
reversed, by its last; a pair that shares both counts in the first.  A list of
more than ``chunk`` words is dealt as chunk against chunk, so a task's memory
does not grow with a common beginning.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ascii_lower, reach_workers, staged

#: fixed values: a run of letters, and pieces of a text that end where no run does
RUN = "[A-Za-z\\u00C0-\\u00FF]+"
PIECE = "(?s).{1,4096}(?![A-Za-z\\u00C0-\\u00FF])|[A-Za-z\\u00C0-\\u00FF]+"
CHUNK = 20_000
#: nodes of a chunk that are looked at together
PAIRS = 400_000

_NEAR = T.StructType([T.StructField("word", T.StringType()), T.StructField("n_near", T.LongType()),
                      T.StructField("best_n", T.LongType()), T.StructField("best", T.StringType())])


def runs(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``run`` for every maximal run of letters, A-Z lower-cased.

    Texts are first cut into pieces between runs, so a long text is never one
    array of words; a run of any length stays whole.
    """
    pieces = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(PIECE), F.lit(0))).alias("piece"))
    found = pieces.select("doc_id", F.explode(F.regexp_extract_all("piece", F.lit(RUN), F.lit(0))).alias("run"))
    return found.select("doc_id", ascii_lower(F.col("run")).alias("run"))


def count_words(words: DataFrame, min_length: int, min_count: int) -> DataFrame:
    """``word, n`` of words of so many code points and occurrences (combined before the shuffle)."""
    return (words.filter(F.char_length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n"))
            .filter(F.col("n") >= min_count))


def _start(width: int, h: int, queries: int) -> np.ndarray:
    """Rows at a prefix that equals the query's first ``h``: one off the diagonal costs one."""
    rows = np.full((queries, 3), 1, dtype=np.int8)
    rows[:, 1] = 0
    if h == 0:
        rows[:, 0] = 2
    if h + 1 > width:
        rows[:, 2] = 2
    return rows


def near_pairs(words: np.ndarray, lengths: np.ndarray, queries: np.ndarray, width: int, h: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, word) places of pairs at a distance of exactly one that share their first ``h`` code points.

    ``words`` is a sorted matrix of code points, zero behind a word's end, of
    words of ``width`` or ``width + 1``; ``queries`` a matrix of words of ``width``.
    """
    m, depth = words.shape
    # LCP of each word with the one before it; words are distinct
    differ = words[1:] != words[:-1]
    lcp = np.concatenate(([-1], np.where(differ.any(axis=1), differ.argmax(axis=1), depth)))
    # the range of each query's first h code points, by binary search
    def head(of: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(of[:, :h]).view(f"S{h}")[:, 0] if h else np.zeros(len(of), "S1")

    heads, wanted = head(words), head(queries)
    low, high = np.searchsorted(heads, wanted), np.searchsorted(heads, wanted, side="right")
    some = np.flatnonzero(low < high)
    per_step = max(1, PAIRS // 64)
    # where the nodes one deeper begin, for each depth: places with an LCP of at most it
    begins = [np.flatnonzero(lcp <= d) for d in range(depth)]
    for part in range(0, len(some), per_step):
        q = some[part:part + per_step]
        first, last, rows = low[q], high[q], _start(width, h, len(q))
        for d in range(h, depth):
            # words that end at d, in the node's first place, are judged
            ended = lengths[first] == d
            if ended.any():
                cell = width - d + 1
                if 0 <= cell <= 2:
                    hit = ended & (rows[:, cell] == 1)
                    if hit.any():
                        yield q[hit], first[hit]
                first = first + ended                       # the rest of the range is longer
            # what is left begins a node one deeper, as its LCP is at most d, and so do the others up to ``last``
            starts = begins[d]
            a, b = np.searchsorted(starts, first), np.searchsorted(starts, last)
            total = np.maximum(b - a, 0)
            rep = np.repeat(np.arange(len(q)), total)
            if not len(rep):
                q = q[:0]
                break
            at = a[rep] + np.arange(len(rep)) - np.repeat(np.cumsum(total) - total, total)
            begin = starts[at]
            stop = np.where(at + 1 < b[rep], starts[np.minimum(at + 1, len(starts) - 1)], last[rep])
            letter, old, q = words[begin, d], rows[rep], q[rep]
            new = np.full((len(rep), 3), 2, dtype=np.int8)
            for k in range(3):
                j = d + 1 + k - 1                           # cells are j = d, d + 1, d + 2 of the query
                if j > width:
                    continue
                value = old[:, k] + (queries[q, j - 1] != letter) if j else np.full(len(rep), d + 1)
                if k < 2:
                    value = np.minimum(value, old[:, k + 1] + 1)
                if k:
                    value = np.minimum(value, new[:, k - 1] + 1)
                new[:, k] = np.minimum(value, 2)
            keep = new.min(axis=1) <= 1                      # else the range is skipped
            q, first, last, rows = q[keep], begin[keep], stop[keep], new[keep]
        if len(q):
            cell = width - depth + 1
            if 0 <= cell <= 2:
                hit = (first < last) & (lengths[np.minimum(first, m - 1)] == depth) & (rows[:, cell] == 1)
                yield q[hit], first[hit]


def _matrix(words: list[str], depth: int) -> np.ndarray:
    out = np.frombuffer(b"".join(w.encode("latin-1").ljust(depth, b"\0") for w in words), dtype=np.uint8)
    return out.reshape(len(words), depth)


class _Best:
    """Near words counted, and each word's best near word: the largest n, then the least word."""

    def __init__(self, words: list[str], n: np.ndarray):
        self.words, self.n = words, n
        self.rank = np.empty(len(words), np.int64)
        self.rank[np.lexsort((np.arange(len(words)), -n))] = np.arange(len(words))
        self.count = np.zeros(len(words), np.int64)
        self.best = np.full(len(words), len(words), np.int64)

    def add(self, word: np.ndarray, near: np.ndarray) -> None:
        np.add.at(self.count, word, 1)
        np.minimum.at(self.best, word, self.rank[near])

    def rows(self) -> list[tuple]:
        by_rank = np.argsort(self.rank)
        return [(self.words[i], int(self.count[i]), int(self.n[by_rank[self.best[i]]]), self.words[by_rank[self.best[i]]])
                for i in np.flatnonzero(self.count)]


def _list_near(width: int, reverse: bool, rows: list[tuple]) -> list[tuple]:
    """Near pairs of whole lists (list number, word, n, is query, is listed) of one width and direction."""
    out, h = [], width // 2
    turned = (lambda w: w[::-1]) if reverse else (lambda w: w)
    share = width - h if reverse else h
    words = sorted({r[1] for r in rows})
    place = {w: i for i, w in enumerate(words)}
    n = np.zeros(len(words), np.int64)
    for r in rows:
        n[place[r[1]]] = r[2]
    best = _Best(words, n)
    groups: dict[int, tuple[list, list]] = {}
    for number, word, _, is_query, is_listed in rows:
        g = groups.setdefault(number, ([], []))
        if is_listed:
            g[1].append(word)
        if is_query and len(word) == width:
            g[0].append(word)
    # lists differ in their shared half, so plain ones are searched as one sorted list
    plain: tuple[list, list] = ([], [])
    todo = []
    for number, g in groups.items():
        if number >= 0:
            plain[0].extend(g[0])
            plain[1].extend(g[1])
        else:
            todo.append(g)
    for asked, listed in [plain, *todo]:
        if not asked or not listed:
            continue
        listed = sorted(map(turned, listed))
        asked = sorted(map(turned, asked))
        to = np.array([place[turned(w)] for w in listed])
        of = np.array([place[turned(w)] for w in asked])
        lengths = np.array([len(w) for w in listed])
        a, b = _matrix(listed, width + 1), _matrix(asked, width)
        for q, w in near_pairs(a, lengths, b, width, share):
            if reverse:
                # the first half as well: counted in the other direction (reversed, it is the last h of both)
                end = lengths[w]
                same = np.ones(len(q), bool)
                for k in range(h):
                    same &= b[q, width - 1 - k] == a[w, end - 1 - k]
                q, w = q[~same], w[~same]
            best.add(of[q], to[w])
            longer = lengths[w] == width + 1                # pairs of one length are met from both sides
            best.add(to[w[longer]], of[q[longer]])
    return best.rows()


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (width, reverse, list, blocks, word, n, is query, is listed) sorted by the first three, list by list."""
    from pyspark.sql.pandas.types import to_arrow_schema
    schema = to_arrow_schema(_NEAR)

    def out(kind, rows):
        found = _list_near(kind[0], kind[1], rows)
        if found:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in found], schema=schema)

    kind, rows, current, number = None, [], None, 0
    for batch in batches:
        for width, reverse, key, blocked, word, n, is_query, is_listed in zip(*[c.to_pylist() for c in batch.columns]):
            if key != current or (width, reverse) != kind:
                if kind is not None and ((width, reverse) != kind or len(rows) >= CHUNK):
                    yield from out(kind, rows)
                    rows = []
                kind, current, number = (width, reverse), key, number + 1
            rows.append((-number if blocked else number, word, n, is_query, is_listed))
    if rows:
        yield from out(kind, rows)


def near_words(vocabulary: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``word, n, n_near, form, form_n`` of a table of distinct words ``word, n``.

    ``n_near`` counts the words at exactly one edit; ``form`` is the one of
    them with the largest ``n`` (ties: the smallest), null if there is none.
    Words are of letters up to U+00FF and of two code points at least.  An empty table has no rows.
    """
    reach_workers(vocabulary.sparkSession)
    vocabulary = vocabulary.select("word", "n")
    length = F.char_length("word")
    half = F.floor(F.col("width") / 2).cast("int")
    keyed = (vocabulary.withColumn("width", F.explode(F.array(length, length - 1))).filter("width > 0")
             .withColumn("reverse", F.explode(F.array(F.lit(False), F.lit(True))))
             .withColumn("key", F.when(F.col("reverse"), F.reverse("word").substr(F.lit(1), F.col("width") - half))
                         .otherwise(F.col("word").substr(F.lit(1), half))))
    by = ["width", "reverse", "key"]
    sizes = keyed.groupBy(*by).agg(F.count("*").alias("size")).filter("size > 1")
    # a word alone in its list has no partner there
    lists = keyed.join(sizes, by).withColumn("blocks", F.ceil(F.col("size") / F.lit(chunk)).cast("int"))
    lists = lists.withColumn("mine", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    # block (i, j): the words of chunk i against the queries of chunk j
    roles = F.when(F.col("blocks") == 1, F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(True).alias("query"), F.lit(True).alias("listed"))))
    asks = F.when(length == F.col("width"), every).otherwise(F.array("mine"))
    as_query = F.transform(asks, lambda i: F.struct(i.alias("i"), F.col("mine").alias("j"), F.lit(True).alias("query"),
                                                     (i == F.col("mine")).alias("listed")))
    as_listed = F.transform(F.filter(every, lambda j: j != F.col("mine")),
                            lambda j: F.struct(F.col("mine").alias("i"), j.alias("j"), F.lit(False).alias("query"), F.lit(True).alias("listed")))
    dealt = lists.withColumn("role", F.explode(F.coalesce(roles, F.concat(as_query, as_listed))))
    name = F.concat_ws(":", "key", F.col("role.i").cast("string"), F.col("role.j").cast("string"))
    rows = (dealt.select("width", "reverse", name.alias("list"), (F.col("blocks") > 1).alias("blocked"), "word", "n", "role.query", "role.listed")
            .repartition("width", "reverse", "list").sortWithinPartitions("width", "reverse", "list"))
    found = rows.mapInArrow(_search, _NEAR).groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("top"))
    return (vocabulary.join(found, "word", "left")
            .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.col("top.word").alias("form"),
                    (-F.col("top.n")).alias("form_n")))


def spelling_forms(vocabulary: DataFrame, ratio: int = 2, chunk: int = CHUNK) -> DataFrame:
    """``word, form, root, n, n_near, form_n``: each word's more common spelling and the last of its chain.

    ``form`` needs ``ratio`` times the word's ``n`` (at least 2, so chains
    end); a word without is its own ``root``.  Roots are found by joining
    forms with forms, which doubles the steps taken each round.
    """
    found = near_words(vocabulary, chunk)
    good = F.col("form_n") >= ratio * F.col("n")
    forms = staged(found.select("word", F.when(good, F.col("form")).alias("form"), "n", "n_near",
                                F.when(good, F.col("form_n")).alias("form_n")), "spelling-forms")
    step = forms.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        further = step.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = staged(step.join(further, "root", "left")
                      .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if step.filter("moved").isEmpty():
            break
        step = step.select("word", "root")
    return (forms.join(step.select("word", "root"), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
