"""Repeated passages by prefix-free parsing.

A byte is removed when a string of ``span`` bytes that covers it also starts
in a document with a smaller id.  Strings are judged on the input, so the
result does not depend on any order of work.

*Parse.*  The trigger of a string of ``span`` bytes is its smallest rolling
hash of ``gram`` bytes.  A maximal run of strings with one trigger is a phrase;
it is taken with all bytes of its strings, so equal phrases hold equal strings,
and a passage that two texts share falls into equal phrases but for its ends.

*Dictionary.*  A phrase that a document with a smaller id has is removed whole,
by its trigger and a 64-bit hash.  Its strings are looked at once, in the document
with the smallest id that has it: the dictionary.

*Suffixes.*  Two different phrases can share a string only if they have one
trigger.  Only the suffixes of such dictionary phrases are sorted within a
chunk, by their first 4 bytes and then by a fingerprint of their first
``span``; the first of each run of equal ones goes on to be merged with those
of other chunks.  The smallest id of a run tells which of its places are
removed.  (Runs of equal prefixes are all the suffix arrays are needed for, so
beyond 4 bytes their order is the fingerprints', not the bytes'.)

Everything that is common is combined within a chunk before it is sent: a
phrase, trigger or string that a third of all documents have sends a few rows
a chunk.

A null text is empty.  Texts shorter than ``span`` lose nothing.  Rows of one
id do not remove each other's bytes; a null id counts as larger than all
others.  An empty table gives no rows.  Other columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import IdFilter, staged
from .textbytes import Hashes, byte_table, mix, slices, utf8

_GRAM, _FIRST, _SECOND = byte_table(7), byte_table(71), byte_table(72)
NO_ID = (1 << 63) - 1
SLICE = 1 << 16                 # bytes of text that are parsed at once: their arrays stay in the CPU's cache
#: codes of a bucket of texts: packed codes and places of ids, and the ids
CODES = "bucket bigint, codes binary, places binary, docs binary, ths binary"
MARKS = "doc bigint, th bigint, start int, stop int"


def sliding_min(x: np.ndarray, size: int) -> np.ndarray:
    """Minimum of x[i : i + size], for every i where that fits."""
    width, out = 1, x
    while width * 2 <= size:
        out = np.minimum(out[:-width], out[width:])
        width *= 2
    return np.minimum(out[:len(out) - (size - width)], out[size - width:]) if size > width else out


class Parse:
    """The strings of ``span`` bytes of a slice of texts, and their phrases."""

    def __init__(self, column: pa.Array, span: int, gram: int):
        self.buf, offsets = utf8(column)
        self.offsets, n, self.span = offsets, len(self.buf), span
        size = np.diff(offsets)
        self.at = np.zeros(0, np.int64)
        if n < span:
            return
        least = sliding_min(Hashes(self.buf, _GRAM).windows(gram), span - gram + 1)
        edge = np.zeros(n + 1, dtype=np.int64)
        long = size >= span
        np.add.at(edge, offsets[:-1][long], 1)
        np.add.at(edge, offsets[1:][long] - span + 1, -1)
        #: first byte of every string that lies in one text
        self.at = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
        if not len(self.at):
            return
        least = least[self.at]
        new = np.ones(len(self.at), dtype=bool)
        new[1:] = (least[1:] != least[:-1]) | (self.at[1:] != self.at[:-1] + 1)
        #: per phrase: its first string (a number of ``at``), text, trigger and hash
        self.run = np.flatnonzero(new)
        start = self.at[self.run]
        self.stop = self.at[np.concatenate((self.run[1:], [len(self.at)])) - 1] + span
        self.start, self.trigger = start, least[self.run]
        self.text = np.searchsorted(offsets, start, side="right") - 1
        self._first = Hashes(self.buf, _FIRST)
        self.phrase = self._first.of(start, self.stop)

    def strings(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First 8 bytes as a big-endian number, and two fingerprints, of strings."""
        head = np.ndarray(len(self.buf) - 7, dtype=">u8", buffer=self.buf, strides=(1,))[at].astype(np.uint64)
        second = Hashes(self.buf, _SECOND)
        return head, self._first.of(at, at + self.span), second.of(at, at + self.span) >> np.uint64(32)


def known_code(trigger: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """The code of a phrase that an earlier document has; a trigger's own code is the trigger."""
    return mix(trigger + phrase * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))


def _part(key: np.ndarray, parts: int) -> np.ndarray:
    return ((key >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _dealt(doc: np.ndarray, th: np.ndarray, parts: int) -> np.ndarray:
    """Parts of texts by id and hash, so that copies of one text spread over all parts."""
    return _part(mix(th.astype(np.uint64) ^ mix(doc.astype(np.uint64))), parts)


def _packed_column(x: np.ndarray) -> bytes:
    """A column's bytes, all lowest ones first and all highest ones last: bytes that are alike lie side by side,
    so that a shuffle compresses what small or sorted numbers share."""
    return x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def _unpacked(x: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(size, -1).T).reshape(-1).view(kind)


def _cut(part: np.ndarray, columns: list[np.ndarray]) -> tuple[np.ndarray, list[list[np.ndarray]]]:
    """The parts that occur, and each column's rows for each of them."""
    # numbers of 16 bits are sorted in one pass
    order = np.argsort(part.astype(np.uint16) if part.max(initial=0) < 1 << 16 else part, kind="stable")
    part = part[order]
    cut = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))) if len(part) else np.zeros(0, np.int64)
    end = np.concatenate((cut[1:], [len(part)]))
    return part[cut], [[c[a:b] for a, b in zip(cut, end)] for c in (c[order] for c in columns)]


def _by_part(part: np.ndarray, columns: list[np.ndarray]) -> tuple[np.ndarray, list[list[bytes]]]:
    """The parts that occur, and each column packed for each of them."""
    part, columns = _cut(part, columns)
    return part, [[_packed_column(x) for x in c] for c in columns]


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where a run of equal keys begins, in arrays sorted by them."""
    new = np.ones(len(keys[0]), dtype=bool)
    new[1:] = False
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return new


def _runs(key: np.ndarray, *exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order with equal rows of ``exact`` together, by ``key``, which follows from them, and where their runs begin."""
    order = np.argsort(key)
    new = _starts(*(x[order] for x in exact))
    if (new & ~_starts(key[order])).any():                          # different rows of one key
        order = np.lexsort((*exact, key))
        new = _starts(*(x[order] for x in exact))
    return order, new


def _after_first(doc: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Which ids of a run are larger than its smallest."""
    first = np.flatnonzero(new)
    if not len(first):
        return np.zeros(0, dtype=bool)
    return doc > np.repeat(np.minimum.reduceat(doc, first), np.diff(np.concatenate((first, [len(doc)]))))


def _first_of_run(values: np.ndarray, new: np.ndarray) -> np.ndarray:
    return values[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]


def _packed(fields: str):
    """Spark and Arrow schemas of a part's packed columns."""
    spark = "kind string, part bigint, " + ", ".join(f"{f} binary" for f in fields)
    return spark, ["kind", "part", *fields]


def _batch(names: list[str], kind: str, part: np.ndarray, columns: list[list[bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([kind] * len(part), pa.string()), pa.array(part), *[pa.array(c, pa.binary()) for c in columns]],
        names=names)


def _with_places(part: np.ndarray, columns: list[np.ndarray], at: np.ndarray, doc: np.ndarray, th: np.ndarray):
    """Packed columns by part, and last the places of ids and the ids that a part's rows use.

    ``at`` is the place of each row's id in ``doc`` and ``th``.
    """
    part, cut = _cut(part, [*columns, at.astype(np.uint32)])
    place, own_doc, own_th = [], [], []
    for x in cut.pop():
        used = np.zeros(len(doc), dtype=bool)
        used[x] = True
        own_doc.append(_packed_column(doc[used]))
        own_th.append(_packed_column(th[used]))
        place.append(_packed_column((np.cumsum(used) - 1).astype(np.uint32)[x]))
    return part, [*([_packed_column(x) for x in c] for c in cut), place, own_doc, own_th]


def _with_ids(part: np.ndarray, columns: list[np.ndarray], doc: np.ndarray, th: np.ndarray):
    """The same for rows with their ids."""
    row = np.lexsort((th, doc))
    new = _starts(doc[row], th[row])
    at = np.zeros(len(doc), dtype=np.int64)
    at[row] = np.cumsum(new) - 1
    return _with_places(part, columns, at, doc[row][new], th[row][new])


def _ids_of(frame: pd.DataFrame, place: str, doc: str, th: str) -> tuple[np.ndarray, np.ndarray]:
    base = np.concatenate(([0], np.cumsum([len(x) // 8 for x in frame[doc]])))
    at = np.concatenate([_unpacked(x, np.uint32).astype(np.int64) + b for x, b in zip(frame[place], base)])
    return _join(frame, doc, np.int64)[at], _join(frame, th, np.int64)[at]


PHRASES, PHRASE_NAMES = _packed("abcde")
STRINGS, STRING_NAMES = _packed("abcdef")


def _texts(doc: np.ndarray, th: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The place of each row's text, and the texts, of rows that come text by text."""
    new = _starts(doc, th) if len(doc) else np.zeros(0, dtype=bool)
    return np.cumsum(new) - 1, doc[new], th[new]


def _phrases_out(trigger, phrase, doc, th, parts: int) -> Iterator[pa.RecordBatch]:
    """A chunk's phrases to the parts of their triggers.

    Of a phrase, places after the chunk's smallest id are known to repeat; they
    go to parts dealt by text as codes, which are only passed on there.  To the
    part of its trigger a phrase sends a row for each text of that smallest id:
    one a chunk, but for null and repeated ids.  Triggers are the smallest of
    many hashes, so they are mixed again before they choose a part.
    """
    at, ids, hashes = _texts(doc, th)
    order, one = _runs(phrase, phrase, trigger)
    trigger, phrase, at = trigger[order], phrase[order], at[order]
    doc, th = ids[at], hashes[at]
    later = _after_first(doc, one)
    # of a text's places only one; most runs are of one place
    text = np.ones(len(doc), dtype=bool)
    run = np.cumsum(one) - 1
    some = np.flatnonzero((np.bincount(run) > 1)[run]) if len(run) else run
    some = some[np.lexsort((th[some], doc[some], run[some]))]
    text[some] = _starts(run[some], doc[some], th[some])
    repeats, first = text & later, text & ~later
    code = known_code(trigger[repeats], phrase[repeats])
    yield _batch(PHRASE_NAMES, "code", *_with_places(
        _dealt(ids, hashes, parts)[at[repeats]], [code, np.zeros(len(code), np.uint8)], at[repeats], ids, hashes))
    trigger, phrase = trigger[first], phrase[first]
    yield _batch(PHRASE_NAMES, "phrase", *_with_places(
        _part(mix(trigger), parts), [trigger, phrase], at[first], ids, hashes))


def _join(frame: pd.DataFrame, column: str, kind) -> np.ndarray:
    return np.concatenate([_unpacked(x, kind) for x in frame[column]])


def _codes(doc: np.ndarray, th: np.ndarray, code: np.ndarray, parts: int) -> pd.DataFrame:
    """Codes by bucket of texts, a row for each bucket: so many rows a part at most as there are parts."""
    bucket, columns = _with_ids(_dealt(doc, th, parts), [code], doc, th)
    return pd.DataFrame(dict(zip(("bucket", "codes", "places", "docs", "ths"), [bucket, *columns])))


def _settle(frame: pd.DataFrame, parts: int) -> pd.DataFrame:
    """One part: codes of phrases after a smaller id, and triggers that dictionary phrases share."""
    trigger = _join(frame, "a", np.uint64)
    doc, th = _ids_of(frame, "c", "d", "e")
    if frame["kind"].iloc[0] == "code":
        return _codes(doc, th, trigger, parts)
    phrase = _join(frame, "b", np.uint64)
    order = np.lexsort((doc, phrase, trigger))
    trigger, phrase, doc, th = (x[order] for x in (trigger, phrase, doc, th))
    one = _starts(trigger, phrase)
    later = doc > _first_of_run(doc, one)
    known = known_code(trigger[later], phrase[later]), doc[later], th[later]
    # every text of the smallest id of each phrase
    keep = ~later
    new = _starts(trigger)
    group = np.cumsum(new) - 1
    several = np.bincount(group, weights=one)[group] > 1
    shared = keep & several
    return _codes(*(np.concatenate(x) for x in zip((known[1], known[2], known[0]),
                                                   (doc[shared], th[shared], trigger[shared]))), parts)


def _by_text(frame: pd.DataFrame) -> pd.DataFrame:
    """One bucket: a row per text with its codes, no more than it has phrases."""
    doc, th = _ids_of(frame, "places", "docs", "ths")
    code = _join(frame, "codes", np.uint64)
    order = np.lexsort((th, doc))
    doc, th, code = doc[order], th[order], code[order]
    first = np.flatnonzero(_starts(doc, th)) if len(doc) else np.zeros(0, np.int64)
    end = np.concatenate((first[1:], [len(doc)]))
    return pd.DataFrame({"doc": doc[first], "th": th[first],
                         "codes": [code[a:b].tobytes() for a, b in zip(first, end)]})


def _of_text(code: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Codes of several texts, told apart by their text."""
    return mix(code ^ mix(text.astype(np.uint64)))


def _codes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The packed codes of a slice of texts, and the text of each."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    if offsets[0] == offsets[-1]:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    codes = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]].view(np.uint64)
    return codes, np.repeat(np.arange(len(column)), np.diff(offsets) // 8)


def _counting(lengths: np.ndarray) -> np.ndarray:
    """0 .. n-1 for each length n, one after the other."""
    return np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def _merged(doc, th, start, stop) -> pd.DataFrame:
    """Ranges of bytes, joined where they touch."""
    order = np.lexsort((start, th, doc))
    doc, th, start, stop = (x[order] for x in (doc, th, start, stop))
    if not len(doc):
        return pd.DataFrame({"doc": doc, "th": th, "start": start.astype(np.int32), "stop": stop.astype(np.int32)})
    text = np.cumsum(_starts(doc, th))
    # the furthest stop so far within a text: texts are far apart on one line
    line = int(stop.max()) + 2
    reach = np.maximum.accumulate(stop + text * line)
    new = np.ones(len(doc), dtype=bool)
    new[1:] = start[1:] + text[1:] * line > reach[:-1]
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [len(doc)])) - 1
    return pd.DataFrame({"doc": doc[first], "th": th[first], "start": start[first].astype(np.int32),
                         "stop": (reach[last] - text[last] * line).astype(np.int32)})


def repeated_ranges(rows: DataFrame, span: int = 50, gram: int = 24, part_bytes: int = 16 << 20,
                    chunk_bytes: int = 16 << 20, chunk_strings: int = 1_000_000, id_filter_bits: int = 22) -> DataFrame:
    """Ranges of removed bytes of ``rows`` (doc, th, text): doc, th, start, stop, which may overlap."""
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = int(total // part_bytes) + 1

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            doc, th = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for i, j in slices(batch.column(2), SLICE):
                p = Parse(batch.column(2)[i:j], span, gram)
                if len(p.at):
                    held.append((p.trigger, p.phrase, doc[i:j][p.text], th[i:j][p.text]))
                size += len(p.buf)
                if held and size >= chunk_bytes:
                    yield from _phrases_out(*(np.concatenate(c) for c in zip(*held)), parts)
                    held, size = [], 0
        if held:
            yield from _phrases_out(*(np.concatenate(c) for c in zip(*held)), parts)

    def settle(frame: pd.DataFrame) -> pd.DataFrame:
        return _settle(frame, parts)

    codes = staged(rows.mapInArrow(parse, PHRASES).groupBy("kind", "part").applyInPandas(settle, CODES)
                   .groupBy("bucket").applyInPandas(_by_text, "doc bigint, th bigint, codes binary"), "parse-codes", free=True)
    may = IdFilter(codes, "doc", id_filter_bits)
    suspects = rows.filter(may.may_have(F.col("doc"))).join(codes, ["doc", "th"])

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            doc, th = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for i, j in slices(batch.column(2), SLICE):
                p = Parse(batch.column(2)[i:j], span, gram)
                if not len(p.at):
                    continue
                have = _of_text(*_codes_of(batch.column(3)[i:j]))
                known = np.isin(_of_text(known_code(p.trigger, p.phrase), p.text), have)
                shared = np.isin(_of_text(p.trigger, p.text), have)
                own = p.offsets[p.text]
                if known.any():
                    yield from marks_out(doc[i:j][p.text[known]], th[i:j][p.text[known]],
                                         (p.start - own)[known], (p.stop - own)[known])
                shared &= ~known
                if shared.any():
                    length = p.stop - p.start - span + 1
                    at = np.repeat(p.start[shared], length[shared]) + _counting(length[shared])
                    text = np.repeat(p.text[shared], length[shared])
                    held.append((*p.strings(at), doc[i:j][text], th[i:j][text], at - p.offsets[text]))
                    size += len(at)
                if size >= chunk_strings:
                    yield from strings_out(*(np.concatenate(c) for c in zip(*held)))
                    held, size = [], 0
        if held:
            yield from strings_out(*(np.concatenate(c) for c in zip(*held)))

    def marks_out(doc, th, start, stop) -> Iterator[pa.RecordBatch]:
        r = _merged(doc, th, start, stop)
        part, (a, b, c, d) = _by_part(_dealt(r["doc"].to_numpy(), r["th"].to_numpy(), parts), [r[c].to_numpy() for c in r])
        empty = [b""] * len(part)
        yield _batch(STRING_NAMES, "mark", part, [a, b, c, d, empty, empty])

    def strings_out(head, first, second, doc, th, at) -> Iterator[pa.RecordBatch]:
        text, ids, hashes = _texts(doc, th)
        half = np.uint64(32)
        order, new = _runs(head >> half << half | first >> half, head, first, second)
        later = _after_first(doc[order], new)
        if later.any():
            gone = order[later]
            yield from marks_out(doc[gone], th[gone], at[gone], at[gone] + span)
        k = order[~later]
        yield _batch(STRING_NAMES, "string", *_with_places(
            _part(mix(first[k]), parts), [first[k], second[k].astype(np.uint32), at[k].astype(np.int32)], text[k], ids, hashes))

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        if frame["kind"].iloc[0] == "mark":
            return _merged(_join(frame, "a", np.int64), _join(frame, "b", np.int64),
                           _join(frame, "c", np.int32).astype(np.int64), _join(frame, "d", np.int32).astype(np.int64))
        first, second, at = _join(frame, "a", np.uint64), _join(frame, "b", np.uint32), _join(frame, "c", np.int32)
        doc, th = _ids_of(frame, "d", "e", "f")
        order = np.lexsort((doc, second, first))
        new = _starts(first[order], second[order])
        later = order[doc[order] > _first_of_run(doc[order], new)]
        at = at[later].astype(np.int64)
        return _merged(doc[later], th[later], at, at + span)

    found = (suspects.select("doc", "th", "text", "codes").mapInArrow(suffixes, STRINGS)
             .groupBy("kind", "part").applyInPandas(merge, MARKS))
    return staged(found, "removed-ranges", free=True)


def remove_repeats(docs: DataFrame, span: int = 50, id_col: str = "doc_id", text_col: str = "text",
                   id_filter_bits: int = 22, **settings) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept (bytes; null when nothing goes) and its SHA-256."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)).alias("doc"),
                       F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("th"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    marks = repeated_ranges(rows.select("doc", "th", "text"), span, id_filter_bits=id_filter_bits, **settings)
    per_text = staged(marks.groupBy("doc", "th").agg(F.collect_list(F.struct("start", "stop")).alias("ranges")),
                      "removed", free=True)
    may = IdFilter(per_text, "doc", id_filter_bits)
    touched = may.may_have(F.col("doc"))
    schema = "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in slices(batch.column(1), 8 << 20):
                out = []
                for r in range(i, j):
                    data = batch.column(1)[r].as_py().encode("utf-8")
                    ranges = batch.column(2)[r].values
                    gone = np.zeros(len(data) + 1, dtype=np.int64)
                    if ranges is not None and len(ranges):
                        np.add.at(gone, ranges.field("start").to_numpy(), 1)
                        np.add.at(gone, ranges.field("stop").to_numpy(), -1)
                    off = np.cumsum(gone[:-1]) > 0
                    kept = np.frombuffer(data, np.uint8)[~off].tobytes()
                    spans = int((np.diff(np.concatenate(([False], off)).astype(np.int8)) == 1).sum())
                    out.append((len(data), int(off.sum()), spans, hashlib.sha256(kept).hexdigest(),
                                kept if off.any() else None))
                n, removed, spans, sha, kept = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[i:j], pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                     pa.array(spans, pa.int64()), pa.array(sha), pa.array(kept, pa.binary())],
                    names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    some = (rows.filter(touched).join(per_text, ["doc", "th"], "left").select("id", "text", "ranges")
            .mapInArrow(cut, schema))
    none = rows.filter(~touched).select(
        "id", F.octet_length("text").cast("bigint").alias("n_bytes"), F.lit(0).cast("bigint").alias("n_removed"),
        F.lit(0).cast("bigint").alias("n_spans"), F.sha2("text", 256).alias("kept_sha256"),
        F.lit(None).cast("binary").alias("kept"))
    return some.unionByName(none).select(F.col("id").alias(id_col), "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")
