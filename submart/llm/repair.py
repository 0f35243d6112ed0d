"""Repair of conversations by an auction for shortest paths.

A conversation's turns and the role last written span a lattice: node (i, q)
has i turns behind it, and q is ``none``, ``system``, ``user`` or
``assistant``.  Arcs are edits: Keep (0), Rerole to the role that is due (1),
Delete (2) and Insert an empty turn of the role that is due (5); a truncated
turn that is not deleted costs 5 more, and blank and repeated turns can only
be deleted.  A repaired conversation is nothing, or an optional system turn
and then user and assistant turns in pairs.

The auction keeps a price per node, at most any arc's cost plus the price
behind it, and a path from the origin along arcs where both are equal.  At the
path's end the price rises to the best arc's; if it rose the path contracts by
a node, and otherwise it extends over that arc.  Prices start at what the
turns ahead cost at least.  Of a long run the nodes of every 16th turn are
settled first, from the end on, and a path stops where a price is exact, so
the work is in proportion to the turns.  When the path reaches the end the
origin's price is the least cost, and every cheapest path runs over tight arcs
(price = cost + price behind), so the least audit is traced over tight arcs
that still lead to the end, taking D before I, K and R; a node has one arc of
each.

A conversation over ``block_bytes`` is solved in blocks (``turns.py``): each
block for every role before and after it, which are then joined in order by
cost and audit.  Two audits of one block, with equal ends and costs, have as
many inserts, so neither is the other's prefix and the least stays least.
"""

from __future__ import annotations

import functools
import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import turns
from .common import reach_workers, staged

#: fixed values: what edits cost
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
SPACES = " \t\n\v\f\r"
NONE, SYSTEM, USER, ASSISTANT = range(4)
#: the role that is due after each, and what it is called
DUE = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: where a kept turn of a role may follow
AFTER = {"s": {NONE: SYSTEM}, "u": {NONE: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
LEGAL = {"su", "ua", "au"}
#: turns between origins that are settled from the end on, so a path is never much longer
STATION = 16
WHOLE = (NONE, ASSISTANT)

_TURNS = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]))
_COUNTS = [T.StructField(c, T.LongType()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
REPAIRED = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("block", T.LongType()), *_COUNTS,
                         T.StructField("audit", T.StringType()), T.StructField("turns", _TURNS)])
_PART = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("block", T.LongType()), *_COUNTS[1:5],
                      *[T.StructField(c, T.LongType()) for c in ("n_turns", "first_turn", "last_turn")],
                      T.StructField("first_role", T.StringType()), T.StructField("last_role", T.StringType()),
                      T.StructField("costs", T.ArrayType(T.LongType())), T.StructField("audits", T.ArrayType(T.StringType()))])
_CHOSEN = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("block", T.LongType()), *_COUNTS,
                        T.StructField("audit", T.StringType()), T.StructField("role", T.IntegerType())])


def code(initial: str, fault: str) -> str:
    """A turn as the lattice sees it: role initial (``o``: another), upper case if truncated, ``x`` if it must go."""
    if fault in ("blank", "duplicate"):
        return "x"
    initial = initial if initial in AFTER else "o"
    return initial.upper() if fault == "truncated" else initial


def _arcs(codes: str, i: int, q: int) -> list[tuple[str, int, int, int]]:
    """(edit, cost, i, q) out of a node, by edit."""
    due, out = DUE[q], []
    if i < len(codes):
        out.append(("D", DELETE, i + 1, q))
    out.append(("I", INSERT, i, due))
    if i < len(codes) and codes[i] != "x":
        more = TRUNCATED if codes[i].isupper() else 0
        kept = AFTER.get(codes[i].lower(), {}).get(q)
        if kept is not None:
            out.append(("K", more, i + 1, kept))
        out.append(("R", REROLE + more, i + 1, due))
    return out


class Lattice:
    """The lattice of a run of turns up to one of the roles ``ends``, with its prices."""

    def __init__(self, codes: str, ends: tuple[int, ...] = WHOLE):
        n = self.n = len(codes)
        self.ends = ends
        # arcs to nodes from which an end can be reached
        self.reach = [[i == n and q in ends for q in range(4)] for i in range(n + 1)]
        self.arcs: list[list] = [[[] for _ in range(4)] for _ in range(n + 1)]
        ahead = [0] * (n + 1)
        for i in range(n, -1, -1):
            if i < n:
                ahead[i] = ahead[i + 1] + (DELETE if codes[i] == "x" or codes[i].isupper() else 0)
            out = [_arcs(codes, i, q) for q in range(4)]
            for _ in range(3):
                for q in range(4):
                    self.reach[i][q] = self.reach[i][q] or any(self.reach[j][r] for _, _, j, r in out[q])
            for q in range(4):
                self.arcs[i][q] = [a for a in out[q] if self.reach[a[2]][a[3]]]
        self.price = [[a] * 4 for a in ahead]
        # nodes whose price is their distance to the end
        self.exact = {(n, q) for q in ends}
        for i in range(n - STATION, 0, -STATION):
            for q in range(4):
                if self.reach[i][q]:
                    self._settle(i, q)
            # the turns before a station cost what they cost at least and the least that follows it
            least = min(self.price[i][q] for q in range(4) if self.reach[i][q])
            for k in range(max(0, i - STATION), i):
                self.price[k] = [ahead[k] - ahead[i] + least] * 4

    def _settle(self, i: int, q: int) -> None:
        """The auction from one origin; its path ends where a price is exact already."""
        price, path = self.price, [(i, q)]
        while path[-1] not in self.exact:
            i, q = path[-1]
            best, to = min((c + price[j][r], (j, r)) for _, c, j, r in self.arcs[i][q])
            if price[i][q] < best:
                price[i][q] = best
                if len(path) > 1:
                    path.pop()
            else:
                path.append(to)
        self.exact.update(path)

    def solve(self, start: int) -> tuple[int, str] | None:
        """Least cost from role ``start`` over all turns and its least audit; None if there is no way."""
        if not self.reach[0][start]:
            return None
        self._settle(0, start)
        price, tight = self.price, {}
        # tight arcs from here on, and those of them that lead to the end
        todo = [(0, start)]
        while todo:
            node = todo.pop()
            if node not in tight:
                i, q = node
                tight[node] = [(e, (j, r)) for e, c, j, r in self.arcs[i][q] if price[i][q] == c + price[j][r]]
                todo.extend(to for _, to in tight[node])
        at_end = {(self.n, q) for q in self.ends if price[self.n][q] == 0}
        leads, before = set(), {}
        for node, out in tight.items():
            for _, to in out:
                before.setdefault(to, []).append(node)
        todo = [node for node in tight if node in at_end]
        while todo:
            node = todo.pop()
            if node not in leads:
                leads.add(node)
                todo.extend(before.get(node, ()))
        node, audit = (0, start), []
        while node not in at_end:
            edit, node = next(a for a in tight[node] if a[1] in leads)
            audit.append(edit)
        return price[0][start], "".join(audit)


def auction(codes: str, start: int = NONE, ends: tuple[int, ...] = WHOLE) -> tuple[int, str] | None:
    return Lattice(codes, ends).solve(start)


_auction_kept = functools.lru_cache(maxsize=1 << 14)(auction)


def apply_audit(audit: str, rows: list[tuple[str, str]], role: int = NONE) -> list[tuple[str, str]]:
    """The turns (role, text) that an audit makes of ``rows``, after a turn of ``role``."""
    out, at = [], iter(rows)
    for edit in audit:
        if edit == "I":
            role = DUE[role]
            out.append((NAMES[role], ""))
            continue
        name, text = next(at)
        if edit == "K":
            role = AFTER[name[0]][role]
            out.append((name, text))
        elif edit == "R":
            role = DUE[role]
            out.append((NAMES[role], text))
    return out


def fault(role: str, text: str, seen: bool) -> str:
    said = text.strip(SPACES)
    if not said:
        return "blank"
    if seen:
        return "duplicate"
    return "" if said[-1] in ".!?" else "truncated"


def _judged(rows, seen=None) -> tuple[list[tuple], list[tuple[str, str]], str, dict]:
    """Turns, role and text, codes and counts of rows (turn, role, text[, seen])."""
    known, faults, said = set(), [], []
    for row in rows:
        role, text = row[1] or "", row[2] or ""
        key = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
        faults.append(fault(role, text, row[3] if seen else key in known))
        known.add(key)
        said.append((role, text))
    initials = [r[:1] for r, _ in said]
    codes = "".join(map(code, initials, faults))
    counts = {f: faults.count(f) for f in ("blank", "duplicate", "truncated")}
    counts["illegal"] = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
    return [r[0] for r in rows], said, codes, counts


def _gaps(first, last, n) -> int:
    return 0 if first is None else last - first + 1 - n


def _whole(groups):
    for (conv,), rows in groups:
        rows = [r[1:] for r in rows]
        order, said, codes, n = _judged(rows)
        order = [t for t in order if t is not None]
        # short conversations are much alike
        cost, audit = _auction_kept(codes) if len(codes) <= 64 else auction(codes)
        yield (conv, 0, _gaps(min(order, default=None), max(order, default=None), len(set(order))), n["blank"], n["duplicate"],
               n["truncated"], n["illegal"], cost, audit, [{"role": r, "text": t} for r, t in apply_audit(audit, said)])


def _parts(groups):
    """A block's ways from each role to each, and what its neighbours need to know."""
    for (conv, block), rows in groups:
        order, said, codes, n = _judged([r[2:] for r in rows], seen=True)
        order = [t for t in order if t is not None]
        ways = [None] * 16
        for r in range(4):
            lattice = Lattice(codes, (r,))
            ways[r::4] = [lattice.solve(q) for q in range(4)]
        yield (conv, block, n["blank"], n["duplicate"], n["truncated"], n["illegal"], len(set(order)),
               min(order, default=None), max(order, default=None), said[0][0][:1], said[-1][0][:1],
               [w and w[0] for w in ways], [w and w[1] for w in ways])


def _joined(groups):
    """Each block's piece of the conversation's audit; sums stand on its first block."""
    for (conv,), parts in groups:
        best = {NONE: (0, None)}                            # role: (cost, linked pieces)
        sums, names, distinct, low, high, last_role = [0] * 4, [], 0, None, None, None
        for _, block, *counts, n, first, last, first_role, role, costs, audits in parts:
            names.append(block)
            sums = [a + b for a, b in zip(sums, counts)]
            sums[3] += last_role is not None and last_role + first_role not in LEGAL
            distinct += n - (first is not None and first == high)
            low, high, last_role = first if low is None else low, high if last is None else last, role
            step = {}
            for q, (cost, linked) in best.items():
                for r in range(4):
                    if costs[4 * q + r] is not None:
                        new = (cost + costs[4 * q + r], (linked, q, audits[4 * q + r]))
                        if r not in step or new[0] < step[r][0] or (new[0] == step[r][0] and _less(new[1], step[r][1])):
                            step[r] = new
            best = step
        cost, linked = functools.reduce(lambda a, b: b if b[0] < a[0] or (b[0] == a[0] and _less(b[1], a[1])) else a,
                                        [best[r] for r in WHOLE if r in best])
        pieces = []
        while linked is not None:
            linked, q, audit = linked
            pieces.append((q, audit))
        for k, (block, (q, audit)) in enumerate(zip(names, reversed(pieces))):
            total = (_gaps(low, high, distinct), *sums, cost) if k == 0 else (None,) * 6
            yield (conv, block, *total, audit, q)


def _less(a, b) -> bool:
    """Whether one linked audit is less than another of as many blocks; they part before what they share."""
    tail = []
    while a is not b:
        tail.append((a[2], b[2]))
        a, b = a[0], b[0]
    return "".join(x for x, _ in reversed(tail)) < "".join(y for _, y in reversed(tail))


def _applied(groups):
    """Blocks with their choice (the first row, its audit as text) made into turns."""
    for (conv, block), rows in groups:
        choice, *rows = list(rows)
        made = apply_audit(choice[4], [(r[3] or "", r[4] or "") for r in rows], choice[5])
        yield (conv, block, *choice[6:], choice[4], [{"role": r, "text": t} for r, t in made])


def repair_conversations(rows: DataFrame, block_bytes: int = turns.BLOCK_BYTES) -> DataFrame:
    """The cheapest repair of every conversation of ``rows`` (``conv_id, turn, role, text``), by block.

    Columns: ``conv_id, block, gaps, blank, duplicate, truncated, illegal,
    cost, audit, turns, long``.  A conversation of up to ``block_bytes`` is one
    block.  The counts and the cost stand on a conversation's first block;
    ``audit`` and ``turns`` (role, text) are each block's, in order.

    Other columns may have any name and are not read.  Turns are ordered by
    ``turn``, null first, rows of equal turn by role and then text.  A null role or text is empty, so a null text is blank; rows with a
    null ``conv_id`` are one conversation.  A repeated row is a duplicate.  An
    empty table has no rows.
    """
    reach_workers(rows.sparkSession)
    short, long = turns.split_long(turns.turn_rows(rows), block_bytes)
    out = turns.stream(turns.whole(short), 1, REPAIRED, _whole).withColumn("long", F.lit(False))
    if long is None:
        return out
    own = turns.in_blocks(long, block_bytes)
    text = F.coalesce("text", F.lit(""))
    firsts = (own.groupBy("conv_id", F.coalesce("role", F.lit("")).alias("r"), F.sha2(text, 256).alias("t"))
              .agg(F.min("at").alias("first")).select(F.col("conv_id").alias("c"), "first"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("at") == F.col("first"))
    judged = own.join(firsts, same, "left").withColumn("seen", F.col("first").isNull())
    parts = turns.stream(turns.by_block(judged.select("conv_id", "block", "turn", "role", "text", "seen", "at"), "at"),
                         2, _PART, _parts)
    chosen = staged(turns.stream(turns.by_conversation(parts, "block"), 1, _CHOSEN, _joined), "repair-choices")
    counts = [f.name for f in _COUNTS]
    both = (chosen.select("conv_id", "block", F.lit(-1).cast("bigint").alias("at"), F.lit(None).cast("string").alias("role"),
                          F.col("audit").alias("text"), F.col("role").alias("before"), *counts)
            .unionByName(own.select("conv_id", "block", "at", "role", "text"), allowMissingColumns=True))
    return out.unionByName(turns.stream(turns.by_block(both, "at"), 2, REPAIRED, _applied).withColumn("long", F.lit(True)))


_TOLD = T.StructType([T.StructField("conv_id", T.LongType()), *_COUNTS, T.StructField("audit", T.StringType()),
                      T.StructField("repaired_sha256", T.StringType())])


def _told(groups):
    for (conv,), blocks in groups:
        digest, audit, totals, wrote = hashlib.sha256(), [], None, False
        for _, _, *counts, piece, made in blocks:
            totals = counts if totals is None else totals
            audit.append(piece)
            for turn in made:
                digest.update(("\n" * wrote + f"{turn['role']}:{turn['text']}").encode())
                wrote = True
        yield (conv, *totals, "".join(audit), digest.hexdigest())


def repair_digests(repaired: DataFrame) -> DataFrame:
    """Per conversation its counts, cost, audit and the digest of its repaired ``role:text`` lines."""
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    counts = [f.name for f in _COUNTS]
    short = repaired.filter(~F.col("long")).select("conv_id", *counts, "audit", F.sha2(F.array_join(lines, "\n"), 256)
                                                   .alias("repaired_sha256"))
    blocks = turns.by_conversation(repaired.filter("long").drop("long"), "block")
    return short.unionByName(turns.stream(blocks, 1, _TOLD, _told))
