"""Document fingerprints by consistent weighted sampling.

A text's terms are its words, weighted by their counts.  For each of the
``samples`` draws, a term gets gamma variables r and c and a uniform beta from
hashes of the term and the draw alone; with weight w,

    t = floor(ln w / r + beta),   ln a = ln c - r (t - beta + 1),

and the draw's sample is the (term, t) of the smallest a.  Two texts agree in
a draw with the chance of their generalised Jaccard similarity, sum(min) over
sum(max) of the weights.  A fingerprint holds 16 bits of a hash of each sample,
as four hex digits a draw; the likeness of two is the share of equal draws.

Everything is DataFrame functions.  Texts are shuffled once, by ranges of the
id; counting the terms, taking the minima and finding the next text all happen
within those ranges.

A null text is empty.  A text without words has the fingerprint of dashes,
which is like itself alone.  A null id comes last in descending order; rows of
one id go by a hash of their text.  A single row is its own next.  An empty
table gives no rows.  Other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

BITS = 21                       # of a uniform variable
#: word numbers below this one carry a row's own values through the counting
RESERVED = 16
MAX_RANGES = 10_000
RANGES_A_PARTITION = 3


def _range_of(docs: DataFrame, range_bytes: int) -> Column:
    """The range number of an id: 0 for the largest ids, the last for a null id."""
    # a filter over the cuts tells a row's range, so they are bounded; ranges then grow with the data
    size, rows = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count(F.lit(1))).first()
    n = int(max(1, min(rows, size // range_bytes + 1, MAX_RANGES)))
    cuts = []
    if n > 1:
        at = [i / n for i in range(1, n)]
        cuts = docs.agg(F.percentile_approx("doc_id", at, 100 * n)).first()[0] or []
    cuts = sorted(set(cuts))
    if not cuts:
        return F.when(F.col("doc_id").isNull(), F.lit(1)).otherwise(F.lit(0))
    above = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c >= F.col("doc_id")))
    return F.when(F.col("doc_id").isNull(), F.lit(len(cuts) + 1)).otherwise(above)


def _next(rows: DataFrame, columns: list[str], have: list[int]) -> DataFrame:
    """Rows with ``next_<column>`` of the row that follows: by range, then by the place ``at`` in it.

    Within a range the next row is in the same window.  The last row of a range
    takes the first of the next one, and the last of all the first of all;
    ``have`` are the ranges with rows, in order.
    """
    w = Window.partitionBy("range").orderBy("at")
    ahead = rows.select("*", *[F.lead(c).over(w).alias(f"in_{c}") for c in columns], F.lead("at").over(w).alias("in_at"))
    heads = rows.filter("at = 1").select("range", *[F.col(c).alias(f"head_{c}") for c in columns])
    if not have:
        return ahead.select(*rows.columns, *[F.col(f"in_{c}").alias(f"next_{c}") for c in columns])
    before = {have[i]: have[i - 1] for i in range(len(have))}
    pairs = rows.sparkSession.createDataFrame(list(before.items()), "range int, for int")
    heads = heads.join(pairs, "range").drop("range").withColumnRenamed("for", "range")
    return (ahead.join(heads, "range", "left")
            .select(*rows.columns, *[F.when(F.col("in_at").isNotNull(), F.col(f"in_{c}"))
                                     .otherwise(F.col(f"head_{c}")).alias(f"next_{c}") for c in columns]))


def _uniform(h: str, part: int) -> str:
    return f"((shiftrightunsigned({h}, {part * BITS}) & {(1 << BITS) - 1}) + 0.5D) / {float(1 << BITS)}D"


def _draw(term: str, log_weight: str, k: int) -> str:
    """One draw of a weighted term: ln a in the high bits, 16 bits of its sample in the low ones.

    A null weight gives null.  r, ln c and beta are the same expressions for
    every weight, so Spark computes them once for both texts.
    """
    h = f"xxhash64({term}, {k})"
    g = f"xxhash64({term}, {k}, 1)"
    r = f"(-ln({_uniform(h, 0)} * ({_uniform(h, 1)})))"
    log_c = f"ln(-ln({_uniform(h, 2)} * ({_uniform(g, 0)})))"
    beta = f"({_uniform(g, 1)})"
    t = f"floor({log_weight} / {r} + {beta})"
    log_a = f"({log_c} - {r} * ({t} - {beta} + 1))"
    sample = f"(shiftrightunsigned({term} ^ shiftleft({t}, 37) ^ shiftleft({t}, 26), 24) & 65535)"
    return f"shiftleft(cast(({log_a} + 64D) * 4294967296D as bigint), 24) | {sample}"


def _terms(text: str, first: int, second: int) -> str:
    words = f"filter(split({text}, '[ \\\\t\\\\n\\\\x0B\\\\f\\\\r]+'), w -> w <> '')"
    return (f"transform({words}, w -> named_struct('w', xxhash64(w) | {RESERVED}L, "
            f"'n', {first}L, 'm', {second}L))")


def likeness(left: Column, right: Column, samples: int) -> Column:
    """The share of draws in which two fingerprints agree."""
    same = F.aggregate(F.sequence(F.lit(0), F.lit(samples - 1)), F.lit(0), lambda n, i: n + F.when(
        F.substr(left, i * 4 + 1, F.lit(4)) == F.substr(right, i * 4 + 1, F.lit(4)), 1).otherwise(0))
    return same / F.lit(float(samples))


def edited_fingerprints(docs: DataFrame, samples: int = 32, id_col: str = "doc_id", text_col: str = "text",
                        range_bytes: int = 2 << 20) -> DataFrame:
    """Fingerprints of each text and of its edited text.

    The edited text has the last floor(n_chars / 2) code points replaced by
    the first as many (or all) of the next text in descending order of the id.
    """
    base = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    number = _range_of(base, range_bytes).cast("int")
    have = sorted(r[0] for r in base.select(number.alias("range")).distinct().collect())
    w = Window.partitionBy("range").orderBy(F.desc_nulls_last("doc_id"), "tie")
    # a few ranges a partition: counting a partition's terms fits in memory
    rows = (base.withColumn("range", number)
            .repartition(max(1, -(-len(have) // RANGES_A_PARTITION)), "range")
            .withColumn("tie", F.xxhash64("text")).withColumn("at", F.row_number().over(w)).drop("tie"))
    rows = _next(rows, ["text"], have)
    n, half = F.length("text"), F.floor(F.length("text") / 2)
    rows = rows.withColumn("edited", F.concat(F.substr("text", F.lit(1), (n - half).cast("int")),
                                              F.substr("next_text", F.lit(1), half.cast("int"))))
    rows = rows.withColumn("sha", F.sha2("edited", 256)).withColumn("n_chars", n.cast("bigint"))
    # a row's own values travel as reserved word numbers, so one shuffle serves all
    own = ["coalesce(doc_id, 0L)", "if(doc_id is null, 1L, 0L)", "n_chars",
           *[f"cast(conv(substr(sha, {16 * i + 1}, 16), 16, -10) as bigint)" for i in range(4)]]
    reserved = ", ".join(f"named_struct('w', {i}L, 'n', {x}, 'm', 0L)" for i, x in enumerate(own))
    terms = rows.selectExpr("range", "at", f"inline(concat(array({reserved}), {_terms('text', 1, 0)}, "
                                           f"{_terms('edited', 0, 1)})) as (w, n, m)")
    counted = terms.groupBy("range", "at", "w").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))
    is_term = f"w < 0 or w >= {RESERVED}"
    # ln of 0 is null: a term that a text lacks draws nothing for it
    counted = counted.selectExpr("range", "at", "w", "n", f"if({is_term}, ln(n), null) as ln_n",
                                 f"if({is_term}, ln(m), null) as ln_m")
    draws = [F.expr(f"min({_draw('w', f'ln_{c}', k)})").alias(f"{c}{k}") for c in ("n", "m") for k in range(samples)]
    values = [F.expr(f"max(if(w = {i}, n, null))").alias(f"v{i}") for i in range(len(own))]
    drawn = counted.groupBy("range", "at").agg(*values, *draws)

    def print_of(c: str) -> Column:
        parts = [F.lpad(F.lower(F.hex(F.col(f"{c}{k}").bitwiseAND(F.lit(65535)))), 4, "0") for k in range(samples)]
        return F.when(F.col(f"{c}0").isNull(), F.lit("-" * 4 * samples)).otherwise(F.concat(*parts))

    sha = F.lower(F.concat(*[F.lpad(F.hex(f"v{i}"), 16, "0") for i in range(3, 7)]))
    done = staged(drawn.select("range", "at", F.when(F.col("v1") == 0, F.col("v0")).alias("doc_id"),
                               F.col("v2").alias("n_chars"), sha.alias("edited_sha256"),
                               print_of("n").alias("fingerprint"), print_of("m").alias("edited_fingerprint")),
                  "fingerprints")
    out = _next(done, ["fingerprint"], have)
    return out.select(F.col("doc_id").alias(id_col), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                      likeness(F.col("fingerprint"), F.col("edited_fingerprint"), samples).alias("near_edited"),
                      likeness(F.col("fingerprint"), F.col("next_fingerprint"), samples).alias("near_next"))
