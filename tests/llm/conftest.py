from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType())])

WORDS = ("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon "
         "phi chi psi omega árbol straße naïve façade über el niño").split()


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", str(rng.randrange(50))]) for _ in range(n))


def corpus(seed: int = 1, n: int = 60) -> list[tuple]:
    """Documents with copies, near copies, shared passages, nulls, empties, repeated rows and a long one."""
    rng = random.Random(seed)
    rows, passage = [], sentence(rng, 30)
    texts = [sentence(rng, rng.choice([1, 3, 8, 40, 120])) for _ in range(n)]
    for i in range(n):
        kind = i % 6
        if kind == 1 and i > 6:
            texts[i] = texts[i - 6]                                          # a copy
        elif kind == 2 and i > 3:
            w = (texts[i - 2] or "x").split(" ")
            w[rng.randrange(len(w))] = "changed"                             # a near copy
            texts[i] = " ".join(w)
        elif kind == 3:
            texts[i] = texts[i] + "\n" + passage + " " + sentence(rng, 5)    # a shared passage
    texts[4], texts[5], texts[10], texts[11] = None, "", " \t\n", "!!! 123 ???"
    texts[12] = sentence(rng, 6000)
    for i, t in enumerate(texts):
        rows.append((i * 7, t, ["en", "de", None][i % 3], [None, "a", "b", "hot", "hot"][i % 5]))
    rows += [rows[3], rows[3], rows[20]]
    return rows


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    from submart.llm.common import reach_workers
    reach_workers(spark)
