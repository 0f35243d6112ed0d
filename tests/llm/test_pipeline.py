from __future__ import annotations

import collections

import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from compare import compare, duck
from submart.llm import sql
from submart.llm.jaccard import Threshold, jaccard_components
from submart.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("row", F.lit(1)).withColumn("set", F.lit("x"))
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = collections.Counter(r.doc_id for r in docs.select("doc_id").collect())
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmp_path}/{k}")
        out = spark.read.parquet(f"{tmp_path}/{k}")
        after = collections.Counter(r.doc_id for r in out.select("doc_id").collect())
        assert after and set(after) <= set(before)
        if name == "near_duplicates":
            found = jaccard_components(docs, Threshold(5, 80, 100)).collect()
            assert set(after) == {r.component_id for r in found} and max(after.values()) == 1
        if name == "mix":
            assert max(after.values()) <= 2
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns
        else:
            assert after == before
        docs = out


def test_registered():
    names = set(__spark_entry__.queries())
    assert set(QUERIES) <= names and "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(sql.ORACLE_SQL))
def test_oracle(spark, name):
    ok, why = compare(QUERIES[name](spark, SF), duck(SF), sql.ORACLE_SQL[name])
    assert ok, why


def test_one_row_per_conversation(spark):
    out = QUERIES["op11_chat_formatting"](spark, SF).select("conv_id").collect()
    stored = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id").distinct().collect()
    assert sorted(r.conv_id for r in out) == sorted([-1, *(r.conv_id for r in stored)])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(sql.ORACLE_SQL) - {"op11_chat_formatting"}))
def test_one_row_per_document(spark, name):
    out = QUERIES[name](spark, SF).select("doc_id").collect()
    assert sorted(r.doc_id for r in out) == sorted(
        r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect())
