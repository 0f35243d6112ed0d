"""The corpus pipeline: from raw documents to balanced shards of a mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and reread as the next one's ``docs``.  All but the last return the
columns of ``docs``.

1. Language: documents whose language is undetermined, or whose margin over the
   next language is narrow, go.
2. Near duplicates: of documents linked by word 5-grams at a Jaccard
   similarity of 0.8 or more, the one with the smallest id stays.
3. Decontamination: documents that hold a window of a benchmark item go.
4. Mix: each document is taken as often as its source's target wants.
5. Shards: documents of equal text together, bytes near equal.

Null and empty texts have no language and go in the first stage.  Repeated
rows are near duplicates of each other.  An empty table gives no rows.  Extra
columns pass through to the last stage, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from submart.llm.common import reach_workers, read_table, staged
from submart.llm.decontam import benchmark_items, find_contamination
from submart.llm.jaccard import Threshold, keep_one_of_each
from submart.llm.langid import MIN_MARGIN, identify_languages, language_samples
from submart.llm.mixing import mixed_documents
from submart.llm.sharding import shard_documents


def _kept(docs: DataFrame, judged: DataFrame, keep) -> DataFrame:
    """The rows of ``judged`` (a column ``row`` and a judgement) that stay, with the columns of ``docs``."""
    return judged.filter(keep).select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    reach_workers(spark)
    samples = language_samples(docs.select("doc_id", "text", "lang"))
    rows = docs.select(F.struct("*").alias("row"), "text")
    return _kept(docs, identify_languages(rows, samples, min_margin=MIN_MARGIN), ~F.col("langid.rejected"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    reach_workers(spark)
    return keep_one_of_each(docs, Threshold(words=5, num=80, den=100))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = benchmark_items(read_table(spark, sf_dir, "benchmark").select("item_id", "text"))
    rows = docs.select(F.struct("*").alias("row"), "text")
    return _kept(docs, find_contamination(rows, items), F.col("found.n_hit") == 0)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    reach_workers(spark)
    return mixed_documents(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    reach_workers(spark)
    return shard_documents(docs.select("doc_id", "text"), shards=40)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mix", mix),
    ("shards", shards),
]

#: compression, the pseudorandom mix and differencing have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
