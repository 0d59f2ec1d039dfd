"""The corpus pipeline: quality, exact copies, near copies, source mix, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again
as the next one's `docs`. All but the last return the columns of `documents`.

A null text counts as empty throughout: it is scored as an empty line, is a copy of other empty texts, has no shingles and
so no near copies, has no words to mix and no ids. A null id is kept; of copies it counts as the smallest in the exact
stage and as the largest in the near one. A null source is a source of its own, after the others. Repeated rows are
copies. Extra columns pass through, whatever their names. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemill.llm import crf, exact_dedup, jaccard_join, mixing, queries
from tidemill.llm.common import fresh_name
from tidemill.session import materialize, prepare


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the line model rejects; it is fitted on labelled documents of the input."""
    prepare(spark)
    chain = crf.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score, predicted = fresh_name(docs, "score"), fresh_name(docs, "predicted")
    return crf.score_documents(docs, chain).where(f"`{predicted}` = 1").drop(score, predicted)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the row with the largest id of equal texts."""
    prepare(spark)
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group that Jaccard links connect, that with the smallest id."""
    prepare(spark)
    return jaccard_join.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or drop documents so that each source comes near its target of words."""
    prepare(spark)
    return mixing.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode each document and decode it again; digests of both, one row per row of the mix."""
    prepare(spark)
    return queries.bpe_digests(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources", mix_sources),
    ("byte-level BPE", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from `documents`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


ORACLE_SQL = None  # model scores, a sampling key and a tokenizer: tested against a brute-force version
