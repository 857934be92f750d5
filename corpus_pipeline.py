"""A corpus pipeline: filter, deduplicate, decontaminate and encode documents.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's docs. All but the last
return the columns of ``documents``.

Defined cases: an empty table passes through; with no labelled row nothing is
rejected for quality, with no known language every row is rejected as ``und``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pitfeat.checkpoints import cut_lineage
from pitfeat.llm import bpe_codec, decontaminate, language_id, ngram_join, quality_net
from pitfeat.llm.common import id_bucket
from pitfeat.llm.queries import table, vocabulary

#: least confidence in a language; with four languages chance is 0.25
CONFIDENCE = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of good quality reaches the cut."""
    labels = table(spark, sf_dir, "labels").where(id_bucket("doc_id", 5) != 0)
    scored = quality_net.score(docs, quality_net.train(docs, labels), only_good=True)
    return scored.select(*docs.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was recognised."""
    model = language_id.train(docs.where(id_bucket("doc_id", 4) != 2))
    return language_id.identify(docs, model, least=CONFIDENCE).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones, that with the smallest id."""
    return ngram_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, checked by decoding them."""
    return bpe_codec.encode(docs, vocabulary())


STAGES = [
    ("quality", quality),
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

# trained networks, near duplicates and BPE are beyond SQL; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
