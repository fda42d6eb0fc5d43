"""A corpus pipeline of five stages: language ID, exact dedup, SimHash near-dedup, mixing to target weights, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next stage's docs. All but the
last return the columns of documents. No stage can be told in SQL as a whole (the first and fourth are trained models), so ORACLE_SQL is None and
tests hold the stages against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.llm import exact_dedup, langid, mixing, packing, simhash
from tracewright.llm.common import boxed, materialize, table
from tracewright.llm.queries import tokenizer_path

#: A document goes if it has no letters, or if its best language has no more than this share of the belief.
LEAST_BELIEF = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is clear; null and letterless texts go. The model learns from the lang column of the table itself.

    Repeated rows are judged alike; without any lang every document goes. An empty table gives an empty result; further columns stay."""
    told = boxed(docs, told=langid.teller(spark, langid.fit(docs))(F.col("text")))
    return told.filter((F.col("told.lang_pred") != langid.UNKNOWN) & (F.col("told.score") > LEAST_BELIEF)).select("own.*")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the row with the largest doc_id of each text (null texts are empty ones, null ids come last), and one of rows that repeat it. An empty table
    gives an empty result; further columns stay."""
    return exact_dedup.dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the row with the smallest doc_id of each class of near copies: linked texts share 0.8 of their shingles of five words (Jaccard) or more.

    Null ids come last; texts without words are alike. An empty table gives an empty result; further columns stay."""
    return simhash.dedup(docs, width=5, likeness=0.8)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Thins or repeats documents so that the labelled table's domains get their target shares of the tokens (words between white space).

    Empty texts stay once; without labels every row does. An empty table gives an empty result; further columns stay."""
    labels = table(spark, sf_dir, "labels").select("doc_id", mixing.domain_of().alias("domain"))
    return mixing.mix(docs, labels)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 ids, with their ids. Null and empty texts give the closing id; repeated rows are packed each. An empty table gives an
    empty result; further columns go."""
    return packing.pack(docs, tokenizer_path(), tokens=True)


STAGES = [("language", language), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mix), ("packing", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
