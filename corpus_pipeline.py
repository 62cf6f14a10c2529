"""From raw documents to packed sequences in four stages.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it
kept; its result is written as Parquet and read again. All but the last return
the columns of ``documents``.

Cases: a null text counts as empty, fails the fixed rules and goes in the first stage; a
stage that gets such rows all the same keeps them as their operator says (see
``tidemark.llm``); null ids, languages and sources pass through; repeated rows are one
class of near-duplicates; extra columns are dropped at the start of a stage; an empty
table gives empty results with the same columns. Every stage starts from files, so a lost
executor costs a stage's tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import minhash, packing, pii, quality
from tidemark.llm.common import read_table, stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the fixed rules and the log-likelihood ratio."""
    scored = quality.score_documents(docs, read_table(spark, sf_dir, "labels"), keep=COLUMNS)
    return scored.filter("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return minhash.one_of_each_class(docs.select(*COLUMNS))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data and what reveals it replaced by general names."""
    return pii.redact(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("long"))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document's tokens lie in the training sequences."""
    return packing.pack(stored(packing.token_pieces(docs), "pieces"))


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("packed_sequences", packed_sequences)]

#: Tokenizing, hashing and packing have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
