"""The corpus pipeline: five stages from raw documents to token sequences, each one operator of recengine.llm.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as Parquet in the shared folder
(spark.checkpoint.dir) and reads it again as the next stage's documents, so a lost executor costs at most the stage it worked on. All
stages but the last return the columns of documents.

  language_id      documents without a recognisable language (no letter) go; a missing lang is filled in
  ngram_join       of each group of near duplicates (five-word shingles, Jaccard similarity of 0.8 or more) one document stays
  decontamination  documents that hold a window of a benchmark item go
  mixing           each source is taken to its target: a document stays 0, 1 or 2 times
  token_output     token ids in Arrow files of equal-length sequences; a row per document, read back from them
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recengine.llm import decontaminate, language_id, mixing, ngram_join, token_output
from recengine.llm.common import Scratch, table

SHINGLE, PERCENT = 5, 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.train(docs)
    # columns are numbered meanwhile, so that their names don't matter
    names = ["text" if c == "text" else f"c{i}" for i, c in enumerate(docs.columns)]
    known = language_id.predict(docs.toDF(*names), model)
    # if no language could be learned, only texts without a letter are rejected
    keep = F.col("lang_pred") != language_id.UNDETERMINED if model.languages else F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False))
    lang = F.coalesce(names[docs.columns.index("lang")], F.when(F.col("lang_pred") != language_id.UNDETERMINED, F.col("lang_pred")))
    return known.where(keep).select(*[(lang if c == "lang" else F.col(name)).alias(c) for c, name in zip(docs.columns, names)])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs, SHINGLE, PERCENT)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_output.token_output(docs)


STAGES = [
    ("language_id", identify_language),
    ("ngram_join", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix),
    ("token_output", write_tokens),
]

#: No SQL: tokens, predictions and thresholds of a trained model have none. tests/llm compares stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return docs
