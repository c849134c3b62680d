"""Corpus pipeline: quality rules, near-duplicate removal, passage removal,
benchmark decontamination, packing.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; all but the last return the columns of ``documents``.  ``run`` writes
each stage's result as Parquet to the shared folder and reads it back as the
next one's input, so a lost executor costs a re-read.  Null texts are dropped
by the first stage (they have too few words); an empty table gives an empty
result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.llm import decontamination, jaccard, packing, quality, substrings
from lakeward.llm.texts import Folder, text_key, without_keys


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the divergence limits.  Verdicts
    are joined back by id and text, so rows that repeat an id stay apart."""
    named = docs.withColumn("__key", F.struct("doc_id", *text_key("text")))
    rejected = quality.judge(named, id_col="__key").filter(~F.col("kept")).select("__key").distinct()
    rejected = Folder(spark, "rejected").keep(rejected, "keys")
    return without_keys(named, rejected, ["__key"]).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked ones: that with the least id (nulls
    last), then the least text key, then the least of its columns."""
    return jaccard.one_per_group(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the word windows that occur more than once."""
    return substrings.without_repeats(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents with their sequence and place."""
    return packing.piece_digests(packing.pack(docs))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_free", benchmark_free),
    ("packed_sequences", packed_sequences),
]

#: SQL can't express the tokenizer's ids; tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, one after the other, over ``documents``."""
    folder = Folder(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = folder.keep(stage(spark, docs, sf_dir), name)
    return docs
