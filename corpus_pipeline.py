"""The corpus pipeline over ``documents``: stages, their run, and comparison SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duosync.llm.common import Scratch, table
from duosync.llm.fm_index import clean
from duosync.llm.language import learn, with_language
from duosync.llm.minhash import near_duplicates
from duosync.llm.pack import pack
from duosync.llm.queries import tokenizer_file


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told; ``lang`` becomes that language."""
    model = learn(docs.withColumnRenamed("lang", "label"))
    found = with_language(docs, model, Scratch(spark)).filter("language IS NOT NULL")
    columns = [
        F.col("language").alias(c) if c == "lang" else F.col("_doc").getField(c).alias(c)
        for c in docs.columns
    ]
    return found.select(columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: the one with the smallest id, null ids last.

    Every row is a document of its own, whatever its id: copies with null or shared ids are found
    like others, and unlike texts with one id all stay, as does every row without words. What the
    search has written goes before the documents kept are read.
    """
    scratch, search, row = Scratch(spark), Scratch(spark), "_row"
    while row in docs.columns:
        row += "_"
    keyed = scratch(docs.withColumn(row, F.monotonically_increasing_id()))
    found = near_duplicates(keyed.select(F.col(row).alias("doc_id"), "text"), search)
    first = scratch(
        found.select(F.col("doc_id").alias(row), "component_id")
        .join(keyed.select(row, "doc_id"), row)
        .groupBy("component_id")
        .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", row)).getField(row).alias(row))
        .select(row)
    )
    search.release()
    return keyed.join(first, row, "left_semi").select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return clean(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents' pieces in sequences of 2048 tokens."""
    return pack(docs, Scratch(spark), tokenizer_file())


STAGES = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

# SQL cannot express the trigram model nor the tokenizer's vocabulary.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; each result is written and read by the next."""
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = scratch(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
