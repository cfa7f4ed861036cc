"""From raw documents to packed training sequences.

Each stage takes the documents that the one before has kept and, but for the last,
returns documents with the same columns. Stages tell rows apart by their place in the
table they read, not by doc_id: of repeated rows one stays, a row that shares its id with
a dropped one stays, and rows with a null id are judged like others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm._store import numbered, saved, without
from quillon.llm.decontamination import contaminated
from quillon.llm.exact_dedup import exact_duplicates
from quillon.llm.language_id import identify
from quillon.llm.minhash import near_duplicates
from quillon.llm.packing import pack
from quillon.shipping import ship

#: A column that no table of documents has.
ROW = "row_of_stage_"
#: A document goes if its language's probability against the closest other one is less: that of two coin tosses.
LEAST_SCORE = 0.25


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; a null lang is filled with the language predicted.

    Those without text or letters go, and those of which the model cannot tell the
    language (LEAST_SCORE). Where no row has a lang there is nothing to learn from:
    all documents with letters stay, as they are.
    """
    ship(spark)
    if docs.where("lang is not null and text is not null").isEmpty():
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = identify(docs, F.col("lang").isNotNull()).where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE))
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of documents that are equal but for white space."""
    ship(spark)
    rows = numbered(docs, ROW)
    return without(rows, exact_duplicates(rows, row_col=ROW).where("not kept").select(ROW), ROW).drop(ROW)


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each component of documents whose five-word shingles are 0.8 similar or more."""
    ship(spark)
    rows = numbered(docs, ROW)
    return without(rows, near_duplicates(rows, 4, 5, row_col=ROW).where("not kept").select(ROW), ROW).drop(ROW)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not hold half of a benchmark item or more."""
    ship(spark)
    rows = numbered(docs, ROW)
    found = contaminated(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col=ROW)
    return without(rows, found.select(ROW), ROW).drop(ROW)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, packed into sequences of at most 2,048 tokens."""
    ship(spark)
    return pack(docs)


STAGES = [("language ID", language_id), ("exact dedup", exact_dedup), ("MinHash near-dedup", minhash_dedup), ("benchmark decontamination", decontamination), ("best-fit packing", packing)]
#: Language models, components and packing have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = saved(docs, f"stage{k}")
    return docs
