"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm import exact_dedup, licenses, pii, ppm, toxicity, warc
from quillon.llm._store import fresh_path
from quillon.llm.decontamination import contaminated
from quillon.llm.exact_dedup import exact_duplicates
from quillon.llm.language_id import identify
from quillon.llm.minhash import near_duplicates
from quillon.llm.packing import pack


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(divisor: int, id_col: str = "doc_id") -> Column:
    """crc32 of the id as text modulo ``divisor``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % divisor


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score(table(spark, sf_dir, "documents"), remainder(5) == 1)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), toxicity.default_categories(), "toxic")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"), digest_all=True)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write(table(spark, sf_dir, "pages"), fresh_path(spark, "warc"))
    return warc.resolved(warc.read(archives))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.personal_data(table(spark, sf_dir, "documents")))


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), 85, 100)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = remainder(4) == 2
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out)
    found = identify(docs, ~F.col("held_out"), ["doc_id", "held_out"])
    return found.select("doc_id", "held_out", "lang_pred", "score", "family_pred")


QUERIES = {f.__name__: f for f in (op1_lm_score, op2_toxicity, op3_exact_dedup, op4_warc, op5_packing, op6_decontamination, op7_licenses, op8_pii, op9_minhash, op10_language_id)}
ORACLE_SQL = {"op3_exact_dedup": exact_dedup.SQL, "op4_warc": warc.SQL, "op7_licenses": licenses.sql()}
