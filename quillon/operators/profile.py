"""Statistics of a corpus in single passes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.store import ranged


def counts(records: DataFrame, columns: list[str]) -> DataFrame:
    """(what, value, n): how often each value of several columns occurs, in one aggregation."""
    rows = records.select(F.explode(F.array(*[F.struct(F.lit(c).alias("what"), F.col(c).cast("string").alias("value")) for c in columns])).alias("x"))
    return rows.groupBy("x.what", "x.value").agg(F.count(F.lit(1)).alias("n"))


def distribution(rows: DataFrame, value: str) -> DataFrame:
    """(n, min, p50, p90, max, mean): the value at place n div 2, and at int(0.9 n), of the sorted ones.

    Values are counted first, so only distinct ones are ranked; running counts go over
    ranges of them, of which each task sorts one.
    """
    from pyspark.sql import Window as W

    spark = rows.sparkSession
    bins = ranged(rows.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("c")), F.col("v"))
    sizes = sorted((r["range"], r["n"]) for r in bins.groupBy("range").agg(F.sum("c").alias("n")).collect())
    offsets, total = [], 0
    for k, n in sizes:
        offsets.append((k, total))
        total += n
    if not total:
        return spark.createDataFrame([], "n long, min double, p50 double, p90 double, max double, mean double")
    base = F.broadcast(spark.createDataFrame(offsets, "range int, before long"))  # a row per partition
    upto = W.partitionBy("range").orderBy("v").rowsBetween(W.unboundedPreceding, 0)
    run = bins.withColumn("run", F.sum("c").over(upto)).join(base, "range").withColumn("last", F.col("run") + F.col("before"))
    at = lambda k: F.min(F.when(F.col("last") > k, F.col("v"))).cast("double")
    return run.agg(F.sum("c").alias("n"), F.min("v").cast("double").alias("min"), at(total // 2).alias("p50"), at(min(total - 1, int(0.9 * total))).alias("p90"), F.max("v").cast("double").alias("max"), (F.sum(F.col("v").cast("double") * F.col("c")) / F.sum("c")).alias("mean"))


def field_hits(records: DataFrame) -> DataFrame:
    """(field, documents, validated): documents that have a field, and that have it proven."""
    each = records.select("doc_id", F.explode_outer("metadata").alias("m")).where("m is not null")
    return each.groupBy(F.col("m.field").alias("field")).agg(F.countDistinct("doc_id").alias("documents"), F.countDistinct(F.when(F.col("m.validated"), F.col("doc_id"))).alias("validated"))


def routes(pages: DataFrame) -> DataFrame:
    """(method, pages, mean_confidence) from (doc_id, method, confidence)."""
    return pages.groupBy("method").agg(F.count(F.lit(1)).alias("pages"), F.round(F.avg("confidence"), 4).alias("mean_confidence"))


def hybrid_delta(pages: DataFrame) -> DataFrame:
    """(doc_id, delta): native less OCR confidence of documents with pages of both; rescued pages count for neither."""
    native, ocr = (F.avg(F.when(F.col("method") == m, F.col("confidence"))) for m in ("native", "ocr"))
    return pages.groupBy("doc_id").agg(F.round(native - ocr, 4).alias("delta")).where("delta is not null")


def low_confidence(documents: DataFrame, below: float = 0.6) -> DataFrame:
    """(documents, low, share) from (confidence)."""
    n, low = F.count(F.lit(1)), F.count_if(F.col("confidence") < below)
    return documents.agg(n.alias("documents"), low.alias("low"), F.round(F.coalesce(low / F.nullif(n, F.lit(0)), F.lit(0.0)), 4).alias("share"))
