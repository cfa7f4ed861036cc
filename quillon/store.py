"""Tables in the folder that every executor shares.

Intermediate results that two passes must see alike, or that cut a long lineage, are
written as Parquet below ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The shared folder: ``spark.checkpoint.dir``, else the context's checkpoint folder.

    Only a local master may run without either; it then gets a temporary folder.
    """
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    context = spark.sparkContext
    known = context._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get().rstrip("/")
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    base = os.path.join(tempfile.gettempdir(), "checkpoints")
    os.makedirs(base, exist_ok=True)
    context.setCheckpointDir("file://" + base)
    return context._jsc.sc().getCheckpointDir().get().rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used yet."""
    return f"{shared_dir(spark)}/quillon/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return a reader of what was written."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ranged(rows: DataFrame, *order: Column) -> DataFrame:
    """``rows`` with the number of their range in ``order`` as ``range``, a written table.

    Spark samples the bounds of ranges anew in every job; written once, each later pass
    sees the same ranges.
    """
    return saved(rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "ranges")


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """``rows`` in some parts for each core: a small file of a single row group is else read, and all made of it, by one."""
    return rows.repartition(4 * rows.sparkSession.sparkContext.defaultParallelism, *keys)


def exists(spark: SparkSession, path: str) -> bool:
    """If a store that Spark reads has this file or folder."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)
