"""Tables and files in the folder that every executor shares.

Intermediate results that are read more than once, or that cut a long lineage,
are written as Parquet below ``spark.checkpoint.dir``. A lost executor then costs
only the tasks it was running.
"""

from __future__ import annotations

import os
import tempfile
import uuid

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
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
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if "[" in context.master and context.master.startswith("local-cluster"):
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


#: Up to so many ids (8 bytes each) are sent to every executor; more are joined by a shuffle.
BROADCAST_IDS = 2_000_000
#: Rows of one file that row numbers leave room for.
_FILE_ROWS = 1 << 40


def numbered(docs: DataFrame, row_col: str) -> DataFrame:
    """``docs`` with a long in ``row_col`` that differs by row and is the same at every read.

    Rows of files are numbered by file and place in it; the list of files, which Spark
    plans with in the driver anyway, is sent out. Other frames are written once first.
    """
    spark = docs.sparkSession
    try:
        placed = docs.select("*", F.col("_metadata.file_path").alias("file_"), F.col("_metadata.row_index").alias("index_"))
        files = [r[0] for r in placed.select("file_").distinct().collect()]
    except AnalysisException:
        return saved(docs.withColumn(row_col, F.monotonically_increasing_id()), "numbered")
    # As Arrow: a list of rows would be read by Python workers of a second kind, which executors then keep.
    names = spark.createDataFrame(pa.table({"no_": pa.array(range(len(files)), pa.int64()), "file_": pa.array(sorted(files), pa.string())}), "no_ long, file_ string")
    out = placed.join(F.broadcast(names), "file_", "left")
    return out.select(*docs.columns, (F.col("no_") * F.lit(_FILE_ROWS) + F.col("index_")).alias(row_col))


def without(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose id is not in ``ids`` (one column); rows with a null id stay."""
    ids = saved(ids.select(ids.columns[0]).toDF(id_col).distinct(), "dropped")
    return docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, id_col, "left_anti")
