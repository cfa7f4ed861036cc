"""Records of files as they arrive, each document once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quillon.plans.process import records
from quillon.schema import doc_id
from quillon.sources.documents import exclusion, extract


def arriving(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """(path, content, doc_id) of documents that appear below a folder."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    raw = spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", files_per_batch).load(folder)
    return raw.where(exclusion(F.col("path")).isNull()).select("path", "content", doc_id(F.col("content")).alias("doc_id"))


def run(spark: SparkSession, folder: str, output: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append records of new documents to ``output``; the checkpoint remembers which files were seen.

    A batch that is run again after a failure overwrites its own folder, so it leaves
    no second copy; documents of earlier batches are dropped by an anti join.
    """

    def write(batch: DataFrame, number: int) -> None:
        fresh = batch.dropDuplicates(["doc_id"])
        try:
            done = batch.sparkSession.read.parquet(output).where(F.col("batch") < number).select("doc_id")
            fresh = fresh.join(done, "doc_id", "left_anti")
        except Exception as e:  # nothing has been written yet
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
        records(extract(fresh)).write.mode("overwrite").parquet(f"{output}/batch={number}")

    writer = arriving(spark, folder).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
