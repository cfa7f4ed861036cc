"""Make this package importable on executors that do not have it installed, and bound what passes to their Python workers at a time."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()
#: Bytes of rows that a JVM and its Python worker exchange at a time. Both hold them outside the heap, some times over.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_BATCH = "4m"


def ship(spark: SparkSession) -> SparkSession:
    """Send the package's sources to the executors, once for each application; batches get a size unless the session has one."""
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, _BATCH)
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = Path(__file__).resolve().parent
        target = os.path.join(tempfile.mkdtemp(prefix="quillon-"), "quillon.zip")
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
            for p in sorted(root.rglob("*")):
                if p.suffix in (".py", ".yaml"):
                    z.write(p, Path("quillon") / p.relative_to(root))
        spark.sparkContext.addPyFile(target)
        _shipped.add(app)
    return spark
