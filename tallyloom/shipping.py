"""Make a session ready for this package's Python stages."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


BATCH_ROWS = 2000


def ship(spark: SparkSession) -> None:
    """Add the package as a zip of its sources, once per context, for workers that do not have it on
    their path; and keep Arrow batches small, since a row is a whole text."""
    sc = spark.sparkContext
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    if getattr(sc, "_tallyloom_shipped", False):
        return
    root, data = Path(__file__).parent, io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, str(p.relative_to(root.parent)))
    fd, path = tempfile.mkstemp(prefix="tallyloom-", suffix=".zip")
    with os.fdopen(fd, "wb") as f:
        f.write(data.getvalue())
    sc.addPyFile(path)
    sc._tallyloom_shipped = True
