"""Append newly arrived wide files to the raw table."""

from __future__ import annotations

from pyspark.sql import SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyloom.sources import wide_csv


def follow(spark: SparkSession, folder: str, n: int, out: str, checkpoint: str) -> StreamingQuery:
    """Read the folder's files that the checkpoint has not seen, append them to `out`, then stop."""
    rows = spark.readStream.schema(wide_csv.schema(n)).options(header=True, multiLine=True, escape='"', mode="FAILFAST", enforceSchema=False).csv(folder)
    rows = rows.select("*", wide_csv.source_file().alias("_source_file"), F.current_timestamp().alias("_loaded_at"))
    return rows.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
