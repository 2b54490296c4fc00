"""Writers: idempotent replacement, clustering for pruning, appends with provenance."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

#: Rows from which a table should be partitioned by a column rather than only clustered.
PARTITION_FROM = 10_000_000


def clustered(df: DataFrame, by: Sequence[str], files: int | None = None) -> DataFrame:
    """Rows ranged and sorted by the columns, so that row groups have narrow bounds and scans skip them."""
    ranged = df.repartitionByRange(files, *by) if files else df.repartitionByRange(*by)
    return ranged.sortWithinPartitions(*by)


def replace(df: DataFrame, path: str, by: Sequence[str] = (), files: int | None = None) -> None:
    """Write df to path in place of what was there; running it again gives the same table."""
    (clustered(df, by, files) if by else df).write.mode("overwrite").parquet(path)


def replace_table(df: DataFrame, name: str, by: Sequence[str] = ()) -> None:
    """The same for a table of the catalog; its database is made if need be."""
    if "." in name:
        df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {name.split('.')[0]}")
    (clustered(df, by) if by else df).write.mode("overwrite").format("parquet").saveAsTable(name)


def append(df: DataFrame, path: str, provenance: Mapping[str, str]) -> None:
    """Add rows with literal provenance columns."""
    df.withColumns({k: F.lit(v) for k, v in provenance.items()}).write.mode("append").parquet(path)
