"""Readers and writers: strict wide CSV files, crosstab reports, clustered Parquet."""
