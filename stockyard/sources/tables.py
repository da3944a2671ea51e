"""Parquet table access for the driver-supplied inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

def table_path(base_dir: str, name: str) -> str:
    return f"{base_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, base_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Read one input table; selecting columns here lets the scan prune them."""
    df = spark.read.parquet(table_path(base_dir, name))
    return df.select(*columns) if columns else df
