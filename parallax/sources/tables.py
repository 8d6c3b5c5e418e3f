"""Tables of a folder of parquet files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table by name; columns and rows are pruned by what is done with it."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
