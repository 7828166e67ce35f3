"""Parquet tables of one data folder, read lazily so that filters and columns reach the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table ``name`` of ``folder``; a file and a directory of parts are read alike."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
