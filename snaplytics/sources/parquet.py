"""Parquet fact / dimension scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaplytics.schemas import FACT_COLUMNS


def read_fact(spark: SparkSession, path: str, regions: list[str] | None = None) -> DataFrame:
    """The region-partitioned fact; a region filter prunes whole partitions.

    Partition values are read as strings (type inference is off in the session
    defaults) and ``region`` is put back among the 20 fact columns in order.
    """
    df = spark.read.option("basePath", path).parquet(path)
    if regions:
        df = df.where(F.col("region").isin(regions))
    return df.select(*FACT_COLUMNS)


def read_dimension(spark: SparkSession, path: str) -> DataFrame:
    """The single-file category dimension."""
    return spark.read.parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table or view."""
    return spark.table(name)
