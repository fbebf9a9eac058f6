"""Disk that a job uses on its way: staged tables, shuffle files, and work by waves of regions.

A job that shuffles whole rows several times holds the files of all its shuffles until it ends.
Here the rows are staged by region between two shuffles, which ends the first one's, and
what follows runs for one wave of regions after the other: each wave is an ordinary
distributed job over all rows of its regions, whose shuffle files go with it. All waves together
do what the one job did, for steps that keep rows of different regions apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Spark removes a query's shuffle files at its end; a query that still asks for them works them out again.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SPLIT_BYTES = "spark.sql.files.maxPartitionBytes"

#: Rows that are not worth a wave of their own, and the most waves (each has a job's fixed costs).
WAVE_ROWS = 1 << 20
MOST_WAVES = 8

#: Regions of one wave; None: all of them.
Wave = list[str | None] | None


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def shuffles_end_with_queries(spark: SparkSession):
    """Inside, the shuffle files of a query go with its end, not when the driver collects its garbage."""
    return setting(spark, SHUFFLE_CLEANUP, "true")


def remove(spark: SparkSession, *folders: str) -> None:
    """Delete folders that nothing reads any more."""
    try:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    except Exception:  # noqa: BLE001 - no JVM at hand (Spark Connect): they go with the application's folder
        return
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def region_waves(sizes: dict[str | None, int], least: int | None = None) -> list[Wave]:
    """Regions in waves of about equal size, none of less than ``least`` on average: ``[None]`` when they are small."""
    count = min(MOST_WAVES, sum(sizes.values()) // (least or WAVE_ROWS), len(sizes))
    if count < 2:
        return [None]
    waves: list[tuple[int, list]] = [(0, []) for _ in range(count)]
    for region, size in sorted(sizes.items(), key=lambda x: (-x[1], str(x[0]))):
        k = min(range(count), key=lambda i: waves[i][0])
        waves[k] = (waves[k][0] + size, [*waves[k][1], region])
    return [regions for _, regions in waves if regions]


def in_wave(df: DataFrame, wave: Wave) -> DataFrame:
    """The rows of a wave; over rows staged by region, or read from files of a region, only these are read."""
    if wave is None:
        return df
    here = F.col("region").isin([r for r in wave if r is not None])
    return df.where(here | F.col("region").isNull() if None in wave else here)


def write_by_region(rows: DataFrame, folder: str, waves: list[Wave] | None = None) -> DataFrame:
    """Write rows to a folder a region, wave by wave, and read them back with their columns."""
    spark = rows.sparkSession
    with shuffles_end_with_queries(spark):
        for wave in waves or [None]:
            in_wave(rows, wave).write.mode("append").option("compression", "zstd").partitionBy("region").parquet(folder)
    return spark.read.schema(rows.schema).option("basePath", folder).parquet(folder).select(*rows.columns)
