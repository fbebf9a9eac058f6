"""Sinks: Parquet fact / dimension, catalog tables, JDBC, CSV reports (K1-K7)."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snaplytics.schemas import DIM_MAX_LENGTHS, FACT_SCHEMA, MAX_LENGTHS, NOT_NULL_DIM, NOT_NULL_FACT
from snaplytics.sinks.publish import Refresh, declare, publish
from snaplytics.sinks.staging import Wave, in_wave, shuffles_end_with_queries


def write_dimension(dim: DataFrame, path: str) -> None:
    """K1: the dimension as one Parquet file (one row per category: small by nature)."""
    dim.coalesce(1).write.mode("overwrite").parquet(path)


#: Bits of each column in the interleaved sort key; the key has one bit of each in turn.
LAYOUT_BITS = 12
#: Rows whose item a row group may hold; Bloom filters on the item are sized to it.
ITEMS_A_ROW_GROUP = 1_000_000


def leading_bits(c: Column) -> Column:
    """A whole number on a scale of 2^LAYOUT_BITS steps, monotone and relative to its size:
    the position of its top bit, then the bits below it (NULL and negative: 0)."""
    v = F.greatest(F.coalesce(c.cast("long"), F.lit(0)), F.lit(0)) + 1
    top = F.floor(F.log2(v)).cast("int")
    below = LAYOUT_BITS - 6
    scaled = F.when(top > below, F.call_function("shiftright", v, top - below)).otherwise(F.call_function("shiftleft", v, below - top))
    return top.cast("long") * (1 << below) + F.greatest(scaled - (1 << below), F.lit(0)).cast("long")


def layout_parts() -> list[Column]:
    """Date, category and views, each on a scale of 2^LAYOUT_BITS steps."""
    days = F.coalesce(F.datediff("trending_date", F.lit("1970-01-01").cast("date")), F.lit(0))
    day = F.pmod(days, F.lit(1 << LAYOUT_BITS)).cast("long")  # days 4,096 apart share a step: neighbours stay neighbours
    category = F.pmod(F.coalesce("category_id", F.lit(0)), F.lit(64)).cast("long") * (1 << (LAYOUT_BITS - 6))  # ids are few
    return [day, category, leading_bits(F.col("views"))]


def interleaved_key(parts: list[Column]) -> Column:
    """K7: one sort key over date, category and views (Z-order), so that row groups are
    narrow in all three and range predicates on any of them skip most.

    The bits of each half of a part are set apart by a table of 2^(LAYOUT_BITS / 2) numbers:
    the binary digits of the place, read as octal ones when there are three parts."""
    half = LAYOUT_BITS // 2
    apart = [sum((i >> b & 1) << (len(parts) * b) for b in range(half)) for i in range(1 << half)]
    spread = F.split(F.lit(",".join(map(str, apart))), ",").cast("array<bigint>")
    at = lambda p: F.get(spread, p.bitwiseAND(F.lit((1 << half) - 1)).cast("int"))
    key = F.lit(0).cast("long")
    for k, p in enumerate(parts):
        key = key + F.shiftleft(at(p) + F.shiftleft(at(F.shiftright(p, half)), len(parts) * half), k)
    return key


def layout_fact(fact: DataFrame, files_per_region: int | None = None) -> DataFrame:
    """K2 / K7 layout.

    Rows are rebalanced by region: AQE splits a region that holds most of the rows and
    merges small ones by their bytes, so the number of files follows the data and not
    tasks x regions. Within the task rows are sorted by region and an interleaved key, which
    gives row groups tight min/max statistics for date, category and views.
    ``files_per_region`` (for small outputs) instead hashes items into that many files
    per region. The key is a column while rows are sorted: a sort works out an expression
    in its order anew in every comparison.
    """
    if files_per_region:
        bucket = F.pmod(F.xxhash64("video_id"), F.lit(files_per_region))
        fact = fact.repartition(F.col("region"), bucket)
    else:
        fact = fact.hint("rebalance", F.col("region"))
    keyed = fact.withColumn("__layout", interleaved_key(layout_parts()))
    return keyed.sortWithinPartitions("region", "__layout").drop("__layout")


def write_fact(fact: DataFrame, path: str, files_per_region: int | None = None, waves: list[Wave] | None = None,
               derive: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> None:
    """K2: Parquet partitioned by region; static overwrite removes stale regions. With ``waves``, regions are
    laid out and written wave by wave. ``derive`` adds columns to rows that are laid out, so that
    these don't go through the shuffle."""
    write_waves((derive(layout_fact(in_wave(fact, wave), files_per_region)) for wave in waves or [None]), len(waves or [None]), path)


def write_waves(parts: Iterable[DataFrame], count: int, path: str) -> None:
    """K2 for rows that are already laid out, in ``count`` parts of different regions. Only the last part
    leaves the mark of success, so that a fact that broke off between two is told from a whole one."""
    for k, part in enumerate(parts):
        with shuffles_end_with_queries(part.sparkSession):
            (part.write.mode("append" if k else "overwrite").option("partitionOverwriteMode", "static")
             .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", str(k == count - 1).lower())
             .option("parquet.bloom.filter.enabled#video_id", "true")
             .option("parquet.bloom.filter.expected.ndv#video_id", str(ITEMS_A_ROW_GROUP))
             .partitionBy("region").parquet(path))


def column_type(name: str, kind: str, limits: dict[str, int]) -> str:
    return f"VARCHAR({limits[name]})" if name in limits else kind


def fact_ddl(table: str, location: str | None = None, if_not_exists: bool = True) -> str:
    """K6: ``CREATE TABLE`` for the fact with its declared lengths, partitioned by region."""
    cols = ", ".join(f"{f.name} {column_type(f.name, f.dataType.simpleString(), MAX_LENGTHS)}"
                     + (" NOT NULL" if f.name in NOT_NULL_FACT else "") for f in FACT_SCHEMA.fields)
    loc = f" LOCATION '{location}'" if location else ""
    return f"CREATE TABLE {'IF NOT EXISTS ' * if_not_exists}{table} ({cols}) USING parquet PARTITIONED BY (region){loc}"


def dim_ddl(table: str, location: str | None = None, if_not_exists: bool = True) -> str:
    loc = f" LOCATION '{location}'" if location else ""
    title = column_type("category_title", "string", DIM_MAX_LENGTHS)
    return (f"CREATE TABLE {'IF NOT EXISTS ' * if_not_exists}{table} (category_id int NOT NULL, "
            f"category_title {title} NOT NULL) USING parquet{loc}")


def refresh_table(df: DataFrame, table: str, ddl: str) -> DataFrame:
    """K3 / K4: full refresh of one declared catalog table: created from its DDL when it
    isn't there, its rows replaced in one committed overwrite. Partitions that the new
    rows lack go, whatever overwrite mode was submitted. (``publish`` refreshes several
    tables as one.)"""
    spark = df.sparkSession
    spark.sql(ddl)
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        df.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    spark.catalog.refreshTable(table)
    return spark.table(table)


def register_table(spark: SparkSession, table: str, ddl: str) -> DataFrame:
    """K3 / K4 without a copy: declare an external table by its DDL (names, lengths, NOT NULL)
    over files that are already written and checked; region filters prune its folders.
    A table of that name is only redeclared: dropping an external table keeps its files."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    declare(spark, ddl)
    return spark.table(table)


def write_jdbc(df: DataFrame, url: str, table: str, batchsize: int, properties: dict | None = None,
               num_partitions: int = 8, truncate: bool = True) -> None:
    """K3 / K4 against an external database: batched inserts, bounded connections.

    Dimension first (batchsize 1000), fact second (batchsize 5000), after the
    constraint checks, so the database's foreign key never sees an orphan.
    """
    (df.coalesce(num_partitions).write.mode("overwrite").format("jdbc")
       .option("url", url).option("dbtable", table).option("batchsize", batchsize)
       .option("truncate", truncate).options(**(properties or {})).save())


def refresh_pair(fact: DataFrame, dim: DataFrame, fact_table: str, dim_table: str, root: str, waves: list[Wave] | None = None) -> str:
    """K3 + K4: both tables refreshed as one publish, the dimension first. With ``waves``, the fact's
    regions are laid out and written wave by wave."""
    return publish(fact.sparkSession, [
        Refresh(dim_table, [dim.coalesce(1)], dim_ddl, NOT_NULL_DIM),
        Refresh(fact_table, [layout_fact(in_wave(fact, wave)) for wave in waves or [None]], fact_ddl, NOT_NULL_FACT)], root)


def write_report_csv(report: DataFrame, path: str, ordered: bool = True) -> None:
    """K5: one headered CSV file at ``path``. The part is committed in a folder beside it and then
    renamed, so readers see the old file or the whole new one. An ordered report is a few
    rows after its sort. One that is not (the region sample) gets a shuffle before the
    writing task, so that its own work stays parallel."""
    spark = report.sparkSession
    one = report.coalesce(1) if ordered else report.repartition(1)
    folder = f"{path}.{uuid.uuid4().hex[:8]}"
    one.write.option("header", True).option("escape", '"').csv(folder)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    target, parts = hadoop.Path(path), hadoop.Path(f"{folder}/part-*")
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(target, True)
    if not fs.rename(fs.globStatus(parts)[0].getPath(), target):
        raise OSError(f"{folder}: its part can't be renamed to {path}")
    fs.delete(hadoop.Path(folder), True)
