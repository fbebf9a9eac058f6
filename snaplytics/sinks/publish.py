"""Full refresh of several tables as one publish.

Every table is written to a folder of a new version first, through a table declared by its
DDL, so ``VARCHAR(n)`` and NOT NULL hold for the rows. Only when all writes have
succeeded do the tables' locations move, one metadata statement a table and no data
in between; if a statement fails, those before it are taken back. A failure at any point
leaves the pair that was there (what was written of a version whose writes fail is deleted), and a version is never written twice, so no submitted
overwrite mode can mix old and new partitions.

Partitioned tables are declared without partitions in the catalog: these are found from the
folders of the version (one listing, cached by the session, pruned by region), so that
moving the location moves all of them at once. If the driver itself dies between two
statements, the tables before it already have the new version; the next load sets both.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaplytics.sinks.staging import remove, shuffles_end_with_queries

TRACKING = "spark.sql.hive.manageFilesourcePartitions"


@dataclass
class Refresh:
    """A table, its new rows (in parts that are written one after the other), and its DDL as a function of
    (name, location)."""
    table: str
    rows: list[DataFrame]
    ddl: Callable[[str, str], str]
    not_null: list[str]


def declare(spark: SparkSession, ddl: str) -> None:
    """Run a CREATE TABLE without partitions in the catalog."""
    before = spark.conf.get(TRACKING)
    spark.conf.set(TRACKING, "false")
    try:
        spark.sql(ddl)
    finally:
        spark.conf.set(TRACKING, before)


def location_of(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def refuse_nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    """The same rows; a NULL in one of the columns fails the job that meets it."""
    return df.withColumns({c: F.when(F.col(c).isNull(), F.raise_error(F.lit(f"NULL in {c}")).cast(df.schema[c].dataType))
                           .otherwise(F.col(c)) for c in columns})


def write_version(refresh: Refresh, folder: str) -> None:
    spark = refresh.rows[0].sparkSession
    staging = f"{refresh.table}__{uuid.uuid4().hex[:8]}"
    declare(spark, refresh.ddl(staging, folder))
    try:
        columns = spark.table(staging).columns
        for rows in refresh.rows:
            with shuffles_end_with_queries(spark):
                refuse_nulls(rows.select(*columns), refresh.not_null).write.insertInto(staging)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {staging}")  # external: the files stay


def publish(spark: SparkSession, refreshes: list[Refresh], root: str) -> str:
    """Write all tables' new versions below ``root``, then move all locations. Returns the version."""
    version = f"v-{uuid.uuid4().hex[:12]}"
    folders = {r.table: f"{root.rstrip('/')}/{r.table}/{version}" for r in refreshes}
    try:
        for r in refreshes:
            write_version(r, folders[r.table])
    except Exception:
        remove(spark, *folders.values())  # no table was moved there
        raise
    moved: list[tuple[str, str | None]] = []
    try:
        for r in refreshes:
            old = location_of(spark, r.table) if spark.catalog.tableExists(r.table) else None
            if old is None:
                declare(spark, r.ddl(r.table, folders[r.table]))
            else:
                set_location(spark, r.table, folders[r.table])
            moved.append((r.table, old))
    except Exception:
        for table, old in reversed(moved):
            if old is None:
                spark.sql(f"DROP TABLE IF EXISTS {table}")
            else:
                set_location(spark, table, old)
        raise
    return version


def set_location(spark: SparkSession, table: str, folder: str) -> None:
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(table)
