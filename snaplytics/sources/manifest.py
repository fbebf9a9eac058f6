"""Input manifest (S7, S8, S10): the configured regions against the files that exist.

The configured (region, kind) pairs are a table; so are the files below the raw folder, listed
by Spark without reading them. A left join shows every configured input with its files
and bytes, missing ones included, and gates ask this table instead of guessing from a reader's
error. A raw folder that does not exist still raises.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaplytics.functions import expressions as X

KINDS = ("csv", "json")


def template_pattern(template: str) -> str:
    """A regular expression for a path below the raw folder whose group 1 is the region."""
    prefix, suffix = template.split("{region}")
    return "/" + re.escape(prefix) + "([^/]+?)" + re.escape(suffix) + "(?:/|$)"


def listed_files(spark: SparkSession, raw_dir: str) -> DataFrame:
    """(path, bytes) of every file below a folder; contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(raw_dir.rstrip("/")) \
        .select("path", F.col("length").alias("bytes"))


def input_manifest(spark: SparkSession, raw_dir: str, regions: list[str] | None = None,
                   csv_template: str = X.CSV_NAME_TEMPLATE, json_template: str = X.JSON_NAME_TEMPLATE,
                   category_regions: list[str] | None = None) -> DataFrame:
    """region, kind, ord, files, bytes: one row per configured region and kind of input."""
    regions = regions or X.DEFAULT_REGIONS
    wanted = [(r, "csv", i) for i, r in enumerate(regions)]
    wanted += [(r, "json", i) for i, r in enumerate(category_regions or regions)]
    configured = spark.createDataFrame(wanted, "region string, kind string, ord int")
    files = listed_files(spark, raw_dir)
    found = None
    for kind, template in zip(KINDS, (csv_template, json_template)):
        region = F.regexp_extract("path", template_pattern(template), 1)
        part = files.select(region.alias("region"), F.lit(kind).alias("kind"), "bytes").where("region <> ''")
        found = part if found is None else found.unionByName(part)
    sizes = found.groupBy("region", "kind").agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))
    return configured.join(sizes, ["region", "kind"], "left").fillna(0, ["files", "bytes"]) \
        .select("region", "kind", "ord", "files", "bytes")


def present(manifest: DataFrame, kind: str) -> list[str]:
    """The configured regions that have input of a kind, in configured order."""
    rows = manifest.where((F.col("kind") == kind) & (F.col("files") > 0)).orderBy("ord").select("region").collect()
    return [r[0] for r in rows]  # at most one row a configured region


def missing(manifest: DataFrame, kind: str) -> list[str]:
    """The configured regions without input of a kind."""
    rows = manifest.where((F.col("kind") == kind) & (F.col("files") == 0)).orderBy("ord").select("region").collect()
    return [r[0] for r in rows]
