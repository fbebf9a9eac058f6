"""Writers for raw regional inputs (CSV per region, category JSON per region).

They produce the layout the transform job reads, from any DataFrame: used to
stage inputs derived from the generated tables and in tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PARTITION_TEMPLATE = "region={region}"
COMPRESSED_ROWS = 500_000


def write_regional_csv(raw: DataFrame, out_dir: str, latin1_regions: list[str] | None = None,
                       rename: dict[str, str] | None = None, latin1_order: list[str] | None = None,
                       compression: str | None = None, append: bool = False) -> str:
    """Write ``raw`` (with a ``region`` column) as one CSV directory per region.

    Quotes are escaped by doubling (RFC 4180). Rows of ``latin1_regions`` are
    written ISO-8859-1 encoded, optionally with another column order, so a
    reader must decide encoding per file and map columns by name. ``append`` adds to the
    files that are there. Compressed files can't be split, so they hold ``COMPRESSED_ROWS``
    rows at most. Returns the path template to read them back with.
    """
    latin1_regions = latin1_regions or []
    rename = rename or {}

    def shaped(df, order=None):
        cols = order or [c for c in df.columns if c != "region"]
        return df.select(*[F.col(c).alias(rename.get(c, c)) for c in cols], "region")

    writer = dict(header=True, escape='"', quoteAll=False)
    if compression:
        writer |= dict(compression=compression, maxRecordsPerFile=COMPRESSED_ROWS)
    utf8 = raw.where(~F.col("region").isin(latin1_regions)) if latin1_regions else raw
    (shaped(utf8).write.mode("append" if append else "overwrite").partitionBy("region").options(**writer).csv(out_dir))
    if latin1_regions:
        (shaped(raw.where(F.col("region").isin(latin1_regions)), latin1_order)
         .write.mode("append").partitionBy("region").options(**writer)
         .option("encoding", "ISO-8859-1").csv(out_dir))
    return PARTITION_TEMPLATE


def write_regional_lines(lines: DataFrame, out_dir: str, header: str) -> str:
    """Write (line, region) rows as they are, below a header line, one directory per region:
    for raw files that a CSV writer would not make."""
    (lines.select(F.col("line").alias(header), "region").write.mode("overwrite").partitionBy("region")
     .options(header=True, sep="\u0001", quote="\u0000").csv(out_dir))
    return PARTITION_TEMPLATE


def write_category_json(items: DataFrame, out_dir: str) -> str:
    """Write ``(region, pos, category_id, category_title)`` rows as one
    ``{"items": [{"id", "snippet": {"title"}}]}`` document per region.

    A document holds one region's category list, which is dimension-sized.
    """
    docs = (items.groupBy("region").agg(
        F.sort_array(F.collect_list(F.struct(
            F.col("pos"),
            F.col("category_id").cast("string").alias("id"),
            F.struct(F.col("category_title").alias("title")).alias("snippet")))).alias("entries"))
        .select("region", F.transform("entries", lambda e: F.struct(e["id"].alias("id"),
                                                                    e["snippet"].alias("snippet")))
                .alias("items")))
    docs.write.mode("overwrite").partitionBy("region").json(out_dir)
    return PARTITION_TEMPLATE
