"""Category JSON scan (S4, S9, F3, F4, F5) feeding the dimension build.

One pretty-printed document per region: ``{"items": [{"id": "10", "snippet":
{"title": "Music"}}, ...]}``. Read with a fixed schema in PERMISSIVE mode: a
broken file yields a row of NULLs, hence no items; an entry whose id is not
an integer, or without a title, is dropped (the rest of that file is kept), so
it can't replace a good title of another region.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaplytics.functions import expressions as X
from snaplytics.schemas import CATEGORY_JSON_SCHEMA
from snaplytics.sources.manifest import input_manifest, present
from snaplytics.sources.regional_csv import region_glob


def read_category_items(spark: SparkSession, raw_dir: str, regions: list[str] | None = None,
                        template: str = X.JSON_NAME_TEMPLATE) -> DataFrame | None:
    """(region, region_ord, pos, category_id, category_title) for every parsable entry; None when no
    configured region has a document."""
    regions = regions or X.DEFAULT_REGIONS
    here = present(input_manifest(spark, raw_dir, regions, json_template=template), "json")
    if not here:
        return None
    docs = (spark.read.schema(CATEGORY_JSON_SCHEMA).option("multiLine", True)
            .option("mode", "PERMISSIVE").json(region_glob(raw_dir, here, template)))
    region = X.region_from_path(F.col("_metadata.file_path"), template)
    order = F.array_position(F.array(*[F.lit(r) for r in regions]), region)
    items = docs.select(region.alias("region"), order.alias("region_ord"),
                        F.posexplode_outer("items").alias("pos", "item"))
    return (items.where(F.col("item").isNotNull())
            .select("region", "region_ord", "pos",
                    F.col("item.id").try_cast("int").alias("category_id"),
                    F.col("item.snippet.title").alias("category_title"))
            .where(F.col("category_id").isNotNull() & F.col("category_title").isNotNull()))
