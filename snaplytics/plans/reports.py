"""The seven dashboard reports.

These follow dataframe-library semantics rather than SQL ones: a NULL group key
is not a group, means skip NULLs, a sum over only NULLs is 0, float outputs are
rounded half-even. Every report is its own plan over the fact scan and reads
only the columns it needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaplytics.functions import expressions as X
from snaplytics.operators.dedup import keep_max_per_key
from snaplytics.operators.joins import complete_domain, join_dimension
from snaplytics.operators.windows import top_n_by_cutoff

TOP_VIEWED_COLUMNS = ["video_id", "title", "channel_title", "category_title", "region", "views", "likes",
                      "dislikes", "comment_count", "engagement_rate", "trending_date", "publish_time"]


def _sum0(c: str):
    return F.coalesce(F.sum(c), F.lit(0).cast("bigint"))


def _mean(c: str, scale: int):
    return X.round_half_even(F.avg(c), scale)


def with_category(fact: DataFrame, dim: DataFrame, broadcast="auto") -> DataFrame:
    """Left join, items with an unknown category keep a NULL title."""
    return join_dimension(fact, dim, how="left", broadcast=broadcast)


def report_top_viewed(fact: DataFrame, dim: DataFrame, k: int = 50, broadcast="auto") -> DataFrame:
    """The ``k`` most viewed distinct items, each at its peak snapshot.

    The output items are exactly the first ``k`` by (peak views desc, id), so the
    peak of every item is found with a fixed-width hash aggregate, the ``k`` ids
    are picked (``TakeOrderedAndProject``), and only their rows go through the
    full-row tie-break. The ids are broadcast: their count is bounded by ``k``.
    """
    peaks = fact.groupBy("video_id").agg(F.max("views").alias("__peak"))
    top_ids = (peaks.orderBy(F.col("__peak").desc_nulls_last(), F.col("video_id").asc_nulls_last())
               .limit(k).select(F.col("video_id").alias("__id")))
    candidates = fact.join(F.broadcast(top_ids), fact["video_id"].eqNullSafe(F.col("__id")), "left_semi")
    rows = with_category(candidates, dim, broadcast).select(*TOP_VIEWED_COLUMNS)
    peak = keep_max_per_key(rows, ["video_id"], by="views")
    return peak.orderBy(F.col("views").desc_nulls_last(), F.col("video_id").asc_nulls_last()).limit(k)


def report_category(fact: DataFrame, dim: DataFrame, broadcast="auto") -> DataFrame:
    """Per-category totals and means (2 dp), unknown categories excluded."""
    rows = with_category(fact.select("category_id", "video_id", "views", "likes", "engagement_rate"),
                         dim, broadcast)
    agg = rows.where(F.col("category_title").isNotNull()).groupBy("category_title").agg(
        F.count_distinct("video_id").alias("total_videos"),
        _sum0("views").alias("total_views"),
        _mean("views", 2).alias("avg_views"),
        _mean("likes", 2).alias("avg_likes"),
        _mean("engagement_rate", 2).alias("avg_engagement"),
        F.count("video_id").alias("total_trending_entries"))
    return agg.orderBy(F.col("total_views").desc(), "category_title")


def report_region(fact: DataFrame) -> DataFrame:
    """Per-region summary (2 dp)."""
    agg = fact.where(F.col("region").isNotNull()).groupBy("region").agg(
        F.count_distinct("video_id").alias("unique_videos"),
        _sum0("views").alias("total_views"),
        _mean("views", 2).alias("avg_views"),
        _mean("engagement_rate", 2).alias("avg_engagement"),
        _mean("likes", 2).alias("avg_likes"),
        _mean("comment_count", 2).alias("avg_comment_count"))
    return agg.orderBy(F.col("total_views").desc(), "region")


def weekday_domain(spark: SparkSession) -> DataFrame:
    """The seven weekdays with their position, as a one-row-source explode."""
    days = F.array(*[F.struct(F.lit(d).alias("trending_day"), F.lit(i).alias("__ord"))
                     for i, d in enumerate(X.WEEKDAYS)])
    return spark.range(1).select(F.inline(days))


def report_weekday(fact: DataFrame) -> DataFrame:
    """All seven weekdays Monday..Sunday, NULL metrics for a missing day."""
    agg = fact.where(F.col("trending_day").isNotNull()).groupBy("trending_day").agg(
        F.count("video_id").alias("trending_count"),
        _mean("views", 2).alias("avg_views"),
        _mean("engagement_rate", 2).alias("avg_engagement"))
    return complete_domain(F.broadcast(weekday_domain(fact.sparkSession)), agg, "trending_day", "__ord")


def report_publish_hour(fact: DataFrame) -> DataFrame:
    """E5: per publish hour, ascending."""
    agg = fact.where(F.col("publish_hour").isNotNull()).groupBy("publish_hour").agg(
        F.count("video_id").alias("video_count"),
        _mean("views", 2).alias("avg_views"),
        _mean("engagement_rate", 2).alias("avg_engagement"))
    return agg.orderBy("publish_hour")


def report_top_channels(fact: DataFrame, k: int = 20) -> DataFrame:
    """Top ``k`` channels by total views (4 dp)."""
    agg = fact.where(F.col("channel_title").isNotNull()).groupBy("channel_title").agg(
        F.count_distinct("video_id").alias("unique_videos"),
        _sum0("views").alias("total_views"),
        _sum0("likes").alias("total_likes"),
        _mean("engagement_rate", 4).alias("avg_engagement"),
        F.count("video_id").alias("trending_appearances"))
    return agg.orderBy(F.col("total_views").desc(), "channel_title").limit(k)


def report_region_sample(fact: DataFrame, dim: DataFrame, n: int = 5000, broadcast="auto") -> DataFrame:
    """At most ``n`` rows per region, most viewed first, all columns + category title.

    The cut is deterministic: views descending, then the whole row as tie-break.
    A histogram of ``views`` gives each region's cutoff first, so only wide rows above it
    are joined and sorted, in two levels that keep the rows reaching one task bounded. A title is
    a function of the category, so it need not be part of the order.
    """
    cols = [*fact.columns, "category_title"]
    order = [F.col("views").desc_nulls_last()] + [F.col(c).asc_nulls_first() for c in fact.columns
                                                  if c not in ("views", "region")]
    return with_category(top_n_by_cutoff(fact, "region", "views", order, n), dim, broadcast).select(*cols)


# The report file names the dashboards read.
REPORT_FILES = {
    "top_viewed": "top_50_most_viewed.csv",
    "category": "category_performance.csv",
    "region": "regional_summary.csv",
    "weekday": "trending_by_day.csv",
    "publish_hour": "publish_hour_analysis.csv",
    "top_channels": "top_20_channels.csv",
    "region_sample": "dashboard_sample.csv",
}


def all_reports(fact: DataFrame, dim: DataFrame) -> dict[str, DataFrame]:
    return {
        "top_viewed": report_top_viewed(fact, dim),
        "category": report_category(fact, dim),
        "region": report_region(fact),
        "weekday": report_weekday(fact),
        "publish_hour": report_publish_hour(fact),
        "top_channels": report_top_channels(fact),
        "region_sample": report_region_sample(fact, dim),
    }
