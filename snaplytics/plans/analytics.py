"""The five analytics queries (R1-R5) and the sample query.

Each takes the snapshot fact (and the category dimension where it joins) and
returns a lazy DataFrame. The fact is a periodic snapshot: an item recurs per
day and region with cumulative counters, so sums count an item once per
appearance, exactly as the queries are defined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaplytics.functions import expressions as X
from snaplytics.operators.joins import join_dimension
from snaplytics.operators.windows import rank_within, top_n_per_group


def top_categories_per_region(fact: DataFrame, dim: DataFrame, k: int = 3, broadcast="auto") -> DataFrame:
    """Top ``k`` categories per region by total views (RANK: ties share a rank)."""
    per_cat = (join_dimension(fact.select("region", "category_id", "video_id", "views"), dim,
                              how="inner", broadcast=broadcast)
               .groupBy("region", "category_title")
               .agg(F.sum("views").alias("total_views"),
                    F.count_distinct("video_id").alias("unique_videos_count")))
    ranked = rank_within(per_cat, ["region"], [F.col("total_views").desc_nulls_last()], "category_rank")
    return (ranked.where(F.col("category_rank") <= k)
            .select("region", "category_rank", "category_title", "total_views", "unique_videos_count")
            .orderBy("region", "category_rank", "category_title"))


def top_channels_by_max_likes(fact: DataFrame, k: int = 10) -> DataFrame:
    """R2: channels by the sum over their items of each item's peak likes."""
    per_item = fact.groupBy("channel_title", "video_id").agg(F.max("likes").alias("max_likes"))
    per_channel = per_item.groupBy("channel_title").agg(
        F.sum("max_likes").alias("total_accumulated_likes"),
        F.count("video_id").alias("number_of_trending_videos"))
    return per_channel.orderBy(F.col("total_accumulated_likes").desc_nulls_last(),
                               F.col("channel_title").asc_nulls_last()).limit(k)


def regional_performance(fact: DataFrame) -> DataFrame:
    """Per-region totals, engagement percentage and a zero-guarded likes/dislikes ratio."""
    agg = fact.groupBy("region").agg(
        F.count_distinct("video_id").alias("total_unique_trending_videos"),
        F.sum("views").alias("total_views"),
        X.pct_rounded(X.exact_mean("engagement_rate", X.ENGAGEMENT_DECIMALS)).cast("double").alias("average_engagement_percentage"),
        F.sum("likes").alias("total_likes"),
        F.sum("dislikes").alias("total_dislikes"),
        X.ratio_of_sums(F.sum("likes"), F.sum("dislikes")).cast("double").alias("likes_to_dislikes_ratio"))
    return agg.orderBy(F.col("total_views").desc_nulls_last(), "region")


def top_engaged_items(fact: DataFrame, min_views: int = 100_000, k: int = 10) -> DataFrame:
    """The ``k`` most engaging (item, region) peaks among snapshots with >= ``min_views``."""
    cols = ["video_id", "title", "channel_title", "region", "views", "likes", "dislikes",
            "comment_count", "engagement_rate", "trending_date"]
    eligible = fact.select(*cols).where(F.col("views") >= min_views)
    peak = top_n_per_group(
        eligible, ["video_id", "region"],
        [F.col("views").desc_nulls_last(), F.col("trending_date").desc_nulls_last(),
         F.col("engagement_rate").desc_nulls_last(), F.col("likes").desc_nulls_last(),
         F.col("dislikes").desc_nulls_last(), F.col("comment_count").desc_nulls_last(),
         F.col("title").asc_nulls_last(), F.col("channel_title").asc_nulls_last()], 1)
    out = peak.select("title", "channel_title", "region", "views", "engagement_rate",
                      X.interactions_strict().alias("total_interactions"))
    return out.orderBy(F.col("engagement_rate").desc_nulls_last(), F.col("views").desc_nulls_last(),
                       F.col("region").asc_nulls_last(), F.col("title").asc_nulls_last(),
                       F.col("channel_title").asc_nulls_last(),
                       F.col("total_interactions").desc_nulls_last()).limit(k)


def weekday_pattern(fact: DataFrame) -> DataFrame:
    """Records, mean and total views per weekday, Monday..Sunday then others."""
    agg = fact.groupBy("trending_day").agg(
        F.count(F.lit(1)).alias("total_trending_records"),
        F.round(X.exact_mean("views"), 2).cast("double").alias("average_views_per_record"),
        F.sum("views").alias("total_views_on_day"))
    return agg.orderBy(X.weekday_order("trending_day"), "trending_day")


def views_by_region_sample(fact: DataFrame) -> DataFrame:
    """Total views and 4-dp mean engagement per region."""
    agg = fact.groupBy("region").agg(
        F.sum("views").alias("total_views"),
        F.round(X.exact_mean("engagement_rate", X.ENGAGEMENT_DECIMALS), 4).cast("double").alias("avg_engagement"))
    return agg.orderBy(F.col("total_views").desc_nulls_last(), "region")
