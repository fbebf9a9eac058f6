"""Cleaning and enrichment of the raw snapshot rows.

The order of the clean job matters and follows the reference's: fill text
defaults -> parse dates -> drop incomplete rows -> cast category -> dedup ->
engagement features (from the unclamped counters) -> clamp negatives.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaplytics.functions import expressions as X

TEXT_DEFAULTS = {"description": X.DESCRIPTION_FILLER, "tags": X.TAGS_FILLER}
CRITICAL_COLUMNS = ["publish_time", "trending_date", "category_id"]
BOOLEAN_COLUMNS = ["comments_disabled", "ratings_disabled", "video_error_or_removed"]


def lower_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name (do it per input, before a union)."""
    return df.toDF(*[c.lower() for c in df.columns])


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """Union-all by column name; a column missing from an input becomes NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def fill_text_defaults(df: DataFrame, defaults: dict | None = None) -> DataFrame:
    """NULL description / tags -> fixed filler text (before exact dedup)."""
    d = {k: v for k, v in (defaults or TEXT_DEFAULTS).items() if k in df.columns}
    return df.fillna(d)


def to_long(c) -> F.Column:
    """Counter text -> bigint; ``'12'`` / ``'12.0'`` -> 12, junk -> NULL."""
    c = X.col(c)
    return F.coalesce(c.try_cast("bigint"), c.try_cast("double").try_cast("bigint"))


def type_raw(df: DataFrame) -> DataFrame:
    """Typed projection of all-string raw rows (C8, C9, counters, booleans).

    ``category_id`` stays as parsed double text here; ``cast_category`` truncates it
    after the incomplete rows are dropped, as the reference does.
    """
    out = df
    if "publish_time" in df.columns:
        out = out.withColumn("publish_time", X.parse_publish_time("publish_time"))
    if "trending_date" in df.columns:
        out = out.withColumn("trending_date", X.parse_trending_date("trending_date"))
    if "category_id" in df.columns:
        out = out.withColumn("category_id", F.col("category_id").try_cast("double"))
    for c in X.COUNTER_COLUMNS:
        if c in df.columns:
            out = out.withColumn(c, to_long(c))
    for c in BOOLEAN_COLUMNS:
        if c in df.columns:
            out = out.withColumn(c, F.col(c).try_cast("boolean"))
    return out


def drop_incomplete(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop rows whose publish_time, trending_date or category_id is NULL/unparseable."""
    return df.dropna(subset=subset or CRITICAL_COLUMNS)


def cast_category(df: DataFrame, column: str = "category_id") -> DataFrame:
    """Category id to int, truncating (``12.7`` -> 12)."""
    return df.withColumn(column, X.to_int_truncating(column))


def add_features(df: DataFrame) -> DataFrame:
    """engagement_rate (4 dp half-even), trending_day, publish_hour."""
    return (df.withColumn("engagement_rate", X.engagement_rate())
              .withColumn("trending_day", X.weekday_name("trending_date"))
              .withColumn("publish_hour", X.hour_of("publish_time")))


def clamp_counters(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Negative counters -> 0, NULL stays NULL; engagement is not recomputed."""
    out = df
    for c in cols or X.COUNTER_COLUMNS:
        out = out.withColumn(c, X.clamp_non_negative(c))
    return out


def min_threshold(df: DataFrame, column: str = "views", threshold: int = 100_000) -> DataFrame:
    """Keep rows at or above a threshold (pushed to the Parquet scan)."""
    return df.where(F.col(column) >= threshold)


def interactions(df: DataFrame, name: str = "total_interactions") -> DataFrame:
    """NULL-propagating sum of the three interaction counters."""
    return df.withColumn(name, X.interactions_strict())


def negative_flag(df: DataFrame, name: str = "has_negative") -> DataFrame:
    """C17: boolean column, true when any counter is negative."""
    return df.withColumn(name, X.any_negative())
