"""Schemas of the raw inputs, the clean snapshot fact and the category dimension."""

from pyspark.sql import types as T

FACT_SCHEMA = T.StructType([
    T.StructField("video_id", T.StringType()),
    T.StructField("trending_date", T.DateType()),
    T.StructField("region", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("channel_title", T.StringType()),
    T.StructField("category_id", T.IntegerType()),
    T.StructField("publish_time", T.TimestampNTZType()),
    T.StructField("tags", T.StringType()),
    T.StructField("views", T.LongType()),
    T.StructField("likes", T.LongType()),
    T.StructField("dislikes", T.LongType()),
    T.StructField("comment_count", T.LongType()),
    T.StructField("thumbnail_link", T.StringType()),
    T.StructField("comments_disabled", T.BooleanType()),
    T.StructField("ratings_disabled", T.BooleanType()),
    T.StructField("video_error_or_removed", T.BooleanType()),
    T.StructField("description", T.StringType()),
    T.StructField("engagement_rate", T.DoubleType()),
    T.StructField("trending_day", T.StringType()),
    T.StructField("publish_hour", T.IntegerType()),
])
FACT_COLUMNS = [f.name for f in FACT_SCHEMA.fields]
FACT_KEY = ["video_id", "trending_date", "region"]

CATEGORY_JSON_SCHEMA = "items array<struct<id:string,snippet:struct<title:string>>>"

# Declared maximum string lengths of the loaded tables (VARCHAR(n))
# and the columns that must not be NULL.
MAX_LENGTHS = {
    "video_id": 50, "region": 10, "title": 255, "channel_title": 255,
    "thumbnail_link": 255, "trending_day": 15,
}
DIM_MAX_LENGTHS = {"category_title": 100}
NOT_NULL_FACT = ["video_id", "trending_date", "region", "category_id"]
NOT_NULL_DIM = ["category_id", "category_title"]
