"""The flat BI view (B1 / K8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEW_COMMENT = "One row per clean snapshot with the title of its category; snapshots of unknown categories are left out."

# The view's columns, in order.
DASHBOARD_COLUMNS = [
    "video_id", "trending_date", "region", "title", "channel_title", "category_title",
    "publish_time", "views", "likes", "dislikes", "comment_count", "comments_disabled",
    "ratings_disabled", "video_error_or_removed", "engagement_rate", "trending_day", "publish_hour",
]


def create_dashboard_view(spark: SparkSession, fact_table: str, dim_table: str,
                          view_name: str = "dashboard_view", temporary: bool = True) -> DataFrame:
    """K8: ``CREATE OR REPLACE [TEMP] VIEW``; a catalog view also carries the comment."""
    cols = ", ".join(("c." if c == "category_title" else "v.") + c for c in DASHBOARD_COLUMNS)
    body = (f"SELECT {cols} FROM {fact_table} v "
            f"JOIN {dim_table} c ON v.category_id = c.category_id")
    if temporary:
        spark.sql(f"CREATE OR REPLACE TEMP VIEW {view_name} AS {body}")
    else:
        comment = VIEW_COMMENT.replace("'", "\\'")
        spark.sql(f"CREATE OR REPLACE VIEW {view_name} COMMENT '{comment}' AS {body}")
    return spark.table(view_name)
