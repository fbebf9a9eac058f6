"""Scalar column expressions.

All of these are built-in Catalyst expressions, so they stay inside
whole-stage codegen; nothing here runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must equal the reference's outputs exactly.
# ---------------------------------------------------------------------------
DESCRIPTION_FILLER = "No description provided"
TAGS_FILLER = "[none]"
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
TRENDING_DATE_FORMAT = "yy.dd.MM"
DEFAULT_REGIONS = ["US", "CA", "GB", "IN", "DE", "FR"]
CSV_NAME_TEMPLATE = "{region}videos.csv"
JSON_NAME_TEMPLATE = "{region}_category_id.json"
COUNTER_COLUMNS = ["views", "likes", "dislikes", "comment_count"]
ENGAGEMENT_DECIMALS = 4
# ---------------------------------------------------------------------------


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_trending_date(c: str | Column, fmt: str = TRENDING_DATE_FORMAT) -> Column:
    """``YY.DD.MM`` snapshot date; anything unparseable becomes NULL (C8). Two-digit years
    from 69 on are of the last century (the POSIX rule), the others of this one."""
    parsed = F.try_to_date(col(c), fmt)
    return F.when(F.year(parsed) >= 2069, F.add_months(parsed, -1200)).otherwise(parsed) if "yyyy" not in fmt else parsed


def parse_publish_time(c: str | Column) -> Column:
    """ISO-8601 publish timestamp (UTC) -> TIMESTAMP_NTZ wall clock; bad -> NULL."""
    return F.try_to_timestamp(col(c)).cast("timestamp_ntz")


def to_int_truncating(c: str | Column) -> Column:
    """``'12'``, ``'12.0'``, ``12.7`` -> 12; junk or out of range -> NULL."""
    return col(c).try_cast("double").try_cast("int")


def null_as_zero(c: str | Column) -> Column:
    """C11 / F12."""
    return F.coalesce(col(c), F.lit(0))


def interactions_null_as_zero(likes="likes", dislikes="dislikes", comments="comment_count") -> Column:
    return null_as_zero(likes) + null_as_zero(dislikes) + null_as_zero(comments)


def interactions_strict(likes="likes", dislikes="dislikes", comments="comment_count") -> Column:
    """``likes + dislikes + comment_count``; NULL if any input is NULL."""
    return col(likes) + col(dislikes) + col(comments)


def guarded_ratio(numerator: Column, denominator: str | Column) -> Column:
    """numerator / denominator, 0.0 when the denominator is <= 0 or NULL."""
    d = col(denominator)
    return F.when(d > 0, numerator.cast("double") / d).otherwise(F.lit(0.0))


def round_half_even(c: str | Column, scale: int) -> Column:
    """Banker's rounding, as float ``.round(n)`` does."""
    return F.bround(col(c), scale)


def engagement_rate(views="views", likes="likes", dislikes="dislikes", comments="comment_count") -> Column:
    """(likes + dislikes + comment_count) / views, nulls as 0, 0.0 if views <= 0, 4 dp half-even."""
    return round_half_even(guarded_ratio(interactions_null_as_zero(likes, dislikes, comments), views),
                           ENGAGEMENT_DECIMALS)


def weekday_name(c: str | Column) -> Column:
    """Full English weekday name, e.g. ``Monday`` (C14): looked up, as a formatter costs a row more than its parsing."""
    return F.get(F.split(F.lit(",".join(WEEKDAYS)), ","), F.weekday(col(c)))


def hour_of(c: str | Column) -> Column:
    """C15."""
    return F.hour(col(c))


def clamp_non_negative(c: str | Column) -> Column:
    """Negative -> 0; NULL stays NULL (C16 / F14). ``greatest`` would turn NULL into 0."""
    x = col(c)
    return F.when(x < 0, F.lit(0).cast("bigint")).otherwise(x)


def any_negative(cols=COUNTER_COLUMNS) -> Column:
    """C17: true when any counter is negative (NULL counters do not count)."""
    pred = F.lit(False)
    for c in cols:
        pred = pred | F.coalesce(col(c) < 0, F.lit(False))
    return pred


def weekday_order(c: str | Column) -> Column:
    """Monday=1 .. Sunday=7, anything else 8."""
    expr = F.when(F.lit(False), F.lit(0))
    for i, day in enumerate(WEEKDAYS, start=1):
        expr = expr.when(col(c) == day, F.lit(i))
    return expr.otherwise(F.lit(8))


def exact_mean(c: str | Column, scale: int = 0) -> Column:
    """Mean of a column of whole numbers, or of values with at most ``scale`` decimals, as a decimal:
    exact sums over a count (A5), so no order of addition changes a digit. NULLs are skipped."""
    total = F.sum(col(c).cast(f"decimal(28,{scale})")).cast(f"decimal(38,{scale})")
    return F.try_divide(total, F.nullif(F.count(col(c)), F.lit(0)).cast("decimal(18,0)"))


def pct_rounded(avg_col: Column, scale: int = 2) -> Column:
    """``ROUND(AVG(x)::numeric * 100, 2)``: half away from zero on a decimal."""
    return F.round(avg_col.cast("decimal(38,18)") * 100, scale)


def ratio_of_sums(num: Column, den: Column, scale: int = 2) -> Column:
    """``ROUND(SUM(a)::numeric / NULLIF(SUM(b), 0), 2)``."""
    return F.round(F.try_divide(num.cast("decimal(38,0)"), F.nullif(den, F.lit(0)).cast("decimal(38,0)")),
                   scale)


def region_pattern(template: str) -> str:
    """The pattern whose group is the ``{region}`` part of a file path built from ``template``."""
    import re
    name = template.split("/")[-1]
    prefix, suffix = name.split("{region}")
    return "(?:^|/)" + re.escape(prefix) + "([^/]+?)" + re.escape(suffix) + "(?:/|$)"


def region_from_path(path_col: Column, template: str) -> Column:
    """Pull the ``{region}`` part out of a file path built from ``template`` (S3 / F2)."""
    # file paths are URIs: a partition value "MIDDLE EAST" shows up as MIDDLE%20EAST
    return F.url_decode(F.regexp_extract(path_col, region_pattern(template), 1))


def region_of_path(path: str, template: str) -> str:
    """``region_from_path`` of one plain path, in which nothing but a plus is left to decode ("" if it has none)."""
    import re
    found = re.search(region_pattern(template), path)
    return found.group(1).replace("+", " ") if found else ""


__all__ = [n for n in dir() if not n.startswith("_") and n not in ("annotations", "Column", "F")]
