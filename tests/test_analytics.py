"""Analytics and reports on a hand-made snapshot fact with the edge cases of FIXTURES.md."""

import datetime as dt

import pytest

from snaplytics.plans import analytics as A
from snaplytics.plans import reports as E
from snaplytics.schemas import FACT_SCHEMA


def fact_row(vid, region, day, views, likes, dislikes, comments, cat, channel="ch", title=None, hour=10):
    d = dt.date(2018, 1, day)
    er = round(((likes or 0) + (dislikes or 0) + (comments or 0)) / views, 4) if views and views > 0 else 0.0
    return (vid, d, region, title or f"t-{vid}", channel, cat, dt.datetime(2018, 1, 1, hour), "tags",
            views, likes, dislikes, comments, "thumb", False, False, False, "desc", er,
            d.strftime("%A"), hour)


@pytest.fixture(scope="module")
def fact(spark):
    rows = [
        fact_row("a", "US", 1, 100, 10, 0, 0, 1),          # US: dislikes sum to 0 -> ratio NULL
        fact_row("b", "US", 1, 100, 5, 0, 1, 2),
        fact_row("c", "US", 2, 300, 3, 0, 0, 3),
        fact_row("d", "FR", 1, 200, 4, 2, 2, 1, channel="ch2"),
        fact_row("d", "FR", 2, 250, None, 2, 2, 1, channel="ch2"),   # NULL likes
        fact_row("e", "FR", 3, 150000, 900, 50, 50, 9, channel="ch3"),  # category without title
    ]
    return spark.createDataFrame(rows, FACT_SCHEMA)


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame([(1, "Music"), (2, "Pets"), (3, "Comedy")],
                                 "category_id int, category_title string")


def test_r1_rank_ties_share_rank(fact, dim):
    out = [tuple(r) for r in A.top_categories_per_region(fact, dim, k=3, broadcast="checked").collect()]
    us = [r for r in out if r[0] == "US"]
    assert us == [("US", 1, "Comedy", 300, 1), ("US", 2, "Music", 100, 1), ("US", 2, "Pets", 100, 1)]
    assert [r for r in out if r[0] == "FR"] == [("FR", 1, "Music", 450, 1)]   # category 9 has no title


def test_r2_sum_of_peak_likes(fact):
    out = {r["channel_title"]: (r["total_accumulated_likes"], r["number_of_trending_videos"])
           for r in A.top_channels_by_max_likes(fact).collect()}
    assert out == {"ch": (18, 3), "ch2": (4, 1), "ch3": (900, 1)}


def test_r3_zero_dislikes_gives_null_ratio(fact):
    out = {r["region"]: r for r in A.regional_performance(fact).collect()}
    assert out["US"]["likes_to_dislikes_ratio"] is None
    assert out["FR"]["likes_to_dislikes_ratio"] == round(904 / 54, 2)
    assert out["US"]["total_unique_trending_videos"] == 3 and out["FR"]["total_likes"] == 904


def test_r4_threshold_and_strict_interactions(fact):
    out = [tuple(r) for r in A.top_engaged_items(fact, min_views=100).collect()]
    assert out[0][:3] == ("t-a", "ch", "US") and out[0][5] == 10
    assert ("t-d", "ch2", "FR", 250, 0.016, None) in out      # peak row has NULL likes -> NULL sum
    assert [r[0] for r in A.top_engaged_items(fact).collect()] == ["t-e"]


def test_r5_weekday_order(spark, fact):
    days = [r["trending_day"] for r in A.weekday_pattern(fact).collect()]
    assert days == ["Monday", "Tuesday", "Wednesday"]


def test_e2_excludes_unknown_category_and_e6_sums_nulls_as_zero(spark, fact, dim):
    cats = {r["category_title"] for r in E.report_category(fact, dim).collect()}
    assert cats == {"Music", "Pets", "Comedy"}
    nulls = fact.where("video_id = 'd' and likes is null")
    ch = E.report_top_channels(nulls).first()
    assert ch["total_likes"] == 0 and ch["trending_appearances"] == 1


def test_e4_missing_weekdays_are_null(fact):
    out = [tuple(r) for r in E.report_weekday(fact).collect()]
    assert [r[0] for r in out] == ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday",
                                   "Sunday"]
    assert out[3][1:] == (None, None, None) and out[0][1] == 3
