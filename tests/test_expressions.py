import datetime as dt

from pyspark.sql import functions as F

from snaplytics.functions import expressions as X


def one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr).collect()]


def test_engagement_half_even_tie(spark):
    # 5 / 4000 = 0.00125 -> 0.0012 with banker's rounding (not 0.0013)
    got = one(spark, X.engagement_rate(), [(4000, 5, 0, 0)],
              "views long, likes long, dislikes long, comment_count long")
    assert got == [0.0012]


def test_engagement_nulls_as_zero_and_guard(spark):
    data = [(100, None, 2, 3), (0, 5, 5, 5), (None, 1, 1, 1), (-10, 1, 1, 1)]
    got = one(spark, X.engagement_rate(), data,
              "views long, likes long, dislikes long, comment_count long")
    assert got == [0.05, 0.0, 0.0, 0.0]


def test_strict_interactions_propagate_null(spark):
    got = one(spark, X.interactions_strict(), [(1, None, 2), (1, 2, 3)],
              "likes long, dislikes long, comment_count long")
    assert got == [None, 6]


def test_clamp_keeps_null(spark):
    got = one(spark, X.clamp_non_negative("v"), [(-5,), (None,), (7,)], "v long")
    assert got == [0, None, 7]


def test_any_negative_ignores_null(spark):
    data = [(None, 1, 1, 1), (1, -1, 1, 1), (1, 1, 1, 1)]
    got = one(spark, X.any_negative(), data, "views long, likes long, dislikes long, comment_count long")
    assert got == [False, True, False]


def test_parse_trending_date(spark):
    got = one(spark, X.parse_trending_date("d"), [("17.14.11",), ("bad",), ("",), (None,)], "d string")
    assert got == [dt.date(2017, 11, 14), None, None, None]


def test_parse_publish_time_utc(spark):
    got = one(spark, X.parse_publish_time("t"), [("2017-11-13T17:13:01.000Z",), ("nope",)], "t string")
    assert got == [dt.datetime(2017, 11, 13, 17, 13, 1), None]


def test_category_truncation(spark):
    got = one(spark, X.to_int_truncating("c"), [("12",), ("12.0",), ("12.7",), ("x",), (None,)], "c string")
    assert got == [12, 12, 12, None, None]


def test_weekday_and_hour(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), dt.datetime(2024, 1, 1, 23, 5))], "d date, t timestamp")
    r = df.select(X.weekday_name("d"), X.hour_of("t")).first()
    assert tuple(r) == ("Monday", 23)


def test_weekday_order(spark):
    days = X.WEEKDAYS + ["Funday"]
    got = one(spark, X.weekday_order("d"), [(d,) for d in days], "d string")
    assert got == [1, 2, 3, 4, 5, 6, 7, 8]


def test_ratio_and_pct(spark):
    df = spark.createDataFrame([(10, 3), (5, 0)], "l long, d long")
    got = [r[0] for r in df.select(X.ratio_of_sums(F.col("l"), F.col("d"))).collect()]
    assert [float(g) if g is not None else None for g in got] == [3.33, None]
    pct = spark.createDataFrame([(0.012345,)], "x double").select(X.pct_rounded(F.col("x"))).first()[0]
    assert float(pct) == 1.23


def test_region_from_path(spark):
    paths = [("file:/raw/USvideos.csv",), ("file:/raw/GBvideos.csv/part-0001.csv",),
             ("file:/raw/region=MIDDLE%20EAST/part-1.csv",)]
    df = spark.createDataFrame(paths, "p string")
    a = [r[0] for r in df.select(X.region_from_path(F.col("p"), "{region}videos.csv")).collect()]
    b = [r[0] for r in df.select(X.region_from_path(F.col("p"), "region={region}")).collect()]
    assert a[:2] == ["US", "GB"]
    assert b[2] == "MIDDLE EAST"


def test_cluster_settings_sizes_partitions():
    from snaplytics.session import cluster_settings
    conf = cluster_settings(100 << 40, 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600
    assert cluster_settings(1 << 20, 16)["spark.sql.shuffle.partitions"] == "32"
