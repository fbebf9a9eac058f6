from pyspark.sql import functions as F

from snaplytics.operators.dedup import dedup_exact, keep_max_per_key, last_wins
from snaplytics.operators.joins import bounded_broadcast, complete_domain, join_dimension, orphans
from snaplytics.operators.windows import rank_within, top_n_per_group
from tests.conftest import rows


def test_dedup_exact_nulls_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a")], "k int, v string")
    assert rows(dedup_exact(df)) == rows(spark.createDataFrame([(1, None), (1, "a")], "k int, v string"))


def test_keep_max_views_nulls_last_and_total_order(spark):
    data = [("v1", "US", 10, "a"), ("v1", "US", 20, "b"), ("v1", "US", None, "c"),
            ("v2", "US", None, "x"), ("v2", "US", None, "y"),          # all-null views: tie-break
            ("v3", "CA", 5, "p"), ("v3", "CA", 5, "q")]               # equal views: tie-break
    df = spark.createDataFrame(data, "video_id string, region string, views long, title string")
    out = keep_max_per_key(df, ["video_id", "region"], by="views")
    assert out.columns == df.columns
    assert rows(out) == sorted([("v1", "US", 20, "b"), ("v2", "US", None, "y"), ("v3", "CA", 5, "q")], key=repr)


def test_keep_max_is_deterministic_under_repartition(spark):
    df = spark.range(0, 2000).select((F.col("id") % 7).alias("k"), (F.col("id") % 5).alias("views"),
                                     F.col("id").cast("string").alias("payload"))
    a = rows(keep_max_per_key(df, ["k"]))
    b = rows(keep_max_per_key(df.repartition(13), ["k"]))
    assert a == b


def test_last_wins(spark):
    data = [(10, "Music", 0, 0), (10, "Musik", 2, 0), (10, "Musique", 1, 5), (20, "Film", 0, 1)]
    df = spark.createDataFrame(data, "category_id int, category_title string, region_ord int, pos int")
    assert rows(last_wins(df, "category_id", "category_title", ["region_ord", "pos"])) == [(10, "Musik"), (20, "Film")]


def test_joins(spark):
    fact = spark.createDataFrame([(1, "a"), (2, "b"), (99, "c"), (None, "d")], "category_id int, v string")
    dim = spark.createDataFrame([(1, "One"), (2, "Two")], "category_id int, category_title string")
    assert len(join_dimension(fact, dim, how="inner", broadcast="checked").collect()) == 2
    left = join_dimension(fact, dim, how="left", broadcast="checked")
    assert rows(left, "v", "category_title") == sorted(
        [("a", "One"), ("b", "Two"), ("c", None), ("d", None)], key=repr)
    assert rows(orphans(fact, dim), "v") == [("c",), ("d",)]


def _plan(df):
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(True)
    return buf.getvalue().lower()


def test_bounded_broadcast_refuses_large(spark):
    fact = spark.range(0, 1000).withColumnRenamed("id", "k")
    dim = spark.range(0, 50).withColumnRenamed("id", "k")
    assert "broadcast" in _plan(fact.join(bounded_broadcast(dim, 100), "k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "broadcast" not in _plan(fact.join(bounded_broadcast(dim, 10), "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_complete_domain(spark):
    domain = spark.createDataFrame([("Mon", 0), ("Tue", 1), ("Wed", 2)], "d string, o int")
    agg = spark.createDataFrame([("Tue", 5), ("Xyz", 9)], "d string, n long")
    out = [tuple(r) for r in complete_domain(domain, agg, "d", "o").collect()]
    assert out == [("Mon", None), ("Tue", 5), ("Wed", None)]


def test_rank_ties_and_topn(spark):
    df = spark.createDataFrame([("US", "a", 10), ("US", "b", 10), ("US", "c", 5), ("CA", "d", 1)],
                               "region string, t string, v long")
    ranked = rank_within(df, ["region"], [F.col("v").desc()], "r")
    assert rows(ranked, "t", "r") == [("a", 1), ("b", 1), ("c", 3), ("d", 1)]
    top1 = top_n_per_group(df, ["region"], [F.col("v").desc(), F.col("t")], 1)
    assert rows(top1, "t") == [("a",), ("d",)]
