"""File layout (K7), the region sample's cutoff (W3) and order-independent means."""

import random

import pytest
from pyspark.sql import functions as F

from snaplytics import sinks as K
from snaplytics.operators.windows import cutoffs, top_n_by_cutoff, top_n_per_group, value_bin
from snaplytics.plans import analytics as A
from snaplytics.plans import reports as E
from snaplytics.sources.driver_tables import category_dim, fact_star
from snaplytics.sources.parquet import read_fact
from tests.conftest import SF_SMALL


def scanned_rows(df) -> int:
    """Rows that the file scan of a query handed out: skipped row groups don't count."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    text = plan.getClass().getSimpleName()
    node = plan.executedPlan() if text == "AdaptiveSparkPlanExec" else plan
    todo, rows = [node], 0
    while todo:
        p = todo.pop()
        if "Scan" in p.nodeName():
            rows += p.metrics().apply("numOutputRows").value()
        children = p.children()
        todo += [children.apply(i) for i in range(children.size())]
    return rows


@pytest.fixture(scope="module")
def laid_out(spark, tmp_path_factory):
    """A fact in one file with row groups of some hundred rows."""
    path = str(tmp_path_factory.mktemp("layout"))
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("parquet.block.size", "20000")
    conf.set("parquet.block.size.row.check.min", "100")
    conf.set("parquet.page.size.row.check.min", "100")
    try:
        fact = fact_star(spark, SF_SMALL).withColumn("region", F.lit("ALL"))
        K.write_fact(fact.withColumn("video_id", F.concat(F.lit("item "), F.md5("video_id"))), path, files_per_region=1)
    finally:
        for key in ("parquet.block.size", "parquet.block.size.row.check.min", "parquet.page.size.row.check.min"):
            conf.unset(key)
    return read_fact(spark, path)


def test_row_groups_are_skipped_by_each_indexed_column(laid_out):
    n = laid_out.count()
    top = laid_out.agg(F.percentile("views", 0.98)).first()[0]
    day = laid_out.agg(F.min("trending_date")).first()[0]
    for predicate in (F.col("views") >= int(top), F.col("trending_date") <= F.date_add(F.lit(day), 60), F.col("category_id") >= 20):
        part = laid_out.where(predicate)
        assert 0 < part.count() < n / 3
        assert scanned_rows(part.select("views", "trending_date", "category_id")) < 0.7 * n, predicate


def test_bloom_filter_skips_row_groups_for_an_absent_item(laid_out):
    absent = laid_out.where(F.col("video_id") == "item 7fffffffffffffffffffffffffffffff").select("video_id", "views")
    assert scanned_rows(absent) == 0
    one = laid_out.first()["video_id"]
    found = laid_out.where(F.col("video_id") == one).select("video_id", "views")
    assert 0 < scanned_rows(found) < 0.9 * laid_out.count()


def test_sort_of_the_layout_compares_columns_only(spark):
    """An expression in a sort order is worked out in every comparison, not once a row."""
    for files in (None, 2):
        plan = K.layout_fact(fact_star(spark, SF_SMALL), files)._jdf.queryExecution().optimizedPlan()
        todo, orders = [plan], []
        while todo:
            p = todo.pop()
            if p.nodeName() == "Sort":
                orders += [p.order().apply(i).child().nodeName() for i in range(p.order().size())]
            todo += [p.children().apply(i) for i in range(p.children().size())]
        assert orders == ["AttributeReference"] * 2


def test_layout_key_interleaves_bits(spark):
    rng = random.Random(5)
    data = [tuple(rng.choice([0, 1, 4095, rng.randrange(1 << K.LAYOUT_BITS)]) for _ in range(3)) for _ in range(300)]
    rows = spark.createDataFrame(data, "a long, b long, c long").select("*", K.interleaved_key([F.col(c) for c in "abc"]).alias("k")).collect()
    assert all(r.k == sum((r[i] >> bit & 1) << (3 * bit + i) for bit in range(K.LAYOUT_BITS) for i in range(3)) for r in rows)


def test_layout_sorts_nulls_and_negatives_and_keeps_all_columns(spark):
    data = [(r, d, c, v) for r in ("x", None) for d in (None, "1969-12-31", "2017-11-14") for c in (None, -1, 3, 70) for v in (None, -5, 0, 10**9)]
    df = spark.createDataFrame(data, "region string, day string, category_id int, views long") \
        .select("region", F.col("day").cast("date").alias("trending_date"), "category_id", "views")
    out = K.layout_fact(df.coalesce(1))
    assert out.columns == df.columns and sorted(out.collect(), key=repr) == sorted(df.collect(), key=repr)
    keys = out.select(F.spark_partition_id(), F.coalesce("region", F.lit("")), K.interleaved_key(K.layout_parts())).collect()
    assert [tuple(k) for k in keys] == sorted(tuple(k) for k in keys) and all(k[2] is not None for k in keys)


def test_bins_are_monotone(spark):
    values = sorted({0, 1, 2, 1023, 1024, 2047, 2048, 2049, 10**6, 2**48 - 1, 2**48, 2**62 + 5, *(random.Random(1).randrange(10**7) for _ in range(500))})
    rows = spark.createDataFrame([(v,) for v in values], "v long").select("v", value_bin("v").alias("b"),
                                                                        K.leading_bits(F.col("v")).alias("k")).orderBy("v").collect()
    assert all(r.b <= r.v for r in rows)
    for a, b in zip(rows, rows[1:]):
        assert a.b <= b.b and a.k <= b.k < 1 << K.LAYOUT_BITS


def test_cut_is_exact_with_ties_nulls_and_small_groups(spark):
    rng = random.Random(3)
    data = [("big", rng.choice([None, 5, 5, 5, 70_000, rng.randrange(10**6)]), i) for i in range(2000)]
    data += [("ties", 9, i) for i in range(500)] + [("small", None, i) for i in range(7)] + [(None, 3, i) for i in range(40)]
    data += [("negative", -i, i) for i in range(60)]
    df = spark.createDataFrame(data, "region string, views long, i int").repartition(6)
    order = [F.col("views").desc_nulls_last(), F.col("i").asc()]
    want = top_n_per_group(df, ["region"], order, 50)
    got = top_n_by_cutoff(df, "region", "views", order, 50)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    limits = {r[0]: r[1] for r in cutoffs(df, "region", "views", 50).collect()}
    assert limits["ties"] == 9 and limits["small"] is None and limits["negative"] is None and limits[None] is None


def test_sample_sorts_wide_rows_only_above_the_cutoff(spark):
    fact, dim = fact_star(spark, SF_SMALL).checkpoint(), category_dim(spark, SF_SMALL)
    plan = E.report_region_sample(fact, dim, n=20)._jdf.queryExecution().executedPlan().toString()
    semi = plan.index("LeftSemi")
    assert "description" in plan and all(at < semi for at in range(len(plan)) if plan.startswith("WindowGroupLimit", at))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_means_do_not_depend_on_the_order_of_rows(spark, seed):
    fact = fact_star(spark, SF_SMALL).withColumn("views", F.col("views") * 2**30 + F.col("likes")).checkpoint()
    for query in (A.regional_performance, A.weekday_pattern, A.views_by_region_sample):
        base = [tuple(r) for r in query(fact.coalesce(1)).collect()]
        assert [tuple(r) for r in query(fact.repartition(seed + 3, F.xxhash64("views", F.lit(seed)))).collect()] == base


def test_exact_mean_of_decimals_and_nulls(spark):
    from snaplytics.functions import expressions as X
    df = spark.createDataFrame([("a", 0.1), ("a", 0.2), ("a", None), ("b", None)], "g string, v double")
    got = {r.g: r.m for r in df.groupBy("g").agg(X.exact_mean("v", 4).cast("double").alias("m")).collect()}
    assert got == {"a": 0.15, "b": None}
