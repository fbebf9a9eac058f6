"""Steps that a big load pays for in every row are not in the plans; their results are held elsewhere."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import functions as F

from snaplytics import sinks as K
from snaplytics.functions import expressions as X
from snaplytics.plans import registry
from snaplytics.sources.regional_csv import read_regional_csv

from .conftest import SF_SMALL


def plan_of(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("extended")
    return out.getvalue().split("== Optimized Logical Plan ==")[1].lower()


def test_region_of_a_file_is_a_constant(spark, tmp_path):
    for region in ("A B", "C"):
        (tmp_path / f"region={region}").mkdir()
        (tmp_path / f"region={region}" / "p.csv").write_text("video_id,views\nx,1\n")
    back = read_regional_csv(spark, str(tmp_path), ["A B", "C"], "region={region}")
    assert {(r.region, r.video_id, r.views) for r in back.collect()} == {("A B", "x", "1"), ("C", "x", "1")}
    assert "regexp_extract" not in plan_of(back)


def test_region_of_path_is_that_of_the_column(spark):
    paths = ["/d/USvideos.csv", "/d/region=A B/p", "/d/x+y", "/d/region=x+y/p.csv", "/region=a%3Ab/q", "/d/none"]
    for template in ("{region}videos.csv", "region={region}"):
        rows = spark.createDataFrame([(p, p.replace("%", "%25").replace(" ", "%20")) for p in paths], "p string, uri string")
        for r in rows.select("p", X.region_from_path(F.col("uri"), template).alias("r")).collect():
            assert X.region_of_path(r.p, template) == r.r


def test_layout_key_and_weekday_go_without_texts(spark):
    rows = spark.range(3000).select(F.col("id").alias("a"), (F.col("id") * 7 % 4096).alias("b"), (4095 - F.col("id")).alias("c"),
                                    F.date_add(F.lit("1969-06-01").cast("date"), F.col("id").cast("int")).alias("d"))
    out = rows.select("*", K.interleaved_key([F.col(c) for c in "abc"]).alias("key"), X.weekday_name("d").alias("day"),
                      X.weekday_name(F.when(F.col("a") < 0, F.col("d"))).alias("none"))
    plan = plan_of(out)
    assert "conv(" not in plan and "date_format" not in plan
    for r in out.collect():
        bits = [(v >> b & 1) << (3 * b + k) for k, v in enumerate((r.a, r.b, r.c)) for b in range(12)]
        assert r.key == sum(bits) and r.day == r.d.strftime("%A") and r.none is None


def test_refresh_deduplicates_its_rows_once(spark, monkeypatch):
    plans = []
    whole = K.refresh_pair

    def seen(fact, *rest):
        plans.append(plan_of(fact))
        return whole(fact, *rest)

    monkeypatch.setattr(registry.K, "refresh_pair", seen)
    steps = [r.step for r in registry.QUERIES["load_refresh_twice"](spark, SF_SMALL).collect()]
    assert set(steps) == {"first", "failed", "second"}
    assert len(plans) == 3 and not any("aggregate" in p for p in plans)
