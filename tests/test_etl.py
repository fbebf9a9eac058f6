import os

import pytest
from pyspark.sql import functions as F

from snaplytics import sinks as K
from snaplytics.operators.quality import ConstraintViolation
from snaplytics.plans import etl as P
from snaplytics.plans import reports as E
from snaplytics.schemas import FACT_SCHEMA
from snaplytics.sources.driver_tables import category_dim, fact_star
from snaplytics.sources.parquet import read_fact
from tests import fixtures
from tests.conftest import SF_SMALL

REGIONS = ["US", "CA", "GB", "IN", "DE", "FR"]


def test_transform_then_load_aborts_on_orphan(spark, tmp_path):
    raw = str(tmp_path / "raw")
    fixtures.write_raw(raw)
    out = str(tmp_path / "processed")
    metrics = P.run_transform(spark, raw, out, REGIONS)
    assert metrics["raw_rows"] == len(fixtures.us_rows()) + 1
    assert metrics["clean_rows"] == 11 and metrics["dim_rows"] == 3
    assert metrics["negative_rows"] == 1
    assert metrics["missing_regions"] == ["CA", "GB", "IN", "DE"] and metrics["input_files"] == 2
    assert 0 < metrics["quality_rate"] < 1
    assert sorted(d for d in os.listdir(os.path.join(out, "trending")) if d.startswith("region=")) == [
        "region=FR", "region=US"]
    with pytest.raises(ConstraintViolation, match="orphans"):       # category 77 has no dimension row
        P.run_load(spark, out, location=str(tmp_path / "tables"))


def test_load_and_export_when_clean(spark, tmp_path):
    raw = str(tmp_path / "raw")
    fixtures.write_raw(raw)
    out = str(tmp_path / "processed")
    P.run_transform(spark, raw, out, REGIONS)
    fact = read_fact(spark, P.Paths(out).fact).where(F.col("category_id") != 77)
    K.write_fact(fact.checkpoint(), P.Paths(out).fact)
    summary = P.run_load(spark, out, fact_table="t_fact", dim_table="t_dim")     # registered in place
    assert not any(summary.values())
    assert spark.table("t_fact").count() == 10 and spark.table("t_dim").count() == 3
    assert spark.table("t_fact").where("region = 'FR'").count() == 1
    P.run_load(spark, out, fact_table="c_fact", dim_table="c_dim", location=str(tmp_path / "tables"),
               copy=True)                                                          # full-refresh copy
    assert spark.table("c_fact").count() == 10 and os.path.isdir(tmp_path / "tables" / "c_fact")
    written = P.run_export(spark, out, str(tmp_path / "dashboard"))
    assert set(written) == set(E.REPORT_FILES)
    P.run_export(spark, out, str(tmp_path / "dashboard"))               # replaces the files
    assert sorted(f for f in os.listdir(tmp_path / "dashboard") if not f.startswith(".")) == sorted(E.REPORT_FILES.values())
    assert all(os.path.isfile(f) for f in written.values())
    top = (spark.read.option("header", True).option("multiLine", True).option("escape", '"')
           .csv(written["top_viewed"]))
    assert top.count() == 10 and "category_title" in top.columns


def test_static_overwrite_removes_stale_regions(spark, tmp_path):
    path = str(tmp_path / "fact")
    f = fact_star(spark, SF_SMALL)
    K.write_fact(f, path)
    K.write_fact(f.where(F.col("region") == "ASIA"), path)
    assert [d for d in os.listdir(path) if d.startswith("region=")] == ["region=ASIA"]
    assert read_fact(spark, path).count() == f.where(F.col("region") == "ASIA").count()


def test_report_invariants(spark):
    fact, dim = fact_star(spark, SF_SMALL), category_dim(spark, SF_SMALL)
    n = fact.count()
    total_views = fact.agg(F.sum("views")).first()[0]
    cat = E.report_category(fact, dim).agg(F.sum("total_trending_entries"), F.sum("total_views")).first()
    reg = E.report_region(fact).agg(F.sum("total_views")).first()[0]
    day = E.report_weekday(fact).agg(F.sum("trending_count")).first()[0]
    hour = E.report_publish_hour(fact).agg(F.sum("video_count")).first()[0]
    assert cat[0] == day == hour == n
    assert cat[1] == reg == total_views
    top = E.report_top_viewed(fact, dim).collect()
    assert len({r["video_id"] for r in top}) == len(top) == 50
    assert [r["views"] for r in top] == sorted((r["views"] for r in top), reverse=True)
    for r in top:
        inter = r["likes"] + r["dislikes"] + r["comment_count"]
        assert r["engagement_rate"] == round(inter / r["views"], 4) or abs(
            r["engagement_rate"] - inter / r["views"]) <= 5e-5
    days = [r["trending_day"] for r in E.report_weekday(fact).collect()]
    assert days == ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
    sample = E.report_region_sample(fact, dim, n=100)
    assert sample.groupBy("region").count().agg(F.max("count")).first()[0] == 100


def test_catalog_view_with_comment(spark, tmp_path):
    from snaplytics.plans.views import DASHBOARD_COLUMNS, VIEW_COMMENT, create_dashboard_view
    loc = str(tmp_path / "tables")
    coded = fact_star(spark, SF_SMALL).withColumn("region", F.substring("region", 1, 2))    # VARCHAR(10)
    K.refresh_table(coded, "v_fact", K.fact_ddl("v_fact", f"{loc}/fact"))
    K.refresh_table(category_dim(spark, SF_SMALL), "v_dim", K.dim_ddl("v_dim", f"{loc}/dim"))
    view = create_dashboard_view(spark, "v_fact", "v_dim", "v_dashboard", temporary=False)
    assert view.columns == DASHBOARD_COLUMNS
    assert view.count() == fact_star(spark, SF_SMALL).count()
    comment = [r for r in spark.sql("DESCRIBE TABLE EXTENDED v_dashboard").collect() if r[0] == "Comment"]
    assert comment and comment[0][1] == VIEW_COMMENT


def small_pair(spark, regions=("US", "CA"), title="t"):
    raw = [("v1", r, title, 10) for r in regions]
    base = spark.createDataFrame(raw, "video_id string, region string, title string, category_id int")
    fact = base.selectExpr(*[f"{c.name}" if c.name in base.columns else f"cast({'current_date()' if c.name == 'trending_date' else 'null'} "
                             f"as {c.dataType.simpleString()}) as {c.name}" for c in FACT_SCHEMA.fields])
    return fact, spark.createDataFrame([(10, title)], "category_id int, category_title string")


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_publish_is_all_or_nothing(spark, tmp_path, mode, monkeypatch):
    fact_t, dim_t, root = f"p_fact_{mode}", f"p_dim_{mode}", str(tmp_path)

    def state():
        return ([r[0] for r in spark.table(fact_t).select("region").orderBy("region").collect()],
                [r[1] for r in spark.table(dim_t).collect()])
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        K.refresh_pair(*small_pair(spark), fact_t, dim_t, root)
        assert state() == (["CA", "US"], ["t"])
        fact, dim = small_pair(spark, ("US",), "new")
        broken = fact.withColumn("title", F.raise_error(F.lit("between the tables")).cast("string"))
        with pytest.raises(Exception, match="between the tables"):   # the dimension is written, the fact is not
            K.refresh_pair(broken, dim, fact_t, dim_t, root)
        assert state() == (["CA", "US"], ["t"])
        real = K.publish.__globals__["set_location"]

        def fails_once(spark_, table, folder):
            if table == fact_t:
                raise RuntimeError("catalog is away")
            real(spark_, table, folder)
        monkeypatch.setitem(K.publish.__globals__, "set_location", fails_once)
        with pytest.raises(RuntimeError, match="catalog is away"):   # the dimension had moved
            K.refresh_pair(fact, dim, fact_t, dim_t, root)
        monkeypatch.setitem(K.publish.__globals__, "set_location", real)
        assert state() == (["CA", "US"], ["t"])
        K.refresh_pair(fact, dim, fact_t, dim_t, root)
        assert state() == (["US"], ["new"])                            # CA is gone, whatever the mode
        K.refresh_table(small_pair(spark)[0], "one_fact", K.fact_ddl("one_fact", f"{root}/one"))
        one = K.refresh_table(fact, "one_fact", K.fact_ddl("one_fact", f"{root}/one"))
        assert [r.region for r in one.collect()] == ["US"]
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
        spark.sql("DROP TABLE IF EXISTS one_fact")


def test_tables_refuse_long_values_and_nulls(spark, tmp_path):
    fact, dim = small_pair(spark)
    for bad, message in ((fact.withColumn("title", F.lit("x" * 256)), "EXCEED_LIMIT_LENGTH"),
                         (fact.withColumn("category_id", F.lit(None).cast("int")), "NULL in category_id")):
        with pytest.raises(Exception, match=message):
            K.refresh_pair(bad, dim, "refusing_fact", "refusing_dim", str(tmp_path))
        assert not spark.catalog.tableExists("refusing_fact") and not spark.catalog.tableExists("refusing_dim")
    K.refresh_pair(fact.withColumn("title", F.lit("x" * 255)), dim, "refusing_fact", "refusing_dim", str(tmp_path))
    assert spark.table("refusing_fact").count() == 2
    K.write_fact(fact, str(tmp_path / "registered"))
    K.register_table(spark, "registered_fact", K.fact_ddl("registered_fact", str(tmp_path / "registered")))
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        fact.withColumn("title", F.lit("x" * 256)).select(*spark.table("registered_fact").columns).write.insertInto("registered_fact")


RETRIED = """
import json, sys
sys.path.insert(0, {root!r})
from pyspark import TaskContext
from snaplytics.session import build_session
from snaplytics.plans import transform as T
from snaplytics.plans import etl as P
spark = build_session("local[2,4]", shuffle_partitions=4, extra={{"spark.checkpoint.dir": {ckpt!r}}})
spark.sparkContext.setLogLevel("OFF")
typed = T.typed_rows
def flaky(raw):
    def once(batches):
        first = TaskContext.get().attemptNumber() == 0
        for batch in batches:
            yield batch
        if first:
            raise RuntimeError("executor lost")
    df = typed(raw)
    return df.mapInArrow(once, df.schema)
T.typed_rows = flaky
out = P.run_transform(spark, {raw!r}, {out!r}, ["US", "CA", "GB", "IN", "DE", "FR"])
print("RESULT" + json.dumps(out))
"""


def test_stage_counts_survive_failed_tasks(spark, tmp_path):
    import json
    import subprocess
    import sys
    raw = str(tmp_path / "raw")
    fixtures.write_raw(raw)
    calm = P.run_transform(spark, raw, str(tmp_path / "calm"), REGIONS)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = RETRIED.format(root=root, ckpt=str(tmp_path / "ckpt"), raw=raw, out=str(tmp_path / "flaky"))
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=600)
    assert "RESULT" in run.stdout, run.stderr[-2000:]
    flaky = json.loads(run.stdout.split("RESULT")[1])
    assert flaky == calm
    assert calm["by_region"]["US"] == {"raw_rows": 18, "complete_rows": 14, "negative_rows": 1, "clean_rows": 10}
    assert calm["by_region"]["CA"]["raw_rows"] == 0 and calm["missing_category_regions"] == ["IN", "DE"]


def test_fact_ddl_declares_partitioned_table(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS ddl_fact")
    spark.sql(K.fact_ddl("ddl_fact", str(tmp_path / "ddl_fact")))
    cols = [f.name for f in spark.table("ddl_fact").schema.fields]
    assert cols[-1] == "region" and len(cols) == 20


def test_cli_runs_transform_and_export(tmp_path, capsys):
    import json as _json
    import subprocess
    import sys as _sys
    raw = str(tmp_path / "raw")
    fixtures.write_raw(raw)
    cmd = [_sys.executable, "-m", "snaplytics", "--raw", raw, "--processed", str(tmp_path / "out"),
           "--skip-load", "--export", str(tmp_path / "dash")]
    env = dict(os.environ, PYTHONPATH=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    res = subprocess.run(cmd, capture_output=True, text=True, env=env, timeout=600)
    last = [line for line in res.stdout.splitlines() if line.startswith("{")][-1]
    out = _json.loads(last)
    assert res.returncode == 0 and out["status"] == "ok"
    assert out["transform"]["clean_rows"] == 11
    assert (tmp_path / "dash" / "regional_summary.csv").exists()
