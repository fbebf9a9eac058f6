"""Physical-plan assertions: the plans we want at scale, not just right answers."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from snaplytics.operators.clean import min_threshold
from snaplytics.plans import analytics as A
from snaplytics.plans import reports as E
from snaplytics.plans.registry import QUERIES
from snaplytics.sinks import write_fact
from snaplytics.sources.driver_tables import category_dim, fact_star
from snaplytics.sources.parquet import read_fact
from tests.conftest import SF_SMALL


def plan(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.fixture(scope="module")
def written_fact(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("fact"))
    write_fact(fact_star(spark, SF_SMALL), path)
    return path


def test_dimension_join_is_broadcast_and_rank_is_pruned(spark, written_fact):
    p = plan(A.top_categories_per_region(read_fact(spark, written_fact), category_dim(spark, SF_SMALL)))
    assert "BroadcastHashJoin" in p
    assert "WindowGroupLimit" in p and "Partial" in p          # rank <= 3 pruned before the shuffle


def test_topk_is_take_ordered(spark, written_fact):
    fact = read_fact(spark, written_fact)
    for df in (A.top_channels_by_max_likes(fact), A.top_engaged_items(fact),
               E.report_top_channels(fact), E.report_top_viewed(fact, category_dim(spark, SF_SMALL))):
        assert "TakeOrderedAndProject" in plan(df)


def test_sample_report_uses_window_group_limit(spark, written_fact):
    p = plan(E.report_region_sample(read_fact(spark, written_fact), category_dim(spark, SF_SMALL)))
    assert "WindowGroupLimit" in p


def test_threshold_pushed_to_scan_and_columns_pruned(spark, written_fact):
    p = plan(min_threshold(read_fact(spark, written_fact), "views", 100_000).select("video_id", "views"))
    assert "GreaterThanOrEqual(views,100000)" in p
    scan = [line for line in p.splitlines() if line.startswith("ReadSchema")]
    assert scan and "description" not in scan[0] and "views" in scan[0]


def test_region_filter_prunes_partitions(spark, written_fact):
    df = read_fact(spark, written_fact).where(F.col("region") == "ASIA")
    p = plan(df)
    assert "PartitionFilters: [isnotnull(region" in p and "(region#" in p


def test_keep_max_has_partial_aggregation(spark, written_fact):
    from snaplytics.operators.dedup import keep_max_per_key
    p = plan(keep_max_per_key(read_fact(spark, written_fact), ["video_id"]), "simple")
    assert "partial_max" in p                                   # hot keys collapse map-side


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_query_plans(spark, name):
    p = plan(QUERIES[name](spark, SF_SMALL), "simple")
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "MapInPandas" not in p


def test_clean_job_has_no_python_and_combines_before_the_shuffle(spark):
    from snaplytics.plans.transform import clean_fact
    from snaplytics.sources.driver_tables import raw_events
    p = plan(clean_fact(raw_events(spark, SF_SMALL).drop("event_id")), "simple")
    assert "Python" not in p and "InPandas" not in p and "InArrow" not in p
    assert "partial_max" in p


def test_files_follow_bytes_not_tasks_times_regions(spark, tmp_path):
    """One region holds most rows; many tasks must not leave a file per task and region."""
    import glob

    from snaplytics.sinks import write_fact
    from snaplytics.sources.driver_tables import fact_events
    fact = fact_events(spark, SF_SMALL).withColumn("region", F.when(F.rand(1) < 0.9, "hot").otherwise(F.col("region"))).repartition(40)
    write_fact(fact, str(tmp_path / "fact"))
    files = glob.glob(f"{tmp_path}/fact/region=*/*.parquet")
    regions = glob.glob(f"{tmp_path}/fact/region=*")
    assert len(regions) > 3 and len(files) <= 2 * len(regions)
