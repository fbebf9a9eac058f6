"""Disk that jobs hold on their way: waves of regions give what one job gives, and what is read no more goes."""

import os
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from snaplytics import sinks as K
from snaplytics.operators.dedup import keep_max_per_key
from snaplytics.plans import etl as P
from snaplytics.plans.registry import QUERIES
from snaplytics.schemas import FACT_COLUMNS, FACT_KEY
from snaplytics.session import scratch_path
from snaplytics.sinks import staging as S
from snaplytics.sources import driver_tables as D
from snaplytics.sources.parquet import read_fact
from tests import fixtures
from tests.conftest import SF_SMALL, rows
from tests.test_etl import small_pair


@pytest.fixture
def small_waves(monkeypatch):
    monkeypatch.setattr(S, "WAVE_ROWS", 1)
    monkeypatch.setattr(P, "WAVE_BYTES", 8)


def shuffle_files(spark) -> set[str]:
    """Data files of shuffles that lie on disk, without those of counts (a few rows each)."""
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    found = blocks.getAllFiles()
    files = [found.apply(i) for i in range(found.size())]
    return {f.getName() for f in files if f.getName().startswith("shuffle_") and f.getName().endswith(".data") and f.length() > 4096}


def scratch(spark) -> set[str]:
    return {p.name for p in Path(scratch_path(spark, "x")).parent.glob("*")}


def count_writes(monkeypatch) -> list:
    seen, real = [], S.in_wave
    for module in (K, P, S, D):
        monkeypatch.setattr(module, "in_wave", lambda df, wave: seen.append(wave) or real(df, wave))
    return seen


def test_waves_hold_each_region_once():
    waves = S.region_waves({"a": 10, "b": 4, "c": 3, None: 3, "d": 0}, least=5)
    assert sorted(str(r) for w in waves for r in w) == ["None", "a", "b", "c", "d"] and len(waves) == 4
    assert S.region_waves({"a": 10, "b": 4}, least=8) == [None] and S.region_waves({}) == [None] == S.region_waves({"a": 1 << 40})
    assert len(S.region_waves({str(i): 1 << 30 for i in range(500)})) == S.MOST_WAVES


def test_fact_written_in_waves_is_the_same(spark, tmp_path):
    fact = D.fact_star(spark, SF_SMALL).withColumn("region", F.when(F.col("region") != "ASIA", F.col("region")))
    K.write_fact(fact.withColumn("region", F.lit("stale")), str(tmp_path / "w"))
    K.write_fact(fact, str(tmp_path / "w"), waves=[["AFRICA", None], ["EUROPE"], ["AMERICA", "MIDDLE EAST"]])
    assert rows(read_fact(spark, str(tmp_path / "w"))) == rows(fact)
    assert (tmp_path / "w" / "_SUCCESS").exists()


def test_fact_that_broke_off_between_waves_has_no_mark_of_success(spark, tmp_path):
    path, fact = tmp_path / "f", D.fact_star(spark, SF_SMALL)
    K.write_fact(fact, str(path))
    broken = fact.withColumn("title", F.when(F.col("region") == "ASIA", F.raise_error(F.lit("breaks off")).cast("string")).otherwise(F.col("title")))
    with pytest.raises(Exception, match="breaks off"):
        K.write_fact(broken, str(path), waves=[["EUROPE"], ["ASIA"]])
    assert (path / "region=EUROPE").exists() and not (path / "_SUCCESS").exists()


def test_star_is_staged_between_its_shuffles(spark, small_waves, monkeypatch):
    """The staged star has the star's rows; neither its table nor a shuffle of the write stays behind."""
    want = rows(D.fact_star(spark, SF_SMALL))
    before, shuffled, seen = scratch(spark), shuffle_files(spark), count_writes(monkeypatch)
    monkeypatch.setattr(D, "_MATERIALIZED", {})
    got = D.star(spark, SF_SMALL)
    assert shuffle_files(spark) <= shuffled and len([w for w in seen if w]) == 5
    assert [n.rsplit("-", 1)[0] for n in scratch(spark) - before] == ["fact-star"]
    assert got.columns == FACT_COLUMNS and rows(got) == want


def test_transform_by_waves_counts_and_writes_the_same(spark, tmp_path, monkeypatch):
    raw, regions = str(tmp_path / "raw"), ["US", "CA", "GB", "IN", "DE", "FR"]
    fixtures.write_raw(raw)
    whole = P.run_transform(spark, raw, str(tmp_path / "whole"), regions)
    seen = count_writes(monkeypatch)
    monkeypatch.setattr(P, "WAVE_BYTES", 8)
    assert P.run_transform(spark, raw, str(tmp_path / "waves"), regions) == whole
    assert len(seen) > 1 and None not in seen
    assert rows(P.clean_fact_frame(spark, str(tmp_path / "waves"))) == rows(P.clean_fact_frame(spark, str(tmp_path / "whole")))


def test_raw_star_is_compressed_and_read_back(spark, tmp_path, small_waves):
    from snaplytics.sources.regional_csv import read_regional_csv

    template = D.write_raw_star(spark, SF_SMALL, str(tmp_path / "csv"))
    files = [p for p in (tmp_path / "csv").rglob("part-*")]
    assert files and all(p.name.endswith(".csv.gz") for p in files)
    want = D.raw_star(spark, SF_SMALL)
    back = read_regional_csv(spark, str(tmp_path / "csv"), ["AF", "AM", "AS", "EU", "MI"], template)
    assert P.packed(back) == P.PACKED
    assert rows(back.select(*want.columns)) == rows(want)


@pytest.mark.parametrize("name, left", [("pipeline_job", set()), ("load_refresh_twice", set()), ("load_job", {"load-tables"})])
def test_jobs_leave_only_what_their_results_read(spark, name, left, small_waves):
    before, shuffled = scratch(spark), shuffle_files(spark)
    out = rows(QUERIES[name](spark, SF_SMALL))
    assert {n.rsplit("-", 1)[0] for n in scratch(spark) - before} == left
    assert shuffle_files(spark) <= shuffled
    star = D.fact_star(spark, SF_SMALL).withColumn("region", D.region_code(F.col("region")))
    clean = keep_max_per_key(star, FACT_KEY, by="views")
    if name == "load_job":
        assert out == rows(clean)
    elif name == "pipeline_job":
        assert [r[:6] for r in out] == [(False, star.count(), clean.count(), 25, clean.count(), 25), (True, star.count(), clean.count(), 25, None, None)]
    else:
        n = {r[0]: r[1] for r in clean.groupBy("region").count().collect()}
        assert out == sorted([(s, r, n[r], 25) for s in ("first", "failed") for r in n] + [("second", r, n[r], 24) for r in n if r != "AS"], key=repr)


def test_version_whose_write_fails_is_deleted(spark, tmp_path):
    names = [f"gone_{x}_{uuid.uuid4().hex[:6]}" for x in ("fact", "dim")]
    fact, dim = small_pair(spark)
    broken = fact.withColumn("title", F.when(F.col("region") == "US", F.raise_error(F.lit("half way")).cast("string")).otherwise(F.lit("t")))
    with pytest.raises(Exception, match="half way"):
        K.refresh_pair(broken, dim, *names, str(tmp_path), [["CA"], ["US"]])
    assert not [f for _, _, files in os.walk(tmp_path) for f in files]
    K.refresh_pair(fact, dim, *names, str(tmp_path), [["CA"], ["US"]])
    assert sorted(r.region for r in spark.table(names[0]).collect()) == ["CA", "US"]
