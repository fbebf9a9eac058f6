"""Load (T3), export and the end-to-end batch pipeline (T4)."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from snaplytics import sinks as K
from snaplytics.functions import expressions as X
from snaplytics.operators import quality as Q
from snaplytics.plans.reports import REPORT_FILES, all_reports
from snaplytics.plans.transform import StageMetrics, counted_fact, load_inputs
from snaplytics.schemas import (DIM_MAX_LENGTHS, FACT_COLUMNS, FACT_KEY, MAX_LENGTHS, NOT_NULL_DIM,
                                NOT_NULL_FACT)
from snaplytics.sinks.staging import SPLIT_BYTES, in_wave, region_waves, setting, shuffles_end_with_queries
from snaplytics.sources.manifest import input_manifest
from snaplytics.sources.parquet import read_dimension, read_fact
from snaplytics.sources.regional_csv import MISSING_TEXTS


@dataclass
class Paths:
    processed: str

    @property
    def fact(self) -> str:
        return f"{self.processed.rstrip('/')}/trending"

    @property
    def dim(self) -> str:
        return f"{self.processed.rstrip('/')}/categories.parquet"


#: Bytes of raw files that are not worth a wave of their own; about so many times the rows are in compressed ones.
WAVE_BYTES, PACKED = 256 << 20, 8


def packed(raw: DataFrame) -> int:
    """How many times the usual rows a byte of the files holds."""
    return PACKED if any(f.endswith((".gz", ".bz2", ".snappy", ".lz4", ".zst", ".deflate")) for f in raw.inputFiles()) else 1


@contextmanager
def splits_for(spark: SparkSession, times: int) -> Iterator[None]:
    """Tasks read so many times fewer bytes of input."""
    if times == 1:
        yield
        return
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    with setting(spark, SPLIT_BYTES, str(max(split // times, 1 << 20))):
        yield


def run_transform(spark: SparkSession, raw_dir: str, processed_dir: str, regions: list[str] | None = None,
                  csv_template: str = X.CSV_NAME_TEMPLATE, json_template: str = X.JSON_NAME_TEMPLATE,
                  multiline="auto", category_regions: list[str] | None = None, surplus: str = "raise",
                  missing_texts: tuple[str, ...] = MISSING_TEXTS) -> dict:
    """T1 + T2: build and write the dimension, then clean and write the fact.

    Returns stage metrics (V2, V3, V9), in all and by region: raw, complete and negative rows are
    observed in the writing stage, clean and dimension rows are counted in the written files'
    footers. Also the number of input files and the configured regions that had none (S8).
    A key holds its region, so large inputs are cleaned and written wave by wave of regions, each with
    its shuffles alone on disk.
    """
    regions = regions or X.DEFAULT_REGIONS
    paths = Paths(processed_dir)
    inputs: dict = {}
    raw, dim = load_inputs(spark, raw_dir, regions, csv_template, json_template, multiline,
                           category_regions, inputs, surplus, missing_texts)
    K.write_dimension(dim, paths.dim)
    metrics = StageMetrics(regions)
    manifest = input_manifest(spark, raw_dir, regions, csv_template, json_template).where("kind = 'csv' AND files > 0")
    times = packed(raw)
    waves = region_waves({r["region"]: r["bytes"] for r in manifest.collect()}, WAVE_BYTES // times)
    parts = (metrics.observe(counted_fact(in_wave(raw, wave), K.layout_fact)) for wave in waves)
    with splits_for(spark, times):
        K.write_waves((part.where("__real").select(*FACT_COLUMNS) for part in parts), len(waves), paths.fact)
    clean = Q.committed_rows(spark, paths.fact)
    return {**metrics.get(clean), "dim_rows": read_dimension(spark, paths.dim).count(), **inputs}


def run_load(spark: SparkSession, processed_dir: str, fact_table: str = "trending_statistics",
             dim_table: str = "categories", location: str | None = None, copy: bool = False) -> dict:
    """Read both Parquet sets, check constraints (V4-V8), then refresh the
    dimension table before the fact table (K3, K4, K6).

    By default the checked Parquet folders become the tables (external tables declared by
    the DDL, metadata only: no second copy of the fact). ``copy=True`` copies the rows into
    new versions of both tables, under ``location`` when given, and publishes the pair
    at once. Both are idempotent full refreshes, so re-running after a failure is safe.
    """
    paths = Paths(processed_dir)
    fact, dim = read_fact(spark, paths.fact), read_dimension(spark, paths.dim)
    with shuffles_end_with_queries(spark):
        summary = Q.violation_summary(fact, dim, FACT_KEY, "category_id", NOT_NULL_FACT, NOT_NULL_DIM,
                                      MAX_LENGTHS, DIM_MAX_LENGTHS)
    Q.assert_loadable(summary)
    if copy:
        waves = region_waves(Q.committed_rows(spark, paths.fact))
        K.refresh_pair(fact, dim, fact_table, dim_table, location or f"{processed_dir.rstrip('/')}/tables", waves)
    else:
        K.register_table(spark, dim_table, K.dim_ddl(dim_table, paths.dim))
        K.register_table(spark, fact_table, K.fact_ddl(fact_table, paths.fact))
    return summary


def run_export(spark: SparkSession, processed_dir: str, out_dir: str) -> dict[str, str]:
    """The seven reports as CSV files (K5)."""
    paths = Paths(processed_dir)
    fact, dim = read_fact(spark, paths.fact), read_dimension(spark, paths.dim)
    written = {}
    for name, frame in all_reports(fact, dim).items():
        target = f"{out_dir.rstrip('/')}/{REPORT_FILES[name]}"
        K.write_report_csv(frame, target, ordered=name != "region_sample")
        written[name] = target
    return written


def run_pipeline(spark: SparkSession, raw_dir: str, processed_dir: str, skip_load: bool = False,
                 regions: list[str] | None = None, table_location: str | None = None,
                 copy_tables: bool = False, fact_table: str = "trending_statistics",
                 dim_table: str = "categories", **kw) -> dict:
    """T4: transform, then (unless skipped) load; the first failure raises."""
    status = {"transform": run_transform(spark, raw_dir, processed_dir, regions, **kw)}
    if not skip_load:
        status["load"] = run_load(spark, processed_dir, fact_table, dim_table, table_location, copy_tables)
    return status


def clean_fact_frame(spark: SparkSession, processed_dir: str) -> DataFrame:
    return read_fact(spark, Paths(processed_dir).fact)
