"""The transform job: category dimension (T1) and clean snapshot fact."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from snaplytics.functions import expressions as X
from snaplytics.operators import clean as C
from snaplytics.operators.dedup import keep_max_per_key, last_wins
from snaplytics.schemas import FACT_COLUMNS, FACT_KEY
from snaplytics.sources.category_json import read_category_items
from snaplytics.sources.manifest import input_manifest, missing
from snaplytics.sources.regional_csv import MISSING_TEXTS, read_regional_csv


class TransformAborted(RuntimeError):
    """Nothing to build from (no categories, no regional input)."""


@dataclass
class StageMetrics:
    """V2 / V3: row counts per region that survive retries.

    The rows dropped as incomplete stay in the job as one row per region, and every row that
    comes out of dedup carries the number of rows it stands for. So all counts can be
    observed in the stage that writes, whose tasks count once each however often they or the
    stages before them run again; and there is no extra pass over the input. Each wave of regions
    that is written on its own is observed on its own; the counts are added up.
    """
    regions: list[str]
    observations: list[Observation] = field(default_factory=list)

    def observe(self, counted: DataFrame) -> DataFrame:
        """Attach the counters to rows of ``counted_fact``; call it above the last shuffle."""
        aggs = []
        for i, r in enumerate(self.regions):
            here = F.col("region") == r
            real = here & F.col("__real")
            aggs += [F.coalesce(F.sum(F.when(here, F.col("__merged"))), F.lit(0)).alias(f"raw_rows_{i}"),
                     F.coalesce(F.sum(F.when(real, F.col("__merged"))), F.lit(0)).alias(f"complete_rows_{i}"),
                     F.count_if(real & F.col("__negative")).alias(f"negative_rows_{i}")]
        self.observations.append(Observation(f"stage_counts_{len(self.observations)}"))
        return counted.observe(self.observations[-1], *aggs)

    def get(self, clean_rows: dict[str, int]) -> dict:
        """Counts in all and by region, once the write is over; ``clean_rows`` come from its output."""
        seen = [o.get for o in self.observations]
        by_region = {r: {k: sum(s.get(f"{k}_{i}", 0) for s in seen) for k in ("raw_rows", "complete_rows", "negative_rows")}
                     | {"clean_rows": clean_rows.get(r, 0)} for i, r in enumerate(self.regions)}
        out: dict = {k: sum(c[k] for c in by_region.values())
                     for k in ("raw_rows", "complete_rows", "negative_rows", "clean_rows")}
        if out["raw_rows"]:
            out["quality_rate"] = out["clean_rows"] / out["raw_rows"]
        out["by_region"] = by_region
        return out


def build_category_dim(items: DataFrame) -> DataFrame:
    """One title per id, the last configured region (then last entry) wins."""
    return last_wins(items, "category_id", "category_title", ["region_ord", "pos"]) \
        .select(F.col("category_id").cast("int"), "category_title")


DERIVED = ("engagement_rate", "trending_day", "publish_hour")


def typed_rows(raw: DataFrame) -> DataFrame:
    """Fill, parse and cast; every base column of the fact is there (missing ones NULL)."""
    df = C.type_raw(C.fill_text_defaults(raw))
    for c in FACT_COLUMNS:
        if c not in df.columns and c not in DERIVED:
            df = df.withColumn(c, F.lit(None).cast("string"))
    return df


def clean_fact(raw: DataFrame) -> DataFrame:
    """T2 on raw all-string rows with ``region``: the 20-column clean fact.

    fill -> parse -> drop incomplete -> cast category -> dedup (exact + keep max
    views per key as one total-order aggregation) -> features -> clamp.
    """
    df = C.cast_category(C.drop_incomplete(typed_rows(raw)))
    base = [c for c in FACT_COLUMNS if c not in DERIVED]
    df = keep_max_per_key(df.select(*base), FACT_KEY, by="views")
    return C.clamp_counters(C.add_features(df)).select(*FACT_COLUMNS)


def counted_fact(raw: DataFrame, lay_out: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """``clean_fact`` with what ``StageMetrics`` counts: ``__real`` rows are the fact, and one other row
    per region stands for its incomplete ones; ``__merged`` rows went into each. ``lay_out`` gets the rows
    before columns are derived, which so don't go through its shuffle (it reads counters below 0 as 0)."""
    df = typed_rows(raw)
    real = F.lit(True)
    for c in C.CRITICAL_COLUMNS:
        real = real & F.col(c).isNotNull()
    df = C.cast_category(df.withColumn("__real", real))
    base = [c for c in FACT_COLUMNS if c not in DERIVED]
    df = df.select("__real", *[c if c == "region" else F.when(F.col("__real"), F.col(c)).alias(c) for c in base])
    df = lay_out(keep_max_per_key(df, [*FACT_KEY, "__real"], by="views", merged="__merged"))
    df = df.withColumn("__negative", X.any_negative())
    return C.clamp_counters(C.add_features(df)).select(*FACT_COLUMNS, "__real", "__merged", "__negative")


def load_inputs(spark: SparkSession, raw_dir: str, regions: list[str] | None = None,
                csv_template: str = X.CSV_NAME_TEMPLATE, json_template: str = X.JSON_NAME_TEMPLATE,
                multiline="auto", category_regions: list[str] | None = None,
                report: dict | None = None, surplus: str = "raise",
                missing_texts: tuple[str, ...] = MISSING_TEXTS) -> tuple[DataFrame, DataFrame]:
    """S1-S4 + S10: (raw rows, category dimension) or TransformAborted.

    ``category_regions`` defaults to ``regions`` (one list configures both inputs).
    """
    items = read_category_items(spark, raw_dir, category_regions or regions, json_template)
    if items is None or items.isEmpty():
        raise TransformAborted("no category mapping could be parsed")
    raw = read_regional_csv(spark, raw_dir, regions, csv_template, multiline, report, surplus, missing_texts)
    if raw is None:
        raise TransformAborted("no regional input found")
    if report is not None:
        manifest = input_manifest(spark, raw_dir, regions, csv_template, json_template, category_regions)
        report["missing_category_regions"] = missing(manifest, "json")
    return raw, build_category_dim(items)
