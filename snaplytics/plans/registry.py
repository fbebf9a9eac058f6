"""Named queries over the generated tables: one entry per operator / job.

Each callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame; the whole
tables are read every time (no row caps, no key subsets).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaplytics import sinks as K
from snaplytics.functions import expressions as X
from snaplytics.operators import clean as C
from snaplytics.operators import quality as Q
from snaplytics.operators.dedup import dedup_exact, keep_max_per_key
from snaplytics.operators.joins import join_dimension, orphans
from snaplytics.plans import analytics as A
from snaplytics.plans import etl as P
from snaplytics.plans import reports as E
from snaplytics.plans import views as V
from snaplytics.plans.transform import build_category_dim
from snaplytics.schemas import DIM_MAX_LENGTHS, FACT_COLUMNS, FACT_KEY, MAX_LENGTHS, NOT_NULL_DIM, NOT_NULL_FACT
from snaplytics.session import apply_defaults, scratch_path
from snaplytics.sinks.raw_inputs import write_category_json, write_regional_csv, write_regional_lines
from snaplytics.sinks.staging import region_waves, remove, write_by_region
from snaplytics.sources.category_json import read_category_items
from snaplytics.sources.driver_tables import (category_dim, category_items, category_items_coded, enrich, raw_events, raw_star,
                                              region_code, region_order, staged_star, table, write_raw_star)
from snaplytics.sources.driver_tables import events_fact as fact_events
from snaplytics.sources.driver_tables import star as fact_star
from snaplytics.sources.manifest import input_manifest
from snaplytics.sources.parquet import read_dimension, read_fact
from snaplytics.sources.regional_csv import csv_rejects, read_regional_csv

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def event_regions(spark: SparkSession, d: str) -> list[str]:
    """The regions to configure: every event type of the table (a handful by nature)."""
    return [r[0] for r in table(spark, d, "events").select("event_type").distinct().orderBy("event_type").collect() if r[0] is not None]


def fresh_name(table_name: str) -> str:
    """A catalog name of its own for each call."""
    return f"{table_name}_{uuid.uuid4().hex[:8]}"


def query(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_defaults(spark)
            return fn(spark, sf_dir)
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


# -- analytics (R1-R6) ------------------------------------------------------

@query("top_categories_per_region")
def _r1(spark, d):
    """R1 J1 A1 A4 A8 W1 C7 O1."""
    return A.top_categories_per_region(fact_star(spark, d), category_dim(spark, d))


@query("top_channels_by_max_likes")
def _r2(spark, d):
    """R2 A3 A6 A9 O3."""
    return A.top_channels_by_max_likes(fact_star(spark, d))


@query("regional_performance")
def _r3(spark, d):
    """R3 A7 A11 A12 O2 F7 F8 F10."""
    return A.regional_performance(fact_star(spark, d))


@query("top_engaged_items")
def _r4(spark, d):
    """R4 C5 C6 W2 F16 O3."""
    return A.top_engaged_items(fact_star(spark, d))


@query("weekday_pattern")
def _r5(spark, d):
    """R5 A2 A5 O5 F6."""
    return A.weekday_pattern(fact_star(spark, d))


@query("views_by_region_sample")
def _r6(spark, d):
    """R6."""
    return A.views_by_region_sample(fact_star(spark, d))


@query("dashboard_view")
def _b1(spark, d):
    """B1 K8 C4 J1."""
    fact_star(spark, d).createOrReplaceTempView("snapshot_fact")
    category_dim(spark, d).createOrReplaceTempView("category_dim")
    return V.create_dashboard_view(spark, "snapshot_fact", "category_dim", "dashboard_view")


# -- reports (E1-E7) --------------------------------------------------------

@query("report_top_viewed")
def _e1(spark, d):
    """E1 D3 O4 J2."""
    return E.report_top_viewed(fact_star(spark, d), category_dim(spark, d))


@query("report_category")
def _e2(spark, d):
    """E2 A10 A13 J2 (events fact: most categories have no dimension row)."""
    return E.report_category(fact_events(spark, d), category_dim(spark, d))


@query("report_region")
def _e3(spark, d):
    """E3 A10 A13."""
    return E.report_region(fact_star(spark, d))


@query("report_weekday")
def _e4(spark, d):
    """E4 J3."""
    return E.report_weekday(fact_events(spark, d))


@query("report_publish_hour")
def _e5(spark, d):
    """E5 O6 C15."""
    return E.report_publish_hour(fact_events(spark, d))


@query("report_top_channels")
def _e6(spark, d):
    """E6 O4."""
    return E.report_top_channels(fact_star(spark, d))


@query("report_region_sample")
def _e7(spark, d):
    """E7 W3."""
    return E.report_region_sample(fact_star(spark, d), category_dim(spark, d))


# -- cleaning, dedup, joins, validation (C, D, J, V) ---------------------------

@query("dedup_exact")
def _d1(spark, d):
    """Lineitem appended to itself, exact duplicates dropped."""
    li = table(spark, d, "lineitem")
    return dedup_exact(li.unionAll(li))


@query("dedup_keep_max")
def _d2(spark, d):
    """One events snapshot per (item, day, region) at peak views."""
    return keep_max_per_key(fact_events(spark, d), FACT_KEY, by="views")


@query("clean_fill_text")
def _c2(spark, d):
    """NULL description / tags filled."""
    return C.fill_text_defaults(raw_events(spark, d)).select("event_id", "description", "tags")


@query("parse_dates")
def _c8(spark, d):
    """Yy.dd.MM snapshot dates, invalid -> NULL."""
    return raw_events(spark, d).select("event_id", X.parse_trending_date("trending_date").alias("trending_date"))


@query("parse_timestamps")
def _c9(spark, d):
    """ISO publish timestamps, invalid -> NULL."""
    return raw_events(spark, d).select("event_id", X.parse_publish_time("publish_time").alias("publish_time"))


@query("cast_category")
def _c10(spark, d):
    """Category id text -> int, truncating."""
    return raw_events(spark, d).select("event_id", X.to_int_truncating("category_id").alias("category_id"))


@query("clean_dropna")
def _c3(spark, d):
    """Typed rows with all of publish_time / trending_date / category_id."""
    typed = C.cast_category(C.drop_incomplete(C.type_raw(raw_events(spark, d))))
    return typed.select("event_id", "video_id", "trending_date", "publish_time", "category_id",
                        "views", "likes", "dislikes", "comment_count", "comments_disabled")


@query("engagement_features")
def _c11(spark, d):
    """Engagement (nulls as 0, guarded, half-even 4 dp), weekday, hour."""
    return fact_events(spark, d).select("video_id", "trending_date", "region", "views", "likes", "dislikes",
                                        "comment_count", "engagement_rate", "trending_day", "publish_hour")


@query("clamp_negative")
def _c16(spark, d):
    """Negative flag, then counters clamped at 0 (NULL stays NULL)."""
    f = C.negative_flag(fact_events(spark, d))
    return C.clamp_counters(f).select("video_id", "trending_date", "region", "publish_time", "views", "likes",
                                      "dislikes", "comment_count", "engagement_rate", "has_negative")


@query("negative_rows")
def _v1(spark, d):
    """V1: rows with a negative counter."""
    return Q.count_negative(fact_events(spark, d))


@query("total_interactions")
def _c5(spark, d):
    """NULL-propagating interactions on snapshots with views >= 10,000."""
    f = C.min_threshold(fact_events(spark, d), "views", 10_000)
    return C.interactions(f).select("video_id", "trending_date", "region", "views", "total_interactions")


@query("inner_join")
def _j1(spark, d):
    """Events fact ⋈ dimension (orphans vanish)."""
    return join_dimension(fact_events(spark, d), category_dim(spark, d), how="inner") \
        .select("video_id", "trending_date", "region", "category_id", "category_title", "views")


@query("left_join")
def _j2(spark, d):
    """Events fact ⟕ dimension (orphans keep a NULL title)."""
    return join_dimension(fact_events(spark, d), category_dim(spark, d), how="left") \
        .select("video_id", "trending_date", "region", "category_id", "category_title", "views")


@query("orphans")
def _j4(spark, d):
    """Fact rows whose category has no dimension row."""
    return orphans(fact_events(spark, d), category_dim(spark, d)) \
        .select("video_id", "trending_date", "region", "category_id", "views")


@query("union_regions")
def _u1(spark, d):
    """Two inputs with different column order, header case and one
    column missing, lower-cased and unioned by name."""
    ev = table(spark, d, "events")
    low = F.coalesce(F.col("value") < 100, F.lit(False))  # a NULL value is in the second input
    a = ev.where(low).select(
        F.col("event_id").alias("Event_ID"), F.col("event_type").alias("REGION"),
        F.col("value").alias("Value"), F.col("props").alias("Props"))
    b = ev.where(~low).select(
        F.col("value").alias("VALUE"), F.col("event_type").alias("Region"), F.col("event_id").alias("event_id"))
    return C.union_by_name([C.lower_columns(a), C.lower_columns(b)])


@query("key_violations")
def _v4(spark, d):
    """V4: (l_orderkey, l_linenumber) values that occur more than once."""
    return Q.key_violations(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("null_violations")
def _v5(spark, d):
    """V5: NULL counts in columns that must not be NULL."""
    return Q.null_violations(fact_events(spark, d), ["video_id", "category_id", "likes", "publish_time"])


@query("length_violations")
def _v6(spark, d):
    """V6: values longer than their declared maximum."""
    return Q.length_violations(table(spark, d, "part"), {"p_name": 10, "p_type": 7, "p_brand": 7})


@query("stage_metrics")
def _v2(spark, d):
    """V2 V3: raw, complete and deduplicated row counts and the quality rate."""
    typed = C.cast_category(C.type_raw(raw_events(spark, d)))
    return Q.stage_counts(typed, FACT_KEY, C.CRITICAL_COLUMNS)


@query("region_filter")
def _s7(spark, d):
    """Only the configured regions."""
    f = fact_star(spark, d)
    return f.where(F.col("region").isin(["AMERICA", "ASIA"])).select(
        "video_id", "trending_date", "region", "views", "engagement_rate")


# -- file round trips and the pipeline (S, K, T) ------------------------------

@query("csv_roundtrip")
def _s1(spark, d):
    """Events staged as regional CSVs (one region Latin-1 with
    another column order, mixed-case headers, quoted newlines), read back by name."""
    raw = raw_events(spark, d)
    out = scratch_path(spark, "raw-csv")
    rename = {"video_id": "Video_ID", "views": "Views", "title": "TITLE"}
    latin1_order = list(reversed([c for c in raw.columns if c != "region"]))
    template = write_regional_csv(raw, out, ["click"], rename, latin1_order)
    back = read_regional_csv(spark, out, [*event_regions(spark, d), "no_input"], template)
    return back.select("event_id", "region", "video_id", "title", "description", "views", "trending_date")


@query("parquet_partition_roundtrip")
def _k2(spark, d):
    """Events fact and dimension written as Parquet (fact
    partitioned by region) and read back."""
    base = scratch_path(spark, "parquet")
    K.write_fact(fact_events(spark, d), f"{base}/trending")
    K.write_dimension(category_dim(spark, d), f"{base}/categories.parquet")
    fact = read_fact(spark, f"{base}/trending")
    return join_dimension(fact, read_dimension(spark, f"{base}/categories.parquet"), how="left") \
        .select(*FACT_COLUMNS, "category_title")


@query("category_dim_build")
def _t1(spark, d):
    """Per-region category JSON documents, parsed and merged;
    the last configured region wins for an id listed twice."""
    out = scratch_path(spark, "raw-json")
    template = write_category_json(category_items(spark, d), out)
    regions = [r["r_name"] for r in region_order(spark, d).orderBy("r_regionkey").collect()]
    return build_category_dim(read_category_items(spark, out, regions, template))


@query("transform_job")
def _t2(spark, d):
    """Raw events as regional CSV + category JSON -> transform job
    (fill, parse, drop, cast, dedup, features, clamp) -> partitioned Parquet."""
    raw_dir = scratch_path(spark, "etl-raw")
    processed = scratch_path(spark, "etl-out")
    raw = raw_events(spark, d).drop("event_id")
    csv_t = write_regional_csv(raw, f"{raw_dir}/csv")
    json_t = write_category_json(category_items(spark, d), f"{raw_dir}/json")
    regions = event_regions(spark, d)
    category_regions = [r["r_name"] for r in region_order(spark, d).orderBy("r_regionkey").collect()]
    P.run_transform(spark, raw_dir, processed, regions, csv_template=f"csv/{csv_t}",
                    json_template=f"json/{json_t}", category_regions=category_regions)
    return P.clean_fact_frame(spark, processed)


@query("table_roundtrip")
def _k3(spark, d):
    """The dimension refreshed as a declared external table."""
    name = fresh_name("snap_categories")
    return K.refresh_table(category_dim(spark, d), name, K.dim_ddl(name, scratch_path(spark, "tables")))


@query("load_job")
def _t3(spark, d):
    """The lineitem star as raw regional files -> transform -> constraint
    checks -> rows copied into tables declared by DDL; the fact is read from its table."""
    raw_dir, processed, tables = (scratch_path(spark, f"load-{x}") for x in ("raw", "out", "tables"))
    csv_t = write_raw_star(spark, d, f"{raw_dir}/csv")
    json_t = write_category_json(category_items_coded(spark, d), f"{raw_dir}/json")
    regions = [r[0] for r in region_order(spark, d).orderBy("r_regionkey").select(region_code("r_name")).collect()]
    P.run_transform(spark, raw_dir, processed, regions, csv_template=f"csv/{csv_t}", json_template=f"json/{json_t}")
    remove(spark, raw_dir)
    fact, dim = fresh_name("load_fact"), fresh_name("load_dim")
    P.run_load(spark, processed, fact, dim, location=tables, copy=True)
    remove(spark, processed)
    return spark.table(fact).select(*FACT_COLUMNS)


@query("load_violations")
def _v8(spark, d):
    """V4-V8: the load checks over the events fact (it has orphans and repeated keys), one row each."""
    summary = Q.violation_summary(fact_events(spark, d), category_dim(spark, d), FACT_KEY, "category_id",
                                  NOT_NULL_FACT, NOT_NULL_DIM, MAX_LENGTHS, DIM_MAX_LENGTHS)
    return spark.createDataFrame(sorted(summary.items()), "check_name string, violations bigint")


@query("category_dim_malformed")
def _s9(spark, d):
    """Category documents of which one is broken, and later entries without a title:
    neither replaces a good title."""
    out = scratch_path(spark, "raw-json-broken")
    items = category_items(spark, d)
    last = F.col("region") == "MIDDLE EAST"
    items = items.withColumn("category_title", F.when(~last, F.col("category_title")))
    template = write_category_json(items, out)
    broken = table(spark, d, "region").filter("r_name = 'ASIA'").select(F.lit('{"items": [{"id": "1", ').alias("value"), F.col("r_name").alias("region"))
    broken.write.mode("append").partitionBy("region").text(f"{out}")
    regions = [r["r_name"] for r in region_order(spark, d).orderBy("r_regionkey").collect()]
    return build_category_dim(read_category_items(spark, out, regions, template))


@query("load_refresh_twice")
def _k4(spark, d):
    """Both tables loaded three times as a pair, with dynamic partition overwrite set:
    all regions; a load that fails between the tables; all regions but one. Rows per region
    and dimension rows after each."""
    fact_table, dim_table = fresh_name("refresh_fact"), fresh_name("refresh_dim")
    root = scratch_path(spark, "refresh")
    # the rows to load are written once: the three loads read them, and don't each deduplicate the fact anew
    rows = scratch_path(spark, "refresh-rows")
    with staged_star(spark, d, region_code) as (star, waves):
        fact = write_by_region(enrich(keep_max_per_key(star, FACT_KEY, by="views")), rows, waves)
    waves = region_waves(Q.committed_rows(spark, rows))
    dim = category_dim(spark, d)
    fewer = fact.where("region <> 'AS'"), dim.where("category_id <> 0")
    broken = fewer[0].withColumn("title", F.raise_error(F.lit("fails between the tables")).cast("string"))
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    seen = []
    try:
        for step, pair in (("first", (fact, dim)), ("failed", (broken, fewer[1])), ("second", fewer)):
            try:
                K.refresh_pair(*pair, fact_table, dim_table, root, waves)
            except Exception as ex:
                if step != "failed" or "fails between the tables" not in str(ex):
                    raise
            counts = spark.table(fact_table).groupBy("region").agg(F.count(F.lit(1)).alias("fact_rows"))
            dims = spark.table(dim_table).count()
            seen += [(step, r["region"], r["fact_rows"], dims) for r in counts.collect()]  # one row a region
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
        for name in (fact_table, dim_table):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        remove(spark, rows, root)
    return spark.createDataFrame(seen, "step string, region string, fact_rows bigint, dim_rows bigint")


@query("csv_rejects")
def _s1r(spark, d):
    """Events as regional CSV lines; every 97th record has surplus fields, every 89th one too few."""
    ev = table(spark, d, "events")
    text = F.concat_ws(",", "event_id", "user_id", F.concat(F.lit('"'), F.col("event_type"), F.lit(', x"')))
    line = F.when(F.col("event_id") % 97 == 0, F.concat(text, F.lit(",9,EXTRA"))) \
        .when(F.col("event_id") % 89 == 0, F.concat_ws(",", "event_id", "user_id")).otherwise(text)
    out = scratch_path(spark, "raw-lines")
    template = write_regional_lines(ev.select(line.alias("line"), F.col("event_type").alias("region")), out, "event_id,user_id,note")
    back = csv_rejects(spark, out, event_regions(spark, d), template)
    return back.select("region", F.col("_record").alias("record"))


@query("input_manifest")
def _s8(spark, d):
    """Configured regions against staged inputs; one region has no CSV, another no JSON."""
    raw_dir = scratch_path(spark, "manifest-raw")
    star = raw_star(spark, d)
    csv_t = write_regional_csv(star.where("region <> 'AF'"), f"{raw_dir}/csv")
    json_t = write_category_json(category_items_coded(spark, d).where("region <> 'EU'"), f"{raw_dir}/json")
    regions = [r[0] for r in region_order(spark, d).orderBy("r_regionkey").select(region_code("r_name")).collect()]
    manifest = input_manifest(spark, raw_dir, [*regions, "ZZ"], f"csv/{csv_t}", f"json/{json_t}")
    return manifest.select("region", "kind", "ord", (F.col("files") > 0).alias("has_files"), (F.col("bytes") > 0).alias("has_bytes"))


@query("stage_counts_by_region")
def _v2r(spark, d):
    """The transform job over raw events; its row counts per region."""
    raw_dir, processed = scratch_path(spark, "counts-raw"), scratch_path(spark, "counts-out")
    csv_t = write_regional_csv(raw_events(spark, d).drop("event_id"), f"{raw_dir}/csv")
    json_t = write_category_json(category_items(spark, d), f"{raw_dir}/json")
    category_regions = [r["r_name"] for r in region_order(spark, d).orderBy("r_regionkey").collect()]
    metrics = P.run_transform(spark, raw_dir, processed, event_regions(spark, d), csv_template=f"csv/{csv_t}",
                              json_template=f"json/{json_t}", category_regions=category_regions)
    rows = [(r, *(c[k] for k in ("raw_rows", "complete_rows", "clean_rows", "negative_rows"))) for r, c in metrics["by_region"].items()]
    return spark.createDataFrame(rows, "region string, raw_rows bigint, complete_rows bigint, clean_rows bigint, negative_rows bigint")


@query("pipeline_job")
def _t4(spark, d):
    """The batch pipeline over the lineitem star, first without the load, then with it:
    its row counts and the rows of both tables (NULL where the load was skipped)."""
    raw_dir = scratch_path(spark, "batch-raw")
    csv_t = write_raw_star(spark, d, f"{raw_dir}/csv")
    json_t = write_category_json(category_items_coded(spark, d), f"{raw_dir}/json")
    regions = [r[0] for r in region_order(spark, d).orderBy("r_regionkey").select(region_code("r_name")).collect()]
    seen = []
    for skip in (True, False):
        names = {"fact_table": fresh_name("batch_fact"), "dim_table": fresh_name("batch_dim")}
        processed = scratch_path(spark, "batch-out")
        status = P.run_pipeline(spark, raw_dir, processed, skip, regions, csv_template=f"csv/{csv_t}",
                                json_template=f"json/{json_t}", **names)
        t = status["transform"]
        loaded = [spark.table(n).count() if spark.catalog.tableExists(n) else None for n in names.values()]
        seen.append((skip, t["raw_rows"], t["clean_rows"], t["dim_rows"], *loaded, sum(status.get("load", {}).values())))
        for n in names.values():
            spark.sql(f"DROP TABLE IF EXISTS {n}")
        remove(spark, processed)
    remove(spark, raw_dir)
    return spark.createDataFrame(seen, "skip_load boolean, raw_rows bigint, clean_rows bigint, dim_rows bigint, "
                                       "fact_table_rows bigint, dim_table_rows bigint, violations bigint")


@query("report_export_roundtrip")
def _k5(spark, d):
    """K5: the seven reports exported as CSV files and read back: name, rows, and the sum of one measure."""
    base, out = scratch_path(spark, "export-in"), scratch_path(spark, "export-out")
    K.write_fact(fact_events(spark, d), P.Paths(base).fact)
    K.write_dimension(category_dim(spark, d), P.Paths(base).dim)
    measures = {"top_viewed": "views", "category": "total_views", "region": "total_views", "weekday": "trending_count",
                "publish_hour": "video_count", "top_channels": "total_views", "region_sample": "views"}
    parts = []
    for name, path in P.run_export(spark, base, out).items():
        back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
        parts.append(back.agg(F.lit(path.rsplit("/", 1)[-1]).alias("file"), F.count(F.lit(1)).alias("report_rows"),
                              F.sum(F.col(measures[name]).cast("bigint")).alias("measure")))
    return C.union_by_name(parts)


# -- the same analytics over the events fact: NULL likes, negative comments,
#    categories without a dimension row, 24 publish hours, 30 trending days -----

@query("top_categories_per_region_events")
def _r1e(spark, d):
    """R1 on events: orphans vanish through the inner join."""
    return A.top_categories_per_region(fact_events(spark, d), category_dim(spark, d))


@query("top_channels_by_max_likes_events")
def _r2e(spark, d):
    """R2 on events: items whose likes are all NULL contribute NULL maxima."""
    return A.top_channels_by_max_likes(fact_events(spark, d))


@query("regional_performance_events")
def _r3e(spark, d):
    """R3 on events: sums skip NULL likes; negative comments stay in the engagement."""
    return A.regional_performance(fact_events(spark, d))


@query("top_engaged_items_events")
def _r4e(spark, d):
    """R4 on events with a 10,000-view threshold (event views stay below 100,000)."""
    return A.top_engaged_items(fact_events(spark, d), min_views=10_000)


@query("weekday_pattern_events")
def _r5e(spark, d):
    """R5 on events."""
    return A.weekday_pattern(fact_events(spark, d))


@query("report_top_viewed_events")
def _e1e(spark, d):
    """E1 on events: unknown categories keep a NULL title."""
    return E.report_top_viewed(fact_events(spark, d), category_dim(spark, d))


@query("report_region_events")
def _e3e(spark, d):
    """E3 on events: means skip NULL likes."""
    return E.report_region(fact_events(spark, d))


@query("report_top_channels_events")
def _e6e(spark, d):
    """E6 on events."""
    return E.report_top_channels(fact_events(spark, d))


@query("report_region_sample_events")
def _e7e(spark, d):
    """E7 on events, 500 rows per region."""
    return E.report_region_sample(fact_events(spark, d), category_dim(spark, d), n=500)
