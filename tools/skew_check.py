"""Empirical skew check from Spark's event log (no UI).

Builds a fact from the generated tables in which one item holds about a third
of all rows, runs the skew-sensitive operators, and reports for every stage
that reads shuffle data the largest and the median number of shuffle records
read by one task. A hot key that is collapsed map-side shows up as a small
maximum; one that lands whole in a task shows up as max ~ a third of the rows.

Usage: python tools/skew_check.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from snaplytics.operators.dedup import keep_max_per_key  # noqa: E402
from snaplytics.plans import analytics as A  # noqa: E402
from snaplytics.plans import reports as E  # noqa: E402
from snaplytics.schemas import FACT_KEY  # noqa: E402
from snaplytics.session import build_session  # noqa: E402
from snaplytics.sources.driver_tables import category_dim, fact_star  # noqa: E402


def hot_fact(spark, sf_dir):
    """fact_star where every line item with line number <= 2 belongs to item 'HOT' on one day."""
    f = fact_star(spark, sf_dir)
    hot = F.col("likes") <= 17          # roughly a third of the line items (quantity 1..50)
    return (f.withColumn("video_id", F.when(hot, F.lit("HOT")).otherwise(F.col("video_id")))
             .withColumn("trending_date", F.when(hot, F.lit("2000-01-01").cast("date"))
                         .otherwise(F.col("trending_date"))))


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="snaplytics-eventlog-")
    # no partition coalescing, so each post-shuffle task reads one hash partition:
    # a hot key that is not collapsed map-side makes one task read ~a third of all rows
    spark = build_session("local[8]", shuffle_partitions=32,
                          extra={"spark.sql.adaptive.coalescePartitions.enabled": "false",
                                 "spark.eventLog.enabled": "true",
                                             "spark.eventLog.dir": log_dir,
                                             "spark.eventLog.compress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    fact = hot_fact(spark, sf_dir).checkpoint()
    total = fact.count()
    hot = fact.where(F.col("video_id") == "HOT").count()
    dim = category_dim(spark, sf_dir)
    jobs = {
        "keep_max_per_key (D2)": keep_max_per_key(fact, FACT_KEY, by="views"),
        "top_categories_per_region (R1)": A.top_categories_per_region(fact, dim),
        "top_engaged_items (R4)": A.top_engaged_items(fact, min_views=0),
        "report_top_viewed (E1)": E.report_top_viewed(fact, dim),
        "report_region_sample (E7)": E.report_region_sample(fact, dim),
    }
    for name, df in jobs.items():
        spark.sparkContext.setJobDescription(name)
        df.write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobDescription(None)
    spark.stop()

    stage_job, job_name, reads = {}, {}, {}
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    desc = (ev.get("Properties") or {}).get("spark.job.description")
                    job_name[ev["Job ID"]] = desc
                    for sid in ev.get("Stage IDs", []):
                        stage_job[sid] = ev["Job ID"]
                elif kind == "SparkListenerTaskEnd":
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                    n = m.get("Total Records Read", 0)
                    if n:
                        reads.setdefault(ev["Stage ID"], []).append(n)
    print(f"rows={total} hot-item rows={hot} ({hot / total:.0%})")
    worst = {}
    for sid, counts in sorted(reads.items()):
        name = job_name.get(stage_job.get(sid))
        if name:
            worst.setdefault(name, []).append((max(counts), statistics.median(counts), len(counts)))
    print(f"{'job':34s} {'max/task':>9s} {'median/task':>12s}  (stage with the largest max)")
    for name in jobs:
        stages = worst.get(name, [])
        if not stages:
            print(f"{name:34s} no shuffle read")
            continue
        top = max(stages)
        print(f"{name:34s} {top[0]:9d} {top[1]:12.0f}  tasks={top[2]}")


if __name__ == "__main__":
    main()
