"""Run the batch pipeline: ``spark-submit -m snaplytics`` or ``python -m snaplytics``.

    python -m snaplytics --raw RAW_DIR --processed OUT_DIR [--regions US CA ...]
                         [--skip-load] [--tables TABLE_DIR] [--export DASHBOARD_DIR]
                         [--multiline auto|always|never]

Transform (dimension + clean fact), then load (constraint checks + tables)
unless skipped, then optionally the seven CSV reports. The first failing stage
stops the run with a non-zero exit code.
"""

from __future__ import annotations

import argparse
import json
import sys
import time

from snaplytics.functions.expressions import DEFAULT_REGIONS


def parse_args(argv=None):
    p = argparse.ArgumentParser(prog="snaplytics", description="snapshot analytics batch pipeline")
    p.add_argument("--raw", required=True, help="folder with {REGION}videos.csv / {REGION}_category_id.json")
    p.add_argument("--processed", required=True, help="output folder for the Parquet fact and dimension")
    p.add_argument("--regions", nargs="+", default=DEFAULT_REGIONS)
    p.add_argument("--skip-load", action="store_true", help="skip the constraint checks and table load")
    p.add_argument("--copy-tables", action="store_true",
                   help="load full-refresh table copies instead of registering the checked Parquet")
    p.add_argument("--tables", default=None, help="location of the table copies (with --copy-tables)")
    p.add_argument("--export", default=None, help="write the seven CSV reports to this folder")
    p.add_argument("--multiline", choices=["auto", "always", "never"], default="auto",
                   help="CSV records spanning lines: detect per file (default), or force a mode")
    return p.parse_args(argv)


def main(argv=None) -> int:
    args = parse_args(argv)
    from snaplytics.plans import etl as P
    from snaplytics.session import build_session

    spark = build_session()
    stages = {}
    try:
        t0 = time.perf_counter()
        status = P.run_pipeline(spark, args.raw, args.processed, skip_load=args.skip_load,
                                regions=args.regions, table_location=args.tables,
                                copy_tables=args.copy_tables,
                                multiline={"auto": "auto", "always": True, "never": False}[args.multiline])
        stages["pipeline_seconds"] = round(time.perf_counter() - t0, 2)
        if args.export:
            t0 = time.perf_counter()
            P.run_export(spark, args.processed, args.export)
            stages["export_seconds"] = round(time.perf_counter() - t0, 2)
        print(json.dumps({"status": "ok", **stages, **status}, default=str))
        return 0
    except Exception as ex:  # noqa: BLE001 - report the failing stage and exit non-zero
        print(json.dumps({"status": "failed", "error": f"{type(ex).__name__}: {ex}", **stages}))
        return 1
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
