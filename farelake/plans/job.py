"""End-to-end job: load the months, register the views, write the ten reports and the workloads.

    spark-submit --py-files farelake.zip farelake/plans/job.py \
        --source s3a://in/trips --table s3a://lake/trips --out s3a://lake/reports \
        --zones s3a://in/taxi_zones.csv --types yellow --start 2024-01 --end 2024-03
"""

from __future__ import annotations

import argparse
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from farelake.plans.ingest import load_summary, read_rollups, read_table, roll_up, run_load
from farelake.plans.reports import MONTHLY, run_all
from farelake.plans.workloads import WORKLOADS
from farelake.session import get_session
from farelake.sources.dimensions import read_zones
from farelake.sources.tables import load, save
from farelake.sources.versions import versions
from farelake.sources.views import create_views


def write_reports(
    trips: DataFrame, zones: DataFrame, out_dir: str, rollups: Mapping[str, DataFrame] | None = None
) -> list[str]:
    """Write each report and workload as its own table; return their names.

    `rollups` are those of the loaded months; without them they are made here, and written first: they
    are small, survive lost executors, and spare every result but the percentiles a scan of the trips.
    """
    if rollups is None:
        roll_up(trips, lambda name: f"{out_dir}/rollups/{name}")
        rollups = {
            name: load(trips.sparkSession, f"{out_dir}/rollups/{name}", build(trips).schema)
            for name, build in MONTHLY.items()
        }
    written = []
    for report, frame in run_all(trips, zones, rollups):
        save(frame, f"{out_dir}/reports/{report.name}")
        written.append(report.name)
    for workload in WORKLOADS.values():
        save(workload.over(trips, rollups), f"{out_dir}/workloads/{workload.name}")
        written.append(workload.name)
    return written


def run(
    spark: SparkSession,
    source_dir: str,
    table_dir: str,
    out_dir: str,
    zones_csv: str,
    taxi_types: Sequence[str],
    start: str,
    end: str,
    allow_missing: bool = False,
    file_rows: int | None = None,
) -> list[str]:
    """Load, register, report. Months that failed, or landed in part, stop the job before the reports unless

    they are allowed; then the reports stand beside the list of them, `reports/_missing`. The reports are
    of one version of the table. Trips are read again for the percentiles alone, and there only once;
    all else comes from the rollups of the months, of which a load makes only those of its own months.
    """
    outcome = run_load(spark, source_dir, table_dir, taxi_types, start, end, file_rows=file_rows)
    save(outcome, f"{out_dir}/load/files")
    save(load_summary(outcome), f"{out_dir}/load/summary")
    bad = outcome.where("action = 'failed' OR size(rejected) > 0")
    missing = bad.select("taxi_type", "month", "file_name", "rejected")
    failed = [row.file_name for row in missing.collect()]
    if failed and not allow_missing:
        raise RuntimeError(f"no reports, as {len(failed)} months failed: {', '.join(sorted(failed)[:20])}")
    save(missing, f"{out_dir}/reports/_missing")
    version = max(versions(spark, table_dir), default=None)
    trips, zones = read_table(spark, table_dir, version), read_zones(spark, zones_csv)
    create_views(trips, zones)
    return write_reports(trips, zones, out_dir, read_rollups(spark, table_dir, version))


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    for name in ("source", "table", "out", "zones"):
        parser.add_argument(f"--{name}", required=True)
    parser.add_argument("--types", default="yellow", help="comma list")
    parser.add_argument("--start", default="2024-01", help="YYYY-MM")
    parser.add_argument("--end", default="2024-03", help="YYYY-MM")
    parser.add_argument("--allow-missing", action="store_true", help="report although months failed")
    parser.add_argument("--file-rows", type=int, help="cluster the landed trips by pickup time, so many to a file")
    args = parser.parse_args(argv)
    types = [t.strip().lower() for t in args.types.split(",") if t.strip()]
    spark = get_session()
    run(
        spark, args.source, args.table, args.out, args.zones, types, args.start, args.end, args.allow_missing, args.file_rows
    )


if __name__ == "__main__":
    main()
