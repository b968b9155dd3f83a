"""Run one named report, or all of them, straight over monthly files and show the result.

    spark-submit --py-files farelake.zip farelake/plans/query.py \
        --data s3a://in/trips --sample s3a://in/sample --types yellow top-zones
"""

from __future__ import annotations

import argparse
import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from farelake.plans.reports import MONTHLY, REPORTS, Report
from farelake.session import get_session
from farelake.sources.scratch import stored
from farelake.sources.tables import print_table
from farelake.sources.trips import conform_trips
from farelake.sources.views import register_views

log = logging.getLogger(__name__)


def check_columns(trips: DataFrame, reports: Sequence[Report]) -> None:
    """ValueError with the names of columns that the reports read and the files do not have."""
    there = {name.lower() for name in trips.columns}
    for report in reports:
        missing = [column for column in report.reads if column.lower() not in there]
        if missing:
            raise ValueError(f"{report.name} reads {', '.join(missing)}, which the files do not have")


def results(
    spark: SparkSession,
    data_dir: str,
    sample_dir: str,
    name: str = "all",
    taxi_type: str = "yellow",
    log_dir: str | None = None,
) -> list[tuple[str, DataFrame]]:
    """(title, lazy result) of the named report or of all ten, over the registered views."""
    if name != "all" and name not in REPORTS:
        raise ValueError(f"no report is named {name!r}; choose 'all' or one of {', '.join(REPORTS)}")
    register_views(spark, data_dir, sample_dir, taxi_type, log_dir)
    wanted = list(REPORTS.values()) if name == "all" else [REPORTS[name]]
    check_columns(spark.table("trips"), wanted)
    trips = conform_trips(spark.table("trips"))
    rollups = {}
    if name == "all":
        # Small, made once, and safe from lost executors.
        rollups = {key: stored(build(trips), key) for key, build in MONTHLY.items()}
    found = []
    for report in wanted:
        zones = spark.table("taxi_zones") if report.with_zones else None
        found.append((f"{report.name} - {report.description}", report.over(trips, zones, rollups)))
    return found


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("name", nargs="?", default="all", help="report name, or 'all'")
    parser.add_argument("--data", required=True, help="folder of monthly files")
    parser.add_argument("--sample", required=True, help="fallback folder, with taxi_zones.csv")
    parser.add_argument("--types", default="yellow", help="comma list; each is reported on in turn")
    parser.add_argument("--layouts", help="folder in which the layouts of the files are remembered")
    args = parser.parse_args(argv)
    types = [t.strip().lower() for t in args.types.split(",") if t.strip()]
    spark = get_session()
    for taxi_type in types:
        try:
            found = results(spark, args.data, args.sample, args.name, taxi_type, args.layouts)
        except (FileNotFoundError, ValueError) as error:
            # The first type has to be there; a further one may have no files, or not the columns.
            if taxi_type == types[0]:
                raise
            log.warning("%s is left out: %s", taxi_type, error)
            continue
        for title, frame in found:
            print(title if taxi_type == types[0] else f"{taxi_type}: {title}")
            print_table(stored(frame, "report"))


if __name__ == "__main__":
    main()
