"""Time the reports, the workloads and the batch; print one JSON line.

Everything is read from the tables in `$BENCH_SF_DIR`; nothing is prepared, so the derivation of the
trips and the join of the order dates are part of every time. Each query runs once unmeasured and
`BENCH_REPEATS` times (3 by default), the fastest counts, and a run ends when all its rows are at the
driver.

`workloads_small` has the three timing workloads over the smallest tables (about 6,000 trips), the
scale nearest to the published baseline (10,000 rows). `job_floor_s` is the time of a job that does
nothing: what any query costs at least. `rollups` are the scans that the batch shares, `q11_batch` is
the whole batch through them. With `BENCH_SCRATCH` naming a folder, a load of one month is timed too.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame

from checks.registry import QUERIES
from farelake import bindings
from farelake.plans.ingest import run_load
from farelake.plans.reports import ROLLUPS
from farelake.session import get_session
from farelake.sources.tables import save

HEADLINE = [name for name in QUERIES if name[0] in "qb" and not name.startswith("q11")]


def fastest(build: Callable[[], DataFrame], repeats: int) -> float:
    build().collect()
    times = []
    for _ in range(repeats):
        start = time.perf_counter()
        build().collect()
        times.append(time.perf_counter() - start)
    return round(min(times), 4)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = get_session(
        "bench",
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus) if cpus.isdigit() else os.cpu_count(),
        **{"spark.driver.memory": "8g", "spark.log.level": "ERROR"},
    )

    queries = {name: fastest(lambda n=name: QUERIES[n](spark, folder), repeats) for name in HEADLINE}
    trips = bindings.trips(spark, folder)
    more = {f"rollup_{name}": fastest(lambda b=build: b(trips), repeats) for name, build in ROLLUPS.items()}
    more["q11_batch"] = fastest(lambda: QUERIES["q11_batch"](spark, folder), 1)
    small = os.path.join(os.path.dirname(folder), "sf0.001")
    workloads = {n: fastest(lambda n=n: QUERIES[n](spark, small), repeats) for n in HEADLINE if n[0] == "b"}
    floor = fastest(lambda: spark.range(1).selectExpr("count(*)"), repeats)

    if scratch := os.environ.get("BENCH_SCRATCH"):
        place = f"{scratch.rstrip('/')}/bench-{uuid.uuid4().hex}"
        save(trips, f"{place}/in/yellow_tripdata_2024-01.parquet")
        start = time.perf_counter()
        run_load(spark, f"{place}/in", f"{place}/table", ["yellow"], "2024-01", "2024-01")
        more["load_one_month"] = round(time.perf_counter() - start, 4)

    print(
        json.dumps(
            {
                "metric": "reports_and_workloads_total",
                "value": round(sum(queries.values()), 4),
                "unit": "sec",
                "queries": queries,
                "sf": os.path.basename(folder).removeprefix("sf"),
                "rows": trips.count(),
                "repeats": repeats,
                "more": more,
                "workloads_small": workloads,
                "small_rows": bindings.trips(spark, small).count(),
                "job_floor_s": floor,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
