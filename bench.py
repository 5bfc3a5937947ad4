"""Time the headline queries; prints one JSON line.

Reads BENCH_SF_DIR (default sf0.1) on local[BENCH_CPUS]. Each query gets one
warm-up run, then the median of BENCH_RUNS runs counts. A ``noop`` write forces
the whole result. Naming queries on the command line times only those.
``stored`` has the same jobs over the model's tables written once as Parquet, without
deriving the pledges from line items each time; it is not part of ``value``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from conformance.queries import JOBS, QUERIES  # noqa: E402
from pledgeflow.session import local_session, working_folder  # noqa: E402
from pledgeflow.sources.adapters import VIEWS, DriverTables  # noqa: E402

HEADLINE = (
    "successful_projects",
    "days_to_funding",
    "find_superbackers",
    "find_top_success",
    "find_top_popular",
    "funding_curve",
    "ingest_pledges",
    "rule_request_success",
    "auto_reject",
    "refund_status",
    "audit_fk",
    "audit_unique",
)


def timed(build) -> float:
    started = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def median_of(build, runs: int) -> float:
    timed(build)
    return round(statistics.median(timed(build) for _ in range(runs)), 3)


def stored_tables(spark, folder: str) -> dict:
    """The derived tables and batches, written once and read back."""
    derived, root = DriverTables(spark, folder), working_folder(spark, "bench")
    for name in VIEWS:
        derived[name].write.parquet(f"{root}/{name}")
    return {name: spark.read.schema(derived[name].schema).parquet(f"{root}/{name}") for name in VIEWS}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8)
    names = sys.argv[1:] or HEADLINE
    seconds = {name: median_of(lambda n=name: QUERIES[n](spark, folder), runs) for name in names}
    tables = stored_tables(spark, folder)
    stored = {name: median_of(lambda n=name: JOBS[n](tables), runs) for name in names}
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "stored": stored,
                "sf": Path(folder).name,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
