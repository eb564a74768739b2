"""Times the queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every result is consumed whole by Spark's noop sink.  ``BENCH_QUERIES`` (comma
separated) narrows the run; ``BENCH_ALL=1`` times every registered query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cubeloom.session import local_session  # noqa: E402
from cubeloom.workload import QUERIES  # noqa: E402

HEADLINE = (
    "cube_aggregate",
    "merge_partial_cubes",
    "legacy_cube",
    "mart_entity",
    "mart_entity_sex",
    "mart_sector4",
    "audit_summary_general",
    "audit_job_composition",
    "audit_duplicate_keys",
    "top_values_per_column",
    "light_period_audit",
    "profile_columns",
    "source_profile",
    "period_fingerprint",
    "period_compare",
    "insert_only_history",
    "dedup_ignore_metadata",
    "staging_projection",
    "post_promotion_checks",
    "housekeeping_eligibility",
    "batch_plan",
    "share_of_total",
    "yoy_change",
    "top_k_semi_join",
    "raw_scan_cast",
    "file_cube",
    "incremental_ingest",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = HEADLINE if not os.environ.get("BENCH_ALL") else tuple(QUERIES)
    if os.environ.get("BENCH_QUERIES"):
        names = tuple(os.environ["BENCH_QUERIES"].split(","))
    spark = local_session(cpus)

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    for name in ("mart_entity", "cube_aggregate"):  # warm the JVM and the file cache
        run(name)
    seconds = {name: run(name) for name in names}
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
