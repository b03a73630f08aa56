"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the test tables, BENCH_CPUS the local cores, BENCH_REPEATS the timed runs per query
(the best counts). Results go to Spark's no-op sink, so every column is computed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from addrspark.session import build_session  # noqa: E402
from addrspark.workload.queries import QUERIES  # noqa: E402

HEADLINE = [
    "distinct_streets",
    "duplicate_keys",
    "duplicate_details",
    "duplicate_split",
    "unique_doors",
    "street_documents",
    "street_documents_nested",
    "blocks_v1",
    "blocks_v2",
    "provinces_by_department",
    "accents_removed",
    "clean_coordinates",
    "ndjson_good",
    "apply_mapping",
    "utm_project",
    "polygon_centroid",
    "nearest_edge",
    "address_points",
    "hex_index",
    "hex_shapes",
    "wkb_roundtrip",
    "patch_documents",
    "bulk_export_lines",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    # One unmeasured query, so that the first one does not pay for the start of the JVM.
    QUERIES[names[0]](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        runs = []
        for _ in range(repeats):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - started)
        times[name] = round(min(runs), 3)
    total = round(sum(times.values()), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": total,
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
