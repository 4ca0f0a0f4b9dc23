"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is built and fully executed (``noop`` sink, every row and
column computed); queries that write a lake or run a stream include that
work.  A query's time is the median of $BENCH_REPEATS runs (3).  Prints
one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from changelake.plans.queries import QUERIES  # noqa: E402
from changelake.session import get_session  # noqa: E402

HEADLINE = [
    "envelope_decode",
    "bad_message_split",
    "date_partition_counts",
    "stream_append_lake",
    "publish_keys",
    "publish_envelope",
    "audit_capture_full",
    "unpublished_antijoin",
    "key_violations",
    "member_join",
    "table_map_lookup",
    "table_map_static",
    "row_event_explode",
    "changelog_union",
    "dedup_redelivered",
    "table_map_stream",
    "row_log_publish",
    "synth_transactions",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = get_session(
        f"local[{cpus}]",
        spark_sql_shuffle_partitions=os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(max(8, int(cpus) * 2))),
        spark_driver_memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    # warm-up: one pass of every query over the smallest tables compiles
    # the generated code and JIT-warms the JVM (not timed)
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for name in names:
            try:
                QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
            except Exception:  # noqa: BLE001 - reported by the timed run below
                pass
    times: dict[str, float | None] = {}
    errors: dict[str, str] = {}
    for name in names:
        runs = []
        try:
            for _ in range(repeats):
                t0 = time.perf_counter()
                QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                runs.append(time.perf_counter() - t0)
            times[name] = round(statistics.median(runs), 3)
        except Exception as exc:  # noqa: BLE001 - keep the one-line report whole
            times[name] = None
            errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "total_query_time",
        "value": round(sum(t for t in times.values() if t is not None), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": int(cpus),
        "median_of": repeats,
        "warmed_on": warm_dir if os.path.isdir(warm_dir) else None,
        **({"errors": errors} if errors else {}),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
