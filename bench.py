"""Headline benchmark: prints ONE JSON line.

completion_once (batch, written to the ``noop`` sink) and stream_completion
(availableNow run into a file sink). One warm-up, then the median of 3 runs.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["dwd_video_wide", "session_metrics", "rule_match", "completion_once",
            "stream_completion"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    from watchtally.session import build_spark
    from watchtally.plans.catalog import registry

    spark = build_spark(f"local[{cpus}]", shuffle_partitions=cpus)
    reg = registry()
    times: dict[str, float | None] = {}
    rows: dict[str, int] = {}
    errors: dict[str, str] = {}
    selected = os.environ.get("BENCH_QUERIES")
    for name in (selected.split(",") if selected else HEADLINE):
        fn = reg[name]

        def once() -> None:
            df = fn(spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()

        try:
            once()                                        # warm-up
            samples = []
            for _ in range(runs):
                t = time.perf_counter()
                once()
                samples.append(time.perf_counter() - t)
            times[name] = round(statistics.median(samples), 3)
            rows[name] = fn(spark, sf_dir).count()
        except Exception as e:  # keep the one-line contract; report the failure
            times[name] = None
            errors[name] = f"{type(e).__name__}: {str(e)[:300]}"
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    record = {
        "metric": "headline_total_sec",
        "value": round(sum(t for t in times.values() if t is not None), 3), "unit": "sec",
        "queries": times, "rows": rows, "input_events": events, "sf": sf, "cpus": cpus,
        "shuffle_partitions": cpus, "spark": spark.version,
    }
    if errors:
        record["errors"] = errors
    print(json.dumps(record))
    spark.stop()
    if errors:
        sys.exit(1)


if __name__ == "__main__":
    main()
