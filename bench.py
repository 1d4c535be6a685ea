"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Samples are written as Parquet, as a cycle writes them; other results are only computed. Each
figure is the shorter of two runs in one session.
"""

import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402

from workload.runs import queries  # noqa: E402

SAMPLES = ["sorted_sample", "random_sample", "random_sample_scaled", "hash_sample", "block_sample"]
OTHERS = [
    "row_count", "json_to_policy", "effective_request", "compliant_plan", "validate_size",
    "route_commands", "idempotent_commands", "governed_sample",
]
RUNS = 2


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .config("spark.checkpoint.dir", f"{scratch}/shared")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf}/lineitem.parquet").write.format("noop").mode("overwrite").save()

    known, seconds = queries(), {}
    for name in SAMPLES + OTHERS:
        times = []
        for run in range(RUNS):
            start = time.perf_counter()
            result = known[name](spark, sf)
            if name in SAMPLES:
                result.write.parquet(f"{scratch}/{name}-{run}")
            else:
                result.write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times), 3)
    line = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
