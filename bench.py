"""Time the named queries at one scale and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES (comma-separated
or "all", default the headline queries), BENCH_REPEAT (default 2: the best run counts, so start-up
and code generation do not).
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from trialweave.catalog.queries import QUERIES  # noqa: E402
from trialweave.session import configure  # noqa: E402


HEADLINE = (
    "trial_landscape", "enriched_trials", "lead_sponsors", "primary_area", "primary_area_ranked",
    "stg_trials", "delimited_studies", "delimited_studies_split", "stored_trials", "years_of_area",
    "monthly_run", "flattened_pages", "pages_activity", "condition_list_area",
    "condition_rows_area", "document_areas", "encoded_events", "daily_activity",
    "daily_activity_stream", "activity_trends", "sync_skip_date", "sync_upsert", "backfill_run",
    "quality_report", "duplicate_ids", "tile1_pivot", "tile2_lines",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("trialweave-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="trialweave-bench-"))
    )
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")

    seconds = {}
    for name in names:
        runs = []
        for _ in range(repeat):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - started)
        seconds[name] = round(min(runs), 3)
    spark.stop()

    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale.group(1)) if scale else None,
    }))


if __name__ == "__main__":
    main()
