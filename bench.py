"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line. Each is run once to warm up and three times
for its median, into a sink that reads every row."""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

from stayspark.plans import catalogue
from stayspark.session import local_session

HEADLINE = (
    "hotel_daily_summary", "destination_daily_summary", "rating_distribution", "price_by_star", "latest_state", "merge_insert_only", "merge_upsert", "contract_failures", "silver_typing", "bronze_parse",
    "fill_missing", "identity_promotion", "enrichment_topk", "nearest_rank_percentiles", "url_sets", "textual_fallback",
)


def main() -> None:
    d = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus=cpus, partitions=cpus, name="bench")
    spark.sparkContext.setLogLevel("ERROR")
    built, out = catalogue.queries(), {}
    for name in HEADLINE:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            built[name](spark, d).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        out[name] = round(statistics.median(times[1:]), 3)
        print(name, out[name], file=sys.stderr)
    scale = re.search(r"sf([0-9.]+)", d)
    print(json.dumps({"metric": "total_median_seconds", "value": round(sum(out.values()), 3), "unit": "sec", "queries": out, "sf": float(scale[1]) if scale else None}))
    spark.stop()


if __name__ == "__main__":
    main()
