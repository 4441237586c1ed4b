"""Headline queries on local cores; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) set data and cores. Every
query is built and run to completion (results discarded). The first run of a query pays for
compiling its plan, so the time is the better of BENCH_RUNS runs (default 2).
"""

import json
import os
import time

from pyspark.sql import SparkSession

from annualis.session import configure
from catalog.queries import QUERIES

HEADLINE = ["read_episodes", "entity_latest", "rectangularise", "episodes_clean", "monthly_days",
            "contrib_merge", "annual_days", "person_year", "firm_panel", "firm_id_fix",
            "income_work", "retirement", "demographics", "panel"]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("annualis-bench")
             .config("spark.driver.memory", "16g").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark, shuffle_partitions=int(cpus))
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times), 3)
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": os.path.basename(sf.rstrip("/")),
                      "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
