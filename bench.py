"""Times the headline queries and prints one JSON line.

Every query is forced with a noop write: one warm-up, then the median of three runs.
Raw files that a job reads are prepared before.
"""

import json
import logging
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession

from tidemark import staging
from tidemark.queries import QUERIES, jobs, scans

# Jobs whose raw files are made beforehand, outside of the time taken.
PREPARED = {
    "b1_clean_job": (jobs.prepare_orders, jobs.run_orders),
    "v1_visits": (jobs.prepare_visits, jobs.run_visits),
    "s1_json_multiline": (scans.prepare_documents, scans.run_documents),
}

# Whole pipelines: one run after the warm-up.
LONG = {"b2_clean_reload", "g2_curated_increment", "v1_visits"}

HEADLINE = [
    "g1_curated",
    "m1_upsert",
    "m2_child_replace",
    "m2a_child_delete",
    "w1_keep_latest",
    "q1_tag",
    "q3_metrics",
    "j1_semi_children",
    "j2_left_lists",
    "j3_broadcast_dims",
    "a1_collect",
    "p1_cast",
    "p2_multi_ts",
    "p3_hash_key",
    "p8_explode",
    "s1_json_scan",
    "b1_clean_job",
    "d1_mart",
    "m4_ref_load",
    "s1_json_multiline",
    "g2_curated_increment",
    "b2_clean_reload",
    "v1_visits",
]


def main() -> None:
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    wanted = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    logging.disable(logging.WARNING)
    if not spark.conf.get("spark.checkpoint.dir", None):
        staging.use_folder(tempfile.mkdtemp(prefix="bench-"))
    seconds = {}
    for name in wanted:
        prepare, run = PREPARED.get(name, (lambda *_: sf_dir, QUERIES.get(name)))
        given = prepare(spark, sf_dir)
        times = []
        for _ in range(2 if name in LONG else 4):
            start = time.perf_counter()
            run(spark, given).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of medians",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
