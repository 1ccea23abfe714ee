"""Time the headline queries: prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) as given by the
driver. Each query runs once to warm up and once timed, with all its rows made but not
collected. The *_bulk queries work on inputs derived from all orders (150,000 crawl
records and sites at sf0.1), the others on those derived from the pages table.
"""

from __future__ import annotations

import hashlib
import json
import os
import tempfile
import time

from checks import fixtures
from checks.compare import local_session
from checks.queries import QUERIES

HEADLINE = (
    "wp_discover",
    "wp_discover_bulk",
    "disqus_discover",
    "disqus_discover_bulk",
    "verify_results_bulk",
    "verify_pages_bulk",
    "comments_per_post",
    "insert_ignore",
    "upsert_results",
    "unverified_wp",
    "export_rows",
    "manifest_wat",
    "discover_wp_run",
    "discover_disqus_run",
    "incremental_disqus",
    "export_run",
)


def write_inputs_once() -> None:
    """From now on the queries' derived inputs are written at their first use and read from then on.

    So the second, timed run of a query has the time of its operator.
    """
    folder, derive, known = tempfile.mkdtemp(prefix="talkscout-bench-"), fixtures.spark_sql, set()

    def read(spark, sf_dir, sql):
        path = f"{folder}/{hashlib.sha1(f'{sf_dir} {sql}'.encode()).hexdigest()}"
        if path not in known:
            derive(spark, sf_dir, sql).write.parquet(path)
            known.add(path)
        return spark.read.parquet(path)

    fixtures.spark_sql = read


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")))
    write_inputs_once()
    seconds = {}
    for name in HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))


if __name__ == "__main__":
    main()
