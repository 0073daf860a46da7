"""Times the headline queries and prints one JSON line.

Each query is planned and run in full into Spark's no-op sink, twice: `first_run` holds the first
times, `queries` and `value` the second ones (code generated, classes loaded).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from perkmill.functions.lineage import scratch  # noqa: E402
from testbed.queries import queries  # noqa: E402

HEADLINE = [
    "accrual_ledger",
    "freeship_milestone",
    "suborder_stamp",
    "campaign_order_agg",
    "campaign_ledger",
    "review_ledger",
    "editor_review_rewards",
    "guest_review_outbox",
    "order_count_ledger",
    "finish_warm_up",
    "referral_ledger",
    "tier_upgrade_ledger",
    "freeship_backfill",
    "email_list_grant",
    "apply_ledger",
    "reject_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        # Call sites for error messages cost driver time per column expression.
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    todo = queries()
    names = sys.argv[1:] or HEADLINE

    def run(name: str) -> float:
        start = time.perf_counter()
        with scratch(spark):
            todo[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            return round(time.perf_counter() - start, 3)

    first = {name: run(name) for name in names}
    times = {name: run(name) for name in names}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "first_run": first,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
