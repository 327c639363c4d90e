"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from ledgerloom.catalog.queries import REGISTRY
from ledgerloom.session import build_session

HEADLINE = [
    "flagship_stage_exposure", "quarantine_transactions", "clean_transactions", "upsert_two_batches", "scd2_two_batches",
    "fact_exposure", "fact_exposure_history", "fact_credit_event", "risk_features", "group_exposure_total",
    "ntile_buckets", "psi_ntile", "psi_quantile_by_quarter", "portfolio_kpis", "quality_by_table", "run_log",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    REGISTRY["quality_by_table"](spark, sf_dir).collect()  # start-up cost is not part of any query
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        started = time.perf_counter()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    print(json.dumps({"metric": "total_query_time", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf")}))


if __name__ == "__main__":
    main()
