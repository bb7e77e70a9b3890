"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from checks.queries import QUERIES
from tallyspark.session import session

HEADLINE = (
    "sales_raw", "sales_hourly", "sales_daily", "sales_monthly", "sales_yearly", "sales_net_raw", "sales_net_daily",
    "split_bill_children", "tax_raw", "tax_daily", "tax_monthly", "compliment_raw", "utilization_raw", "utilization_daily",
    "reservation_summary_daily", "changed_transactions", "affected_daily_keys", "sales_daily_after_batch",
    "tax_daily_after_batch", "sales_daily_recovered", "cdc_decode", "calendar_functions",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    # Start-up (class loading, first parquet read) is not part of any query.
    QUERIES["commission_summary"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total wall time of the headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
