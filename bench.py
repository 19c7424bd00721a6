"""Time the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from quayline.checks.queries import QUERIES
from quayline.session import build_session

HEADLINES = (
    "wide_express_bill", "wide_waybill", "wide_transport_record", "wide_branch_vehicle", "wide_customer",
    "kpi_express_bill", "kpi_waybill", "kpi_transport_record", "kpi_branch_vehicle", "kpi_customer",
    "kpi_order_daily", "csv_ingest", "cdc_oracle_apply", "cdc_mysql_apply", "stream_cdc", "keyed_merge",
    "keyed_table", "changelog_final", "word_count", "stream_word_count", "search_facets", "row_audit",
    "calendar_dim", "date_arithmetic", "time_normalise",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", settings={
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or list(HEADLINES)
    seconds: dict[str, float] = {}
    for name in names:
        best = None
        for _ in range(3):  # the first run also loads classes and compiles
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
        print(f"{name}: {best:.2f} s", file=sys.stderr)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
