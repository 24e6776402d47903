"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose
the data and the cores.  Each query is planned and run in full once after one
warm-up query; rows go to a sink that discards them.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tellerframe.registry.queries import QUERIES
from tellerframe.session import build_session
from tellerframe.sources.storage import release

HEADLINE = (
    "stg_transactions stg_transactions_sparse stg_credit fact_transactions q1_daily_summary q2_segment_analysis q3_dormancy q4_channel_mom q5_large_register"
    " q6_credit_portfolio q7_lifetime_value kpi_daily_summary kpi_customer_segment dash_kpi_cards dash_top_merchants prof_null_pct"
    " prof_median prof_hist_amount dq_profile dq_checks dq_quarantine dq_clean dq_score ge_transactions scd2_customer scd2_account"
    " pit_segment upsert_staging incremental_fact lineage_ancestors lineage_closure retention io_csv io_partitioned stream_ingest"
).split()


def main(names: list[str]) -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    settings = {
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "16g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    spark = build_session("bench", f"local[{cpus}]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, folder, "dash_channel")
    times = {name: run(spark, folder, name) for name in names}
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }
    release(spark)
    spark.stop()
    print(json.dumps(result))


def run(spark, folder: str, name: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - started, 3)


if __name__ == "__main__":
    names = sys.argv[1:] or list(HEADLINE)
    main(list(QUERIES) if names == ["all"] else names)
