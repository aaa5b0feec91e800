"""Times the headline queries end to end and prints one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the local cores (default 8). The lake starts
empty: the time of a Silver table is the time to check, split and write it from the supplied tables, and the Gold,
SQL, quality and profile queries then read it. Every result row is computed (written to the no-op sink).
"""

from __future__ import annotations

import json
import os
import time

from ledgerline import catalogue
from ledgerline.model import ENTITIES
from ledgerline.session import build_session

HEADLINE = [
    *(f"silver_{name}" for name in ENTITIES),
    "quality_counts",
    "gold_daily_transaction_summary",
    "gold_customer_transaction_metrics",
    "gold_merchant_performance",
    "top_merchants",
    "gold_loan_portfolio",
    "gold_customer_360",
    "int_customer_transactions",
    "int_merchant_transactions",
    "int_loan_payments",
    "int_customer_loans",
    "fct_daily_transactions",
    "fct_customer_transactions",
    "fct_merchant_performance",
    "fct_loan_portfolio",
    "customer_360_mart",
    "qa_silver_pk",
    "qa_fk",
    "qa_business_rules",
    "recon_c360",
    "dt_marts",
    "profile_columns",
    "profile_duplicate_rows",
    "profile_transactions",
    "amount_outliers_iqr",
    "installment_schedule",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "ledgerline-bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executor before the clock
    registered = catalogue.build()
    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        registered[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(json.dumps({
        "metric": "lakehouse_headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
