"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

The layered tables are staged first (reported as `stage_*`), then the queries run over them.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from spendline.plans import catalog  # noqa: E402
from spendline.plans.mart import mart  # noqa: E402
from spendline.session import session  # noqa: E402

STAGES = ["silver_contract", "silver_po_spend", "silver_invoice_matching", "silver_supplier_performance", "silver_savings_project",
          "fact_purchase_order", "fact_invoice", "fact_savings", "fact_supplier_performance", "price_features", "opportunities", "prioritised",
          "ml_pricing_anomaly_prediction", "ml_savings_opportunity", "ml_supplier_risk_prediction"]
HEADLINE = ["Q01_annual_spend", "Q05_spend_by_supplier", "Q07_annual_invoice_kpis", "Q09_annual_performance", "O03_fx_resolve", "O09_contract_validity",
            "O12_split_spend", "O14_received_asof", "O17_three_way_match", "O22_scorecard", "O27_scd2_supplier", "O29a_po_fact", "O32_price_features",
            "O41_item_evidence", "O43_prioritise", "P44_asof_scd2", "P80_dedup_latest", "P87_global_rank", "P88_global_percent_rank", "D08_foreign_keys",
            "D23_po_spend", "M04_contract_compliance_pct", "M53_eligible_spend_with_pricing_anomalies", "R08_year_supplier_drilldown", "R12_sliced_spend"]


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session("spendline-bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g",
                                                            "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    tables = mart(spark, directory)
    for name in STAGES:
        start = time.perf_counter()
        tables[name]
        times[f"stage_{name}"] = round(time.perf_counter() - start, 3)
    for name in HEADLINE:
        start = time.perf_counter()      # building the plan may already pin data in the checkpoint folder
        plan = catalog.QUERIES[name].run(spark, directory)
        plan.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "total wall time of staging and headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(directory.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
