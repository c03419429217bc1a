"""Time the headline queries and print one JSON line.

Every query is evaluated completely (all rows and columns, written to a sink that discards them).
"""

from __future__ import annotations

import json
import os
import sys
import time

from bodega.queries import REGISTRY, Tables
from bodega.session import build_session

HEADLINE = """
daily_balance header_line row_number_dedupe correlated_counts union_align line_amounts
bs_customer bs_account bs_balance bs_credit bs_transfer
gd_customer gd_account gf_movement gf_account_balance gf_credit gf_instalment gf_transfer
ws_order ws_sale ws_transaction wd_stock_item wf_movement wf_order wf_sale
scd2_two_days surrogate_keys fact_lookup_unknown fact_two_hop
dq_profile_lineitem dq_profile_orders dq_profile_events dq_profile_documents dq_profile_people dq_constraint_unique dq_constraint_fk
mapping_dedupe mapping_enriched lineage_closure
risk_month_end instalment_schedule offer_conditions monthly_profile
""".split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "20g",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    tables = Tables(spark, folder)
    tables.lineitem.groupBy("l_returnflag").count().collect()  # start the executors and load the reader
    seconds = {}
    for name in names:
        start = time.perf_counter()
        REGISTRY[name].run(tables).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
