"""Times the headline queries and prints one JSON line.

Each query is built and run to its last row with the no-op sink. The decoded events
and the enriched spine are written once, as tables of their own, and their times are listed as
`decoded_table` and `spine`; the models read them. Queries run twice
and the second time counts, so that code generation of a fresh JVM does not.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from bindings.queries import QUERIES, Inputs  # noqa: E402
from orderloom.session import local_session  # noqa: E402

HEADLINE = [
    "stg_event_log",
    "events_decoded",
    "events_enriched",
    "fct_events",
    "fct_orders",
    "fct_order_cycles",
    "item_demand_daily",
    "inventory_daily",
    "items",
    "item_demand_supply",
    "missed_opportunity_4wk",
    "customer_weekly",
    "feature_pairing",
    "rep_weekly",
    "rep_order_cycle",
    "rep_order_journey",
    "unmapped_event_codes",
    "quarantine_invalid_source",
    "unmatched_demand_skus",
    "incremental_upsert",
    "refresh_events",
    "refresh_orders",
]


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    wanted = sys.argv[1:] or HEADLINE
    spark = local_session("bench", cores, shuffle_partitions=cores)
    inputs = Inputs(spark, sf_dir)
    seconds = {
        "decoded_table": timed(inputs.decoded_table),
        "spine": timed(inputs.spine),
    }
    for name in wanted:

        def run(name: str = name) -> None:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

        run()
        seconds[name] = timed(run)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": cores,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
