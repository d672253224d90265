"""Wall clock of the headline queries, printed as one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the cores.  Each query runs whole
and its result is consumed by a sink that keeps nothing.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cadenza.queries.registry import REGISTRY  # noqa: E402
from cadenza.session import local_session  # noqa: E402

HEADLINE = [
    "cycle_summary",
    "cycle_labels",
    "cycle_labels_customer",
    "cycle_labels_supplier",
    "base_transactions",
    "blocked_counterparties",
    "char_grams",
    "word_grams",
    "counterparty_pairs",
    "counterparty_clusters",
    "training_table",
    "next_date_dataset",
    "is_next_negatives",
    "user_split",
    "window_assignment",
    "best_match",
    "predict_by_rules",
    "stream_by_rules",
    "has_cycle_model",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session("bench", cpus)
    spark.sparkContext.setLogLevel("ERROR")
    # The JVM and the Python workers start outside the clock.
    REGISTRY["cycle_summary"][0](spark, sf_dir).limit(1).collect()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        REGISTRY[name][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall clock",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
