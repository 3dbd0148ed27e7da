"""Benchmark the headline checks.

Runs each query at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS] (default 8), forcing full execution with the ``noop``
sink (no driver collection), after one warm-up run of the flagship. Prints
one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from featuremart.catalog import QUERIES, load_all  # noqa: E402
from featuremart.session import get_session  # noqa: E402

HEADLINE = [
    "batch_features",  # flagship
    "event_window_features",
    "session_features",
    "order_features",
    "user_mart",
    "cohorts",
    "user_profile",
    "order_gaps",
    "prior_bookings",
    "association",
    "sales_lags",
    "psi",
    "tfidf_sql",
    "forecast_batch",  # end-to-end forecast: features, fit, save/load, predict, clip, write
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session(f"local[{cpus}]", max(8, cpus * 2), app_name="featuremart-bench")
    load_all()
    names = [n for n in HEADLINE if n in QUERIES]
    QUERIES["batch_features"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    panel_rows = QUERIES["sales_with_plan"](spark, sf_dir).count()
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "flagship_sec": times.get("batch_features"),
                "forecast_panel_rows": panel_rows,
                "forecast_rows_per_sec": round(panel_rows / times["forecast_batch"], 1)
                if times.get("forecast_batch")
                else None,
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
