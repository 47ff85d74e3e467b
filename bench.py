"""Headline-query benchmark.

Runs the pipeline's main stages at $BENCH_SF_DIR (default sf0.1) on
local[$BENCH_CPUS] and prints ONE JSON line. Each query is forced to full
execution with the ``noop`` sink (no collect). Stages run in pipeline order;
like a production run, the pre-departure table is written once by the first
stage (``pre_departure``) and later stages read it.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "pre_departure",          # raw -> validated -> cleaned -> written pre-departure table
    "quality_summary",
    "validate_flags",
    "history_features_p3",
    "history_features_2a",
    "prior_rolling_7d",
    "weather_asof_join",
    "chrono_split",
    "feature_table_p3",
    "roc_auc",
    "average_precision",
    "threshold_sweep",
    "eda_numeric_profile",
    "corr_matrix",
    "categorical_profile",
    "ml_logreg",              # fit on train, score the test split
]


def main() -> None:
    from flightops.plans import catalog
    from flightops.plans import pipeline as PL
    from flightops.session import get_spark

    spark = get_spark(master=f"local[{CPUS}]")
    spark.conf.set("spark.sql.shuffle.partitions", str(int(CPUS) * 2))
    # warm-up: JVM start, codegen of trivial plans -- not billed to the first query
    spark.range(1000).selectExpr("sum(id)").collect()
    queries = dict(catalog.QUERIES)
    queries["pre_departure"] = lambda s, d: PL.pre_departure(s, d)
    times: dict[str, float] = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        df = queries[name](spark, SF_DIR)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    sf = SF_DIR.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": int(CPUS)}))
    spark.stop()


if __name__ == "__main__":
    main()
