"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

The pipeline steps (ETL from JSON files, training, streaming) are timed as whole
jobs including their writes; the reports read what those steps stored.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from orderloom.plans import etl, frames  # noqa: E402
from orderloom.plans.catalog import QUERIES  # noqa: E402
from orderloom.session import build_session, shared_dir  # noqa: E402
from orderloom.sources import tables  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "return_rate_by_category",
    "revenue_by_category",
    "daily_revenue",
    "dedup_latest",
    "snapshot_upsert",
    "pk_upsert",
    "fk_semi",
    "star_wide",
    "na_report",
    "distinct_profile",
    "describe_numeric",
    "describe_categorical",
    "median_cols",
    "corr_matrix",
    "hist_total",
    "relation_items_basket",
    "message_normalize",
    "eco_summary",
    "split_stratified",
    "roc_auc",
    "clf_metrics",
    "threshold_sweep",
]


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session(
        "orderloom-bench",
        master=f"local[{CPUS}]",
        shuffle_partitions=int(CPUS),
        extra={
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-bench-", dir="/tmp"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Raw input of the ETL step: the nested log as JSON files (not timed).
    raw = shared_dir(spark, "raw")
    tables.nested_events(spark, SF_DIR).write.json(raw)

    steps = {
        "etl_json_to_clean_and_exports": lambda: etl.run(spark, raw, shared_dir(spark, "store"), star=False),
        "clean_table": lambda: frames.clean_table(spark, SF_DIR),
        "train_logistic": lambda: consume(QUERIES["train_logistic"](spark, SF_DIR)),
        "score_batch": lambda: consume(QUERIES["score_batch"](spark, SF_DIR)),
        "stream_ingest_and_score": lambda: consume(QUERIES["stream_events"](spark, SF_DIR)),
    }
    steps |= {name: (lambda n=name: consume(QUERIES[n](spark, SF_DIR))) for name in HEADLINE}
    seconds = {}
    for name, step in steps.items():
        start = time.perf_counter()
        step()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total wall time of headline steps",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
