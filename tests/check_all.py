"""Run every query against its check at a scale factor: python tests/check_all.py [sf_dir] [name...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from orderloom.plans.catalog import CHECKS, QUERIES  # noqa: E402
from orderloom.session import build_session  # noqa: E402
from tests.compare import connect, difference  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session(
        master="local[8]", shuffle_partitions=8, extra={"spark.driver.memory": "8g", "spark.ui.enabled": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    failed = 0
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf)
            problem = difference(df, con, CHECKS[name]) if name in CHECKS else f"unchecked, {df.count()} rows"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        ok = problem is None or problem.startswith("unchecked")
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:28s} {time.time() - start:6.2f}s {problem or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")


if __name__ == "__main__":
    main()
