"""Time every query on tables: one JSON line with seconds per query (the better of two runs) and their sum."""

from __future__ import annotations

import json
import os
import time

from millrace.plans import QUERIES
from millrace.session import local_session, scratch_scope


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    only = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n] or list(QUERIES)
    seconds: dict[str, float] = {}
    for name in only:
        runs = []
        for _ in range(2):
            with scratch_scope(spark):
                started = time.perf_counter()
                QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
                runs.append(time.perf_counter() - started)
        seconds[name] = round(min(runs), 3)
    sf = folder.rstrip("/").rsplit("sf", 1)[-1]
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total seconds of all queries on tables", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
