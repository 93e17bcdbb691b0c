"""Times the queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]`` and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from tabwright.plans.queries import QUERIES
from tabwright.session import local_session

TRAINING = {"train_lr_grid", "train_rf", "train_svm", "final_test", "predict_svm", "predict_lr_grid"}  # minutes of model fitting


def main(names: list[str]) -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["missing_profile"](spark, folder).collect()  # start the JVM's and the scan's warm-up
    seconds = {}
    for name in names or [q for q in QUERIES if q not in TRAINING]:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total_query_time", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main(sys.argv[1:])
