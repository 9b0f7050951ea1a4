"""Wall time of every registered query, as one JSON line.

Each query runs once to warm up and BENCH_RUNS times for the record (median kept); its rows are computed and thrown
away. Queries that build scores run their whole plan from the tables each time. Queries on published scores read the
score table, and the classifier's reports one model; writing the one and training the other, once, are reported as
`publish` and `train` and are part of the total.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from recall_lens.plans import queries as registered  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "1"))
ONLY = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]


WARMED_BY_PUBLISH = ("device_rollup", "rpss_components", "rpss_scores")


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("recall-lens-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="recall-lens-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = ONLY or list(registered.QUERIES)
    seconds = {"publish": timed(lambda: registered.published(spark, FOLDER)), "train": timed(lambda: registered.trained(spark, FOLDER))}
    for name in names:
        query = registered.QUERIES[name]
        if name not in WARMED_BY_PUBLISH:
            run(query(spark, FOLDER))
        seconds[name] = statistics.median(timed(lambda: run(query(spark, FOLDER))) for _ in range(RUNS))
    print(
        json.dumps(
            {
                "metric": "total wall time of publishing, training and the registered queries, warm, median of runs",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {n: round(s, 3) for n, s in seconds.items()},
                "sf": Path(FOLDER).name.removeprefix("sf"),
                "cpus": int(CPUS),
                "runs": RUNS,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
