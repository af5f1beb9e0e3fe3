"""Time the headline queries and print one JSON line.

Settings come from the environment: BENCH_SF_DIR (folder of Parquet tables) and
BENCH_CPUS (local threads). Every query is run in full into a sink that keeps nothing,
once cold and then RUNS times warm; the figure is the median of the warm runs, planning
included. The cold times are reported beside it.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

HERE = str(Path(__file__).resolve().parent)
sys.path.insert(0, HERE)
# Python workers have to find the package as well, whatever folder the benchmark starts in.
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [HERE, os.environ.get("PYTHONPATH")]))

from tributary import get_session  # noqa: E402
from tributary.plans.models import MODELS  # noqa: E402
from tributary.plans.registry import QUERIES  # noqa: E402

RUNS = 3
HEADLINE = (*MODELS, "ingest_json_array", "check_outcomes")


def run(query: str, spark, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[query](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            # Call sites in error messages cost a round trip per expression.
            "spark.python.sql.dataFrameDebugging.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    cold = {query: round(run(query, spark, folder), 3) for query in HEADLINE}
    warm = {
        query: round(statistics.median(run(query, spark, folder) for _ in range(RUNS)), 3)
        for query in HEADLINE
    }
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds_headline_queries",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "runs": RUNS,
                "cpus": int(cpus),
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
