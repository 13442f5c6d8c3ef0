"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the local cores.
Each query runs four times into a sink that discards rows. The first time is shown under "cold";
the median of the others counts, so that code generation and JVM warm-up do not. CSV
exports that a query reads are written in the first run only.
"""

from __future__ import annotations

import functools
import json
import os
import sys
import time
from pathlib import Path
from statistics import median

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from daybook.session import RECOMMENDED_CONF  # noqa: E402
from daybook_checks import queries  # noqa: E402
from daybook_checks.queries import QUERIES  # noqa: E402

HEADLINE = (
    "daily_model",
    "end_to_end_model",
    "orders_clean",
    "ads_clean",
    "dedupe_first",
    "dq_report_orders",
    "dq_report_ads",
    "orders_daily",
    "ads_daily",
    "money_parse",
    "timestamp_parse",
    "period_kpis",
    "csv_export",
    "csv_roundtrip",
    "table_roundtrip",
)


def session(cpus: int) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("daybook-bench")
    conf = {
        **RECOMMENDED_CONF,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        "spark.sql.shuffle.partitions": str(cpus),
        # The tables are a few megabytes: let small files and shuffles use all cores.
        "spark.sql.files.openCostInBytes": "262144",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
    }
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = session(cpus)
    queries._write_exports = functools.cache(queries._write_exports)
    cold = {name: timed(spark, name, sf_dir) for name in HEADLINE}
    again = [{name: timed(spark, name, sf_dir) for name in HEADLINE} for _ in range(3)]
    warm = {name: median(times[name] for times in again) for name in HEADLINE}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
