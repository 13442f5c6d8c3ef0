"""Times a full rebuild over many order rows.

    python benchmarks/full_rebuild.py [copies] [hot]

The orders derived from the sf0.1 tables are written to CSV ``copies`` times over
(66 copies make ten million rows), each copy under its own ids. With ``hot``, one
order id holds a third of all rows. Prints the rows per second of each stage.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import functions as F  # noqa: E402

from bench import session  # noqa: E402
from daybook import Params  # noqa: E402
from daybook.contracts import POSITION, T_ORDERS_CLEAN  # noqa: E402
from daybook.plans import daily_run, run  # noqa: E402
from daybook.session import scratch_path  # noqa: E402
from daybook.sources import TableStore  # noqa: E402
from daybook_checks import frames  # noqa: E402
from daybook_checks.queries import AD_HEADERS, ORDER_HEADERS  # noqa: E402


def write_csv(frame, headers, path) -> None:
    frame.drop(*POSITION).toDF(*headers).write.options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)


def main(copies: int, hot: bool) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(int(os.environ.get("BENCH_CPUS", "8")))
    orders_csv, ads_csv = scratch_path(spark, "orders"), scratch_path(spark, "ads")
    raw = frames.raw_orders(spark, sf_dir).withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))
    )
    own_id = F.concat("order_id", F.lit("-"), F.col("copy").cast("string"))
    shared = F.when(F.col("copy") % 3 == 0, F.lit("HOT")).otherwise(own_id) if hot else own_id
    write_csv(raw.withColumn("order_id", shared).drop("copy"), ORDER_HEADERS, orders_csv)
    write_csv(frames.raw_ads(spark, sf_dir), AD_HEADERS, ads_csv)

    times: dict[str, float] = {}

    def clocked(name):
        inner = getattr(daily_run, name)

        def outer(*args, **kw):
            start = time.perf_counter()
            try:
                return inner(*args, **kw)
            finally:
                times[name] = round(time.perf_counter() - start, 1)

        setattr(daily_run, name, outer)

    for name in ("ingest_orders", "ingest_ads"):
        clocked(name)
    store = TableStore(spark, root=scratch_path(spark, "rebuild"))
    start = time.perf_counter()
    result = run(spark, orders_csv, ads_csv, store, Params(dq_rejection_threshold=1))
    total = time.perf_counter() - start
    rows = result.orders_report.rows_received
    kept = store.read(T_ORDERS_CLEAN).count()
    assert kept == result.orders_report.rows_accepted
    print(
        json.dumps(
            {
                "order_rows": rows,
                "kept": kept,
                "model_days": result.model.count(),
                "seconds": round(total, 1),
                **times,
                "rows_per_second": round(rows / total),
                "reasons": dict(result.orders_report.reasons),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main(int(sys.argv[1]) if len(sys.argv) > 1 else 66, "hot" in sys.argv[2:])
