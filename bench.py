"""Time the nightly build, the consumer views and the analytic queries; print one JSON line.

``build.*`` writes one stored table from those before it, ``view.*`` reads one consumer view of
the stored tables in full, and the other names run a whole query from the raw tables.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession

from vintora.plans import build
from vintora.plans.book import Book
from vintora.registry.catalog import ALL
from vintora.sources import load

HEADLINE = (
    "m03_route_scd", "m04_grouped_orders", "m05_loss_rates", "m07_vintage_analysis",
    "m14_cohort_panel", "m16_lifecycle_audience", "m18_pre_post_sales", "m19_woe_table",
    "d09_roll_rates", "x08_segment_summary",
)


def read_all(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "16g")
             .config("spark.sql.shuffle.partitions", cpus)
             .config("spark.python.sql.dataFrameDebugging.enabled", "false")
             .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="vintora-bench-"))
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    # Starting the session is paid before the clock.
    read_all(ALL["m04_grouped_orders"].run(spark, folder))
    seconds = {}
    book = Book.open(spark, folder)
    begun = time.perf_counter()
    for entry in build.rebuild(book, load.scratch(spark, "book")):
        seconds[f"build.{entry['table_name']}"] = round(entry["seconds"], 3)
    build_total = round(time.perf_counter() - begun, 3)
    for name, make in build.VIEWS.items():
        begun = time.perf_counter()
        read_all(make(book))
        seconds[f"view.{name}"] = round(time.perf_counter() - begun, 3)
    for name in HEADLINE:
        begun = time.perf_counter()
        read_all(ALL[name].run(spark, folder))
        seconds[name] = round(time.perf_counter() - begun, 3)
    print(json.dumps({
        "metric": "nightly build, consumer views and headline queries, total wall time",
        "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "build_total": build_total,
        "views_total": round(sum(v for k, v in seconds.items() if k.startswith("view.")), 3),
        "sf": os.path.basename(folder.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
