"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` is the data folder, ``BENCH_CPUS`` the number of local cores. Every query is
written to Spark's no-op sink, so all rows are computed and none is collected. Each runs twice
and the faster run counts. ``daily_extracts`` computes and stores the extracts that the KPI
queries share; they are not part of the KPI times and are in the total.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from uptake.plans.extracts import Extracts, extracts  # noqa: E402
from uptake.plans.queries import QUERIES  # noqa: E402
from uptake.sources.files import drop_scratch  # noqa: E402

HEADLINES = """
campaign_summary_extract
wl_by_offer wl_total_by_offer wl_border wl_los wl_recurring wl_recurring_kabupaten
wl_first_touch_attribution
taker_by_tower taker_by_offer taker_border taker_los
tur_formulation summary_channel summary_channel_mtd summary_product summary_product_mtd
summary_kabupaten top_main_level top_main_level_mtd top_main_level_l1 top_main_level_l1_mtd
border_taker border_wl
latest_snapshot_tolerant replace_partition stage_and_replace sync_upsert
catalog_search tag_counts_with_other category_manufacturer_matrix top10_active_users
usage_listing clean_nulls fold_rows_status_division catalog_ingest
""".split()
RUNS = 2


def seconds(run) -> float:
    times = []
    for _ in range(RUNS):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return round(min(times), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    times = {"daily_extracts": seconds(lambda: Extracts(spark, sf_dir).store_all())}
    extracts(spark, sf_dir).store_all()
    for name in HEADLINES:
        times[name] = seconds(
            lambda query=QUERIES[name]: query(spark, sf_dir)
            .write.format("noop")
            .mode("overwrite")
            .save()
        )
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries, faster of two runs each",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    drop_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
