"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; print one JSON line.

The tables are first written once more in as many files as there are CPUs, as any large table has them: a
table in a single row group is read by a single task, whatever the query does. This is not timed.
"""

from __future__ import annotations

import json
import os
import re
import time

from checks.queries import QUERIES
from replaystats.session import build_session, staging_root

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = os.environ.get("BENCH_QUERIES", "").split() or [
    "category_win_rate",
    "lobby_stats",
    "derived_matches",
    "explode_players",
    "prefer_left_union",
    "filter_new",
    "insert_ignore",
    "insert_match_players",
    "upsert_partial",
    "age_out_cache",
    "update_snapshots",
    "relevant_matches",
    "skill_per_mode",
    "win_loss_total",
    "match_history_top10",
    "daily_activity_84",
    "lobby_histogram",
    "faction_arrays",
    "skill_history_lag1",
    "skill_history_arrays",
    "pages_json",
    "packed_index",
]


TABLES = ("lineitem", "orders", "customer", "events", "nation", "supplier")


def spread(spark, sf_dir: str, files: int) -> str:
    folder = f"{staging_root(spark)}/tables"
    for name in TABLES:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").repartition(files).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return folder


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = spread(spark, SF_DIR, int(CPUS))
    QUERIES["category_win_rate"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm up the JVM
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        # The noop sink computes every row and column, unlike count().
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([\d.]+)", SF_DIR)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
