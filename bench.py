"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line on stdout."""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from extractkit.plans.queries import QUERIES  # noqa: E402

HEADLINE = (
    "generate_pairs",
    "validate_lines",
    "validate_by_code",
    "split_exact",
    "assign_splits",
    "numbered_scan",
    "jsonl_roundtrip",
    "json_flatten",
    "encode_tokens",
    "label_mask",
    "batch_extract",
    "phrase_extract",
    "eval_report",
    "compare_models",
    "compare_paths",
)


def timed(query, spark, sf_dir: str) -> float:
    """Seconds to compute every row and column of the result, from the second of two runs.

    The first compiles the generated code, a cost per job and not per row.
    """
    for _ in range(2):
        start = time.perf_counter()
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds = time.perf_counter() - start
    return round(seconds, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    seconds = {name: timed(QUERIES[name], spark, sf_dir) for name in names}
    sf = re.search(r"sf([0-9.]+)/?$", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(sf.group(1)) if sf else None,
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
