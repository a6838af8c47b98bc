"""Time the headline queries: one JSON line on standard output.

Reads BENCH_SF_DIR (tables) and BENCH_CPUS (threads). Each query runs once over its whole tables and is
written to Spark's noop sink, so every column of every row is computed. Building the query is timed too, since
some queries write and read back files. Before that every query runs once, untimed, on the smallest tables
beside the given ones, so that the timings are of a warm JVM; BENCH_WARM=0 leaves this out.
"""

from __future__ import annotations

import json
import os
import sys
import time

from adjudica.catalogue import QUERIES
from adjudica.session import session

HEADLINE = [
    "version_numbering",
    "apply_versions_ffill",
    "carry_forward",
    "current_rows_dedup",
    "consolidate_union",
    "clean_chain",
    "clean_text",
    "lenient_types",
    "holders_explode",
    "amendment_shapes",
    "nested_holders",
    "json_lines",
    "json_layout_2022",
    "enrich_contracts",
    "cache_upsert",
    "seed_cache",
    "source_overlap",
    "activity_product_scores",
    "yearly_amounts",
    "yearly_stats",
    "global_counts",
    "source_stats",
    "normalised_contracts",
    "page_links",
    "payload_repair",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session("bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").write.format("noop").mode("overwrite").save()
    names = sys.argv[1:] or HEADLINE
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    warm = os.environ.get("BENCH_WARM", "1") != "0" and os.path.isdir(small)
    for name in names if warm else []:
        QUERIES[name](spark, small).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    report = {
        "metric": "total seconds of the headline queries" + (", warm" if warm else ""),
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()
