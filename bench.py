"""Time the headline queries and print one JSON line.

BENCH_SF_DIR   table folder (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  names separated by commas, or "all"
BENCH_RUNS     timed runs per query after one warm-up (default 3); the median counts
"""

import contextlib
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark import SparkConf
from pyspark.sql import SparkSession

from checks.queries import QUERIES

HEADLINE = (
    "scan_jsonl api_result_items json_triage warc_scan cdx_rows parse_jsonl_payload export_jsonl "
    "category_names media_urls og_extract glossary_rows pii_redact lang_normalize lang_distribution audit_gate "
    "keyword_filter keyword_hits filter_noise extract_intent map_taxonomy adaptation_chain terms_by_lang "
    "archive_dedup cdx_collapse cdx_select batch_assign page_of dedup_exact source_fallback stream_scrub "
    "adapt_identity news_rows crowd_reports end_to_end"
).split()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = sorted(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if not SparkConf().get("spark.checkpoint.dir"):
        builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="sitrep-bench-"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    with contextlib.redirect_stdout(sys.stderr):
        for name in names:
            taken = []
            for _ in range(runs + 1):
                start = time.perf_counter()
                QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                taken.append(time.perf_counter() - start)
            times[name] = round(statistics.median(taken[1:]), 3)
    spark.stop()
    result = {
        "metric": "headline_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
