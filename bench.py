"""Headline queries, timed one after another; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the tables and the cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pageloom.session import local_session  # noqa: E402
from workload.registry import QUERIES  # noqa: E402

HEADLINE = (
    "annotations_per_host", "html_blocks", "processed_html", "rule_annotations", "url_decision",
    "first_seen_pages", "canonical_url", "token_estimate", "token_batches", "annotation_pages",
    "annotations", "entity_dedup", "dictionary_entities", "annotation_upsert", "load_collection",
    "resume_decision", "run_summary", "crawl_run_summary", "warc_scan", "stream_first_seen",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    # One run of each on the smallest tables: workers start and code compiles off the clock.
    smallest = os.path.join(os.path.dirname(sf.rstrip("/")), "sf0.001")
    for name in HEADLINE:
        QUERIES[name](spark, smallest).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
