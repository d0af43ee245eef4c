"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the cores.
Every query runs to the end into a no-op sink, after one warm-up query.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pageloom.plans import catalog
from pageloom.session import local_session

HEADLINE = [
    "links_per_domain", "normalize_url", "section_report", "crawl_frontier", "crawl_limited", "depth_summary",
    "download_manifest", "perceptual_hash", "leader_groups", "similar_pairs", "dedup_images", "embed_images",
    "fetch_outcome", "rate_audit", "stream_discover", "stream_rate_audit", "harvest_images", "full_chain", "sink_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "pageloom-bench")

    def run(name: str) -> float:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run("extract_links")
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        times[name] = run(name)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
