"""Time the headline queries: ``BENCH_SF_DIR`` on ``local[BENCH_CPUS]``, one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from acceptance.queries import QUERIES
from acceptance.session import local_session

HEADLINE = (
    "page_links", "page_tag_counts", "page_nav", "clean_text", "organizations_listing", "facilities_listing",
    "experts_listing", "keep_first", "append_new", "running_total", "batch_ids", "first_stable", "attempt_outcome",
    "resolve_option", "completeness", "top_values", "grid_rows", "activity_union", "kv_pairs", "contacts", "expert_facts",
    "facility_facts", "organization_facts",
)
# Tables whose rows stand for what the query reads: pages or listing rows.
PAGES = {"page_links": "pages", "facility_facts": "part", "organization_facts": "customer", "expert_facts": "supplier"}
ROWS = {"organizations_listing": "customer", "facilities_listing": "part", "grid_rows": "part", "activity_union": "orders"}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    count = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet").count()
    QUERIES["page_links"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # start the Python workers

    seconds, rates = {}, {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        for kind, tables in (("pages_per_sec", PAGES), ("rows_per_sec", ROWS)):
            if name in tables:
                rates.setdefault(kind, {})[name] = round(count(tables[name]) / seconds[name], 1)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "cpus": cpus,
                **rates,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
