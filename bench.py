"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Each query writes its full result to the no-op sink. Stand-in tables are
written before the clock starts, as supplied data would be; decomposing names
and records and the match cascade are queries of their own, and later queries
start from their stored results.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.registry import QUERIES, Tables  # noqa: E402
from checks.standin import TABLES  # noqa: E402
from taxaloom.session import local_session  # noqa: E402

HEADLINE = [
    "clean_names", "name_ids", "match_exact_string", "match_exact_canonical", "match_stem",
    "match_fuzzy", "match_fuzzy_relaxed", "match_fuzzy_uninomial", "match_partial",
    "match_partial_fuzzy", "match_partial_fuzzy_relaxed", "match_genus_part", "match_cascade",
    "sources_matched", "best_result", "best_per_source", "best_results", "all_matches",
    "resolve_current", "nest_results", "flat_rows", "extract_facets", "facet_species",
    "search_batch", "lookup_name_strings", "attach_vernaculars", "source_stats", "rank_results",
    "verify_options",
]


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")))
    tables = Tables(spark, sf_dir)
    for name in TABLES:
        getattr(tables, name)
    drain(tables.name_records)  # first job of the session
    seconds: dict[str, float] = {}

    def timed(name: str, run) -> None:
        start = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - start, 3)

    timed("prepare_records", lambda: tables.records)
    timed("prepare_names", lambda: tables.names)
    timed("store_matches", tables.matches)
    for name in HEADLINE:
        timed(name, lambda: drain(QUERIES[name](spark, sf_dir)))
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
