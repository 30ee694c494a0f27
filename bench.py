"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line. Each query is timed to a full materialisation
(``write.format("noop")``), after one untimed warm-up of the session.
Also reports store entries needed and written by a cold and a warm run; that a
content is extracted once is counted in tests/test_pipeline.py.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from quarry.plans import catalogue, fixture_profiles, pipeline  # noqa: E402
from quarry.session import get_session, work_dir  # noqa: E402
from quarry.sources import fixtures  # noqa: E402
from quarry.sources.store import ResultStore  # noqa: E402

HEADLINE = ["q_search_content", "q_display_metadata", "q_generate_metadata", "q_html_extract",
            "q_parse_properties", "q_map_properties", "q_metadata_display", "q_fold_outcomes",
            "q_resolve_attempts", "q_distinct_content", "q_path_conflicts", "q_request_kind", "q_search_content_failures",
            "q_extract_pages", "q_record_roundtrip"]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    catalogue.q_route(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    times = {}
    for name in HEADLINE:
        t0 = time.time()
        catalogue.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    # Store round trip: cold run fills the store, warm run must extract nothing.
    root = work_dir(spark, f"bench-store-{os.getpid()}-{int(time.time())}")
    store = ResultStore(spark, root)
    files = fixtures.files(spark, sf_dir)
    asked = {}
    for run in ("cold", "warm"):
        s = pipeline.Settings(config=fixture_profiles.config(), store=store)
        t0 = time.time()
        pipeline.generate(spark, files, s).write.format("noop").mode("overwrite").save()
        times[f"e2e_{run}_store"] = round(time.time() - t0, 3)
        asked[run] = store.state().count()
    needed = (pipeline.prepare_files(spark, files, s).where("request_rank > 0").select("store", "sha1").distinct().count())
    st = store.state()
    distinct = files.select(F.sha1("content")).distinct().count()
    n_files = files.count()
    out = {"metric": "total_headline_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")),
           "files": n_files, "distinct_contents": distinct, "store_entries_after_cold": asked["cold"],
           "entries_needed": needed, "store_entries_after_warm": st.count(), "store_versions": store.version(),
           "files_per_sec_cold": round(n_files / max(times["e2e_cold_store"], 1e-9), 1)}
    print(json.dumps(out))


if __name__ == "__main__":
    main()
