"""Time the headline queries on $BENCH_SF_DIR; prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from folioflow import schemas  # noqa: E402
from folioflow.operators import records  # noqa: E402
from folioflow.plans import catalog, jobs, landing_queries, scalar_queries, views  # noqa: E402
from folioflow.session import build_session, scratch_dir  # noqa: E402
from folioflow.sources import feeds, landing  # noqa: E402
from folioflow.streaming import landing as stream  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = [
    "w1_first_per_key", "a1_dedup_stats", "a21_dedup_analysis", "w2_batch_number", "a2_upsert_stats",
    "k3_upsert_frame", "k3_paper_upsert", "k5_vector_upsert", "j1_pending_backlog", "j2_trace_coverage",
    "j3_end_to_end_latency", "j4_retry_set", "f9_combine_text", "f10_truncation_chain", "f13_mean_pooling",
    "f14_l2_normalize", "p3_paper_valid", "p4_vector_valid", "u1_embed_texts", "e3_vectorize_traces",
    "s7_trace_retrieval", "t1_search_page", "a4_vectorization_status", "a10_source_profile", "a13_daily_rates",
    "a14_daily_durations", "a17_storage_growth", "a23_trace_outcome", "w4_latest_per_trace",
    "st4_error_windows_above_one", "st5_write_volume_alarm", "st6_stalled_traces", "st11_dedup_rate_warning",
    "st12_alert_summary", "r1_tier_plan",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    """The middle of the runs after one that warms up."""
    times = []
    for _ in range(RUNS + 1):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return sorted(times[1:])[RUNS // 2]


def main() -> None:
    spark = build_session(
        "folioflow-bench", f"local[{CPUS}]", spark__sql__shuffle__partitions=CPUS, spark__ui__enabled="false",
        spark__driver__memory="16g", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    # Landed files and stored tables are prepared outside the clock: a batch of papers, its feed, and papers with their index.
    landed = landing_queries._landed_files(spark, SF_DIR, "bench-landing")
    feed = scratch_dir(spark, "bench-feed")
    entries = views.feed_entries(spark, SF_DIR).select(*schemas.FEED_ENTRY.fieldNames())
    entries.withColumn("title", F.lit("title")).withColumn("summary", F.lit("text")).write.format("xml").option(
        "rootTag", "feed").option("rowTag", "entry").save(feed)
    papers = views.papers(spark, SF_DIR).count()
    stored = scalar_queries._stored_papers(spark, SF_DIR)
    by_trace = scalar_queries._papers_by_trace(stored)

    times["feed_to_papers"] = timed(lambda: run(records.entries_to_papers(feeds.read_feed(spark, feed))))
    times["landing_scan"] = timed(lambda: run(landing.read_landing(spark, landed)))
    times["landing_to_papers"] = timed(lambda: run(jobs.clean_batch(landing.read_landing(spark, landed), "t")))

    def whole_stream() -> None:
        store = stream.Store(spark, scratch_dir(spark, "bench-store"))
        stream.process_landing(spark, landed, store, scratch_dir(spark, "bench-state")).awaitTermination()

    times["stream_landing_to_vectors"] = timed(whole_stream)
    for name in HEADLINE:
        query = catalog.QUERIES[name]
        if name == "s7_trace_retrieval":
            times[name] = timed(lambda: run(scalar_queries.trace_lookup(stored, by_trace)))
        else:
            times[name] = timed(lambda: run(query(spark, SF_DIR)))

    sf = re.search(r"sf([0-9.]+)", SF_DIR)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": {k: round(v, 4) for k, v in times.items()}, "sf": float(sf.group(1)) if sf else SF_DIR,
        "cpus": int(CPUS), "papers": papers,
        "rates": {
            "papers_collected_per_sec": round(papers / times["feed_to_papers"], 1),
            "papers_landed_per_sec": round(papers / times["landing_to_papers"], 1),
            "papers_landed_and_vectorized_per_sec": round(papers / times["stream_landing_to_vectors"], 1),
            "vectors_per_sec_stand_in_encoder": round(papers / times["u1_embed_texts"], 1),
        },
    }), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
