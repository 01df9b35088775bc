"""Headline queries, timed warm, as one JSON line.

Every query first runs once on the smallest data set beside BENCH_SF_DIR (when there is one), so
that compiled code and Python workers are warm.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES
(comma-separated names, or "all"), BENCH_RUNS (default 1).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from casework import plans
from casework.session import build_session

HEADLINE = """
c1_chunk_fixed c2_chunk_ratio c3_chunk_by_key c4_dedupe_docs c7_dry_run c8_embed
r1_knn_exact r2_knn_approx r3_bm25 r4_rrf r6_hybrid_search o1_format_context
r7_tier_lookup r8_interval_conflicts r10_leave_clash r14_reconcile r16_owner_as_of w8_first_ack
a1_eval_cases a2_eval_report a7_latency_stats a9_audit_overview a11_deal_measures a12_funnel a13_forecast_by_month
a17_connector_policy a18_multi_owner a21_profile a23_correlation a24_histogram
w1_top_k w2_win_rate_12m w3_history w4_transcript w6_clarify_limit
d1_escalation d6_calibration d9_access_review d13_recurring
m1_label_encode m2_standardise m20_class_metrics m22_roc_auc m28_calinski_harabasz m29_davies_bouldin
s4_append_jsonl s5_upsert p16_reference_no t5_tumbling_counts
""".split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    every = plans.queries()
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(every) if wanted == "all" else wanted.split(",") if wanted else HEADLINE
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    small = os.path.join(os.path.dirname(folder.rstrip("/")), "sf0.001")
    times: dict[str, float] = {}
    for name in names:
        if os.path.isdir(small):
            every[name](spark, small).write.format("noop").mode("overwrite").save()
        taken = []
        for _ in range(runs):
            start = time.perf_counter()
            every[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": folder}))


if __name__ == "__main__":
    main()
