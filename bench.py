"""

Runs W1, W2, W3, A12, A9, U5, J3, H8, H13, E4 and R4-vs-R6 at
``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]``;
each query is run once to warm up, then timed 3 times (median), fully
executed through the ``noop`` sink.  U5 and J3 build from the given tables, the
others read the published star.  Building, checking and publishing the star
(``star_build``) is part of the total, like the analysed application's load.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = {
    "W1": "w1_top_n_per_group",
    "W2": "w2_yoy_growth",
    "W3": "w3_pareto",
    "A12": "a12_outcome_rates_by_group",
    "A9": "a9_total_by_type",
    "U5": "u5_unpivot_positive",
    "J3": "j3_u3_dimension_keys",
    "H8": "h8_mann_whitney",
    "H13": "h13_kruskal_wallis",
    "E4": "e4_roc_auc",
    "R4": "r4_industry_summary_live",
}


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _timed(fn, repeats: int = 3) -> float:
    fn()  # warm
    out = []
    for _ in range(repeats):
        s = time.perf_counter()
        fn()
        out.append(time.perf_counter() - s)
    return statistics.median(out)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from ledgerlens.plans import summaries as R
    from ledgerlens.plans.catalog import all_queries
    from ledgerlens.plans.star import warehouse
    from ledgerlens.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="ledgerlens-bench")
    queries = all_queries()
    from ledgerlens.plans.star import publish_star
    from ledgerlens.sources.warehouse import warehouse_root

    def build_and_publish(tag):
        publish_star(spark, sf_dir, warehouse_root(spark, f"bench-star-{tag}"))

    build_and_publish(f"warm-{time.time_ns()}")  # warm-up (JVM, codegen)
    s = time.perf_counter()
    build_and_publish(f"timed-{time.time_ns()}")  # always a full build + publish into a fresh folder
    star_build = time.perf_counter() - s
    tables = warehouse(spark, sf_dir)

    timings = {}
    for label, name in HEADLINE.items():
        fn = queries[name]
        timings[label] = round(_timed(lambda fn=fn: _run(fn(spark, sf_dir))), 4)

    root = warehouse_root(spark, "bench-summaries")
    published = R.refresh_summaries(tables, root)["industry_summary"]
    r6 = R.time_summary_vs_live(tables, published, repeats=3)
    timings["R6_summary_read"] = round(r6["summary_sec"], 4)
    timings["R6_live"] = round(r6["live_sec"], 4)

    timings["star_build"] = round(star_build, 3)
    total = round(star_build + sum(v for k, v in timings.items() if k in HEADLINE), 4)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_sec", "value": total, "unit": "sec", "queries": timings,
                      "queries_total_sec": round(total - star_build, 4),
                      "r6_speedup": round(r6["speedup"] or 0, 2),
                      "sf": float(sf) if sf.replace(".", "").isdigit() else sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
