"""Benchmark the headline catalogue queries.

Runs on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` (default sf0.1). Each
query is forced to completion with the ``noop`` sink (full computation, no
driver collection); the time is the median of ``$BENCH_REPS`` runs after one
warm-up. With ``BENCH_DUCKDB=1`` the same oracle SQL is timed in DuckDB on the
same Parquet files as a single-node yardstick.

Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

HEADLINE = [
    "feature_spine_join", "entity_rollup", "status_counts", "recent_vs_old_agg", "two_hop_rollup",
    "category_shares", "cross_table_features", "recency_pct_rank", "first_last_trend", "tail_head_mean_diff",
    "good_streak", "half_split_trend", "last_k_rate", "spending_trend", "ratio_trend", "recent_success_rate",
    "top_k_per_entity", "clip_score", "median_impute", "group_median_impute", "describe_features", "box_stats",
    "corr_matrix", "score_percentiles", "stratified_folds", "roc_auc", "auc_by_fold", "roc_points",
    "late_under_flags", "blend_gain", "wide_correlation", "credit_bureau_family",
    "credit_prev_family", "credit_instalment_family", "credit_pos_family", "credit_card_family", "credit_pack",
    "blend_grid",
]


#: timed once: it multiplies the distinct score tuples by 231
ONCE = {"blend_grid"}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    names = sys.argv[1:] or HEADLINE
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from ledgerlens.plans import catalog
    from ledgerlens.session import get_spark

    spark = get_spark(cpus, shuffle_partitions=int(cpus) * 2)
    catalog.QUERIES[names[0]](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up

    times = {}
    for n in names:
        runs = []
        for _ in range(1 if n in ONCE else reps):
            t0 = time.perf_counter()
            catalog.QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[n] = round(statistics.median(runs), 3)

    out = {"metric": "total_sec_headline_queries", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""), "cpus": int(cpus)}

    if os.environ.get("BENCH_DUCKDB") == "1":
        import duckdb
        from ledgerlens.plans.verify import duck
        con = duck(sf_dir)
        con.execute(f"SET threads TO {int(cpus)}")
        dt = {}
        for n in names:
            q = catalog.ORACLE.get(n) if n not in ONCE else None
            if q is None:
                continue
            t0 = time.perf_counter()
            con.execute(q).fetchall()
            dt[n] = round(time.perf_counter() - t0, 3)
        out["duckdb_queries"] = dt
        out["duckdb_value"] = round(sum(dt.values()), 3)
        out["duckdb_version"] = duckdb.__version__
    print(json.dumps(out))


if __name__ == "__main__":
    main()
