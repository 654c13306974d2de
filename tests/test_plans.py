"""Plan-shape checks: no Python in the plans, pruned scans, pushed filters,
no single-partition exchange over fact rows."""

import pytest

from conftest import SF001
from ledgerlens.plans import catalog

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "MapInArrow",
            "FlatMapGroupsInArrow", "PythonUDF")
# queries whose plans touch fact rows through windows / rank operators
FACT_ORDERED = ["tail_head_mean_diff", "good_streak", "half_split_trend", "last_k_rate", "spending_trend",
                "recent_success_rate", "stratified_folds", "recency_pct_rank", "top_k_per_entity", "roc_auc",
                "auc_by_fold", "score_percentiles", "describe_features", "median_impute"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def full_plan(df) -> str:
    qe = df._jdf.queryExecution()
    return qe.optimizedPlan().toString() + "\n" + qe.executedPlan().toString()


#: MLlib and boosting fits, and the matrix form of wide correlations, whose partial sums are numpy products inside the tasks;
#: the weight grid, whose blends are sorted in numpy; aggregates that a user writes in Python
PYTHON_ALLOWED = {"logistic_fit", "forest_fit", "oof_scores", "gbt_importance", "random_search", "test_average", "selected_retrain",
                  "split_gains",
                  "wide_correlation", "blend_grid", "blend_best", "user_aggregates"}


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - PYTHON_ALLOWED))
def test_no_python_in_plan(spark, name):
    p = full_plan(catalog.QUERIES[name](spark, SF001))
    assert not any(n in p for n in PY_NODES), name


def single_partition_violations(p: str) -> list[str]:
    """Exchanges into one partition whose child is not a partial aggregate
    (i.e. a global sort or an un-partitioned window over full rows)."""
    lines = p.split("\n")
    bad = []
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            child = lines[i + 1] if i + 1 < len(lines) else ""
            if not ("HashAggregate" in child and "partial_" in child):
                bad.append(line.strip() + " -> " + child.strip()[:80])
    return bad


@pytest.mark.parametrize("name", FACT_ORDERED)
def test_no_single_partition_over_fact_rows(spark, name):
    df = catalog.QUERIES[name](spark, SF001)
    assert single_partition_violations(plan(df)) == [], name


def test_rollup_single_exchange_and_pruned_scan(spark):
    df = catalog.QUERIES["entity_rollup"](spark, SF001)
    p = plan(df)
    assert p.count("Exchange hashpartitioning") == 1
    assert "o_orderpriority" not in p.split("ReadSchema")[1].split("\n")[0]


def test_slice_filter_pushed_down(spark):
    df = catalog.QUERIES["band_window_agg"](spark, SF001)
    assert "IsNotNull(user_id)" in plan(df)


def test_pack_reads_each_fact_table_a_bounded_number_of_times(spark):
    """Each fact family is one aggregation joined once: a fact table is read by
    its rollup, its two-hop lookup and the two levels of the rank operator,
    never again for a second copy of the family."""
    import collections
    import re
    from ledgerlens.plans import q_pack
    p = plan(q_pack.pack(spark, SF001))
    scans = collections.Counter(re.findall(r"sf0\.01/(\w+)\.parquet", p))
    assert scans["orders"] <= 7 and scans["lineitem"] <= 4 and scans["events"] <= 4, scans
