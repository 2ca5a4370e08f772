"""Wall time of the headline queries: one JSON line on standard output."""

import json
import os
import sys
import time

from stayline.plans import registry
from stayline.session import build_session

HEADLINE = [
    "clean_customers", "dq_expectations", "dq_row_errors", "numeric_summary", "describe_by_label",
    "churn_by_category", "correlations", "iqr_outliers", "feature_matrix", "feature_catalogue",
    "stratified_split_exact", "roc_auc", "pr_auc", "topk_metrics", "lift_deciles",
    "eval_by_split", "best_model", "score_scorecard", "score_with_rejects", "explain_topk",
    "global_importance", "psi_numeric", "psi_categorical", "ks_two_sample", "drift_features",
    "drift_summary", "perf_degradation", "cohorts", "cohort_actions", "journey_metrics",
    "clv_percentile", "clv_tiers", "kpis", "kpi_trend", "roi", "playbook_actions", "playbooks",
    "ab_test", "cohort_rollup", "normalize_events", "latest_scores", "stream_score",
    "upsert_scores", "train_baseline",
]


def run(names):
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, seconds = registry.queries(), {}
    # Class loading and the first code generation belong to the session, not to a query.
    queries["cohorts"](spark, folder).write.format("noop").mode("overwrite").save()
    for name in names:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    return folder, seconds


if __name__ == "__main__":
    folder, seconds = run(sys.argv[1:] or HEADLINE)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
