"""Times the headline queries and prints one JSON line. Settings: BENCH_SF_DIR, BENCH_CPUS, BENCH_QUERIES (comma separated)."""

from __future__ import annotations

import json
import os
import sys
import time

from caseloom.plans import registry
from caseloom.session import build_session

HEADLINE = [
    "ol0d_summary", "ol6_rollup_share", "ol10_pos_neg", "ol12_item_rates", "ol13_prevalence_gap", "ol15_incidence_vs_avg",
    "ol18_rollup_topk", "val4_orphans", "prf2_missing", "prf4_categories", "prf8_describe", "cln9_median_impute", "cln13_surrogate",
    "ag3_crosstab_pct", "ag9_box", "st1_chi2", "st2_mannwhitney", "st4_ks", "ev2_metrics", "ev3b_auc", "ev6_sweep",
    "fe2_split", "fe3_scale", "fe6_smote", "fs4_rank_agg", "txt2_split", "txt5_autism_notes", "txt13_diabetes_records",
    "txt15_stroke_notes", "xa5_rules", "cln14_split_star", "txt18_coverage", "ml1_logistic", "ml7_naive_bayes", "xa2_permutation",
    "xa3_shap", "xa4_local_surrogates",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    wanted = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"})
    names = [q for q in wanted if q in registry.QUERIES]
    # one warm-up query starts the JVM's threads and the parquet reader; its time is not reported
    registry.QUERIES["prf1_shape"](spark, sf_dir).collect()
    times: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
