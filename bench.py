"""Time the headline queries: python bench.py. BENCH_SF_DIR and BENCH_CPUS choose the data and the cores."""

import json
import os
import re
import sys
import time

from binoscope.plans.catalog import queries
from binoscope.session import get_session

HEADLINE = ["A6_parquet_source", "B3_numeric_violations", "B6_key_violations", "B7_duplicate_rows", "C1_audit", "C2_describe_numeric",
            "C4_iqr_outliers", "C6_target_rates", "C8_correlation_matrix", "D1_stratified_split", "D3_stratified_folds", "D4_nested_folds",
            "E3_apply_scale", "E6_fit_per_fold", "F2_logistic", "G3_average_precision", "G7_evaluate", "G7_evaluate_models", "G8_threshold_table",
            "G12_capacity", "G15_bootstrap_ci", "G15_bootstrap_poisson", "G16_subgroups", "G17_subgroup_ci", "H3_seed_choices",
            "H13_compare_procedures", "I3_permutation_importance", "I5_top_contributions", "J1_drift_profile", "J5_drift_report",
            "K1_table_diff", "K4_fingerprint", "K6_recheck"]


def main(names: list[str]) -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session("bench", cores, shuffle_partitions=cores)
    registered, seconds = queries(), {}
    registered["A6_parquet_source"](spark, folder).write.format("noop").mode("overwrite").save()
    for name in names or HEADLINE:
        started = time.perf_counter()
        registered[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(f"{seconds[name]:8.3f} {name}", file=sys.stderr, flush=True)
    found = re.search(r"sf([0-9.]+)", folder)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
                      "sf": float(found.group(1)) if found else None}))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
