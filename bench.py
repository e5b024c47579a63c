"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "thr_sweep_windows", "thr_sweep_tolerance", "thr_sweep_rul", "join_asof",
    "join_interval_windows", "rs_grid_mean", "agg_describe", "agg_bin_features", "agg_corr_matrix",
    "agg_monthly_panel", "win_sliding_panel", "win_rolling_mean_std", "win_ewm", "fill_linear",
    "fill_time", "fill_knn", "scale_robust", "den_kde_1d", "eval_roc_auc", "surv_lookahead",
    "spl_stratified", "dec_regret", "ts_decompose", "fs_univariate", "ml_linear",
    "st_tumbling_count", "flagship_alarm",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from tidewright.plans import catalog
    from tidewright.session import local_session

    spark = local_session(cpus)
    queries = catalog.spark_queries()
    names = sys.argv[1:] or HEADLINE
    spark.read.parquet(f"{sf_dir}/region.parquet").count()
    times = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
