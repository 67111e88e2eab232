"""Time the headline queries: ``BENCH_SF_DIR`` (tables), ``BENCH_CPUS`` (local threads). Prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from harvestline.session import get_spark  # noqa: E402
from workload import QUERIES  # noqa: E402

HEADLINE = [
    "w01_dedup_priority", "w04_upsert_updates_win", "w06_duplicates", "j01_join_daily", "j03_normalize_key", "j07_coverage",
    "j08_current_value", "a01_commodity_dimension", "a05_measure_profile", "a08_group_stats", "a09_price_trend",
    "a11_monthly_stats", "a13_calibrate", "a14_regression_metrics", "p06_trim_quantiles", "w07_lags", "w08_rolling",
    "w09_w11_momentum_volatility_change", "w13_w16_weather_features", "w15_impute", "w18_latest_features", "w19_time_folds",
    "v01_price_contract", "v05_repair_prices", "g01_j06_rule_score", "g05_m10_daily_curve", "g07_recommend", "g11_assess",
    "g12_outlook", "g16_joined_model_table", "k01_parquet_by_year", "k04_merge_partitions", "t01_upsert_stream",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark("bench", f"local[{cpus}]", int(cpus), spark__ui__enabled="false", spark__driver__memory="16g",
                      spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    names = [n for q in HEADLINE for n in QUERIES if n == q or n.endswith(f"_{q}")]
    run = lambda n: QUERIES[n](spark, sf).write.format("noop").mode("overwrite").save()
    run("a08_group_stats")  # start the JVM threads and warm the file cache
    times = {}
    for name in names:
        began = time.perf_counter()
        run(name)
        times[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
