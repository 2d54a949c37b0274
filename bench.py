"""Headline timings: prints one JSON line. BENCH_SF_DIR and BENCH_CPUS choose data and cores."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", str(2 * int(cpus))).config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from headroom.catalog import QUERIES
    from headroom.catalog.base import METRICS
    from headroom.operators import clean, features, validate
    from headroom.operators.segments import BUILT
    from headroom.sources import panels

    def run(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    def full_matrix():
        dims = panels.supplier_dimension(spark, folder).drop("server_no")
        return features.feature_matrix(panels.supplier_spine(spark, folder), dims)

    def load_validate():
        panel = panels.supplier_panel(spark, folder)
        return validate.missing_rates(clean.dedup_by_key(panel), METRICS)

    named = {
        "load_validate": load_validate,
        "interpolate_all": lambda: clean.interpolate_linear(panels.supplier_spine(spark, folder), METRICS, regular=BUILT),
        "feature_matrix_rows": full_matrix,
    }
    keys = ["dedup_by_key", "describe_stats", "lag_features", "rolling_stats", "cumulative_sum", "p95_rollup", "forecast_weekday_mean", "forecast_table",
            "best_model", "risk_summary", "breach_report"]
    named |= {k: (lambda k=k: QUERIES[k](spark, folder)) for k in keys}
    run(panels.supplier_metrics(spark, folder))
    times = {}
    for name, make in named.items():
        start = time.time()
        run(make())
        times[name] = round(time.time() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": folder.rstrip("/").rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
