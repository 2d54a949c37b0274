"""Snapshots, categories and long gaps: what a table's shape must not change."""

import datetime
import math
import time

import pytest
from pyspark.sql import functions as F

from headroom.operators import features, forecast, risk
from headroom.sources import files


def test_latest_snapshot_reads_all_files_of_the_newest(spark, tmp_path):
    old, new = spark.range(50).repartition(3), spark.range(100, 400).repartition(6)
    files.write_parquet(old, str(tmp_path / "v1.parquet"))
    time.sleep(1.1)
    files.write_parquet(new, str(tmp_path / "v2.parquet"))
    files.write_parquet(old, str(tmp_path / "other.parquet"))
    got = files.latest_snapshot(spark, str(tmp_path), "v*.parquet")
    assert sorted(r.id for r in got.collect()) == list(range(100, 400))
    with pytest.raises(FileNotFoundError):
        files.latest_snapshot(spark, str(tmp_path), "w*")


def test_latest_snapshot_of_single_files(spark, tmp_path):
    for k, name in enumerate(("a.csv", "b.csv")):
        (tmp_path / name).write_text(f"id\n{k}\n")
        time.sleep(1.1)
    assert [r.id for r in files.latest_snapshot(spark, str(tmp_path), "*.csv", "csv").collect()] == ["1"]


def test_one_hot_has_no_limit_and_no_twins(spark):
    many = spark.range(700).select("id", F.concat(F.lit("v"), "id").alias("kind"))
    assert len(features.one_hot(many, ["kind"]).columns) == 701
    twins = spark.createDataFrame([("a", "a")], "region string, regime string")
    with pytest.raises(ValueError, match="reg_a"):
        features.one_hot(twins, ["region", "regime"])


def test_risk_matrix_takes_the_days_of_the_table(spark):
    rows = [("s1", datetime.date(2020, 1, 1), 2), ("s2", datetime.date(2020, 1, 9), 1)]
    out = risk.risk_matrix(spark.createDataFrame(rows, "server_id string, timestamp date, risk_code int")).orderBy("server_id").collect()
    assert [tuple(r) for r in out] == [("s1", 2, 0), ("s2", 0, 1)]


def test_smoothing_on_a_stale_server(spark):
    """400 values in 1990, then a gap of ten years."""
    day = datetime.date(1990, 1, 1)
    rows = [("old", day + datetime.timedelta(k), 10.0 + k % 7) for k in range(400)]
    rows += [("old", datetime.date(2000, 1, 1) + datetime.timedelta(k), 5.0) for k in range(5)]
    panel = spark.createDataFrame(rows, "server_id string, timestamp date, cpu_p95 double")
    out = forecast.forecast_table(panel, "cpu_p95", "2000-01-01", models=("ses", "theta", "baseline")).where("model = 'ses'").collect()
    level = rows[0][2]
    for _, _, y in rows[1:400]:
        level = 0.3 * y + 0.7 * level
    assert out and all(math.isclose(r.predicted, level, rel_tol=1e-9) for r in out)
