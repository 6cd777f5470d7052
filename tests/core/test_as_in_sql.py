"""Edges on which a query must agree with its SQL to the letter, one small table each."""

import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

from fathomline import registry
from fathomline.operators import grid
from fathomline.plans import samples

T0 = dt.datetime(2024, 1, 1)


def test_split_shares_are_decimals(spark):
    df = spark.range(360).select(F.lit("a").alias("series_id"), F.col("id").alias("t"))
    parts = grid.chronological_split(df, (0.7, 0.1, 0.2)).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in parts} == {"train": 252, "val": 36, "test": 72}


@pytest.fixture
def near_mean(spark, tmp_path):
    """Events of one user, one of them less than half a step of the rounding below the mean."""
    rows = [(k, T0 + dt.timedelta(minutes=k), 0, "view", v, "{}") for k, v in enumerate([499999.5, 0.0, 1000000.0])]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(str(tmp_path / "events.parquet"))
    return tmp_path


def as_text(spark, name, sf):
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW events AS SELECT * FROM '{sf}/events.parquet/*.parquet'")
        expected = [row[-1] for row in db.execute(registry.oracle_sql()[name]).fetchall()]
    return str([r["seq"] for r in registry.queries()[name](spark, str(sf)).collect()]), str(expected)


def test_mixup_keeps_the_sign_of_rounded_zero(spark, near_mean):
    got, expected = as_text(spark, "x8_mixup", near_mean)
    assert got == expected and "-0.0" in got


def test_sample_norm_keeps_the_sign_of_rounded_zero(spark, near_mean):
    got, expected = as_text(spark, "x10_x11_sample_norm_and_anomalies", near_mean)
    assert got == expected and "-0.0" in got


def test_sample_norm_at_the_threshold(spark, tmp_path):
    """Deviations of exactly 1.5: the last bit of mean and deviation decides what is masked."""
    users = [[375.96, 349.4, 309.56, 336.12, 349.4, 296.28], [349.89, 349.89, 315.31, 419.05, 367.18, 401.76], [158.69, 182.77, 182.77, 176.75, 164.71, 194.81], [303.73, 290.45, 290.45, 257.25, 277.17, 283.81, 283.81]]
    rows = [(10 * u + k, T0 + dt.timedelta(minutes=k), u, "view", v, "{}") for u, values in enumerate(users) for k, v in enumerate(values)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(str(tmp_path / "events.parquet"))
    name = "x10_x11_sample_norm_and_anomalies"
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
        expected = dict(db.execute(registry.oracle_sql()[name]).fetchall())
    assert {r["user_id"]: r["seq"] for r in registry.queries()[name](spark, str(tmp_path)).collect()} == expected


def test_arrays_round_as_duckdb_does(spark):
    values = [k / 1e6 for k in range(5, 40000, 10)] + [-1.000005, 0.0, -2e-6, 560.210005, None]
    with duckdb.connect() as db:
        expected = db.execute("SELECT list_transform(?::DOUBLE[], lambda x: round(x, 5))", [values]).fetchone()[0]
    got = samples.arrays(spark.createDataFrame([(values,)], "v array<double>"), "v", digits=5).first()["v"]
    assert str(got) == str(expected)
