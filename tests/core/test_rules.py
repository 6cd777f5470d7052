"""Edges of the time-series rules, one small frame each."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fathomline.functions import scalars as s
from fathomline.functions.settings import SETTINGS, Experiment
from fathomline.operators import align, clean, features, fill, graph, grid, metrics, models, scale, spectral, windows
from fathomline.sources import readers, sinks

T0 = dt.datetime(2024, 1, 1)


def series(spark, values, name="a"):
    return spark.createDataFrame([(name, k, T0 + dt.timedelta(minutes=k), None if v is None else float(v)) for k, v in enumerate(values)], "series_id string, t long, ts timestamp, value double")


def values(df, column="value"):
    return [r[column] for r in df.orderBy("series_id", "t").collect()]


def test_gap_of_exactly_the_limit_is_filled_and_longer_is_not(spark):
    x = [None, 0.0] + [None] * 120 + [121.0] + [None] * 121 + [0.0, None]
    got = values(fill.interpolate_short_gaps(series(spark, x)))
    assert got[0] is None and got[-1] is None
    assert [round(v, 9) for v in got[1:123]] == [float(k) for k in range(122)]
    assert all(v is None for v in got[123:244])


def test_edges_and_empty_series(spark):
    assert values(fill.interpolate(series(spark, [None, 1, None, 3, None]), edges=True)) == [1, 1, 2, 3, 3]
    assert values(fill.interpolate(series(spark, [None, None]), edges=True)) == [None, None]
    report = fill.gap_stats(series(spark, [None, 1, None, None])).first()
    assert (report.na_count, report.na_ratio, report.gap_count, report.max_gap) == (3, 0.75, 2, 2)


def test_rolling_window_is_open_on_the_left(spark):
    rows = [("a", T0 + dt.timedelta(hours=h), float(h)) for h in (0, 24, 25)]
    df = spark.createDataFrame(rows, "series_id string, ts timestamp, value double")
    assert [r.w_n for r in clean.rolling_stats(df).orderBy("ts").collect()] == [1, 1, 2]


def test_rolling_stats_equal_pandas(spark):
    r = np.random.default_rng(1)
    at = np.cumsum(r.integers(1, 400, 300))
    x = r.normal(size=300).round(2)
    df = spark.createDataFrame([("a", T0 + dt.timedelta(minutes=int(m)), float(v)) for m, v in zip(at, x)], "series_id string, ts timestamp, value double")
    got = clean.rolling_stats(df).orderBy("ts").toPandas()
    want = pd.Series(x, index=pd.to_datetime([T0 + dt.timedelta(minutes=int(m)) for m in at])).rolling("24h", min_periods=1)
    assert np.allclose(got["w_mean"], want.mean()) and np.allclose(got["w_std"].astype(float), want.std(), equal_nan=True)


def test_rule_hours(spark):
    times = [(T0 + dt.timedelta(hours=1, minutes=20),), (T0 + dt.timedelta(hours=1, minutes=21),), (T0 + dt.timedelta(minutes=10),), (T0 + dt.timedelta(hours=3),)]
    df = spark.createDataFrame(times, "ts timestamp")
    got = {r.ts: r.aligned_ts for r in align.to_rule_hour(df, list(range(1, 24, 2))).collect()}
    assert [got[t[0]] for t in times] == [T0 + dt.timedelta(hours=1), None, None, T0 + dt.timedelta(hours=3)]


def test_asof_never_looks_forward(spark):
    left = spark.createDataFrame([("k", T0 + dt.timedelta(minutes=m), m) for m in (0, 5, 7)], "k string, ts timestamp, m int")
    right = spark.createDataFrame([("k", T0 + dt.timedelta(minutes=m), m * 10) for m in (5, 6, 9)], "k string, ts timestamp, v int")
    assert {(r.m, r.match.v) for r in align.asof_backward(left, right, ["k"]).collect()} == {(5, 50), (7, 60)}
    assert align.asof_backward(left, right, ["k"], keep_unmatched=True).count() == 3


def test_cleaning_stages(spark):
    assert values(clean.zero_to_null(series(spark, [0, 1]))) == [None, 1]
    assert values(clean.drop_iqr_outliers(series(spark, [5] * 9 + [99]))) == [5] * 9 + [99]  # no spread, left alone
    assert values(clean.drop_iqr_outliers(series(spark, [1, 2, 3, 4, 5, 6, 7, 8, 99])))[-1] is None
    assert values(clean.drop_far_from_median(series(spark, [10] * 9 + [16]))) == [10] * 9 + [None]
    assert clean.drop_empty_series(series(spark, [None, None])).count() == 0
    two = spark.createDataFrame([("a", T0, 2, 1.0), ("a", T0, 1, 2.0)], "series_id string, ts timestamp, place int, value double")
    assert clean.floor_to_minute(two, "place").first().value == 2.0


def test_windows_and_splits(spark):
    df = series(spark, range(20))
    assert windows.forecast_windows(df, 5, 3).count() == 20 - 5 - 3 + 1 and windows.imputation_windows(df, 20).count() == 1
    assert [r["n"] for r in grid.chronological_split(df, (0.6, 0.2, 0.2)).groupBy("split").agg(F.count("*").alias("n")).orderBy("n").collect()] == [4, 4, 12]
    assert grid.missing_steps(df.where("t <> 7"), "1 minute").count() == 1
    off = df.withColumn("ts", F.when(F.col("t") == 3, F.col("ts") + F.expr("INTERVAL 1 SECOND")).otherwise(F.col("ts")))
    assert grid.complete_grid(off.drop("t"), "1 minute").where("value IS NULL").count() == 1  # a row off the grid is lost


def test_scaler_round_trip_and_fallbacks(spark):
    df = grid.chronological_split(series(spark, [1, 2, 3, 4, 5, 6, 7, 8, 9, 10]), (0.6, 0.2, 0.2))
    stats = scale.fit_z(df)
    assert np.allclose(values(scale.inverse(scale.transform(df, stats), stats), "restored"), range(1, 11))
    flat = grid.chronological_split(series(spark, [3.0] * 5), (0.6, 0.2, 0.2))
    assert scale.fit_z(flat).first()["std"] == 1.0 and scale.fit_min_max(flat).first()["std"] == 1.0
    bad = grid.chronological_split(series(spark, [math.nan, math.inf, None]), (1.0, 0.0, 0.0))
    assert values(scale.transform(bad, scale.fit_z_safe(bad), safe=True), "scaled") == [0, 0, 0]


def test_masks(spark):
    df = series(spark, [0.0, 5e-5, 6e-5, None])
    got = df.select("t", s.valid_mask(F.col("value"), 0.0).alias("z"), s.valid_mask(F.col("value")).alias("n")).orderBy("t").collect()
    assert [(r.z, r.n) for r in got] == [(False, True), (False, True), (True, True), (True, False)]


def test_metrics_on_nothing_valid(spark):
    rows = spark.createDataFrame([("a", 0, 0, None, 1.0)], "series_id string, sample_id int, h int, y_true double, y_pred double")
    got = metrics.cell_metrics(metrics.with_mask(rows), ["series_id"]).first()
    assert (got.mae, got.mse, got.mape, got.smape, got.weight) == (0, 0, 0, 0, 0)


def test_moving_average_of_a_constant_and_numpy(spark):
    assert np.allclose(values(spectral.moving_average(series(spark, [4.0] * 9), 25), "trend"), 4)
    x = np.random.default_rng(2).normal(size=60)
    padded = np.r_[[x[0]] * 12, x, [x[-1]] * 12]
    assert np.allclose(values(spectral.moving_average(series(spark, x), 25), "trend"), np.convolve(padded, np.ones(25) / 25, "valid"))


@pytest.mark.parametrize("n", [1, 47, 48, 49, 60])
def test_dft_and_inverse(spark, n):
    x = np.random.default_rng(n).normal(size=n)
    spec = spectral.dft(series(spark, x))
    rows = spec.orderBy("f").collect()
    assert np.allclose([complex(r.re, r.im) for r in rows], np.fft.rfft(x))
    assert np.allclose(values(spectral.inverse_dft(spec)), x)
    corr = np.fft.irfft(np.abs(np.fft.rfft(x)) ** 2, n) / n
    assert np.allclose([r.value for r in spectral.circular_correlation(series(spark, x)).orderBy("lag").collect()], corr)


def test_laplacian_equals_numpy(spark):
    r = np.random.default_rng(5)
    a = (r.random((8, 8)) < 0.4) * r.random((8, 8))
    a = np.maximum(a, a.T)
    np.fill_diagonal(a, 0)
    edges = spark.createDataFrame([(int(i), int(j), float(a[i, j])) for i, j in zip(*np.nonzero(a))], "src int, dst int, weight double")
    d = np.where(a.sum(1) > 0, a.sum(1), np.inf) ** -0.5
    want = np.eye(8) - d[:, None] * a * d
    got = {(x.src, x.dst): x.weight for x in graph.laplacian(edges).collect()}
    assert all(abs(got.get((i, j), 0) - want[i, j]) < 1e-12 for i in range(8) for j in range(8) if a[i].any() and a[j].any())
    with pytest.raises(ValueError):
        graph.normalised(edges, "unknown")
    assert all(len(graph.normalised(edges, k)) == n for k, n in (("scalap", 1), ("doubletransition", 2), ("identity", 1), ("original", 1)))


def test_linear_models_recover_a_line(spark):
    samples = windows.forecast_windows(series(spark, [0.5 * k for k in range(60)]), 6, 3)
    out = models.nlinear(samples, models.fit_linear(samples, 6, 3, subtract_last=True))
    assert all(np.allclose(r.prediction, r.targets, atol=1e-3) for r in out.collect())
    assert features.feature_matrix(series(spark, range(5)), [1], [2]).columns[-5:] == ["value_lag_1m", "value_ma_2m", "value_std_2m", "value_max_2m", "value_min_2m"]


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "in.csv").write_text("﻿date, a ,b\n2024-01-01 00:00:00,1,x\nbad,2,3\n2024-01-01 01:00:00,3,4\n")
    got = {(r.series_id, r.ts.hour, r.value) for r in readers.read_dated_csv(spark, str(tmp_path / "in.csv")).collect()}
    assert got == {("a", 0, 1.0), ("b", 0, None), ("a", 1, 3.0), ("b", 1, 4.0)}
    (tmp_path / "edges.csv").write_text("from,to,distance\n0,1,2.5\n1,2\n2,0,1\n")
    assert readers.read_distances(spark, str(tmp_path / "edges.csv")).count() == 2
    with pytest.raises(ValueError):
        readers.strip_names(spark.createDataFrame([(1, 2)], "`a ` int, a int"))
    np.save(tmp_path / "x.npy", np.arange(6.0).reshape(3, 2))
    assert readers.load_npy(spark, str(tmp_path / "x.npy")).agg(F.sum("value")).first()[0] == 15
    np.savez(tmp_path / "x.npz", data=np.arange(12.0).reshape(3, 2, 2))
    assert readers.load_npz(spark, str(tmp_path / "x.npz"), 1).agg(F.sum("value")).first()[0] == 36
    df = grid.chronological_split(series(spark, range(10)), (0.6, 0.2, 0.2))
    sinks.write_splits(df, str(tmp_path / "out"))
    assert readers.read_arrays(spark, str(tmp_path / "out"), "val").count() == 2
    assert readers.inline_rows(spark, [["2024-01-01 00:00:00", 1, None]]).count() == 2
    with pytest.raises(ValueError):
        readers.check_metadata('{"split": {"train_len": 3}}', {"train": 4})


def test_identity_and_settings():
    a, b = Experiment("ETTh1", "DLinear", options={"gpus": 1, "lr": 0.1}), Experiment("ETTh1", "DLinear", options={"gpus": 2, "lr": 0.1})
    assert a.identity() == b.identity() != Experiment("ETTh1", "NLinear").identity() and Experiment.from_json(a.to_json()) == a
    assert SETTINGS["ETTm1"][-1] == 96


def test_streaming_means(spark, tmp_path):
    from fathomline.streaming.incremental import windowed_means

    rows = [("a", T0 + dt.timedelta(seconds=20 * k), float(k)) for k in range(12)]
    spark.createDataFrame(rows, "series_id string, ts timestamp, value double").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("series_id string, ts timestamp, value double").parquet(str(tmp_path / "in"))
    q = windowed_means(stream).writeStream.outputMode("complete").format("memory").queryName("means").start()
    q.processAllAvailable()
    q.stop()
    assert [r.value for r in spark.table("means").orderBy("ts").collect()] == [1.0, 4.0, 7.0, 10.0]


def test_scaled_laplacian_by_its_largest_eigenvalue(spark):
    r = np.random.default_rng(9)
    a = (r.random((9, 9)) < 0.5) * r.random((9, 9))
    a = np.maximum(a, a.T)
    np.fill_diagonal(a, 0)
    edges = spark.createDataFrame([(i, j, float(a[i, j])) for i in range(9) for j in range(9) if a[i, j]], "src int, dst int, weight double")
    d = np.diag(1 / np.sqrt(a.sum(1)))
    lap = np.eye(9) - d @ a @ d
    (out,) = graph.normalised(edges, "scalap", None)
    got = np.zeros((9, 9))
    for x in out.collect():
        got[x.src, x.dst] = x.weight
    assert np.allclose(got, 2 / np.linalg.eigvalsh(lap).max() * lap - np.eye(9), atol=1e-4)


@pytest.mark.parametrize("n", [5, 64, 150])
def test_legendre_state_equals_the_recurrence(spark, n):
    x = np.random.default_rng(n).normal(size=n)
    a, b = models.legendre_system(5)
    c = np.zeros(5)
    for v in x:
        c = a @ c + b * v
    assert np.allclose([r.value for r in models.legendre_state(series(spark, x), 5).orderBy("k").collect()], c)


def test_dynamic_modes_follow_a_linear_system(spark):
    t = np.arange(80)
    x = 0.99**t * np.cos(0.3 * t) + 0.5 * 0.97**t
    got = [r.value for r in models.dynamic_modes(series(spark, x), 4, 6).orderBy("h").collect()]
    t = np.arange(80, 86)
    assert np.allclose(got, 0.99**t * np.cos(0.3 * t) + 0.5 * 0.97**t, atol=1e-6)


def test_fitted_frequency_and_period_maps(spark):
    t = np.arange(400)
    x = np.sin(2 * np.pi * t / 8) + 0.5 * np.cos(2 * np.pi * t / 16)
    samples = windows.forecast_windows(series(spark, x), 32, 16)
    for out in (
        models.frequency_forecast(samples, models.fit_frequencies(samples, 32, 16, 9), 16),
        models.sparse_linear(samples, models.fit_cross_period(samples, 8, 32, 16), 8, 16),
        models.dlinear(samples, *models.fit_parts(samples, 32, 16, 5), 5),
    ):
        rows = out.collect()
        assert np.allclose([r.prediction for r in rows], [r.targets for r in rows], atol=0.05)


def test_rolling_stats_over_blocks_and_gaps(spark):
    r = np.random.default_rng(12)
    minutes = np.cumsum(r.choice([1, 7, 300, 2000], size=300, p=[0.5, 0.3, 0.15, 0.05]))
    values = [None if r.random() < 0.1 else float(round(v, 2)) for v in r.normal(100, 5, size=300)]
    ts = [T0 + dt.timedelta(minutes=int(m)) for m in minutes]
    df = spark.createDataFrame([("a", x, v) for x, v in zip(ts, values, strict=True)], "series_id string, ts timestamp, value double")
    got = {row.ts: row for row in clean.rolling_stats(df).collect()}
    for x in ts:
        near = [v for y, v in zip(ts, values, strict=True) if v is not None and x - dt.timedelta(hours=24) < y <= x]
        assert got[x].w_n == len(near)
        if near:
            assert np.isclose(got[x].w_mean, np.mean(near), atol=1e-9)
        if len(near) > 1:
            assert np.isclose(got[x].w_std, np.std(near, ddof=1), atol=1e-8)


def test_array_files_and_folders(spark, tmp_path):
    x = np.arange(24, dtype="<f4").reshape(6, 4)
    x[1, 2] = np.nan
    x.tofile(tmp_path / "data.dat")
    np.save(tmp_path / "shape.npy", np.array(x.shape))
    rows = readers.load_memmap(spark, str(tmp_path)).orderBy("seq_id").collect()
    assert [r.seq for r in rows] == [[None if v != v else v for v in row.tolist()] for row in x]
    assert readers.missing_files(spark, str(tmp_path), ["data.dat", "meta.json"]) == ["meta.json"]


def test_null_columns_go_and_numeric_ones_are_named(spark):
    df = spark.createDataFrame([(1, None, "a", None), (2, None, None, 2.0)], "`a.b` long, none double, s string, d double")
    assert clean.drop_null_columns(df).columns == ["a.b", "s", "d"] and clean.numeric_columns(df) == ["a.b", "none", "d"]
    assert clean.drop_null_columns(df.limit(0)).columns == df.columns
