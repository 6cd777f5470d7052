"""Forecast scoring, models, prediction export and the flagship query."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathomline.operators import analytics, fill, grid, metrics, models, scale, windows
from fathomline.plans.base import FILLED, HOURLY, NEIGHBOURS, events, filled, hourly, query, rounded
from fathomline.plans.samples import SPLIT, WINDOWS, split

#: Forecasts to score: the value a day before, of the last fifth; every 13th target and every 29th prediction is missing.
ROWS = ", f AS (SELECT series_id, t // 24 AS sample_id, t % 24 AS h, CASE WHEN t % 13 = 0 THEN NULL ELSE value END AS y_true, lag(value, 24) OVER (PARTITION BY series_id ORDER BY t) AS y_pred FROM filled), rows_ AS (SELECT *, CASE WHEN y_true IS NULL THEN 0.0 ELSE 1.0 END AS m, coalesce(y_pred, 0) * (CASE WHEN y_true IS NULL THEN 0.0 ELSE 1.0 END) AS pz, coalesce(y_true, 0) AS tz FROM f WHERE y_pred IS NOT NULL)"


def forecasts(spark, sf):
    from fathomline.operators.grid import in_order

    rows = filled(spark, sf)
    out = rows.select("series_id", F.floor(F.col("t") / 24).alias("sample_id"), F.pmod("t", F.lit(24)).alias("h"), F.when(F.col("t") % 13 != 0, F.col("value")).alias("y_true"), F.lag("value", 24).over(in_order()).alias("y_pred"))
    return metrics.with_mask(out.where("y_pred IS NOT NULL"))


def curriculum_length(epoch: int, warm: int, every: int, step: int, horizon: int) -> int:
    """Horizon of an epoch: all of it while warming up, then ``step`` more every ``every`` epochs."""
    return horizon if epoch <= warm else min(((epoch - 1 - warm) // every + 1) * step, horizon)


CELLS = """round(coalesce(sum(coalesce(abs(y_pred - y_true), 0) * m) / nullif(sum(m), 0), 0), 5) AS mae, round(coalesce(sum(coalesce((y_pred - y_true) ** 2, 0) * m) / nullif(sum(m), 0), 0), 4) AS mse, round(sqrt(coalesce(sum(coalesce((y_pred - y_true) ** 2, 0) * m) / nullif(sum(m), 0), 0)), 5) AS rmse,
round(coalesce(sum(CASE WHEN abs(y_true) > 5e-5 THEN abs((y_pred - y_true) / y_true) ELSE 0 END) / nullif(sum(CASE WHEN abs(y_true) > 5e-5 THEN 1.0 ELSE 0 END), 0), 0), 5) AS mape,
round(coalesce(sum(CASE WHEN abs(y_true) > 5e-5 THEN abs(y_pred - y_true) / ((abs(y_pred) + abs(y_true)) / 2) ELSE 0 END) / nullif(sum(CASE WHEN abs(y_true) > 5e-5 THEN 1.0 ELSE 0 END), 0), 0), 5) AS smape,
round(avg(CASE WHEN abs(pz - tz) < 1 THEN 0.5 * (pz - tz) ** 2 ELSE abs(pz - tz) - 0.5 END), 5) AS huber, sum(m)::DOUBLE AS weight"""


@query("m1_m4_m6_m9_cell_metrics", "WITH" + FILLED + ROWS + f" SELECT series_id, {CELLS} FROM rows_ GROUP BY 1")
def m1(spark, sf):
    return rounded(metrics.cell_metrics(forecasts(spark, sf), ["series_id"]), 5, mse=4)


@query("m4_mape_without_mask", "WITH" + FILLED + ROWS + " SELECT series_id, round(sum(CASE WHEN abs(y_true) > 5e-5 THEN abs((y_pred - y_true) / y_true) ELSE 0 END) / count(*), 5) AS mape_all FROM rows_ GROUP BY 1")
def m4(spark, sf):
    return rounded(metrics.mape_unmasked(forecasts(spark, sf), ["series_id"]), 5)


HORIZON = """SELECT {0}, sum(abs(pz - tz)) AS ae, sum(abs(tz)) AS at_, sum((pz - tz) ** 2) AS se, sum(tz * tz) - sum(tz) * sum(tz) / count(*) AS st,
count(*) * sum(y_pred * y_true) - sum(y_pred) * sum(y_true) AS cov, count(*) * sum(y_pred * y_pred) - sum(y_pred) * sum(y_pred) AS vp, count(*) * sum(y_true * y_true) - sum(y_true) * sum(y_true) AS vt, sum(m) AS m FROM rows_ GROUP BY {0}"""
REDUCED = "round(avg(ae / (at_ + 5e-5)), 5) AS wape, round(avg(1 - se / (st + 1e-6)), 4) AS r2, round(coalesce(sum(CASE WHEN vp > 1e-9 AND vt > 1e-9 THEN cov / (sqrt(vp) * sqrt(vt)) ELSE 0 END * m) / nullif(sum(m), 0), 0), 5) AS corr"


@query("m5_m7_m8_horizon_metrics", "WITH" + FILLED + ROWS + ", s AS (" + HORIZON.format("series_id, sample_id") + f") SELECT series_id, {REDUCED} FROM s GROUP BY 1")
def m5(spark, sf):
    return rounded(metrics.horizon_metrics(forecasts(spark, sf), ["series_id"]), 5, r2=4)


@query("m12_per_horizon_metrics", "WITH" + FILLED + ROWS + ", s AS (" + HORIZON.format("h, sample_id") + f") SELECT h, {REDUCED} FROM s GROUP BY 1")
def m12(spark, sf):
    return rounded(metrics.horizon_metrics(forecasts(spark, sf), ["h"], over=["h", "sample_id"]), 5, r2=4)


@query("m13_m14_a13_a14_meters", "WITH" + FILLED + ROWS + f", b AS (SELECT sample_id // 7 AS batch_id, {CELLS} FROM rows_ GROUP BY 1) SELECT round(sum(mape * weight) / sum(weight), 4) AS mape, round(sqrt(sum(rmse * rmse * weight) / sum(weight)), 3) AS rmse FROM b")
def m13(spark, sf):
    each = metrics.cell_metrics(grid.batches(forecasts(spark, sf), 7), ["batch_id"]).withColumn("one", F.lit(1))
    mape, rmse = metrics.meter(each, "mape", "weight", ["one"]), metrics.meter(each, "rmse", "weight", ["one"], square=True)
    return rounded(mape.join(rmse, "one").drop("one"), 4, rmse=3)


@query("m10_accuracy", "SELECT avg(CASE WHEN user_id % 4 = event_id % 4 THEN 1.0 ELSE 0.0 END) AS accuracy FROM events")
def m10(spark, sf):
    return metrics.accuracy(events(spark, sf).select((F.col("user_id") % 4).alias("y_pred"), (F.col("event_id") % 4).alias("y_true")))


@query("m11_custom_metric", "WITH" + FILLED + ROWS + " SELECT series_id, round(max(abs(y_pred - y_true)), 5) AS worst FROM rows_ GROUP BY 1")
def m11(spark, sf):
    return rounded(metrics.custom(forecasts(spark, sf), ["series_id"], worst=F.max(F.abs(F.col("y_pred") - F.col("y_true")))), 5)


@query("hi_historical_inertia", "WITH" + FILLED + WINDOWS.format(11) + " SELECT series_id, sample_id, list_transform(v[5:8], lambda x: round(x, 6)) AS prediction FROM w WHERE len(v) = 12")
def hi(spark, sf):
    out = models.historical_inertia(windows.forecast_windows(filled(spark, sf), 8, 4), 4)
    return out.select("series_id", "sample_id", F.transform("prediction", lambda x: F.round(x, 6)).alias("prediction"))


@query("hi_reversed", "WITH" + FILLED + WINDOWS.format(11) + " SELECT series_id, sample_id, list_transform(list_reverse(v[5:8]), lambda x: round(x, 6)) AS prediction FROM w WHERE len(v) = 12")
def hir(spark, sf):
    out = models.historical_inertia(windows.forecast_windows(filled(spark, sf), 8, 4), 4, reverse=True)
    return out.select("series_id", "sample_id", F.transform("prediction", lambda x: F.round(x, 6)).alias("prediction"))


def _scored(samples):
    return rounded(metrics.cell_metrics(metrics.with_mask(models.scored_rows(samples)), ["series_id"]).select("series_id", "mae", "rmse"), 4)


@query("nlinear_least_squares")
def nlinear(spark, sf):
    samples = windows.forecast_windows(filled(spark, sf), 24, 12)
    return _scored(models.nlinear(samples, models.fit_linear(samples, 24, 12, subtract_last=True)))


@query("dlinear_least_squares")
def dlinear(spark, sf):
    samples = windows.forecast_windows(filled(spark, sf), 24, 12)
    return _scored(models.dlinear(samples, *models.fit_parts(samples, 24, 12, 5), 5))


@query("sparsetsf_cross_period")
def sparse(spark, sf):
    samples = windows.forecast_windows(filled(spark, sf), 48, 24)
    return _scored(models.sparse_linear(samples, models.fit_cross_period(samples, 24, 48, 24), 24, 24))


@query("lightts_shortcut")
def shortcut(spark, sf):
    samples = windows.forecast_windows(filled(spark, sf), 24, 12)
    return _scored(models.linear(samples, models.fit_linear(samples, 24, 12)))


@query("fits_frequency_map")
def fits(spark, sf):
    samples = windows.forecast_windows(filled(spark, sf), 48, 24)
    return _scored(models.frequency_forecast(samples, models.fit_frequencies(samples, 48, 24, 12), 24))


#: A map of two delays has a closed form: the normal equations of two unknowns, then steps one by one.
MODES = """, d AS (SELECT series_id, t, value AS y, lag(value, 1) OVER o AS b, lag(value, 2) OVER o AS a FROM filled WINDOW o AS (PARTITION BY series_id ORDER BY t)),
s AS (SELECT series_id, sum(a * a) AS aa, sum(a * b) AS ab, sum(b * b) AS bb, sum(a * y) AS ay, sum(b * y) AS yb FROM d WHERE a IS NOT NULL GROUP BY 1),
w AS (SELECT series_id, (ay * bb - yb * ab) / (aa * bb - ab * ab) AS p, (yb * aa - ay * ab) / (aa * bb - ab * ab) AS q FROM s),
e AS (SELECT series_id, max_by(b, t) AS a, max_by(y, t) AS b FROM d GROUP BY 1),
steps AS (SELECT series_id, 0 AS h, b AS a, p * a + q * b AS b FROM e JOIN w USING (series_id) UNION ALL SELECT x.series_id, h + 1, x.b, p * x.a + q * x.b FROM steps x JOIN w ON w.series_id = x.series_id WHERE h < 11)"""


@query("f19_f31_dynamic_modes", "WITH RECURSIVE" + FILLED + MODES + " SELECT series_id, CAST(h AS BIGINT) AS h, round(b, 4) AS value FROM steps")
def dmd(spark, sf):
    return rounded(models.dynamic_modes(filled(spark, sf), 2, 12), 4)


def _legendre_sql(order: int = 6) -> str:
    a, b = models.legendre_system(order)
    row = lambda i: " + ".join([*(f"({float(a[i, j])!r}::DOUBLE * c{j})" for j in range(order)), f"({float(b[i])!r}::DOUBLE * value)"])
    columns = ", ".join(f"c{i}" for i in range(order))
    return (
        ", st AS (SELECT DISTINCT series_id, CAST(-1 AS BIGINT) AS t, " + ", ".join(f"0.0::DOUBLE AS c{i}" for i in range(order)) + " FROM filled UNION ALL SELECT f.series_id, f.t, " + ", ".join(row(i) for i in range(order))
        + f" FROM st JOIN filled f ON f.series_id = st.series_id AND f.t = st.t + 1), z AS (SELECT * FROM st QUALIFY t = max(t) OVER (PARTITION BY series_id)) SELECT series_id, k, round([{columns}][k + 1], 4) AS value FROM z, (SELECT unnest(range(0, {order}))::INT AS k)"
    )


@query("f20_legendre_state", "WITH RECURSIVE" + FILLED + _legendre_sql())
def legendre(spark, sf):
    return rounded(models.legendre_state(filled(spark, sf), 6), 4)


J4 = ", f AS (SELECT series_id, sample_id, h, v[5 + h] AS y_pred FROM w, (SELECT unnest([0, 1, 2, 3]) AS h) WHERE len(v) = 12), times AS (SELECT DISTINCT t - 8 - h AS sample_id, h, ts FROM filled, (SELECT unnest([0, 1, 2, 3]) AS h) WHERE t % 5 > 0)"


@query("j4_join_on_sample_and_horizon", "WITH" + FILLED + WINDOWS.format(11) + J4 + " SELECT f.series_id, f.sample_id AS sample_index, CAST(f.h + 1 AS INT) AS horizon_index, round(y_pred, 6) AS y_pred, ts AS \"Timestamp\" FROM f LEFT JOIN times USING (sample_id, h)")
def j4(spark, sf):
    rows = filled(spark, sf)
    out = models.scored_rows(models.historical_inertia(windows.forecast_windows(rows, 8, 4), 4)).select("series_id", F.col("sample_id").alias("sample_index"), (F.col("h") + 1).alias("horizon_index"), "y_pred")
    times = rows.where("t % 5 > 0").select("t", F.col("ts").alias("Timestamp")).distinct().withColumn("horizon_index", F.explode(F.array(*(F.lit(h) for h in (1, 2, 3, 4)))))
    times = times.select((F.col("t") - 7 - F.col("horizon_index")).alias("sample_index"), "horizon_index", "Timestamp")
    return rounded(out.join(times, ["sample_index", "horizon_index"], "left"))


@query("l17_prediction_export", "WITH" + FILLED + WINDOWS.format(11) + ", f AS (SELECT series_id, sample_id, h, v[5 + h] AS y_pred, v[9 + h] AS y_true FROM w, (SELECT unnest([0, 1, 2, 3]) AS h) WHERE len(v) = 12) SELECT f.series_id AS target_name, sample_id AS sample_index, CAST(h + 1 AS INT) AS horizon_index, ts AS \"Timestamp\", 8 + sample_id + h AS target_local_index, round(y_true, 6) AS y_true, round(y_pred, 6) AS y_pred, round(y_pred - y_true, 6) AS prediction_minus_true, round(abs(y_pred - y_true), 6) AS abs_error FROM f JOIN filled g ON g.series_id = f.series_id AND g.t = 8 + sample_id + h")
def l17(spark, sf):
    rows = filled(spark, sf)
    out = models.scored_rows(models.historical_inertia(windows.forecast_windows(rows, 8, 4), 4))
    timed = out.withColumn("t", 8 + F.col("sample_id") + F.col("h")).join(rows.select("series_id", "t", F.col("ts").alias("Timestamp")), ["series_id", "t"])
    e = F.col("y_pred") - F.col("y_true")
    return rounded(timed.select(F.col("series_id").alias("target_name"), F.col("sample_id").alias("sample_index"), (F.col("h") + 1).alias("horizon_index"), "Timestamp", F.col("t").alias("target_local_index"), "y_true", "y_pred", e.alias("prediction_minus_true"), F.abs(e).alias("abs_error")))


@query("a18_residual_variance", "WITH" + FILLED + WINDOWS.format(11) + ", f AS (SELECT series_id, sample_id + h AS step, v[5 + h] - v[9 + h] AS r FROM w, (SELECT unnest([0, 1, 2, 3]) AS h) WHERE len(v) = 12) SELECT series_id, step, round(avg(r), 5) AS residual_mean, round(avg(r * r) - avg(r) * avg(r), 4) AS residual_var FROM f GROUP BY 1, 2")
def a18(spark, sf):
    out = models.scored_rows(models.historical_inertia(windows.forecast_windows(filled(spark, sf), 8, 4), 4))
    return rounded(analytics.residual_variance(out), 5, residual_var=4)


@query("y7_uncertainty_mask", "WITH" + FILLED + WINDOWS.format(11) + ", f AS (SELECT series_id, sample_id + h AS step, v[5 + h] - v[9 + h] AS r FROM w, (SELECT unnest([0, 1, 2, 3]) AS h) WHERE len(v) = 12), v AS (SELECT series_id, step, avg(r * r) - avg(r) * avg(r) AS rv FROM f GROUP BY 1, 2), q AS (SELECT series_id, quantile_cont(rv, 0.8) AS cut FROM v GROUP BY 1) SELECT series_id, count(*) FILTER (rv < cut) AS kept, count(*) AS steps FROM v JOIN q USING (series_id) GROUP BY 1")
def y7(spark, sf):
    out = models.scored_rows(models.historical_inertia(windows.forecast_windows(filled(spark, sf), 8, 4), 4))
    kept = analytics.certain_steps(analytics.residual_variance(out), 0.2)
    return kept.groupBy("series_id").agg(F.count_if("keep").alias("kept"), F.count("*").alias("steps"))


@query("y8_anomaly_mask", "WITH" + FILLED + WINDOWS.format(11) + ", f AS (SELECT series_id, sample_id, abs(v[5 + h] - v[9 + h]) - abs(v[8] - v[9 + h]) AS x FROM w, (SELECT unnest([0, 1, 2, 3]) AS h) WHERE len(v) = 12), q AS (SELECT series_id, sample_id, quantile_cont(x, 0.75) AS cut FROM f GROUP BY 1, 2) SELECT series_id, count(*) FILTER (x > cut) AS anomalous FROM f JOIN q USING (series_id, sample_id) GROUP BY 1")
def y8(spark, sf):
    samples = models.historical_inertia(windows.forecast_windows(filled(spark, sf), 8, 4), 4)
    rows = samples.select("series_id", "sample_id", F.element_at("inputs", -1).alias("y_ref"), F.posexplode(F.arrays_zip("targets", "prediction")).alias("h", "x")).select("series_id", "sample_id", "h", "y_ref", F.col("x.targets").alias("y_true"), F.col("x.prediction").alias("y_pred"))
    return analytics.anomalous_cells(rows, 0.75).groupBy("series_id").agg(F.count_if("anomalous").alias("anomalous"))


FLAGSHIP = (
    "WITH" + HOURLY + "," + NEIGHBOURS
    + ", inside AS (SELECT series_id, t, ts, CASE WHEN value IS NOT NULL THEN value ELSE pv + (nv - pv) * (t - pt) / (nt - pt) END AS value FROM near)" + SPLIT.format("inside")
    + ", st AS (SELECT series_id, avg(value) AS m, stddev_pop(value) AS s FROM parts WHERE split = 'train' GROUP BY 1), x AS (SELECT series_id, t, value AS y_true, lag((value - m) / s, 24) OVER (PARTITION BY series_id ORDER BY t) * s + m AS y_pred FROM parts JOIN st USING (series_id) WHERE split = 'test')"
    ", e AS (SELECT *, count(*) OVER (PARTITION BY series_id) AS n, min(t) OVER (PARTITION BY series_id) AS t0 FROM x), w AS (SELECT series_id, t, y_true, y_pred, least(t - t0 - 24, 23, n - 1 - (t - t0), n - 48) + 1 AS k FROM e WHERE t - t0 >= 24)"
    " SELECT series_id, round(sum(CASE WHEN y_true IS NOT NULL AND y_pred IS NOT NULL THEN k * abs(y_pred - y_true) ELSE 0 END) / sum(CASE WHEN y_true IS NOT NULL THEN k ELSE 0 END), 5) AS mae, round(sqrt(sum(CASE WHEN y_true IS NOT NULL AND y_pred IS NOT NULL THEN k * (y_pred - y_true) ** 2 ELSE 0 END) / sum(CASE WHEN y_true IS NOT NULL THEN k ELSE 0 END)), 5) AS rmse, CAST(sum(k) AS BIGINT) AS cells FROM w GROUP BY 1"
)


@query("flagship_hourly_inertia", FLAGSHIP)
def flagship(spark, sf_dir: str):
    """Grid, interpolation, split, scaling on train, windows of a day to a day on test, inertia, inverse, errors."""
    series = grid.chronological_split(fill.interpolate_short_gaps(hourly(spark, sf_dir), 120), (0.6, 0.2, 0.2))
    scaled = scale.with_z(series).where("split = 'test'").select("series_id", "t", "mean", "std", F.col("scaled").alias("value"))
    rows = models.scored_rows(models.historical_inertia(windows.forecast_windows(scaled, 24, 24, carry=("mean", "std")), 24), carry=("mean", "std"))
    restored = rows.select("series_id", "sample_id", "h", (F.col("y_true") * F.col("std") + F.col("mean")).alias("y_true"), (F.col("y_pred") * F.col("std") + F.col("mean")).alias("y_pred"))
    scores = metrics.cell_metrics(metrics.with_mask(restored), ["series_id"], cells=F.count("*"))
    return rounded(scores.select("series_id", "mae", "rmse", "cells"), 5)


__all__ = ["curriculum_length", "flagship", "split"]
