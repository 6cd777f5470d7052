"""Decomposition and spectra."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathomline.operators import spectral
from fathomline.plans.base import FILLED, filled, query, rounded

BASE = FILLED + ", n AS (SELECT *, count(*) OVER (PARTITION BY series_id) AS n, first_value(value) OVER w AS a, last_value(value) OVER w AS z FROM filled WINDOW w AS (PARTITION BY series_id ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))"


def ma(k):
    left, right = (k - 1) // 2, k // 2
    return f"(sum(value) OVER (PARTITION BY series_id ORDER BY t ROWS BETWEEN {left} PRECEDING AND {right} FOLLOWING) + a * greatest(0, {left} - t) + z * greatest(0, t + {right} - (n - 1))) / {k}"


DFT = ", n AS (SELECT *, count(*) OVER (PARTITION BY series_id) AS n FROM filled), cells AS (SELECT *, unnest(range(0, n // 2 + 1)) AS f FROM n), spec AS (SELECT series_id, f, n, sum(value * cos(2 * pi() * ((f * t) % n) / n)) AS re, -sum(value * sin(2 * pi() * ((f * t) % n) / n)) AS im FROM cells GROUP BY 1, 2, 3), amp AS (SELECT *, sqrt(re * re + im * im) AS a FROM spec)"
INVERSE = "sum((CASE WHEN f = 0 OR 2 * f = {0} THEN 1.0 ELSE 2.0 END) * (re * cos(2 * pi() * ((f * t) % {0}) / {0}) - im * sin(2 * pi() * ((f * t) % {0}) / {0}))) / any_value(n)"
MASK = ", m AS (SELECT f, avg(a) AS a FROM amp GROUP BY 1 QUALIFY row_number() OVER (ORDER BY round(avg(a), 6) DESC, f) <= greatest(1, floor(count(*) OVER () * 0.2)))"


def series(spark, sf):
    """Each channel, all steps."""
    return filled(spark, sf).select("series_id", "t", "value")


@query("f1_w10_moving_average", "WITH" + BASE + f" SELECT series_id, t, round({ma(25)}, 6) AS trend FROM n")
def f1(spark, sf):
    return rounded(spectral.moving_average(filled(spark, sf), 25).select("series_id", "t", "trend"))


@query("f2_trend_and_season", "WITH" + BASE + f" SELECT series_id, t, round({ma(24)}, 9) AS trend, round(value - {ma(24)}, 9) AS seasonal FROM n")
def f2(spark, sf):
    return rounded(spectral.decompose(filled(spark, sf), 24).select("series_id", "t", "trend", "seasonal"), 9)


@query("f3_mixed_kernels", "WITH" + BASE + f" SELECT series_id, t, round(0.25 * ({ma(13)}) + 0.75 * ({ma(25)}), 9) AS trend FROM n")
def f3(spark, sf):
    return rounded(spectral.decompose_mixed(filled(spark, sf), {13: 0.25, 25: 0.75}).select("series_id", "t", "trend"), 9)


def _gauss():
    parts = []
    for i, w in enumerate(spectral.gaussian_weights()):
        shift, end = i - 12, "a" if i < 12 else "z"
        x = "value" if not shift else f"coalesce({'lag' if shift < 0 else 'lead'}(value, {abs(shift)}) OVER (PARTITION BY series_id ORDER BY t), {end})"
        parts.append(f"{x} * {w!r}::DOUBLE")
    return " + ".join(parts)


@query("f26_gaussian_smoothing", "WITH" + BASE + f" SELECT series_id, t, round({_gauss()}, 6) AS trend FROM n")
def f26(spark, sf):
    return rounded(spectral.smooth(filled(spark, sf), spectral.gaussian_weights()).select("series_id", "t", "trend"))


@query("f4_dft", "WITH" + FILLED + DFT + " SELECT series_id, f, n, round(re, 5) + 0.0 AS re, round(im, 5) + 0.0 AS im FROM spec")
def f4(spark, sf):
    out = spectral.dft(series(spark, sf)).select("series_id", "f", "n", F.when(F.abs("re") < 5e-6, 0.0).otherwise(F.col("re")).alias("re"), F.when(F.abs("im") < 5e-6, 0.0).otherwise(F.col("im")).alias("im"))
    return rounded(out, 5)


@query("f4_top_k_decomposition", "WITH" + FILLED + DFT + ", k AS (SELECT * FROM amp QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY round(a, 6) DESC, f) <= 5), s AS (SELECT series_id, t, " + INVERSE.format("n") + " AS seasonal FROM (SELECT *, unnest(range(0, n)) AS t FROM k) GROUP BY 1, 2) SELECT series_id, t, round(seasonal, 5) AS seasonal, round(value - seasonal, 5) AS trend FROM filled JOIN s USING (series_id, t)")
def f4k(spark, sf):
    return rounded(spectral.spectral_decompose(series(spark, sf), 5).select("series_id", "t", "seasonal", "trend"), 5)


@query("f5_o4_top_periods", "WITH" + FILLED + DFT + " SELECT f, CAST(n // f AS BIGINT) AS period, round(avg(a), 5) AS amplitude FROM amp WHERE f > 0 GROUP BY f, n ORDER BY avg(a) DESC, f LIMIT 5")
def f5(spark, sf):
    return rounded(spectral.top_periods(series(spark, sf), 5), 5)


@query("o6_top_share_mask", "WITH" + FILLED + DFT + MASK + " SELECT f FROM m")
def o6(spark, sf):
    return spectral.top_share_mask(series(spark, sf), 0.2)


@query("f8_fourier_filter", "WITH" + FILLED + DFT + MASK + ", s AS (SELECT series_id, t, " + INVERSE.format("n") + " AS invariant FROM (SELECT *, unnest(range(0, n)) AS t FROM spec SEMI JOIN m USING (f)) GROUP BY 1, 2) SELECT series_id, t, round(invariant, 5) AS invariant, round(value - invariant, 5) AS variant FROM filled JOIN s USING (series_id, t)")
def f8(spark, sf):
    return rounded(spectral.fourier_filter(series(spark, sf), 0.2).select("series_id", "t", "invariant", "variant"), 5)


@query("f9_f10_low_pass_upsampling", "WITH" + FILLED + DFT + " SELECT series_id, t, round(" + INVERSE.format("1080") + ", 5) AS value FROM spec, (SELECT unnest(range(0, 1080)) AS t) WHERE f < 60 GROUP BY 1, 2")
def f9(spark, sf):
    return rounded(spectral.upsample(series(spark, sf), 60, 1080), 5)


ACF = ", n AS (SELECT *, count(*) OVER (PARTITION BY series_id) AS n FROM filled), pairs AS (SELECT *, unnest(range(0, n)) AS lag FROM n), acf AS (SELECT a.series_id, lag, sum(a.value * b.value) / any_value(a.n) AS c FROM pairs a JOIN n b ON b.series_id = a.series_id AND b.t = (a.t + lag) % a.n GROUP BY 1, 2)"


@query("f7_circular_correlation", "WITH" + FILLED + ACF + " SELECT series_id, lag, round(c, 4) AS value FROM acf")
def f7(spark, sf):
    return rounded(spectral.circular_correlation(series(spark, sf)), 4)


@query("o5_delay_aggregation", "WITH" + FILLED + ACF + ", k AS (SELECT * FROM acf QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY round(c, 6) DESC, lag) <= 3), e AS (SELECT *, exp(c - max(c) OVER (PARTITION BY series_id)) AS e FROM k), w AS (SELECT *, e / sum(e) OVER (PARTITION BY series_id) AS w FROM e) SELECT n.series_id, ((t - lag) % n + n) % n AS t, round(sum(value * w), 5) AS value FROM n JOIN w USING (series_id) GROUP BY 1, 2")
def o5(spark, sf):
    return rounded(spectral.aggregate_delays(series(spark, sf), 3), 5)


@query("f22_spectral_distance", "WITH" + FILLED + DFT + " SELECT x.series_id AS a, y.series_id AS b, round(sum((x.a - y.a) ** 2), 2) AS distance FROM amp x JOIN amp y ON x.f = y.f AND x.series_id < y.series_id GROUP BY 1, 2")
def f22(spark, sf):
    return rounded(spectral.spectral_distance(series(spark, sf)), 2)
