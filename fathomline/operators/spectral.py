"""Decomposition and spectral operators as aggregates.

A discrete Fourier transform of n steps goes in two stages, as n = p * q with the divisor p nearest below its square root:
q transforms of p steps, then p transforms of q steps, each an aggregate over (series, place). That is n * (p + q) rows
in generated code and no task that holds a series; a prime n costs n rows a bin.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fathomline.operators.grid import KEY, in_order


def moving_average(df: DataFrame, k: int) -> DataFrame:
    """trend: mean of k steps, (k - 1) // 2 to the left and k // 2 to the right, ends repeated beyond the series."""
    left, right = (k - 1) // 2, k // 2
    whole = in_order().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    near = F.sum("value").over(in_order().rowsBetween(-left, right))
    first, last, n = F.first("value").over(whole), F.last("value").over(whole), F.count(F.lit(1)).over(Window.partitionBy(KEY))
    t = F.col("t")
    total = near + first * F.greatest(F.lit(0), left - t) + last * F.greatest(F.lit(0), t + right - (n - 1))
    return df.withColumn("trend", total / k)


def decompose(df: DataFrame, k: int = 25) -> DataFrame:
    return moving_average(df, k).withColumn("seasonal", F.col("value") - F.col("trend"))


def decompose_mixed(df: DataFrame, kernels: dict[int, float]) -> DataFrame:
    """Several kernels' trends mixed by given weights (they add to one)."""
    out = df
    for k in kernels:
        out = moving_average(out, k).withColumnRenamed("trend", f"_m{k}")
    trend = sum((F.col(f"_m{k}") * w for k, w in kernels.items()), F.lit(0.0))
    return out.withColumn("trend", trend).withColumn("seasonal", F.col("value") - F.col("trend")).drop(*(f"_m{k}" for k in kernels))


def gaussian_weights(k: int = 25, sigma: float = 2.0) -> list[float]:
    """exp(-((i - centre) / sigma)^2), then a softmax over these weights."""
    raw = [math.exp(-(((i - k // 2) / sigma) ** 2)) for i in range(k)]
    e = [math.exp(x) for x in raw]
    return [x / sum(e) for x in e]


def smooth(df: DataFrame, weights: list[float]) -> DataFrame:
    """Weighted average of the neighbourhood, ends repeated: one sum of lags and leads over one sort."""
    half = len(weights) // 2
    whole = in_order().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first, last = F.first("value").over(whole), F.last("value").over(whole)
    parts = [F.coalesce(F.lag("value", half - i).over(in_order()) if i < half else F.lead("value", i - half).over(in_order()) if i > half else F.col("value"), first if i < half else last) * w for i, w in enumerate(weights)]
    return df.withColumn("trend", sum(parts[1:], parts[0])).withColumn("seasonal", F.col("value") - F.col("trend"))


def _turned(theta, sign: int) -> tuple:
    """Sums of (re + i im) * exp(sign * i * theta)."""
    cos, sin = F.cos(theta), sign * F.sin(theta)
    return F.sum(F.col("re") * cos - F.col("im") * sin).alias("re"), F.sum(F.col("im") * cos + F.col("re") * sin).alias("im")


def _transform(rows: DataFrame, by: tuple[str, ...], sign: int, top=None) -> DataFrame:
    """(by, n, f, re, im): sums over t of (re + i im) * exp(sign * 2 pi i f t / n) for f = 0 .. n - 1, or up to ``top``."""
    keys = [*by, "n", "p"]
    rows = rows.withColumn("p", F.expr("array_max(filter(sequence(1L, CAST(floor(sqrt(n)) AS BIGINT)), d -> n % d = 0))"))
    first = rows.select(*keys, "re", "im", F.expr("t DIV (n DIV p)").alias("a"), F.expr("t % (n DIV p)").alias("b"), F.explode(F.expr("sequence(0L, p - 1)")).alias("k"))
    first = first.groupBy(*keys, "b", "k").agg(*_turned(F.expr("(a * k) % p") * (2 * math.pi) / F.col("p"), sign))
    last = F.expr("n - 1") if top is None else top
    second = first.withColumn("top", last.cast("long")).where("k <= top").select(*keys, "re", "im", "b", F.explode(F.expr("transform(sequence(0L, (top - k) DIV p), m -> k + p * m)")).alias("f"))
    return second.groupBy(*by, "n", "f").agg(*_turned(F.expr("(b * f) % n") * (2 * math.pi) / F.col("n"), sign))


def dft(df: DataFrame, bins: int | None = None, by: tuple[str, ...] = (KEY,)) -> DataFrame:
    """(series_id, f, re, im, n): X_f = sum x_t exp(-2 pi i f t / n) for f = 0 .. n // 2, or fewer."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*by))
    rows = df.select(*by, F.col("t").cast("long").alias("t"), F.col("value").alias("re"), F.lit(0.0).alias("im"), n.alias("n"))
    half = F.expr("n DIV 2")
    return _transform(rows, by, -1, half if bins is None else F.least(half, F.lit(bins - 1))).select(*by, "f", "n", "re", "im")


def inverse_dft(spectrum: DataFrame, by: tuple[str, ...] = (KEY,), length: str = "n", scale: str = "n") -> DataFrame:
    """(series_id, t, value) of ``length`` steps from bins 0 .. n // 2 (others count as zero)."""
    both = F.expr(f"IF(f = 0 OR 2 * f = {length}, array(named_struct('f', f, 's', 1.0D)), array(named_struct('f', f, 's', 1.0D), named_struct('f', {length} - f, 's', -1.0D)))")
    rows = spectrum.select(*by, F.col(length).alias("n"), F.col(scale).cast("double").alias("scale"), "re", "im", F.explode(both).alias("x"))
    rows = rows.select(*by, "n", "scale", F.col("x.f").alias("t"), "re", (F.col("im") * F.col("x.s")).alias("im"))
    out = _transform(rows, (*by, "scale"), 1)
    return out.select(*by, F.col("f").alias("t"), (F.col("re") / F.col("scale")).alias("value"))


def amplitude(spectrum: DataFrame) -> DataFrame:
    return spectrum.withColumn("amplitude", F.sqrt(F.col("re") * F.col("re") + F.col("im") * F.col("im")))


def top_periods(df: DataFrame, k: int) -> DataFrame:
    """(f, period, amplitude) of the k frequencies of largest mean amplitude over channels; the mean itself is ignored."""
    mean = amplitude(dft(df)).where("f > 0").groupBy("f", "n").agg(F.avg("amplitude").alias("amplitude"))
    return mean.orderBy(F.desc("amplitude"), "f").limit(k).select("f", F.expr("n DIV f").alias("period"), "amplitude")


def keep_top(spectrum: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(KEY).orderBy(F.desc(F.round("amplitude", 6)), "f"))
    return amplitude(spectrum).withColumn("_r", rank).where(F.col("_r") <= k).drop("_r")


def spectral_decompose(df: DataFrame, k: int = 5) -> DataFrame:
    """seasonal: the k strongest frequencies of each series; trend: the rest."""
    season = inverse_dft(keep_top(dft(df), k)).withColumnRenamed("value", "seasonal")
    return df.join(season, [KEY, "t"]).withColumn("trend", F.col("value") - F.col("seasonal"))


def top_share_mask(df: DataFrame, share: float) -> DataFrame:
    """The frequencies of largest mean amplitude, max(1, int(F * share)) of them."""
    mean = amplitude(dft(df)).groupBy("f").agg(F.avg("amplitude").alias("amplitude"))
    kept = max(1, int(mean.count() * share))
    return mean.orderBy(F.desc(F.round("amplitude", 6)), "f").limit(kept).select("f")


def fourier_filter(df: DataFrame, share: float) -> DataFrame:
    """invariant: the part in the masked frequencies; variant: the rest."""
    part = inverse_dft(dft(df).join(top_share_mask(df, share), "f")).withColumnRenamed("value", "invariant")
    return df.join(part, [KEY, "t"]).withColumn("variant", F.col("value") - F.col("invariant"))


def upsample(df: DataFrame, cut: int, longer: int) -> DataFrame:
    """Low-pass to ``cut`` bins and resample to ``longer`` steps by padding the spectrum with zeros."""
    return inverse_dft(dft(df, cut).withColumn("m", F.lit(longer).cast("long")), length="m")


def circular_correlation(df: DataFrame) -> DataFrame:
    """(series_id, lag, value): mean of x_t * x_(t + lag) around the circle, for all lags, from the power spectrum."""
    power = dft(df).select(KEY, "f", "n", (F.col("re") * F.col("re") + F.col("im") * F.col("im")).alias("re"), F.lit(0.0).alias("im"), (F.col("n") * F.col("n")).alias("square"))
    return inverse_dft(power, scale="square").withColumnRenamed("t", "lag")


def aggregate_delays(df: DataFrame, k: int) -> DataFrame:
    """The series rolled by its k strongest delays and averaged with softmax weights of their correlation."""
    rank = F.row_number().over(Window.partitionBy(KEY).orderBy(F.desc(F.round("value", 6)), "lag"))
    top = circular_correlation(df).withColumn("_r", rank).where(F.col("_r") <= k)
    w = Window.partitionBy(KEY)
    weight = F.exp(F.col("value") - F.max("value").over(w))
    top = top.withColumn("_e", weight).select(KEY, "lag", (F.col("_e") / F.sum("_e").over(w)).alias("weight"))
    n = F.count(F.lit(1)).over(Window.partitionBy(KEY))
    rows = df.select(KEY, "t", "value", n.alias("n")).join(top, KEY)
    return rows.groupBy(KEY, F.pmod(F.col("t") - F.col("lag"), F.col("n")).alias("t")).agg(F.sum(F.col("value") * F.col("weight")).alias("value"))


def spectral_distance(df: DataFrame) -> DataFrame:
    """(a, b, distance): squared distance of channels' amplitude vectors, per bin, each pair once."""
    x = amplitude(dft(df)).select(KEY, "f", "amplitude")
    y = x.select(F.col(KEY).alias("b"), "f", F.col("amplitude").alias("_o"))
    pair = x.withColumnRenamed(KEY, "a").join(y, "f").where("a < b")
    return pair.groupBy("a", "b").agg(F.sum((F.col("amplitude") - F.col("_o")) * (F.col("amplitude") - F.col("_o"))).alias("distance"))
