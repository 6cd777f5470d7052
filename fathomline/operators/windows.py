"""Samples from series: sliding windows, crops, patches, periods, corpus rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathomline.functions.scalars import uniform
from fathomline.operators.grid import KEY, in_order


def forecast_windows(df: DataFrame, inputs: int, targets: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """Stride-1 samples: sample i has steps [i, i + inputs) and [i + inputs, i + inputs + targets); n - L - H + 1 of them.
    ``carry`` names columns that come along from a sample's first step.

    One array a row; for very wide windows prefer operators that aggregate over frames.
    """
    both = F.collect_list(F.struct("t", "value")).over(in_order().rowsBetween(0, inputs + targets - 1))
    out = df.select(KEY, F.col("t").alias("sample_id"), F.transform(both, lambda x: x["value"]).alias("_v"), *carry).where(F.size("_v") == inputs + targets)
    return out.select(KEY, "sample_id", *carry, F.slice("_v", 1, inputs).alias("inputs"), F.slice("_v", inputs + 1, targets).alias("targets"))


def imputation_windows(df: DataFrame, inputs: int) -> DataFrame:
    return forecast_windows(df, inputs, 0).select(KEY, "sample_id", "inputs")


def long_forecasts(samples: DataFrame) -> DataFrame:
    """(series_id, sample_id, h, y_true): one row a target step."""
    return samples.select(KEY, "sample_id", F.posexplode("targets").alias("h", "y_true"))


def corpus_rows(df: DataFrame, least_length: int = 1024, seq2seq: int = 64, least_share: float = 0.5, column: str = "seq") -> DataFrame:
    """Rows whose valid prefix is long enough and filled enough; adds valid_end (one past the last valid cell)."""
    places = F.expr(f"transform({column}, (x, i) -> IF(x IS NULL, 0, i + 1))")
    out = df.withColumn("valid_end", F.array_max(places)).withColumn("valid_share", F.size(F.filter(column, lambda x: x.isNotNull())) / F.nullif(F.col("valid_end"), F.lit(0)))
    return out.where((F.col("valid_end") >= F.greatest(F.lit(least_length), F.lit(seq2seq))) & (F.col("valid_share") >= least_share))


def z_norm(a: Column, least_std: float = 1e-3) -> Column:
    """An array scaled by its own mean and population deviation; a deviation below ``least_std`` counts as 1. The mean is the
    sum in order by the count, the deviation follows Welford's updates in order, as in DuckDB: the last bit decides at a threshold."""
    ok = F.filter(a, lambda x: x.isNotNull())
    n = F.size(ok)
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda s, x: s + x)
    state = lambda n, mean, old, x, sq: F.struct(n.alias("n"), mean.alias("mean"), old.alias("old"), x.alias("x"), sq.alias("sq"))
    zero = F.lit(0.0)
    # a step holds the mean before and after it, as its square is added by the next one: each is computed once
    added = lambda s: s["sq"] + (s["x"] - s["mean"]) * (s["x"] - s["old"])
    last = F.aggregate(ok, state(zero, zero, zero, zero, zero), lambda s, x: state(s["n"] + 1, s["mean"] + (x - s["mean"]) / (s["n"] + 1), s["mean"], x, added(s)), added)
    # what a lambda refers to is evaluated for each element, so the statistics travel beside the elements
    both = F.struct((total(ok) / n).alias("mean"), F.sqrt(last / n).alias("std"))
    return F.zip_with(a, F.array_repeat(both, F.size(a)), lambda x, c: (x - c["mean"]) / F.when(c["std"] < least_std, 1.0).otherwise(c["std"]))


def mask_anomalies(a: Column, threshold: float = 4.0) -> Column:
    return F.transform(a, lambda x: F.when(F.abs(x) <= threshold, x))


def pad_to(a: Column, length: int) -> Column:
    """Cut or fill with NULLs to ``length``."""
    return F.slice(F.concat(a, F.array_repeat(F.lit(None).cast("double"), length)), 1, length)


def random_crop(df: DataFrame, length: int, seed: int, key: str, column: str = "seq") -> DataFrame:
    """``length`` steps from a random place within the valid ones; ``key`` names the row that the place is drawn for."""
    at = F.floor(uniform(seed, key) * (F.greatest(F.col("valid_end") - length, F.lit(0)) + 1)).cast("int") + 1
    return df.withColumn(column, pad_to(F.slice(column, at, length), length))


def shifted(df: DataFrame, column: str = "seq") -> DataFrame:
    """Autoregressive pairs: all but the last, all but the first."""
    n = F.size(column)
    return df.withColumn("inputs", F.slice(F.col(column), F.lit(1), n - 1)).withColumn("targets", F.slice(F.col(column), F.lit(2), n - 1))


def mixup(df: DataFrame, k_max: int, alpha: float, seed: int, length: int, key: str, column: str = "seq") -> DataFrame:
    """(mixture, column): convex mixtures of random rows, each scaled by its own mean and deviation, with Dirichlet weights.

    Rows are dealt at random to half as many groups, so that groups differ in size; the first ``k_max`` of a group, in
    random order, are mixed. Weights are gamma variates over their sum; ``alpha`` is a multiple of one half: a gamma variate
    is then a sum of exponential ones and half a squared normal one.
    """
    if alpha <= 0 or 2 * alpha != int(2 * alpha):
        raise ValueError("alpha must be a positive multiple of 0.5")
    total = F.broadcast(df.agg(F.count("*").alias("_n")))  # one row
    dealt = df.join(total).withColumn("mixture", F.floor(uniform(seed, key) * F.greatest(F.expr("_n DIV 2"), F.lit(1))))
    few = dealt.withColumn("_k", F.row_number().over(Window.partitionBy("mixture").orderBy(uniform(seed + 1, key), key))).where(F.col("_k") <= k_max)
    whole = int(alpha)
    exponential = lambda k: -F.log(1 - uniform(seed + 2 + k, key))
    parts = [exponential(k) for k in range(whole)]
    if alpha > whole:
        parts.append(exponential(whole) * F.pow(F.cos(2 * math.pi * uniform(seed + 3 + whole, key)), F.lit(2.0)))
    normed = few.select("mixture", sum(parts[1:], parts[0]).alias("_w"), z_norm(F.col(column), 1e-8).alias("_s"))
    cells = normed.select("mixture", "_w", F.posexplode(F.slice("_s", 1, length)).alias("pos", "x")).where("x IS NOT NULL")
    mixed = cells.groupBy("mixture", "pos").agg((F.sum(F.col("x") * F.col("_w")) / F.sum("_w")).alias("x"))
    return mixed.groupBy("mixture").agg(F.array_sort(F.collect_list(F.struct("pos", "x"))).alias("_c")).select("mixture", F.transform("_c", lambda c: c["x"]).alias(column))


def encode_labels(df: DataFrame, label: str) -> DataFrame:
    """label codes: places among the sorted distinct labels (as strings). Codes come from the distinct labels, so no
    window runs over the rows; whether they are broadcast is left to their size."""
    names = df.select(F.col(label).cast("string").alias("_name")).distinct().where("_name IS NOT NULL")
    codes = names.select("_name", (F.row_number().over(Window.orderBy("_name")) - 1).alias("label_code"))
    return df.join(codes, F.col(label).cast("string") == F.col("_name")).drop("_name")


def patches(df: DataFrame, length: int = 16, stride: int = 8, pad_end: bool = True) -> DataFrame:
    """(series_id, patch, pos, value): windows of ``length`` every ``stride``; the last value is repeated ``stride`` times
    at the end if asked. Each step is sent to the patches that hold it, so no array grows with the series."""
    last = df.groupBy(KEY).agg(F.max("t").alias("_last"), F.max_by("value", "t").alias("_lv"))
    rows = df.select(KEY, "t", "value").join(last, KEY)
    if pad_end:
        extra = last.select(KEY, F.explode(F.expr(f"sequence(_last + 1, _last + {stride})")).alias("t"), F.col("_lv").alias("value"), (F.col("_last") + stride).alias("_last"), "_lv")
        rows = rows.withColumn("_last", F.col("_last") + stride).unionByName(extra)
    low = F.greatest(F.ceil((F.col("t") - length + 1) / stride), F.lit(0))
    high = F.least(F.floor(F.col("t") / stride), F.floor((F.col("_last") + 1 - length) / stride))
    each = rows.where(high >= low).select(KEY, "t", "value", F.explode(F.sequence(low.cast("long"), high.cast("long"))).alias("patch"))
    return each.select(KEY, "patch", (F.col("t") - F.col("patch") * stride).alias("pos"), "value")


def segments(df: DataFrame, length: int) -> DataFrame:
    """(series_id, segment, pos, value): whole segments, the first filled on the left with the first value."""
    n = F.count(F.lit(1)).over(Window.partitionBy(KEY))
    pad = F.pmod(-n, F.lit(length))
    rows = df.select(KEY, (F.col("t") + pad).alias("p"), "value", pad.alias("_pad"), "t")
    extra = rows.where("t = 0 AND _pad > 0").select(KEY, F.explode(F.expr("sequence(0L, _pad - 1)")).alias("p"), "value")
    return rows.select(KEY, "p", "value").unionByName(extra).select(KEY, F.floor(F.col("p") / length).alias("segment"), F.pmod("p", F.lit(length)).alias("pos"), "value")


def fold_period(df: DataFrame, period: int) -> DataFrame:
    """(series_id, row, col, value): the series on a grid of ``period`` columns, the last row filled with zeros."""
    n = df.groupBy(KEY).agg((F.max("t") + 1).alias("n"))
    extra = n.where(F.col("n") % period != 0).select(KEY, F.explode(F.expr(f"sequence(n, (n DIV {period} + 1) * {period} - 1)")).alias("t"), F.lit(0.0).alias("value"))
    return df.select(KEY, "t", "value").unionByName(extra).select(KEY, F.floor(F.col("t") / period).alias("row"), F.pmod("t", F.lit(period)).alias("col"), "value")


def pool(df: DataFrame, width: int = 2, how: str = "avg") -> DataFrame:
    """Averages or maxima of ``width`` steps; an incomplete tail is dropped."""
    f = {"avg": F.avg, "max": F.max}[how]
    out = df.groupBy(KEY, F.floor(F.col("t") / width).alias("step")).agg(f("value").alias("value"), F.count(F.lit(1)).alias("_n"))
    return out.where(F.col("_n") == width).select(KEY, F.col("step").alias("t"), "value")


def multi_scale(df: DataFrame, width: int = 2, levels: int = 3, how: str = "avg") -> DataFrame:
    out, scale = df.select(F.lit(0).alias("scale"), KEY, "t", "value"), df.select(KEY, "t", "value")
    for k in range(1, levels + 1):
        scale = pool(scale, width, how)
        out = out.unionByName(scale.select(F.lit(k).alias("scale"), KEY, "t", "value"))
    return out


def sampled_two_ways(df: DataFrame, chunk: int) -> DataFrame:
    """Continuous sampling (neighbours share a chunk) and interval sampling (every chunk-th step shares one)."""
    n = F.floor(F.count(F.lit(1)).over(Window.partitionBy(KEY)) / chunk)
    return df.select(KEY, "t", "value", F.floor(F.col("t") / chunk).alias("continuous_row"), F.pmod("t", F.lit(chunk)).alias("continuous_col"), F.pmod("t", n).alias("interval_row"), F.floor(F.col("t") / n).alias("interval_col"), (F.col("t") < n * chunk).alias("whole"))


def nested_lookbacks(df: DataFrame, horizon: int, scales: tuple[int, ...] = (1, 2, 4)) -> DataFrame:
    """The last scale * horizon steps for each scale."""
    n = F.count(F.lit(1)).over(Window.partitionBy(KEY))
    rows = df.withColumn("_n", n).withColumn("scale", F.explode(F.array(*(F.lit(s) for s in scales))))
    return rows.where(F.col("t") >= F.col("_n") - F.col("scale") * horizon).drop("_n")


def circular_views(df: DataFrame, period: int, count: int) -> DataFrame:
    """``count`` copies of each series, the i-th rotated by i * period steps."""
    n = F.count(F.lit(1)).over(Window.partitionBy(KEY))
    rows = df.withColumn("_n", n).withColumn("view", F.explode(F.sequence(F.lit(0), F.lit(count - 1))))
    return rows.select(KEY, "view", F.pmod(F.col("t") - F.col("view") * period, F.col("_n")).alias("t"), "value")


def merge_patches(df: DataFrame, size: int) -> DataFrame:
    """Groups of ``size`` neighbouring steps as arrays; the last group is completed with the series' own last steps."""
    n = F.count(F.lit(1)).over(Window.partitionBy(KEY))
    rows = df.withColumn("_pad", F.pmod(-n, F.lit(size))).withColumn("_n", n)
    tail = rows.where(F.col("t") >= F.col("_n") - F.col("_pad")).withColumn("t", F.col("t") + F.col("_pad"))
    both = rows.unionByName(tail)
    return both.groupBy(KEY, F.floor(F.col("t") / size).alias("group")).agg(F.transform(F.array_sort(F.collect_list(F.struct("t", "value"))), lambda x: x["value"]).alias("values"))


def distil(df: DataFrame) -> DataFrame:
    """Max-pool of width 3, stride 2, padding 1."""
    top = F.max("value").over(in_order().rowsBetween(-1, 1))
    return df.select(KEY, "t", top.alias("value")).where("t % 2 = 0").withColumn("t", F.floor(F.col("t") / 2))
