"""Masked forecast metrics over rows (series_id, sample_id, h, y_true, y_pred[, mask]).

Metrics that are ratios of sums need one aggregate; WAPE, R2 and CORR reduce over a sample's horizon first. ``by`` names
grouping columns; with batch_id among them the values are those of single batches, to be merged by ``meter``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


SMALL = 5e-5


def with_mask(df: DataFrame, mask: Column | None = None) -> DataFrame:
    return df.withColumn("mask", F.coalesce((F.col("y_true").isNotNull() if mask is None else mask).cast("double"), F.lit(0.0)))


def _ratio(top: Column, down: Column) -> Column:
    return F.coalesce(F.try_divide(F.sum(top), F.sum(down)), F.lit(0.0))


def _zero(x: Column) -> Column:
    return F.coalesce(x, F.lit(0.0))


def cell_metrics(df: DataFrame, by: list[str], **more: Column) -> DataFrame:
    """MAE, MSE, RMSE, MAPE, SMAPE, HUBER and the weight (number of valid cells); ``more`` names further aggregates."""
    e = F.col("y_pred") - F.col("y_true")
    big = F.col("mask") * F.coalesce(F.abs(F.col("y_true")) > SMALL, F.lit(False)).cast("double")
    both = F.coalesce((F.col("y_true").isNotNull() & (F.abs(F.col("y_true")) > SMALL)), F.lit(False)).cast("double")
    z = _zero(F.col("y_pred")) * F.col("mask") - _zero(F.col("y_true")) * F.col("mask")
    return df.groupBy(*by).agg(
        _ratio(_zero(F.abs(e)) * F.col("mask"), F.col("mask")).alias("mae"),
        _ratio(_zero(e * e) * F.col("mask"), F.col("mask")).alias("mse"),
        F.sqrt(_ratio(_zero(e * e) * F.col("mask"), F.col("mask"))).alias("rmse"),
        _ratio(_zero(F.abs(F.try_divide(e, F.col("y_true")))) * big, big).alias("mape"),
        _ratio(_zero(F.try_divide(F.abs(e), (F.abs(F.col("y_pred")) + F.abs(F.col("y_true"))) / 2)) * both, both).alias("smape"),
        F.avg(F.when(F.abs(z) < 1, 0.5 * z * z).otherwise(F.abs(z) - 0.5)).alias("huber"),
        F.sum(F.col("mask")).alias("weight"),
        *(x.alias(name) for name, x in more.items()),
    )


def mape_unmasked(df: DataFrame, by: list[str]) -> DataFrame:
    """Without a mask the sum is divided by all cells, those of a target near zero included."""
    big = F.coalesce(F.abs(F.col("y_true")) > SMALL, F.lit(False)).cast("double")
    return df.groupBy(*by).agg((F.sum(_zero(F.abs(F.try_divide(F.col("y_pred") - F.col("y_true"), F.col("y_true")))) * big) / F.count(F.lit(1))).alias("mape_all"))


def horizon_metrics(df: DataFrame, by: list[str], over: list[str] | None = None) -> DataFrame:
    """WAPE, R2 and CORR: along the horizon of each (sample, channel), or along ``over``'s complement, then averaged."""
    inner = ["series_id", "sample_id"] if over is None else over
    p, t = _zero(F.col("y_pred")) * F.col("mask"), _zero(F.col("y_true")) * F.col("mask")
    n = F.count(F.lit(1))
    sums = df.groupBy(*dict.fromkeys([*by, *inner])).agg(
        F.sum(F.abs(p - t)).alias("ae"), F.sum(F.abs(t)).alias("at"), F.sum((p - t) * (p - t)).alias("se"), (F.sum(t * t) - F.sum(t) * F.sum(t) / n).alias("st"),
        (n * F.sum(F.col("y_pred") * F.col("y_true")) - F.sum(F.col("y_pred")) * F.sum(F.col("y_true"))).alias("cov"), (n * F.sum(F.col("y_pred") * F.col("y_pred")) - F.sum(F.col("y_pred")) * F.sum(F.col("y_pred"))).alias("vp"), (n * F.sum(F.col("y_true") * F.col("y_true")) - F.sum(F.col("y_true")) * F.sum(F.col("y_true"))).alias("vt"), F.sum(F.col("mask")).alias("m"),
    )
    spread = F.when((F.col("vp") > 1e-9) & (F.col("vt") > 1e-9), F.sqrt(F.col("vp")) * F.sqrt(F.col("vt")))
    return sums.groupBy(*by).agg(
        F.avg(F.col("ae") / (F.col("at") + SMALL)).alias("wape"),
        F.avg(1 - F.col("se") / (F.col("st") + 1e-6)).alias("r2"),
        F.coalesce(F.try_divide(F.sum(_zero(F.try_divide(F.col("cov"), spread)) * F.col("m")), F.sum("m")), F.lit(0.0)).alias("corr"),
    )


def accuracy(df: DataFrame) -> DataFrame:
    return df.agg(F.avg((F.col("y_pred") == F.col("y_true")).cast("double")).alias("accuracy"))


def meter(df: DataFrame, value: str, weight: str, by: list[str], square: bool = False) -> DataFrame:
    """Values of batches merged by weight; a root-mean meter adds squares. 0 without weight."""
    v = F.col(value) * F.col(value) if square else F.col(value)
    merged = F.coalesce(F.try_divide(F.sum(v * F.col(weight)), F.sum(weight)), F.lit(0.0))
    return df.groupBy(*by).agg((F.sqrt(merged) if square else merged).alias(value))


def custom(df: DataFrame, by: list[str], **metrics: Column) -> DataFrame:
    """User metrics: named aggregate expressions over y_pred, y_true and mask."""
    return df.groupBy(*by).agg(*(e.alias(n) for n, e in metrics.items()))
