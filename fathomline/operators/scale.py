"""Scalers fitted on the train split, instance and layer norms. Statistics are one small row a series and are broadcast
by size through adaptive execution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathomline.functions.scalars import finite
from fathomline.operators.grid import KEY

def _fit(df: DataFrame, per_channel: bool, **stats: Column) -> DataFrame:
    train = df.where(F.col("split") == "train")
    return (train.groupBy(KEY) if per_channel else train.groupBy()).agg(*(e.alias(n) for n, e in stats.items()))


def _joined(df: DataFrame, stats: DataFrame) -> DataFrame:
    return df.join(stats, KEY) if KEY in stats.columns else df.join(F.broadcast(stats))  # a global fit is one row


def fit_z(df: DataFrame, per_channel: bool = True) -> DataFrame:
    return _fit(df, per_channel, mean=F.avg("value"), std=F.when(F.stddev_pop("value") == 0, 1.0).otherwise(F.stddev_pop("value")))


def fit_min_max(df: DataFrame, per_channel: bool = True) -> DataFrame:
    span = F.max("value") - F.min("value")
    return _fit(df, per_channel, mean=F.min("value"), std=F.when(span == 0, 1.0).otherwise(span))


def fit_z_safe(df: DataFrame, per_channel: bool = True) -> DataFrame:
    """Finite cells only; without any, mean 0 and deviation 1."""
    x = finite(F.col("value"))
    std = F.coalesce(F.nullif(F.stddev_pop(x), F.lit(0.0)), F.lit(1.0))
    return _fit(df, per_channel, mean=F.coalesce(F.avg(x), F.lit(0.0)), std=std)


def fit_min_max_safe(df: DataFrame, per_channel: bool = True) -> DataFrame:
    x = finite(F.col("value"))
    return _fit(df, per_channel, mean=F.coalesce(F.min(x), F.lit(0.0)), std=F.coalesce(F.nullif(F.max(x) - F.min(x), F.lit(0.0)), F.lit(1.0)))


def transform(df: DataFrame, stats: DataFrame, mask: Column | None = None, safe: bool = False) -> DataFrame:
    """scaled: cells outside ``mask`` pass through; ``safe`` turns what is not finite into 0."""
    x = (F.col("value") - F.col("mean")) / F.col("std")
    x = x if mask is None else F.when(mask, x).otherwise(F.col("value"))
    return _joined(df, stats).withColumn("scaled", F.coalesce(finite(x), F.lit(0.0)) if safe else x).drop("mean", "std")


def inverse(df: DataFrame, stats: DataFrame, column: str = "scaled", mask: Column | None = None) -> DataFrame:
    x = F.col(column) * F.col("std") + F.col("mean")
    return _joined(df, stats).withColumn("restored", x if mask is None else F.when(mask, x).otherwise(F.col(column))).drop("mean", "std")


def fit_sequences(df: DataFrame, channel: str = "channel", series: str = "series") -> DataFrame:
    """Mean and population deviation of each channel over samples and steps, NaN and NULL left out; deviation 0 counts as 1."""
    cells = df.select(channel, F.explode(series).alias("value")).where("value IS NOT NULL AND NOT isnan(value)")
    return cells.groupBy(channel).agg(F.avg("value").alias("mean"), F.when(F.stddev_pop("value") == 0, 1.0).otherwise(F.stddev_pop("value")).alias("std"))


def with_z(df: DataFrame) -> DataFrame:
    """scaled, mean and std of each series by its train split, without a second reading of ``df``."""
    whole = Window.partitionBy(KEY)
    train = F.when(F.col("split") == "train", F.col("value"))
    std = F.stddev_pop(train).over(whole)
    out = df.withColumns({"mean": F.avg(train).over(whole), "std": F.when(std == 0, 1.0).otherwise(std)})
    return out.withColumn("scaled", (F.col("value") - F.col("mean")) / F.col("std"))


def fill_masked(mask: Column, scaled: Column, null_to: float = 0.0) -> Column:
    """Filling comes after scaling."""
    return F.when(mask, scaled).otherwise(F.lit(null_to))


def instance_norm(df: DataFrame, sample: list[str], subtract_last: bool = False, eps: float = 1e-6) -> DataFrame:
    """Reversible: each sample's mean (or last value) and root of variance + eps, with the normalised value."""
    w = Window.partitionBy(*sample)
    centre = F.max_by("value", "t").over(w) if subtract_last else F.avg("value").over(w)
    out = df.withColumns({"centre": centre, "spread": F.sqrt(F.var_pop("value").over(w) + eps)})
    return out.withColumn("normed", (F.col("value") - F.col("centre")) / F.col("spread"))


def instance_norm_inverse(value: Column) -> Column:
    return value * F.col("spread") + F.col("centre")


def spatial_norm(df: DataFrame, eps: float = 1e-5) -> DataFrame:
    """Per time step over channels (sample variance)."""
    w = Window.partitionBy("t")
    return df.withColumn("spatial", (F.col("value") - F.avg("value").over(w)) / F.sqrt(F.var_samp("value").over(w) + eps))


def temporal_norm(df: DataFrame, eps: float = 1e-5) -> DataFrame:
    """Per channel over time (population variance)."""
    w = Window.partitionBy(KEY)
    return df.withColumn("temporal", (F.col("value") - F.avg("value").over(w)) / F.sqrt(F.var_pop("value").over(w) + eps))


def layer_norm_centred(df: DataFrame, eps: float = 1e-5) -> DataFrame:
    """Layer norm over channels at each step, less its mean over the steps of a channel."""
    w = Window.partitionBy("t")
    x = df.withColumn("_ln", (F.col("value") - F.avg("value").over(w)) / F.sqrt(F.var_pop("value").over(w) + eps))
    return x.withColumn("centred", F.col("_ln") - F.avg("_ln").over(Window.partitionBy(KEY))).drop("_ln")


def rms_norm(df: DataFrame, eps: float = 1e-6) -> DataFrame:
    """Over channels at each step."""
    return df.withColumn("rms", F.col("value") / F.sqrt(F.avg(F.col("value") * F.col("value")).over(Window.partitionBy("t")) + eps))
