"""Similarity, indistinguishability, density and selective masks."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fathomline.functions.scalars import uniform
from fathomline.operators.grid import KEY


def channel_pairs(df: DataFrame, sample: str, step: str) -> DataFrame:
    """Sums over each sample's steps for every ordered pair of its channels. Work per sample is the square of its number
    of channels, a property of the data set, not of its length."""
    a = df.select(sample, step, F.col(KEY).alias("a"), F.col("value").alias("x"))
    b = df.select(sample, step, F.col(KEY).alias("b"), F.col("value").alias("y"))
    x, y = F.col("x"), F.col("y")
    return a.join(b, [sample, step]).groupBy(sample, "a", "b").agg(
        F.sum(x * y).alias("xy"), F.sum(x * x).alias("xx"), F.sum(y * y).alias("yy"), F.sum((x - y) * (x - y)).alias("square"), F.sum(F.abs(x - y)).alias("l1")
    )


def similarity(df: DataFrame, sample: str, step: str, eps: float = 1e-7) -> DataFrame:
    """cosine (eps added to each norm), euclidean and manhattan distance of channels within each sample."""
    cosine = F.col("xy") / ((F.sqrt("xx") + eps) * (F.sqrt("yy") + eps))
    return channel_pairs(df, sample, step).select(sample, "a", "b", cosine.alias("cosine"), F.sqrt("square").alias("euclidean"), F.col("l1").alias("manhattan"))


def indistinguishability(past: DataFrame, future: DataFrame, sample: str, high: float = 0.9, low: float = 0.4) -> DataFrame:
    """Shares of pairs that look alike before and differ after: of all pairs, and of the alike ones."""
    p = past.select(sample, "a", "b", F.col("cosine").alias("p"))
    f = future.select(sample, "a", "b", F.col("cosine").alias("f"))
    alike, split = F.count_if(F.col("p") > high), F.count_if((F.col("p") > high) & (F.col("f") < low))
    return p.join(f, [sample, "a", "b"]).agg(F.count("*").alias("pairs"), alias_(alike, "alike"), alias_(split, "split"), (split / F.count("*")).alias("of_all"), F.coalesce(F.try_divide(split, alike), F.lit(0.0)).alias("of_alike"))


def alias_(c, name):
    return c.alias(name)


def density(df: DataFrame, points: int, low: float, high: float, bandwidth: float = 5.0) -> DataFrame:
    """Gaussian kernel density of each series on a fixed grid of ``points``: rows are first counted per distinct value, so
    the expansion is grid points times distinct values."""
    counted = df.where("value IS NOT NULL").groupBy(KEY, "value").agg(F.count("*").alias("n"))
    grid = F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda i: F.lit(low) + i * ((high - low) / (points - 1)))
    rows = counted.select(KEY, "value", "n", F.posexplode(grid).alias("point", "x"))
    z = (F.col("x") - F.col("value")) / bandwidth
    return rows.groupBy(KEY, "point", "x").agg((F.sum(F.col("n") * F.exp(-z * z / 2)) / (F.sum("n") * bandwidth * math.sqrt(2 * math.pi))).alias("density"))


def residual_variance(forecasts: DataFrame) -> DataFrame:
    """Mean and variance of residuals of overlapping windows per target step: E[r^2] - E[r]^2 is the definition."""
    r = F.col("y_pred") - F.col("y_true")
    return forecasts.groupBy(KEY, (F.col("sample_id") + F.col("h")).alias("step")).agg(F.avg(r).alias("residual_mean"), (F.avg(r * r) - F.avg(r) * F.avg(r)).alias("residual_var"))


def certain_steps(variance: DataFrame, drop_share: float) -> DataFrame:
    """Steps whose variance is below the (1 - share) quantile of their channel."""
    cut = variance.groupBy(KEY).agg(F.percentile("residual_var", 1 - drop_share).alias("cut"))
    return variance.join(cut, KEY).withColumn("keep", F.col("residual_var") < F.col("cut")).drop("cut")


def anomalous_cells(df: DataFrame, share: float) -> DataFrame:
    """Cells whose error exceeds a reference's by more than the given quantile of such excesses along the horizon."""
    excess = F.abs(F.col("y_pred") - F.col("y_true")) - F.abs(F.col("y_ref") - F.col("y_true"))
    out = df.withColumn("excess", excess)
    cut = out.groupBy(KEY, "sample_id").agg(F.percentile("excess", share).alias("cut"))
    return out.join(cut, [KEY, "sample_id"]).withColumn("anomalous", F.col("excess") > F.col("cut")).drop("cut")


def principal_components(df: DataFrame, column: str, k: int = 2) -> DataFrame:
    """A linear map to the plane, in place of t-SNE, which has no distributed exact form."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    rows = df.withColumn("_vec", array_to_vector(F.col(column)))
    return PCA(k=k, inputCol="_vec", outputCol="_pc").fit(rows).transform(rows).withColumn("component", vector_to_array("_pc")).drop("_vec", "_pc")


def random_sample(df: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """``n`` rows without replacement: those of least hash, by a top-n in every task."""
    return df.orderBy(uniform(seed, key), key).limit(n)


def preview(df: DataFrame, n: int, order: str, last: bool = False) -> DataFrame:
    return df.orderBy(F.desc(order) if last else F.asc(order)).limit(n)


def gate_top_k(df: DataFrame, k: int, row: str, expert: str, logit: str) -> DataFrame:
    """Mixture-of-experts gates: softmax, the k largest, renormalised by their sum + 1e-6."""
    w = Window.partitionBy(row)
    e = F.exp(F.col(logit) - F.max(logit).over(w))
    soft = df.withColumn("_e", e).withColumn("_g", F.col("_e") / F.sum("_e").over(w))
    top = soft.withColumn("_r", F.row_number().over(w.orderBy(F.desc(logit), expert))).where(F.col("_r") <= k)
    return top.withColumn("gate", F.col("_g") / (F.sum("_g").over(w) + 1e-6)).drop("_e", "_g", "_r")
