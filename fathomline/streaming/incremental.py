"""Streaming extensions: the batch rules as Structured Streaming queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_means(events: DataFrame, width: str = "1 minute", late: str = "10 minutes") -> DataFrame:
    """(series_id, ts, value, n): means per window; state is dropped once the watermark passes a window."""
    rows = events.withWatermark("ts", late)
    return rows.groupBy(F.window("ts", width).alias("w"), "series_id").agg(F.avg("value").alias("value"), F.count("*").alias("n")).select("series_id", F.col("w.start").alias("ts"), "value", "n")


def running_errors(forecasts: DataFrame, width: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Sums from which masked MAE and MSE of any set of windows follow."""
    e = F.col("y_pred") - F.col("y_true")
    rows = forecasts.where("y_true IS NOT NULL").withWatermark("ts", late)
    return rows.groupBy(F.window("ts", width).alias("w"), "series_id").agg(F.sum(F.abs(e)).alias("abs_error"), F.sum(e * e).alias("squared_error"), F.count("*").alias("n")).select("series_id", F.col("w.start").alias("ts"), "abs_error", "squared_error", "n")
