"""Gaps: runs, statistics and interpolation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fathomline.operators.grid import KEY, in_order

BACK = lambda: in_order().rowsBetween(Window.unboundedPreceding, 0)
AHEAD = lambda: in_order().rowsBetween(0, Window.unboundedFollowing)


def runs(df: DataFrame) -> DataFrame:
    """run_id and run_length of equal missingness."""
    gap = F.col("value").isNull()
    turn = F.when(gap == F.lag(gap).over(in_order()), 0).otherwise(1)
    out = df.withColumn("_turn", turn).withColumn("run_id", F.sum("_turn").over(in_order())).drop("_turn")
    return out.withColumn("run_length", F.count(F.lit(1)).over(Window.partitionBy(KEY, "run_id")))


def gap_stats(df: DataFrame, long_gap: int = 120) -> DataFrame:
    """Per series: missing cells and share, number of gaps, the longest, and those longer than ``long_gap``."""
    each = runs(df).groupBy(KEY, "run_id").agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("valid"))
    gap = F.col("valid") == 0
    return each.groupBy(KEY).agg(
        F.sum(F.when(gap, F.col("n")).otherwise(0)).alias("na_count"),
        F.round(F.sum(F.when(gap, F.col("n")).otherwise(0)) / F.sum("n"), 6).alias("na_ratio"),
        F.count_if(gap).alias("gap_count"),
        F.coalesce(F.max(F.when(gap, F.col("n"))), F.lit(0)).alias("max_gap"),
        F.count_if(gap & (F.col("n") > long_gap)).alias("long_gap_count"),
    )


def interpolate(df: DataFrame, edges: bool = False) -> DataFrame:
    """Linear in t between the nearest valid neighbours; ``edges`` also carries the first and last values outwards."""
    mark = F.when(F.col("value").isNotNull(), F.struct("t", "value"))
    out = df.withColumns({"_p": F.last(mark, True).over(BACK()), "_n": F.first(mark, True).over(AHEAD())})
    p, n = F.col("_p"), F.col("_n")
    line = p["value"] + (n["value"] - p["value"]) * (F.col("t") - p["t"]) / F.nullif(n["t"] - p["t"], F.lit(0))
    value = F.coalesce(F.col("value"), line, *([p["value"], n["value"]] if edges else []))
    return out.withColumn("value", value).drop("_p", "_n")


def interpolate_short_gaps(df: DataFrame, long_gap: int = 120) -> DataFrame:
    """Interior gaps of up to ``long_gap`` steps are interpolated; longer ones, and the ends, stay missing."""
    marked = runs(df).withColumn("_long", F.col("value").isNull() & (F.col("run_length") > long_gap)).drop("run_id", "run_length")
    return interpolate(marked).withColumn("value", F.when(~F.col("_long"), F.col("value"))).drop("_long")


def valid_ratio(df: DataFrame) -> DataFrame:
    return df.groupBy(KEY).agg((F.count("value") / F.count(F.lit(1))).alias("valid_ratio"))


def keep_valid_series(df: DataFrame, least: float = 0.4) -> DataFrame:
    return df.join(valid_ratio(df).where(F.col("valid_ratio") >= least).select(KEY), KEY, "left_semi")


def interpolation_report(df: DataFrame, least: float = 0.4, long_gap: int = 120) -> DataFrame:
    """Gap statistics before and after, one row a series, series too empty to interpolate included, worst first."""
    kept = keep_valid_series(df, least)
    old = gap_stats(df, long_gap).select(KEY, *(F.col(c).alias(f"{c}_before") for c in ("na_count", "na_ratio", "gap_count", "max_gap", "long_gap_count")))
    new = gap_stats(interpolate_short_gaps(kept, long_gap), long_gap).select(KEY, *(F.col(c).alias(f"{c}_after") for c in ("na_count", "na_ratio", "gap_count", "max_gap", "long_gap_count")), F.lit(True).alias("processed"))
    skipped = old.join(new.select(KEY), KEY, "left_anti").select(KEY, *(F.col(f"{c}_before").alias(f"{c}_after") for c in ("na_count", "na_ratio", "gap_count", "max_gap", "long_gap_count")), F.lit(False).alias("processed"))
    out = valid_ratio(df).withColumn("valid_ratio", F.round("valid_ratio", 6)).join(old, KEY).join(new.unionByName(skipped), KEY)
    return out.withColumn("filled_count", F.col("na_count_before") - F.col("na_count_after"))
