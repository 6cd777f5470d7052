"""Outlier removal. Each stage sees the NULLs that the one before it made; none is fused with another."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from fathomline.functions.scalars import MICROS_PER_DAY, micros
from fathomline.operators.grid import KEY

def zero_to_null(df: DataFrame) -> DataFrame:
    return df.withColumn("value", F.nullif(F.col("value"), F.lit(0.0)))


def rolling_stats(df: DataFrame, hours: float = 24) -> DataFrame:
    """Mean, sample deviation and count of (ts - hours, ts], the current row included.

    Time is cut into blocks of the window's length, so a window lies in its row's block and the one before. A row adds to
    the sums of its own block and, as a copy ``hours`` later, takes itself away from those of the next: all windows come
    from running sums, one pass over each (series, block), and a series spreads over its blocks. Sums are of differences
    from the block's mean, which keeps the deviation's digits.
    """
    width = int(hours * MICROS_PER_DAY / 24)
    placed = df.withColumn("_x", micros(F.col("ts")))
    block = F.floor(F.col("_x") / width)
    own = placed.withColumns({"_block": block, "_sign": F.lit(1)})
    left = placed.where("value IS NOT NULL AND _x IS NOT NULL").select(KEY, "value", (F.col("_x") + width).alias("_x"), (block + 1).alias("_block"), F.lit(-1).alias("_sign"))
    part = Window.partitionBy(KEY, "_block")
    so_far = part.orderBy("_x").rangeBetween(Window.unboundedPreceding, 0)
    both = own.unionByName(left, allowMissingColumns=True).withColumn("_c", F.avg("value").over(part))
    d, one = F.col("value") - F.col("_c"), F.when(F.col("value").isNotNull(), 1)
    # what the block before holds in all, and what has come and gone by now
    total = lambda x: F.coalesce(F.sum(F.when(F.col("_sign") < 0, x)).over(part), F.lit(0)) + F.coalesce(F.sum(x * F.col("_sign")).over(so_far), F.lit(0))
    both = both.withColumns({"w_n": total(one), "_s": total(d), "_q": total(d * d)}).where("_sign > 0")
    n, total_, square = F.col("w_n"), F.col("_s"), F.col("_q")
    mean = F.when(n > 0, F.col("_c") + total_ / n)
    std = F.when(n > 1, F.sqrt(F.greatest(square - total_ * total_ / n, F.lit(0.0)) / (n - 1)))
    return both.select(*(F.col(f"`{c}`") for c in df.columns), mean.alias("w_mean"), std.alias("w_std"), n.cast("long").alias("w_n"))


def drop_rolling_outliers(df: DataFrame, hours: float = 24, width: float = 3, least: int = 5) -> DataFrame:
    """Null what lies outside mean +- width * std of the window; windows of fewer than ``least`` values decide nothing."""
    far = (F.col("w_n") >= least) & (F.abs(F.col("value") - F.col("w_mean")) > width * F.col("w_std"))
    return rolling_stats(df, hours).withColumn("value", F.when(~F.coalesce(far, F.lit(False)), F.col("value"))).drop("w_mean", "w_std", "w_n")


def _with(df: DataFrame, **stats) -> DataFrame:
    return df.join(df.groupBy(KEY).agg(*(e.alias(n) for n, e in stats.items())), KEY)


def drop_iqr_outliers(df: DataFrame, width: float = 2.5) -> DataFrame:
    """One percentile pass for both quartiles; a series without spread or data is left alone."""
    out = _with(df, q=F.percentile("value", F.array(F.lit(0.25), F.lit(0.75))))
    iqr = F.col("q")[1] - F.col("q")[0]
    far = (iqr > 0) & ((F.col("value") < F.col("q")[0] - width * iqr) | (F.col("value") > F.col("q")[1] + width * iqr))
    return out.withColumn("value", F.when(~F.coalesce(far, F.lit(False)), F.col("value"))).drop("q")


def drop_far_from_median(df: DataFrame, percent: float = 50, least: int = 10) -> DataFrame:
    """Null what differs from the median by more than ``percent`` of it; not with few values or a median of 0."""
    out = _with(df, mid=F.median("value"), n=F.count("value"))
    far = (F.col("n") >= least) & (F.col("mid") != 0) & (F.abs(F.col("value") - F.col("mid")) > F.abs(F.col("mid")) * (percent / 100))
    return out.withColumn("value", F.when(~F.coalesce(far, F.lit(False)), F.col("value"))).drop("mid", "n")


def drop_extreme_quantiles(df: DataFrame, low: float = 0.001, high: float = 0.999, least: int = 10) -> DataFrame:
    out = _with(df, q=F.percentile("value", F.array(F.lit(low), F.lit(high))), n=F.count("value"))
    far = (F.col("n") >= least) & ((F.col("value") < F.col("q")[0]) | (F.col("value") > F.col("q")[1]))
    return out.withColumn("value", F.when(~F.coalesce(far, F.lit(False)), F.col("value"))).drop("q", "n")


def drop_empty_series(df: DataFrame) -> DataFrame:
    return df.join(df.groupBy(KEY).agg(F.count("value").alias("n")).where("n > 0").select(KEY), KEY, "left_semi")


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of the columns of a numeric type, in their order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def drop_null_columns(df: DataFrame) -> DataFrame:
    """Without the columns that hold nothing but NULL; one aggregate over all columns. An empty table keeps its columns."""
    found = df.agg(F.count(F.lit(1)).alias("rows"), *(F.count(F.col(f"`{c}`")).alias(f"n{k}") for k, c in enumerate(df.columns))).first()
    return df.select(*(F.col(f"`{c}`") for k, c in enumerate(df.columns) if found[f"n{k}"] or not found["rows"]))


def _bounded(counts: DataFrame, low, high, **stats) -> DataFrame:
    """(series_id, low, high): what a quantile stage keeps, from the counts of each value."""
    each = counts.groupBy(KEY).agg(F.sum("n").alias("n"), *(e.alias(name) for name, e in stats.items()))
    return each.select(KEY, low.alias("low"), high.alias("high"))


def _within(counts: DataFrame, bounds: DataFrame) -> DataFrame:
    return counts.join(bounds, KEY).where("(low IS NULL OR value >= low) AND (high IS NULL OR value <= high)").select(KEY, "value", "n")


def clean(df: DataFrame, hours: float = 24, width: float = 3, iqr: float = 2.5, median_percent: float | None = None) -> DataFrame:
    """All stages in their order. The quantile stages follow from the number of times that each value occurs in each
    series, one aggregate of the rows whatever the number of stages; their bounds are applied together at the end."""
    rows = drop_rolling_outliers(zero_to_null(df), hours, width)
    counts = rows.where("value IS NOT NULL").groupBy(KEY, "value").agg(F.count(F.lit(1)).alias("n"))
    quantiles = lambda *p: F.percentile("value", F.array(*(F.lit(x) for x in p)), F.col("n"))
    q, some, mid = F.col("q"), F.col("n") >= 10, F.col("q")[0]
    spread = q[1] - q[0]
    steps = [_bounded(counts, F.when(spread > 0, q[0] - iqr * spread), F.when(spread > 0, q[1] + iqr * spread), q=quantiles(0.25, 0.75))]
    left = _within(counts, steps[-1])
    if median_percent is not None:
        reach, decides = F.abs(mid) * (median_percent / 100), some & (mid != 0)
        steps.append(_bounded(left, F.when(decides, mid - reach), F.when(decides, mid + reach), q=quantiles(0.5)))
        left = _within(left, steps[-1])
    steps.append(_bounded(left, F.when(some, q[0]), F.when(some, q[1]), q=quantiles(0.001, 0.999)))
    # quantiles of what is left lie within it, so no series that reaches the last stage becomes empty there
    bounds = steps[-1]
    for step in reversed(steps[:-1]):
        both = bounds.join(step.select(KEY, F.col("low").alias("l"), F.col("high").alias("h")), KEY)
        bounds = both.select(KEY, F.greatest("low", "l").alias("low"), F.least("high", "h").alias("high"))
    keep = (F.col("low").isNull() | (F.col("value") >= F.col("low"))) & (F.col("high").isNull() | (F.col("value") <= F.col("high")))
    return rows.join(bounds, KEY).withColumn("value", F.when(keep, F.col("value"))).drop("low", "high")


def keep_first(df: DataFrame, keys: list[str], place: str) -> DataFrame:
    """The row of least ``place`` for each key: "first" needs a stated order."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(place))).where("_rn = 1").drop("_rn")


def floor_to_minute(df: DataFrame, place: str) -> DataFrame:
    """Timestamps floored to the minute, bad ones dropped, the first row of each minute kept."""
    floored = df.withColumn("ts", F.date_trunc("minute", "ts")).where("ts IS NOT NULL")
    return keep_first(floored, [KEY, "ts"], place)
