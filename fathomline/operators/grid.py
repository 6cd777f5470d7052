"""Grids, positions and chronological splits of long-format series (series_id, t, ts, value)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = "series_id"


def in_order(*extra: str) -> Window:
    return Window.partitionBy(KEY).orderBy(*(extra or ("t",)))


def extent(df: DataFrame) -> DataFrame:
    return df.agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


def complete_grid(df: DataFrame, step: str = "1 hour") -> DataFrame:
    """Every series on every step between the overall first and last ts. Rows off the grid are lost, as grids match
    exactly; floor timestamps first to keep them. The grid is exploded per series, so it needs no cross join of rows."""
    bounds = F.broadcast(extent(df))  # one row
    names = df.select(KEY).distinct()
    steps = names.join(bounds).select(KEY, F.explode(F.sequence("first_ts", "last_ts", F.expr(f"INTERVAL {step}"))).alias("ts"))
    return steps.join(df, [KEY, "ts"], "left")


def missing_steps(df: DataFrame, step: str = "1 hour") -> DataFrame:
    """Grid points without a row, per series."""
    return complete_grid(df.select(KEY, "ts"), step).join(df.select(KEY, "ts"), [KEY, "ts"], "left_anti")


def positions(df: DataFrame, order: str = "ts") -> DataFrame:
    """t: the 0-based place of each row in its series."""
    return df.withColumn("t", (F.row_number().over(in_order(order)) - 1).cast("long"))


def chronological_split(df: DataFrame, ratios: tuple[float, float, float], normalise: bool = False) -> DataFrame:
    """split: the first int(n * r0) steps train, the next int(n * r1) validate, the rest test.

    Ratios are taken as the decimals that they are written as, so 0.7 of 360 steps are 252; normalised ones are quotients in doubles.
    """
    total = sum(ratios)
    share = lambda r: r / total if normalise else F.lit(Decimal(str(r)))
    n = F.count(F.lit(1)).over(Window.partitionBy(KEY))
    a, b = F.floor(n * share(ratios[0])), F.floor(n * share(ratios[1]))
    return df.withColumn("split", F.when(F.col("t") < a, "train").when(F.col("t") < a + b, "val").otherwise("test"))


def step_minutes(df: DataFrame) -> DataFrame:
    """The most common positive step between neighbours (the smaller of equals), in minutes, and whether it is the only one."""
    delta = (F.unix_micros(F.col("ts").cast("timestamp")) - F.lag(F.unix_micros(F.col("ts").cast("timestamp"))).over(in_order("ts"))) / F.lit(60_000_000.0)
    counted = df.select(KEY, delta.alias("minutes")).where("minutes > 0").groupBy(KEY, "minutes").agg(F.count("*").alias("n"))
    return counted.groupBy(KEY).agg(
        F.bround(F.min_by("minutes", F.struct(-F.col("n"), "minutes"))).cast("long").alias("step_minutes"),
        (F.count("*") == 1).alias("regular"),
    )


def batches(df: DataFrame, size: int, sample: str = "sample_id") -> DataFrame:
    return df.withColumn("batch_id", F.floor(F.col(sample) / size))


def even_subsample(df: DataFrame, n: int, key: str = "seq_id") -> DataFrame:
    """Rows int(i * (N - 1) / (n - 1)) for i = 0..n-1 of N rows keyed 0..N-1."""
    total = F.broadcast(df.agg(F.count("*").alias("total")))
    picks = df.sparkSession.range(n).join(total).select(F.expr(f"CAST(id * (total - 1) DIV {n - 1} AS BIGINT)").alias(key), F.col("id").alias("place"))
    return picks.join(df, key)


def rows_before(df: DataFrame, limit: int | Column) -> DataFrame:
    return df.where(F.col("t") < limit)
