"""Aligning sparse labels with series: as-of join, rule hours, duplicate means."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_backward(left: DataFrame, right: DataFrame, by: list[str], ts: str = "ts", keep_unmatched: bool = False) -> DataFrame:
    """Each left row with the last right row of ts <= its own (equal allowed, no tolerance).

    One union, one sort per key: right rows are tagged to precede left rows of the same ts, and the last right row is
    carried forward. Right columns other than keys come back in a struct ``match`` with its ts.
    """
    struct = F.struct(*(F.col(c) for c in right.columns if c not in by))
    a = right.select(*by, F.col(ts).alias("_ts"), F.lit(0).alias("_side"), struct.alias("_right"))
    b = left.select(*by, F.col(ts).alias("_ts"), F.lit(1).alias("_side"), F.struct(*left.columns).alias("_left"))
    both = b.unionByName(a, allowMissingColumns=True)
    order = Window.partitionBy(*by).orderBy("_ts", "_side").rowsBetween(Window.unboundedPreceding, 0)
    out = both.withColumn("match", F.last("_right", True).over(order)).where("_side = 1")
    out = out if keep_unmatched else out.where("match IS NOT NULL")
    return out.select("_left.*", "match")


def to_rule_hour(df: DataFrame, hours: list[int], tolerance_minutes: int = 20, ts: str = "ts") -> DataFrame:
    """aligned_ts: the latest rule hour not after ts, of the same day or the day before; NULL if further than the tolerance.

    A closed form over the hours' list; no rows are generated.
    """
    day = F.date_trunc("day", F.col(ts))
    hours_ = F.array(*(F.lit(h) for h in sorted(hours)))
    slots = F.flatten(F.transform(F.array(F.lit(-1), F.lit(0)), lambda d: F.transform(hours_, lambda h: d * 24 + h)))
    times = F.transform(slots, lambda h: day + F.make_dt_interval(F.lit(0), h))
    best = F.array_max(F.filter(times, lambda x: x <= F.col(ts)))
    gap = (F.unix_micros(F.col(ts)) - F.unix_micros(best)) / F.lit(60_000_000.0)
    return df.withColumn("aligned_ts", F.when(gap <= tolerance_minutes, best))


def mean_of_duplicates(df: DataFrame, keys: list[str], value: str = "y") -> DataFrame:
    return df.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.avg(value).alias(value))


def long_labels(df: DataFrame, targets: list[str], hours: list[int], tolerance_minutes: int = 20) -> DataFrame:
    """Wide laboratory rows to (target_name, ts, y): unpivot, align to rule hours, average what meets."""
    melted = df.unpivot("ts", targets, "target_name", "y").where("y IS NOT NULL")
    aligned = to_rule_hour(melted, hours, tolerance_minutes).where("aligned_ts IS NOT NULL")
    return mean_of_duplicates(aligned.select("target_name", F.col("aligned_ts").alias("ts"), "y"), ["target_name", "ts"])


def attach_labels(base: DataFrame, labels: DataFrame) -> DataFrame:
    """Every label on the last base row not after it; labels that meet on one row are averaged. All targets at once."""
    targets = labels.select("target_name").distinct()
    times = base.select("ts").distinct().join(targets)
    placed = asof_backward(labels, times, ["target_name"])
    met = placed.groupBy("target_name", F.col("match.ts").alias("ts")).agg(F.avg("y").alias("y"))
    return base.join(met, "ts", "left")
