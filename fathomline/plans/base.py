"""Query registration and the inputs that queries share, in Spark and in SQL.

events stands for a sensor stream: one channel per event_type, hourly means on a complete grid. Values have two decimals,
so sums run over integer cents: they are exact in any order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.operators import fill, grid

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

CENTS = "sum(CAST(round(value * 100) AS BIGINT))"
HOURLY = """
obs AS (SELECT event_type AS series_id, date_trunc('hour', ts) AS ts, sum(CAST(round(value * 100) AS BIGINT)) AS cents, count(*) AS n FROM events GROUP BY 1, 2),
span AS (SELECT min(ts) AS lo, max(ts) AS hi FROM obs),
grid AS (SELECT series_id, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts FROM (SELECT DISTINCT series_id FROM obs), span),
series AS (SELECT series_id, row_number() OVER (PARTITION BY series_id ORDER BY ts) - 1 AS t, ts, cents::DOUBLE / (n * 100) AS value FROM grid LEFT JOIN obs USING (series_id, ts))"""
NEIGHBOURS = """
near AS (SELECT *, last_value(CASE WHEN value IS NOT NULL THEN t END IGNORE NULLS) OVER back AS pt, last_value(value IGNORE NULLS) OVER back AS pv,
  first_value(CASE WHEN value IS NOT NULL THEN t END IGNORE NULLS) OVER ahead AS nt, first_value(value IGNORE NULLS) OVER ahead AS nv FROM series
  WINDOW back AS (PARTITION BY series_id ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), ahead AS (PARTITION BY series_id ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""
FILLED = (
    HOURLY
    + ","
    + NEIGHBOURS
    + """,
filled AS (SELECT series_id, t, ts, CASE WHEN value IS NOT NULL THEN value WHEN pv IS NULL THEN nv WHEN nv IS NULL THEN pv ELSE pv + (nv - pv) * (t - pt) / (nt - pt) END AS value FROM near)"""
)


def query(name: str, sql: str | None = None):
    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", F.col("event_type").alias("series_id"), "value", "props")


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(series_id, ts, t, value) on the complete hour grid; hours without events are NULL."""
    cents = F.sum(F.round(F.col("value") * 100).cast("long"))
    means = events(spark, sf_dir).groupBy("series_id", F.date_trunc("hour", "ts").alias("ts")).agg((cents.cast("double") / (F.count("*") * 100)).alias("value"))
    return grid.positions(grid.complete_grid(means))


def filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill.interpolate(hourly(spark, sf_dir), edges=True)


def uniform_sql(seed: int, *keys: str) -> str:
    """The SQL of ``functions.scalars.uniform``."""
    return f"(('0x' || substr(md5(concat_ws('-', '{seed}', {', '.join(keys)})), 1, 12))::BIGINT / 281474976710656.0::DOUBLE)"


def naive(ts: str = "ts"):
    return F.col(ts).cast("timestamp_ntz").alias(ts)


def rounded(df: DataFrame, digits: int = 6, **more: int) -> DataFrame:
    """Doubles rounded, as sums may run in another order than the oracle's; timestamps without zone, as its own are."""
    return df.select(*(F.round(c, more.get(c, digits)).alias(c) if k == "double" else naive(c) if k == "timestamp" else F.col(c) for c, k in df.dtypes))
