"""Lag and rolling features over row positions; feature lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.functions.scalars import feature_source
from fathomline.operators.grid import in_order

LAGS = [1, 30, 60, 90, 120, 180, 240, 360]
WINDOWS = [15, 30, 60, 90, 120, 180, 360]
STATS = {"ma": F.avg, "std": F.stddev_samp, "max": F.max, "min": F.min}


def feature_matrix(df: DataFrame, lags: list[int] | None = None, windows: list[int] | None = None, column: str = "value") -> DataFrame:
    """Lags and trailing mean, deviation, maximum and minimum. All frames share one exchange and one sort."""
    out = {f"{column}_lag_{k}m": F.lag(column, k).over(in_order()) for k in (LAGS if lags is None else lags)}
    for w in WINDOWS if windows is None else windows:
        frame = in_order().rowsBetween(-(w - 1), 0)
        out |= {f"{column}_{name}_{w}m": f(column).over(frame) for name, f in STATS.items()}
    return df.select("*", *(e.alias(n) for n, e in out.items()))


def rank_by_correlation(df: DataFrame, features: list[str], target: str, k: int = 300) -> DataFrame:
    """(feature, importance, rank): absolute correlation with the target, the k largest; one aggregate for all features.
    Deterministic, unlike importances of boosted trees."""
    ok = lambda f: F.when(F.col(target).isNotNull() & F.col(f).isNotNull(), F.lit(1.0))

    def corr(f):
        x, y, one = F.col(f) * ok(f), F.col(target) * ok(f), ok(f)
        n = F.sum(one)
        top = n * F.sum(x * y) - F.sum(x) * F.sum(y)
        down = F.sqrt((n * F.sum(x * x) - F.sum(x) * F.sum(x)) * (n * F.sum(y * y) - F.sum(y) * F.sum(y)))
        return F.coalesce(F.abs(F.try_divide(top, down)), F.lit(0.0))

    wide = df.agg(*(corr(f).alias(f) for f in features))
    tall = wide.select(F.explode(F.array(*(F.struct(F.lit(f).alias("feature"), F.col(f).alias("importance")) for f in features))).alias("x")).select("x.*")
    top = tall.orderBy(F.desc("importance"), "feature").limit(k)
    return top.groupBy().agg(F.array_sort(F.collect_list(F.struct((-F.col("importance")).alias("low"), "feature"))).alias("xs")).select(F.posexplode("xs").alias("rank", "x")).select((F.col("rank") + 1).alias("rank"), "x.feature", (-F.col("x.low")).alias("importance"))


def summarise_selection(selected: DataFrame) -> DataFrame:
    """(feature, targets): which targets chose each feature, joined in order."""
    return selected.groupBy("feature").agg(F.array_join(F.array_sort(F.collect_set("target_name")), "|").alias("targets"))


def raw_points(selected: DataFrame) -> DataFrame:
    """Selected features and the raw signals behind them, once each."""
    return selected.select("feature").union(selected.select(feature_source(F.col("feature")).alias("feature"))).distinct()


