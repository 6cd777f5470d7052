"""Writers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_splits(df: DataFrame, path: str) -> None:
    """One folder a split; rows of a split and series stay together, so files are few and sorted."""
    df.repartition("split", "series_id").sortWithinPartitions("series_id", "t").write.mode("overwrite").partitionBy("split").parquet(path)


def write_metadata(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").json(path)


def write_results(samples: DataFrame, path: str) -> None:
    """Inputs, prediction and targets keyed by sample, so that a short last batch cannot be misplaced."""
    samples.write.mode("overwrite").parquet(path)


def metrics_json(metrics: DataFrame, by: str) -> DataFrame:
    """One row: {"overall": {...}, "<by>": {...}} of rows keyed by ``by``."""
    fields = [c for c in metrics.columns if c != by]
    return metrics.groupBy().agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(by).cast("string"), F.struct(*fields))))).alias("m")).select(F.to_json("m").alias("metrics"))


def write_graph(edges: DataFrame, path: str) -> None:
    """The distances of a graph's edges and their connectivity, one folder each."""
    both = edges.withColumn("kind", F.lit("distance")).unionByName(edges.withColumn("weight", F.lit(1.0)).withColumn("kind", F.lit("connectivity")))
    both.write.mode("overwrite").partitionBy("kind").parquet(path)


def merge_shards(spark, paths: list[str], out: str, files: int) -> None:
    spark.read.parquet(*paths).coalesce(files).write.mode("overwrite").parquet(out)


def metadata(df: DataFrame, name: str, minutes: int, ratios: list[float], null_value: float | None) -> DataFrame:
    """One row that describes a long-format data set."""
    facts = df.agg(F.countDistinct("t").alias("num_time_steps"), F.countDistinct("series_id").alias("num_vars"))
    settings = F.struct(F.array(*(F.lit(r) for r in ratios)).alias("train_val_test_ratio"), F.lit(null_value).cast("double").alias("null_val"))
    return facts.select(F.lit(name).alias("name"), F.lit(minutes).alias("frequency_minutes"), "num_time_steps", "num_vars", settings.alias("regular_settings"))
