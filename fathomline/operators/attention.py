"""Attention as relations: rows (group, pos, vec) of bounded groups, such as the steps of a sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathomline.functions.scalars import uniform


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def sparse_queries(rows: DataFrame, group: str, sampled: int, top: int, seed: int) -> DataFrame:
    """(group, pos, score): the ``top`` queries of each group by their largest product with sampled keys less the sum of
    these products over the number of all keys. Each query draws ``sampled`` keys, with replacement, by hash."""
    n = rows.groupBy(group).agg(F.count("*").alias("_n"))
    draws = rows.join(n, group).withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(sampled - 1))))
    draws = draws.withColumn("_at", F.floor(uniform(seed, group, "pos", "_i") * F.col("_n")).cast("long"))
    keys = rows.select(group, F.col("pos").cast("long").alias("_at"), F.col("vec").alias("_key"))
    product = draws.join(keys, [group, "_at"]).select(group, "pos", "_n", dot(F.col("vec"), F.col("_key")).alias("_p"))
    scores = product.groupBy(group, "pos").agg((F.max("_p") - F.sum("_p") / F.max("_n")).alias("score"))
    rank = F.row_number().over(Window.partitionBy(group).orderBy(F.desc(F.round("score", 9)), "pos"))
    return scores.withColumn("_r", rank).where(F.col("_r") <= top).drop("_r")


def rotary(vec: Column, pos: Column, size: int, base: float = 10_000.0) -> Column:
    """Rotary position embedding: entry j of the first half turns with entry j of the second by pos * base^(-2j / size)."""
    half = size // 2
    angle = [pos * float(base ** (-2 * j / size)) for j in range(half)]
    low = [vec[j] * F.cos(angle[j]) - vec[j + half] * F.sin(angle[j]) for j in range(half)]
    high = [vec[j + half] * F.cos(angle[j]) + vec[j] * F.sin(angle[j]) for j in range(half)]
    return F.array(*low, *high)


def causal_attention(rows: DataFrame, group: str, size: int, value: str = "value") -> DataFrame:
    """(group, pos, attended): each row's softmax-weighted mean of ``value`` over the rows of its group up to itself, with
    scores of rotated vectors over the root of their length. An equi-join on the group, whose length is bounded."""
    turned = rows.select(group, "pos", value, rotary(F.col("vec"), F.col("pos"), size).alias("vec"))
    keys = turned.select(group, F.col("pos").alias("_at"), F.col("vec").alias("_key"), F.col(value).alias("_value"))
    scored = turned.join(keys, group).where("_at <= pos").select(group, "pos", "_value", (dot(F.col("vec"), F.col("_key")) / size**0.5).alias("_s"))
    top = F.max("_s").over(Window.partitionBy(group, "pos"))
    weighed = scored.withColumn("_w", F.exp(F.col("_s") - top))
    return weighed.groupBy(group, "pos").agg((F.sum(F.col("_w") * F.col("_value")) / F.sum("_w")).alias("attended"))
