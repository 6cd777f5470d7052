"""Graphs as edge lists (src, dst, weight); absent edges are zero."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathomline.sources.scratch import checkpointed


def symmetric(edges: DataFrame, place: str, connectivity: bool = False) -> DataFrame:
    """Both directions of each edge; of repeated edges the last by ``place`` wins. ``connectivity`` makes weights 1."""
    both = edges.select("src", "dst", "weight", place, F.lit(0).alias("_way")).unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight", place, F.lit(1).alias("_way")))
    last = both.groupBy("src", "dst").agg(F.max_by("weight", F.struct(place, "_way")).alias("weight"))
    return last.withColumn("weight", F.lit(1.0)) if connectivity else last


def nodes(edges: DataFrame) -> DataFrame:
    return edges.select("src").union(edges.select("dst")).distinct()


def diagonal(edges: DataFrame) -> DataFrame:
    return nodes(edges).select("src", F.col("src").alias("dst"), F.lit(1.0).alias("weight"))


def added(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def with_self_loops(edges: DataFrame) -> DataFrame:
    return edges.where("src <> dst").unionByName(diagonal(edges))


def degrees(edges: DataFrame) -> DataFrame:
    return edges.groupBy("src").agg(F.sum("weight").alias("degree"))


def _scaled(edges: DataFrame, power: float, both: bool = True) -> DataFrame:
    d = degrees(edges).select("src", F.when(F.col("degree") > 0, F.pow("degree", F.lit(power))).otherwise(0.0).alias("s"))
    out = edges.join(d, "src").withColumn("weight", F.col("weight") * F.col("s")).drop("s")
    if both:
        out = out.join(d.select(F.col("src").alias("dst"), "s"), "dst", "left").withColumn("weight", F.col("weight") * F.coalesce("s", F.lit(0.0))).drop("s")
    return out.select("src", "dst", "weight")


def laplacian(edges: DataFrame) -> DataFrame:
    """I - D^-1/2 A D^-1/2; nodes without edges out keep their diagonal."""
    return added(diagonal(edges), _scaled(edges, -0.5).withColumn("weight", -F.col("weight")))


def scaled_laplacian(edges: DataFrame, largest: float | None = 2.0) -> DataFrame:
    """(2 / largest) L - I of the graph made symmetric by the larger of both directions; without ``largest``, the largest
    eigenvalue of L takes its place."""
    flipped = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    even = edges.unionByName(flipped).groupBy("src", "dst").agg(F.max("weight").alias("weight"))
    lap = laplacian(even)
    if largest is None:
        lap = checkpointed(lap)
        largest = largest_eigenvalue(lap)
    lap = lap.withColumn("weight", F.col("weight") * (2 / largest))
    return added(lap, diagonal(edges).withColumn("weight", -F.col("weight")))


def largest_eigenvalue(matrix: DataFrame, rounds: int = 100, close: float = 1e-9) -> float:
    """Power iteration of a matrix without negative eigenvalues; each round is one join and two aggregates, cut from the
    last by a checkpoint, and the driver sees one number a round."""
    v, value = nodes(matrix).withColumn("x", 1 + F.pmod(F.col("src") * 7919, F.lit(101)) / 101), 0.0
    for _ in range(rounds):
        y = matrix.join(v.select(F.col("src").alias("dst"), "x"), "dst").groupBy("src").agg(F.sum(F.col("weight") * F.col("x")).alias("x"))
        y = checkpointed(y)
        before, value = value, float(y.agg(F.sqrt(F.sum(F.col("x") * F.col("x")))).first()[0] or 0.0)
        if not value or abs(value - before) <= close * value:
            break
        v = y.withColumn("x", F.col("x") / value)
    return value


def renormalised(edges: DataFrame) -> DataFrame:
    """D^-1/2 (A + I) D^-1/2, transposed."""
    out = _scaled(added(edges, diagonal(edges)), -0.5)
    return out.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")


def transition(edges: DataFrame, transposed: bool = True) -> DataFrame:
    out = _scaled(edges, -1.0, both=False)
    return out.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight") if transposed else out


def normalised(edges: DataFrame, kind: str, largest: float | None = 2.0) -> list[DataFrame]:
    """The matrices of each way of normalising; an unknown one is an error. ``largest`` is the scaled Laplacian's."""
    flipped = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    ways = {
        "scalap": lambda: [scaled_laplacian(edges, largest)], "normlap": lambda: [laplacian(edges)], "symnadj": lambda: [renormalised(edges)], "transition": lambda: [transition(edges)],
        "doubletransition": lambda: [transition(edges), transition(flipped)], "identity": lambda: [diagonal(edges)], "original": lambda: [edges],
    }
    if kind not in ways:
        raise ValueError(f"unknown normalisation: {kind}")
    return ways[kind]()


def remap(edges: DataFrame, ids: DataFrame, raw: str) -> DataFrame:
    """Raw node ids replaced by their 0-based place in the sorted list of ids."""
    place = ids.select((F.row_number().over(Window.orderBy(raw)) - 1).alias("place"), F.col(raw).alias("_id"))
    out = edges
    for side in ("src", "dst"):
        out = out.join(place.withColumnRenamed("place", f"_{side}"), F.col(side) == F.col("_id")).drop("_id", side).withColumnRenamed(f"_{side}", side)
    return out


def edge_weight(distance: Column, spread: float) -> Column:
    return F.exp(-(distance * distance) / (spread * spread))
