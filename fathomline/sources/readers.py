"""Readers to long form, and generated series."""

from __future__ import annotations

import json
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.functions.scalars import tolerant_double, tolerant_timestamp, uniform

#: Date formats of the public data sets.
FORMATS = {"dash_seconds": "yyyy-MM-dd HH:mm:ss", "slash_minutes": "yyyy/M/d H:mm"}


def strip_names(df: DataFrame) -> DataFrame:
    """Column names without outer blanks or byte-order mark; names that then collide are an error that lists them."""
    names = [c.strip().lstrip("﻿").strip() for c in df.columns]
    if double := sorted({n for n in names if names.count(n) > 1}):
        raise ValueError(f"column names collide: {double}")
    return df.toDF(*names)


def read_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Header CSV. Without a schema all columns are strings and are cast where used: inference would read it twice."""
    reader = spark.read.option("header", True)
    return strip_names((reader.schema(schema) if schema else reader).csv(path))


def wide_to_long(df: DataFrame, ts: str = "ts") -> DataFrame:
    channels = [c for c in df.columns if c != ts]
    return df.unpivot(ts, channels, "series_id", "value")


def read_dated_csv(spark: SparkSession, path: str, pattern: str = "dash_seconds", date: str = "date") -> DataFrame:
    """date + channel columns to (series_id, ts, value); bad timestamps are dropped, bad numbers become NULL."""
    raw = read_csv(spark, path)
    typed = raw.select(tolerant_timestamp(F.col(date), FORMATS.get(pattern, pattern)).alias("ts"), *(tolerant_double(F.col(f"`{c}`")).alias(c) for c in raw.columns if c != date))
    return wide_to_long(typed.where("ts IS NOT NULL"))


def read_distances(spark: SparkSession, path: str) -> DataFrame:
    """Edge CSV with a header row; rows without exactly three fields are skipped."""
    fields = F.split("value", ",", -1)
    lines = spark.read.text(path).where(F.size(fields) == 3)
    typed = lines.select(fields[0].try_cast("int").alias("src"), fields[1].try_cast("int").alias("dst"), fields[2].try_cast("double").alias("weight"))
    return typed.where("src IS NOT NULL AND dst IS NOT NULL AND weight IS NOT NULL")


def parse_labelled_sequences(lines: DataFrame, text: str = "value") -> DataFrame:
    """Text sequences ``channel:channel:label`` with comma-separated steps, missing as ``?``: (label, channel, series).
    Header lines (starting with @ or #) are skipped."""
    rows = lines.where(~F.col(text).rlike(r"^\s*[@#]") & (F.trim(text) != "")).select(F.split(text, ":", -1).alias("p"))
    parts = rows.select(F.element_at("p", -1).alias("label"), F.posexplode(F.slice(F.col("p"), F.lit(1), F.size("p") - 1)).alias("channel", "steps"))
    return parts.select("label", "channel", F.transform(F.split("steps", ","), lambda x: F.trim(x).try_cast("double")).alias("series"))


def read_arrays(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """A table partitioned by split; naming one prunes the others."""
    df = spark.read.parquet(path)
    return df if split is None else df.where(F.col("split") == split)


def missing_files(spark: SparkSession, path: str, names: list[str]) -> list[str]:
    """Those of ``names`` that the folder lacks, in any file system that Spark reads."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [name for name in names if not files.exists(jvm.org.apache.hadoop.fs.Path(place, name))]


def read_graph(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """One matrix of a graph written by ``write_graph``, as edges."""
    return spark.read.parquet(path).where(F.col("kind") == kind).drop("kind")


def load_memmap(spark: SparkSession, folder: str) -> DataFrame:
    """Corpus rows (seq_id, seq) of a raw float32 matrix ``data.dat`` whose shape is in ``shape.npy``; NaN becomes NULL.

    Records of one row each are read in splits, as the file may be far larger than one task's memory.
    """
    import io

    import numpy as np

    raw = spark.read.format("binaryFile").load(f"{folder}/shape.npy").select("content").first()["content"]
    rows, width = (int(x) for x in np.load(io.BytesIO(raw), allow_pickle=False))

    def parse(numbered):
        for record, k in numbered:
            x = np.frombuffer(record, "<f4")
            yield k, [None if v != v else v for v in x.tolist()]

    records = spark.sparkContext.binaryRecords(f"{folder}/data.dat", 4 * width).zipWithIndex()
    return spark.createDataFrame(records.mapPartitions(parse), "seq_id long, seq array<float>").where(F.col("seq_id") < rows)


def inline_rows(spark: SparkSession, rows: list[list]) -> DataFrame:
    """Request rows [[ts, v1, v2, ...], ...] to long form."""
    width = max((len(r) for r in rows), default=1)
    schema = ", ".join(["ts string", *(f"c{k} double" for k in range(1, width))])
    wide = spark.createDataFrame([(str(r[0]), *(None if v is None else float(v) for v in r[1:])) for r in rows], schema)
    return wide_to_long(wide.withColumn("ts", F.to_timestamp("ts"))) if width > 1 else wide


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).option("allowNonNumericNumbers", True).json(path)


def check_metadata(text: str, rows: dict[str, int]) -> dict:
    """Metadata as a dict; split lengths that differ from the rows found are an error."""
    meta = json.loads(text)
    for mode, n in rows.items():
        told = meta.get("split", {}).get(f"{mode}_len", n)
        if told != n:
            raise ValueError(f"{mode}: metadata says {told} rows, the data has {n}")
    return meta


def gaussian_series(spark: SparkSession, n: int = 10_000, seed: int = 0) -> DataFrame:
    """Independent standard normal values, from two hashes of each step."""
    value = F.sqrt(-2 * F.log(1 - uniform(seed, "id"))) * F.cos(2 * math.pi * uniform(seed + 1, "id"))
    return spark.range(n).select(F.lit("gaussian").alias("series_id"), F.col("id").alias("t"), value.alias("value"))


def pulse_series(spark: SparkSession, n: int = 20_000, interval: int = 30) -> DataFrame:
    """1 at every (interval + 1)-th step, from the first on; else 0."""
    return spark.range(n).select(F.lit("pulse").alias("series_id"), F.col("id").alias("t"), F.when(F.col("id") % (interval + 1) == 0, 1.0).otherwise(0.0).alias("value"))


def load_npy(spark: SparkSession, path: str) -> DataFrame:
    """A .npy array [time, channel] read where Spark can reach it: (series_id, t, value)."""
    import io

    import numpy as np
    import pandas as pd

    def parse(batches):
        for pdf in batches:
            for raw in pdf["content"]:
                x = np.load(io.BytesIO(raw), allow_pickle=False).reshape(len(np.load(io.BytesIO(raw), allow_pickle=False)), -1)
                t, c = np.indices(x.shape)
                yield pd.DataFrame({"series_id": c.ravel().astype(str), "t": t.ravel(), "value": x.ravel().astype(float)})

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(parse, "series_id string, t long, value double")


def load_npz(spark: SparkSession, path: str, channel: int, key: str = "data") -> DataFrame:
    """A 3-D array [time, node, feature] of an .npz file, one feature of it."""
    import io

    import numpy as np
    import pandas as pd

    def parse(batches):
        for pdf in batches:
            for raw in pdf["content"]:
                x = np.load(io.BytesIO(raw), allow_pickle=False)[key][..., channel]
                t, c = np.indices(x.shape)
                yield pd.DataFrame({"series_id": c.ravel().astype(str), "t": t.ravel(), "value": x.ravel().astype(float)})

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(parse, "series_id string, t long, value double")
