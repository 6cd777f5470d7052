"""Sources and sinks, written to and read from the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathomline.operators import fill, metrics
from fathomline.plans.base import FILLED, SQL, events, hourly, query, rounded, table
from fathomline.plans.evaluation import ROWS, forecasts
from fathomline.plans.samples import SPLIT, split
from fathomline.sources import readers, sinks
from fathomline.sources.scratch import scratch


@query("s1_k1_csv", "SELECT event_id, event_type AS series_id, value FROM events")
def csv(spark, sf):
    sinks.write_csv(events(spark, sf).select("event_id", "series_id", "value"), path := scratch(spark, "csv"))
    return readers.read_csv(spark, path, "event_id long, series_id string, value double")


@query("s2_dated_csv", "SELECT strftime(ts, '%Y-%m-%d %H:%M') AS minute, l_quantity AS value, 'quantity' AS series_id FROM (SELECT l_shipdate AS ts, l_quantity FROM lineitem)")
def dated(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("date"), F.col("l_quantity").alias("quantity"))
    sinks.write_csv(rows, path := scratch(spark, "dated"))
    return readers.read_dated_csv(spark, path).select(F.date_format("ts", "yyyy-MM-dd HH:mm").alias("minute"), "value", "series_id")


@query("s11_distance_lines", "SELECT n_nationkey AS src, n_regionkey AS dst, n_nationkey * 1.5::DOUBLE AS weight FROM nation")
def distances(spark, sf):
    good = table(spark, sf, "nation").select(F.concat_ws(",", "n_nationkey", "n_regionkey", (F.col("n_nationkey") * 1.5).cast("string")).alias("value"))
    bad = spark.createDataFrame([("from,to,distance",), ("1,2",), ("1,2,3,4",), ("",)], "value string")
    good.unionByName(bad).write.text(path := scratch(spark, "distances"))
    return readers.read_distances(spark, path)


@query("s14_inline_rows", "SELECT strptime(a, '%Y-%m-%d %H:%M:%S') AS ts, b AS series_id, c::DOUBLE AS value FROM (VALUES ('2024-01-01 00:00:00', 'c1', 1.5), ('2024-01-01 00:00:00', 'c2', NULL), ('2024-01-01 01:00:00', 'c1', 2.5), ('2024-01-01 01:00:00', 'c2', 4.0)) x(a, b, c)")
def inline(spark, sf):
    return rounded(readers.inline_rows(spark, [["2024-01-01 00:00:00", 1.5, None], ["2024-01-01 01:00:00", 2.5, 4]]))


@query("k2_split_files", "WITH" + FILLED + SPLIT.format("filled") + " SELECT series_id, t, round(value, 6) AS value, split FROM parts WHERE split = 'val'")
def split_files(spark, sf):
    sinks.write_splits(split(spark, sf).select("series_id", "t", "value", "split"), path := scratch(spark, "splits"))
    return rounded(readers.read_arrays(spark, path, "val"))


@query("k3_metadata", "WITH" + FILLED + " SELECT 'hourly' AS name, 60::BIGINT AS frequency_minutes, count(DISTINCT t) AS num_time_steps, count(DISTINCT series_id) AS num_vars FROM filled")
def meta(spark, sf):
    sinks.write_metadata(sinks.metadata(hourly(spark, sf), "hourly", 60, [0.6, 0.2, 0.2], None), path := scratch(spark, "meta"))
    return readers.read_metadata(spark, path).select("name", "frequency_minutes", "num_time_steps", "num_vars")


@query("k4_report_csv", SQL["l9_u1_o2_interpolation_report"])
def report(spark, sf):
    out = fill.interpolation_report(hourly(spark, sf), 0.4, 2)
    sinks.write_csv(out, path := scratch(spark, "report"))
    return readers.read_csv(spark, path, ", ".join(f"`{c}` {kind}" for c, kind in out.dtypes))


@query("k5_result_rows", "WITH" + FILLED + ROWS + " SELECT series_id, sample_id, CAST(h AS BIGINT) AS h, round(y_true, 6) AS y_true, round(y_pred, 6) AS y_pred FROM f WHERE y_pred IS NOT NULL")
def results(spark, sf):
    sinks.write_results(forecasts(spark, sf).select("series_id", "sample_id", F.col("h").cast("long").alias("h"), "y_true", "y_pred"), path := scratch(spark, "results"))
    return rounded(spark.read.parquet(path))


@query("k6_metrics_json", "WITH" + FILLED + ROWS + ", c AS (SELECT series_id, CAST(sum(m) AS BIGINT) AS n FROM rows_ GROUP BY 1) SELECT '{' || string_agg('\"' || series_id || '\":{\"cells\":' || n || '}', ',' ORDER BY series_id) || '}' AS metrics FROM c")
def metrics_file(spark, sf):
    counted = metrics.cell_metrics(forecasts(spark, sf), ["series_id"]).select("series_id", F.col("weight").cast("long").alias("cells"))
    return sinks.metrics_json(counted, "series_id")


@query("k7_s12_graph_tables", "SELECT n_nationkey AS src, n_regionkey AS dst, 1.0::DOUBLE AS weight FROM nation")
def graph_tables(spark, sf):
    edges = table(spark, sf, "nation").select(F.col("n_nationkey").alias("src"), F.col("n_regionkey").alias("dst"), (F.col("n_nationkey") * 2.5).alias("weight"))
    sinks.write_graph(edges, path := scratch(spark, "graph"))
    return readers.read_graph(spark, path, "connectivity")


@query("k8_merged_shards", "SELECT event_id, value FROM events")
def shards(spark, sf):
    rows, paths = events(spark, sf).select("event_id", "value"), [scratch(spark, f"shard{k}") for k in range(3)]
    for k, path in enumerate(paths):
        rows.where(F.col("event_id") % 3 == k).write.parquet(path)
    sinks.merge_shards(spark, paths, out := scratch(spark, "merged"), 2)
    return spark.read.parquet(out)
