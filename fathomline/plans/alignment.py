"""Joins, label alignment, features and their selection."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from fathomline.functions import scalars as s
from fathomline.operators import align, features, grid
from fathomline.operators.grid import in_order
from fathomline.plans.base import FILLED, HOURLY, events, filled, hourly, query, rounded, table, uniform_sql

RULE_HOURS = list(range(1, 24, 2))


def labels(spark, sf):
    return events(spark, sf).where("series_id = 'error'").select("event_id", "user_id", "ts", "value")


@query("j1_asof_backward", "SELECT l.event_id, r.event_id AS base_id, r.ts AS base_ts FROM (SELECT * FROM events WHERE event_type = 'error') l ASOF JOIN (SELECT user_id, ts, max(event_id) AS event_id FROM events WHERE event_type = 'click' GROUP BY 1, 2) r ON l.user_id = r.user_id AND l.ts >= r.ts")
def j1(spark, sf):
    base = events(spark, sf).where("series_id = 'click'").groupBy("user_id", "ts").agg(F.max("event_id").alias("event_id"))
    out = align.asof_backward(labels(spark, sf), base, ["user_id"])
    return rounded(out.select("event_id", F.col("match.event_id").alias("base_id"), F.col("match.ts").alias("base_ts")))


@query("j2_left_join_on_time", "WITH" + HOURLY + " SELECT a.t, round(a.value, 6) AS click, round(b.value, 6) AS error FROM series a LEFT JOIN (SELECT * FROM series WHERE series_id = 'error' AND value IS NOT NULL) b ON a.ts = b.ts WHERE a.series_id = 'click'")
def j2(spark, sf):
    h = hourly(spark, sf)
    right = h.where("series_id = 'error' AND value IS NOT NULL").select("ts", F.col("value").alias("error"))
    return rounded(h.where("series_id = 'click'").join(right, "ts", "left").select("t", F.col("value").alias("click"), "error"))


@query("j3_join_drop_missing", "WITH" + HOURLY + " SELECT a.t, round(a.value, 6) AS click, round(b.value, 6) AS error FROM series a JOIN series b ON a.ts = b.ts WHERE a.series_id = 'click' AND b.series_id = 'error' AND b.value IS NOT NULL")
def j3(spark, sf):
    h = hourly(spark, sf)
    right = h.where("series_id = 'error' AND value IS NOT NULL").select("ts", F.col("value").alias("error"))
    return rounded(h.where("series_id = 'click'").join(right, "ts").select("t", F.col("value").alias("click"), "error"))


J5 = """
days AS (SELECT *, date_trunc('day', ts) AS d FROM events WHERE event_type = 'error'),
slots AS (SELECT event_id, user_id, ts, value, max(d + INTERVAL (o * 24 + h) HOUR) AS best FROM days, (SELECT unnest([-1, 0]) AS o), (SELECT unnest(range(1, 24, 2)) AS h) WHERE d + INTERVAL (o * 24 + h) HOUR <= ts GROUP BY ALL),
aligned AS (SELECT event_id, user_id, ts, value, CASE WHEN date_diff('microsecond', best, ts) <= 1200000000 THEN best END AS aligned_ts FROM slots)"""


@query("j5_rule_hour", "WITH" + J5 + " SELECT event_id, aligned_ts FROM aligned")
def j5(spark, sf):
    return rounded(align.to_rule_hour(labels(spark, sf), RULE_HOURS).select("event_id", "aligned_ts"))


@query("a1_mean_of_duplicate_labels", "SELECT event_type AS target_name, date_trunc('hour', ts) AS ts, round(sum(CAST(round(value * 100) AS BIGINT))::DOUBLE / (count(*) * 100), 6) AS y FROM events GROUP BY 1, 2")
def a1(spark, sf):
    rows = events(spark, sf).select(F.col("series_id").alias("target_name"), F.date_trunc("hour", "ts").alias("ts"), F.col("value").alias("y"))
    return rounded(align.mean_of_duplicates(rows, ["target_name", "ts"]))


WIDE = "melted AS (SELECT event_id, ts, CASE WHEN k = 0 THEN 'lab_value' ELSE 'lab_user' END AS target_name, CASE WHEN k = 0 THEN value ELSE CAST(user_id AS DOUBLE) END AS y FROM aligned_rows, (SELECT unnest([0, 1]) AS k))"
L10 = "WITH" + J5 + ", tall AS (SELECT aligned_ts AS ts, CASE WHEN k = 0 THEN 'lab_value' ELSE 'lab_user' END AS target_name, CASE WHEN k = 0 THEN value ELSE CAST(user_id AS DOUBLE) END AS y FROM aligned, (SELECT unnest([0, 1]) AS k) WHERE aligned_ts IS NOT NULL), long AS (SELECT target_name, ts, avg(y) AS y FROM tall GROUP BY 1, 2)"


def lab_long(spark, sf):
    wide = labels(spark, sf).select("ts", F.col("value").alias("lab_value"), F.col("user_id").cast("double").alias("lab_user"))
    return align.long_labels(wide, ["lab_value", "lab_user"], RULE_HOURS)


@query("l10_d10_label_table", L10 + " SELECT target_name, ts, round(y, 6) AS y FROM long")
def l10(spark, sf):
    return rounded(lab_long(spark, sf))


L11 = L10 + ", base AS (SELECT DISTINCT date_trunc('minute', ts) AS ts FROM events WHERE event_type = 'click'), met AS (SELECT target_name, b.ts, avg(y) AS y FROM long ASOF JOIN base b ON long.ts >= b.ts GROUP BY 1, 2)"


def base_minutes(spark, sf):
    return events(spark, sf).where("series_id = 'click'").select(F.date_trunc("minute", "ts").alias("ts")).distinct()


@query("l11_a2_attach_labels", L11 + " SELECT base.ts, target_name, round(y, 6) AS y FROM base LEFT JOIN met USING (ts)")
def l11(spark, sf):
    return rounded(align.attach_labels(base_minutes(spark, sf), lab_long(spark, sf)).select("ts", "target_name", "y"))


@query("l16_target_table", L11 + ", p AS (SELECT ts, y, row_number() OVER (ORDER BY ts) - 1 AS t, count(*) OVER () AS n FROM met WHERE target_name = 'lab_value') SELECT t, ts, round(y, 6) AS y, round((hour(ts) * 60 + minute(ts)) / 1440.0, 9) AS time_of_day, CASE WHEN t < floor(n * 0.7) THEN 'train' WHEN t < floor(n * 0.7) + floor(n * 0.1) THEN 'val' ELSE 'test' END AS split FROM p")
def l16(spark, sf):
    met = align.attach_labels(base_minutes(spark, sf), lab_long(spark, sf)).where("target_name = 'lab_value' AND y IS NOT NULL").withColumn("series_id", F.col("target_name"))
    out = grid.chronological_split(grid.positions(met), (0.7, 0.1, 0.2))
    return rounded(out.select("t", "ts", "y", s.time_of_day(F.col("ts")).alias("time_of_day"), "split"), time_of_day=9)


@query("j9_node_remap", "WITH ids AS (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey DESC) - 1 AS p FROM supplier) SELECT l_orderkey, l_linenumber, p AS node FROM lineitem JOIN ids ON l_suppkey = s_suppkey")
def j9(spark, sf):
    ids = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), (F.row_number().over(Window.orderBy(F.desc("s_suppkey"))) - 1).alias("node"))
    return table(spark, sf, "lineitem").join(ids, "l_suppkey").select("l_orderkey", "l_linenumber", F.col("node").cast("long").alias("node"))


@query("j10_membership", "SELECT event_id, event_type IN (SELECT event_type FROM events WHERE value > 300) AS listed FROM events")
def j10(spark, sf):
    e = events(spark, sf)
    named = e.where("value > 300").select("series_id").distinct().withColumn("listed", F.lit(True))
    return e.join(named, "series_id", "left").select("event_id", F.coalesce("listed", F.lit(False)).alias("listed"))


@query("j11_calendar_embedding", "SELECT event_id, CAST(floor((hour(ts) * 60 + minute(ts)) / 1440.0 * 288) AS INT) AS slot, round(sin(floor((hour(ts) * 60 + minute(ts)) / 1440.0 * 288)), 6) AS embedding FROM events")
def j11(spark, sf):
    embedding = spark.range(288).select(F.col("id").cast("int").alias("slot"), F.sin("id").alias("embedding"))
    slot = F.floor(s.time_of_day(F.col("ts")) * 288).cast("int")
    return rounded(events(spark, sf).select("event_id", slot.alias("slot")).join(embedding, "slot").select("event_id", "slot", "embedding"))


def _frames(w):
    return f"round(avg(value) OVER (PARTITION BY series_id ORDER BY t ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW), 9) AS value_ma_{w}m, round(stddev_samp(value) OVER (PARTITION BY series_id ORDER BY t ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW), 9) AS value_std_{w}m, round(max(value) OVER (PARTITION BY series_id ORDER BY t ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW), 9) AS value_max_{w}m, round(min(value) OVER (PARTITION BY series_id ORDER BY t ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW), 9) AS value_min_{w}m"


def _lags(ks):
    return ", ".join(f"round(lag(value, {k}) OVER (PARTITION BY series_id ORDER BY t), 9) AS value_lag_{k}m" for k in ks)


@query("w2_row_rolling", "WITH" + FILLED + f" SELECT series_id, t, {_frames(15)} FROM filled")
def w2(spark, sf):
    return rounded(features.feature_matrix(filled(spark, sf).select("series_id", "t", "value"), [], [15]).drop("value"), 9)


@query("w3_lags", "WITH" + HOURLY + f" SELECT series_id, t, {_lags(features.LAGS)} FROM series")
def w3(spark, sf):
    return rounded(features.feature_matrix(hourly(spark, sf).select("series_id", "t", "value"), None, []).drop("value"), 9)


@query("l12_feature_matrix", "WITH" + FILLED + f" SELECT series_id, t, round(value, 9) AS value, {_lags(features.LAGS)}, {', '.join(map(_frames, features.WINDOWS))} FROM filled")
def l12(spark, sf):
    return rounded(features.feature_matrix(filled(spark, sf).select("series_id", "t", "value")), 9)


def _selected(spark, sf):
    return table(spark, sf, "part").select(F.concat(F.lower(F.substring("p_type", 1, 6)), F.element_at(F.array(F.lit("_lag_30m"), F.lit("_ma_15m"), F.lit("")), (F.col("p_size") % 3 + 1).cast("int"))).alias("feature"), F.col("p_brand").alias("target_name"))


SELECTED = "sel AS (SELECT lower(substr(p_type, 1, 6)) || ['_lag_30m', '_ma_15m', ''][p_size % 3 + 1] AS feature, p_brand AS target_name FROM part)"


@query("l14_feature_lineage", f"WITH {SELECTED} SELECT DISTINCT feature, CASE WHEN regexp_matches(feature, '^(.+)_(lag|ma|std|max|min)_[0-9]+m$') THEN regexp_extract(feature, '^(.+)_(lag|ma|std|max|min)_[0-9]+m$', 1) ELSE feature END AS source FROM sel")
def l14(spark, sf):
    return _selected(spark, sf).select("feature").distinct().select("feature", s.feature_source(F.col("feature")).alias("source"))


@query("l15_a12_selection_summary", f"WITH {SELECTED} SELECT feature, string_agg(DISTINCT target_name, '|' ORDER BY target_name) AS targets FROM sel GROUP BY 1")
def l15(spark, sf):
    return features.summarise_selection(_selected(spark, sf))


@query("u5_raw_points", f"WITH {SELECTED} SELECT feature FROM sel UNION SELECT CASE WHEN regexp_matches(feature, '^(.+)_(lag|ma|std|max|min)_[0-9]+m$') THEN regexp_extract(feature, '^(.+)_(lag|ma|std|max|min)_[0-9]+m$', 1) ELSE feature END FROM sel")
def u5(spark, sf):
    return features.raw_points(_selected(spark, sf))


RANKED = ["value_lag_1m", "value_lag_30m", "value_ma_15m", "value_max_15m", "value_min_15m"]


@query("l13_w11_o3_rank_features", "WITH" + FILLED + f", f AS (SELECT *, {_lags([1, 30])}, {_frames(15)}, lead(value, 1) OVER (PARTITION BY series_id ORDER BY t) AS y FROM filled), c AS (" + " UNION ALL ".join(f"SELECT '{x}' AS feature, round(abs(corr({x}, y)), 5) AS importance FROM f" for x in RANKED) + ") SELECT CAST(row_number() OVER (ORDER BY importance DESC, feature) AS INT) AS rank, feature, importance FROM c QUALIFY rank <= 3")
def l13(spark, sf):
    m = features.feature_matrix(filled(spark, sf).select("series_id", "t", "value"), [1, 30], [15])
    m = m.withColumn("y", F.lead("value", 1).over(in_order()))
    return rounded(features.rank_by_correlation(m, RANKED, "y", 3), 5)


@query("l13_boosted_trees")
def l13b(spark, sf):
    from fathomline.operators.models import boosted_importance

    m = features.feature_matrix(filled(spark, sf).select("series_id", "t", "value"), [1, 30], [15]).withColumn("y", F.lead("value", 1).over(in_order()))
    return spark.createDataFrame(boosted_importance(m, RANKED, "y", 3), "feature string, importance double")


@query("u1_u2_u3_union_all", "SELECT event_id, CASE WHEN event_type = 'click' THEN 'a' ELSE 'b' END AS part FROM events UNION ALL SELECT event_id, 'c' FROM events")
def u1(spark, sf):
    e = events(spark, sf)
    parts = [e.where("series_id = 'click'").select("event_id", F.lit("a").alias("part")), e.where("series_id <> 'click'").select(F.lit("b").alias("part"), "event_id"), e.select("event_id", F.lit("c").alias("part"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("u6_columns_side_by_side", "SELECT o_orderkey, year(o_orderdate) AS y, CAST(floor(o_totalprice) AS BIGINT) % 7 AS k FROM orders")
def u6(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", F.struct(F.year("o_orderdate").cast("long").alias("y"), (F.floor("o_totalprice") % 7).alias("k")).alias("x")).select("o_orderkey", "x.*")


@query("o1_sort", "SELECT event_type AS target_name, ts, event_id FROM events ORDER BY 1, 2, 3")
def o1(spark, sf):
    return rounded(events(spark, sf).select(F.col("series_id").alias("target_name"), "ts", "event_id").orderBy("target_name", "ts", "event_id"))


@query("o7_preview", "SELECT event_id, value FROM events ORDER BY event_id DESC LIMIT 50")
def o7(spark, sf):
    from fathomline.operators.analytics import preview

    return preview(events(spark, sf).select("event_id", "value"), 50, "event_id", last=True)


@query("o8_random_sample", f"SELECT event_id FROM events ORDER BY {uniform_sql(5, 'event_id')}, event_id LIMIT 1000")
def o8(spark, sf):
    from fathomline.operators.analytics import random_sample

    return random_sample(events(spark, sf).select("event_id"), 1000, 5, "event_id")
