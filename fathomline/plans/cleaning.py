"""Sources, projections, cleaning, gaps and aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathomline.functions import scalars as s
from fathomline.operators import clean, fill, grid, scale
from fathomline.plans.base import FILLED, HOURLY, NEIGHBOURS, events, filled, hourly, query, rounded, table, uniform_sql
from fathomline.sources import readers

DIRTY = "SELECT event_id, event_type AS series_id, ts, CASE WHEN event_id % 10 = 0 THEN 0.0 ELSE value END AS value FROM events"


def dirty(spark, sf):
    return events(spark, sf).select("event_id", "series_id", "ts", F.when(F.col("event_id") % 10 == 0, 0.0).otherwise(F.col("value")).alias("value"))


@query("s2_dated_columns", """SELECT event_id, CAST(substr(CAST(ts AS VARCHAR), 1, 19) AS TIMESTAMP) AS ts, value FROM events""")
def s2(spark, sf):
    text = events(spark, sf).select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("d"), "value")
    return rounded(text.select("event_id", s.tolerant_timestamp(F.col("d"), readers.FORMATS["dash_seconds"]).alias("ts"), "value"))


@query("s3_slash_dates", "SELECT event_id, date_trunc('minute', ts) AS ts FROM events")
def s3(spark, sf):
    text = events(spark, sf).select("event_id", F.date_format("ts", "yyyy/M/d H:mm").alias("d"))
    return rounded(text.select("event_id", s.tolerant_timestamp(F.col("d"), readers.FORMATS["slash_minutes"]).alias("ts")))


@query("s9_even_subsample", "SELECT g AS place, e.event_id, e.value FROM (SELECT unnest(range(50)) AS g) JOIN events e ON e.event_id - (SELECT min(event_id) FROM events) = (g * ((SELECT count(*) FROM events) - 1)) // 49")
def s9(spark, sf):
    e = events(spark, sf)
    low = F.broadcast(e.agg(F.min("event_id").alias("low")))
    keyed = e.join(low).select((F.col("event_id") - F.col("low")).alias("seq_id"), "event_id", "value")
    return grid.even_subsample(keyed, 50).select("place", "event_id", "value")


@query("s10_labelled_text", "SELECT event_type AS label, c AS channel, list_transform(CASE WHEN c = 0 THEN [value, user_id, NULL] ELSE [user_id + 1, NULL, value] END, lambda x: CAST(x AS DOUBLE)) AS series FROM events, (SELECT unnest([0, 1])::INT AS c)")
def s10(spark, sf):
    e = events(spark, sf)
    first, second = F.concat_ws(",", F.col("value").cast("string"), F.col("user_id").cast("string"), F.lit("?")), F.concat_ws(",", (F.col("user_id") + 1).cast("string"), F.lit("?"), F.col("value").cast("string"))
    return readers.parse_labelled_sequences(e.select(F.concat_ws(":", first, second, "series_id").alias("value"))).select("label", "channel", "series")


@query("s13_json_fields", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def s13(spark, sf):
    return events(spark, sf).select("event_id", F.from_json("props", "k BIGINT")["k"].alias("k"))


@query("s16_pulse_train", "SELECT 'pulse' AS series_id, g AS t, CASE WHEN g % 31 = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS value FROM range(20000) r(g)")
def s16(spark, sf):
    return readers.pulse_series(spark)


@query("s15_gaussian_series", f"SELECT 'gaussian' AS series_id, id AS t, round(sqrt(-2 * ln(1 - {uniform_sql(0, 'id')})) * cos(2 * pi() * {uniform_sql(1, 'id')}), 9) AS value FROM (SELECT unnest(range(0, 10000)) AS id)")
def s15(spark, sf):
    return rounded(readers.gaussian_series(spark), 9)


@query("s17_split_selection", "WITH" + HOURLY + ", n AS (SELECT *, count(*) OVER (PARTITION BY series_id) AS n FROM series) SELECT series_id, t, ts, round(value, 6) AS value FROM n WHERE t >= floor(n * 0.6) + floor(n * 0.2)")
def s17(spark, sf):
    return rounded(grid.chronological_split(hourly(spark, sf), (0.6, 0.2, 0.2)).where("split = 'test'").select("series_id", "t", "ts", "value"))


@query("p1_p2_project_rename", "SELECT user_id, value AS reading, event_type AS series_id FROM events")
def p1(spark, sf):
    return events(spark, sf).withColumnRenamed("value", "reading").select("user_id", "reading", "series_id")


@query("p4_distinct_names", "SELECT o_orderpriority AS name, min(o_orderkey) AS place FROM orders GROUP BY 1")
def p4(spark, sf):
    return table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("name")).agg(F.min("o_orderkey").alias("place"))


@query("p5_tolerant_number", "SELECT event_id, TRY_CAST(CASE WHEN event_id % 7 = 0 THEN 'bad' ELSE CAST(user_id AS VARCHAR) END AS DOUBLE) AS x FROM events")
def p5(spark, sf):
    text = F.when(F.col("event_id") % 7 == 0, "bad").otherwise(F.col("user_id").cast("string"))
    return events(spark, sf).select("event_id", s.tolerant_double(text).alias("x"))


@query("p6_tolerant_timestamp", "SELECT event_id, date_trunc('second', ts) AS ts FROM events WHERE event_id % 5 <> 0")
def p6(spark, sf):
    text = F.when(F.col("event_id") % 5 == 0, "not a time").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return rounded(events(spark, sf).select("event_id", s.tolerant_timestamp(text, "yyyy-MM-dd HH:mm:ss").alias("ts")).where("ts IS NOT NULL"))


@query("p7_drop_missing_target", "WITH" + HOURLY + " SELECT series_id, t, round(value, 6) AS value FROM series WHERE value IS NOT NULL")
def p7(spark, sf):
    return rounded(hourly(spark, sf).select("series_id", "t", "value").dropna(subset=["value"]))


@query("p8_conditional_null", "SELECT event_id, CASE WHEN NOT value > 100 THEN value END AS value FROM events")
def p8(spark, sf):
    return events(spark, sf).select("event_id", F.when(~(F.col("value") > 100), F.col("value")).alias("value"))


@query("p9_numeric_columns", "SELECT p_partkey, p_size, p_retailprice FROM part")
def p9(spark, sf):
    part = table(spark, sf, "part")
    return part.select(*clean.numeric_columns(part))


@query("p10_all_null_columns", "SELECT event_id, value, props FROM events")
def p10(spark, sf):
    return clean.drop_null_columns(events(spark, sf).select("event_id", F.when(F.col("value") < 0, 1.0).alias("negative"), "value", "props"))


@query("p11_valid_ratio_filter", "WITH" + HOURLY + " SELECT series_id, round(avg(CASE WHEN value IS NULL THEN 0.0 ELSE 1.0 END), 9) AS valid_ratio FROM series GROUP BY 1 HAVING avg(CASE WHEN value IS NULL THEN 0.0 ELSE 1.0 END) >= 0.4")
def p11(spark, sf):
    return rounded(fill.valid_ratio(hourly(spark, sf)).where("valid_ratio >= 0.4"), 9)


@query("p12_target_slice", "SELECT event_type AS series_id, count(*) AS n, count(CASE WHEN value > 50 THEN value END) AS feature_n FROM events WHERE value IS NOT NULL GROUP BY 1 HAVING count(CASE WHEN value > 50 THEN value END) > 0")
def p12(spark, sf):
    e = events(spark, sf).where("value IS NOT NULL")
    return e.groupBy("series_id").agg(F.count("*").alias("n"), F.count(F.when(F.col("value") > 50, F.col("value"))).alias("feature_n")).where("feature_n > 0")


@query("p13_positional_head", "WITH" + HOURLY + " SELECT series_id, t, round(value, 6) AS value FROM series WHERE t < 240")
def p13(spark, sf):
    return rounded(grid.rows_before(hourly(spark, sf).select("series_id", "t", "value"), 240))


@query("p14_constant_scaling", "SELECT event_id, value / 10 AS value FROM events")
def p14(spark, sf):
    return events(spark, sf).select("event_id", (F.col("value") / 10).alias("value"))


@query("p15_melt", "SELECT l_orderkey, l_linenumber, u.target_name, u.y FROM (SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax FROM lineitem) UNPIVOT (y FOR target_name IN (l_quantity, l_discount, l_tax)) u WHERE y > 0")
def p15(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    return li.unpivot(["l_orderkey", "l_linenumber"], ["l_quantity", "l_discount", "l_tax"], "target_name", "y").where("y > 0")


@query("p16_p17_infinite_values", "SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE value END AS finite, CASE WHEN event_id % 4 = 0 THEN 0.0 ELSE value END AS zeroed FROM events")
def p16(spark, sf):
    x = F.when(F.col("event_id") % 8 == 0, F.lit(float("nan"))).when(F.col("event_id") % 4 == 0, F.lit(float("-inf"))).otherwise(F.col("value"))
    return events(spark, sf).select("event_id", s.finite(x).alias("finite"), s.missing_to_zero(x).alias("zeroed"))


@query("p18_fill_after_scaling", "WITH" + HOURLY + " SELECT series_id, t, round(CASE WHEN value IS NOT NULL THEN (value - 100) / 50 ELSE 0.0 END, 6) AS x FROM series")
def p18(spark, sf):
    return rounded(hourly(spark, sf).select("series_id", "t", scale.fill_masked(s.valid_mask(F.col("value")), (F.col("value") - 100) / 50).alias("x")))


@query("j6_complete_grid", "WITH" + HOURLY + " SELECT series_id, t, ts, round(value, 9) AS value FROM series")
def j6(spark, sf):
    return rounded(hourly(spark, sf), 9)


@query("j7_u4_missing_steps", "WITH" + HOURLY + " SELECT series_id, count(*) AS n FROM series WHERE value IS NULL GROUP BY 1")
def j7(spark, sf):
    present = events(spark, sf).select("series_id", F.date_trunc("hour", "ts").alias("ts")).distinct()
    return grid.missing_steps(present).groupBy("series_id").agg(F.count("*").alias("n"))


@query("a3_keep_first", "SELECT user_id, event_type AS series_id, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1")
def a3(spark, sf):
    return clean.keep_first(events(spark, sf).select("user_id", "series_id", "event_id", "value"), ["user_id", "series_id"], "event_id")


@query("a4_quantiles", "SELECT event_type AS series_id, round(quantile_cont(value, 0.001), 6) AS q001, round(quantile_cont(value, 0.25), 6) AS q25, round(quantile_cont(value, 0.75), 6) AS q75, round(quantile_cont(value, 0.999), 6) AS q999 FROM events GROUP BY 1")
def a4(spark, sf):
    q = events(spark, sf).groupBy("series_id").agg(F.percentile("value", F.array(*(F.lit(x) for x in (0.001, 0.25, 0.75, 0.999)))).alias("q"))
    return rounded(q.select("series_id", *(F.col("q")[i].alias(n) for i, n in enumerate(("q001", "q25", "q75", "q999")))))


@query("a5_median", "SELECT event_type AS series_id, round(median(value), 6) AS mid FROM events GROUP BY 1")
def a5(spark, sf):
    return rounded(events(spark, sf).groupBy("series_id").agg(F.median("value").alias("mid")))


GAPS = """, m AS (SELECT *, CASE WHEN (value IS NULL) = lag(value IS NULL) OVER (PARTITION BY series_id ORDER BY t) THEN 0 ELSE 1 END AS turn FROM series),
r AS (SELECT *, sum(turn) OVER (PARTITION BY series_id ORDER BY t) AS run FROM m), g AS (SELECT series_id, run, count(*) AS n, count(value) AS v FROM r GROUP BY 1, 2)"""


@query("a6_gap_statistics", "WITH" + HOURLY + GAPS + " SELECT series_id, CAST(sum(CASE WHEN v = 0 THEN n ELSE 0 END) AS BIGINT) AS na_count, round(sum(CASE WHEN v = 0 THEN n ELSE 0 END) / sum(n), 6) AS na_ratio, count(*) FILTER (v = 0) AS gap_count, coalesce(max(n) FILTER (v = 0), 0) AS max_gap, count(*) FILTER (v = 0 AND n > 2) AS long_gap_count FROM g GROUP BY 1")
def a6(spark, sf):
    return fill.gap_stats(hourly(spark, sf), 2)


@query("a7_step_mode", "WITH" + HOURLY + ", d AS (SELECT series_id, date_diff('minute', lag(ts) OVER (PARTITION BY series_id ORDER BY ts), ts) AS m FROM obs), c AS (SELECT series_id, m, count(*) AS n FROM d WHERE m > 0 GROUP BY 1, 2) SELECT series_id, CAST(arg_min(m, (-n, m)) AS BIGINT) AS step_minutes, count(*) = 1 AS regular FROM c GROUP BY 1")
def a7(spark, sf):
    return grid.step_minutes(events(spark, sf).select("series_id", F.date_trunc("hour", "ts").alias("ts")).distinct())


@query("a15_distinct_sorted", "SELECT DISTINCT event_type AS name FROM events ORDER BY 1")
def a15(spark, sf):
    return events(spark, sf).select(F.col("series_id").alias("name")).distinct().orderBy("name")


@query("a16_extent", "SELECT min(ts) AS first_ts, max(ts) AS last_ts FROM events")
def a16(spark, sf):
    return rounded(grid.extent(events(spark, sf)))


@query("a20_null_totals", "WITH" + HOURLY + " SELECT count(*) AS cells, count(*) FILTER (value IS NULL) AS missing FROM series")
def a20(spark, sf):
    return hourly(spark, sf).agg(F.count("*").alias("cells"), F.count_if(F.col("value").isNull()).alias("missing"))


ROLL = """SELECT *, count(nz) OVER w AS w_n, avg(nz) OVER w AS w_mean, stddev_samp(nz) OVER w AS w_std FROM (SELECT event_id, series_id, ts, nullif(value, 0.0) AS nz FROM ({0}))
WINDOW w AS (PARTITION BY series_id ORDER BY ts RANGE BETWEEN INTERVAL '23:59:59.999999' PRECEDING AND CURRENT ROW)"""


@query("w1_time_rolling", f"SELECT event_id, w_n, round(w_mean, 9) AS w_mean, round(CASE WHEN w_n >= 5 THEN w_std END, 9) AS w_std FROM ({ROLL.format(DIRTY)})")
def w1(spark, sf):
    out = clean.rolling_stats(clean.zero_to_null(dirty(spark, sf)))
    return rounded(out.select("event_id", "w_n", "w_mean", F.when(F.col("w_n") >= 5, F.col("w_std")).alias("w_std")), 9)


@query("l1_zero_to_null", f"SELECT event_id, nullif(value, 0.0) AS value FROM ({DIRTY})")
def l1(spark, sf):
    return clean.zero_to_null(dirty(spark, sf)).select("event_id", "value")


L2 = f"SELECT event_id, series_id, CASE WHEN w_n >= 5 AND abs(nz - w_mean) > 3 * w_std THEN NULL ELSE nz END AS value FROM ({ROLL.format(DIRTY)})"


@query("l2_rolling_outliers", f"SELECT event_id, value FROM ({L2})")
def l2(spark, sf):
    return clean.drop_rolling_outliers(clean.zero_to_null(dirty(spark, sf))).select("event_id", "value")


L3 = "SELECT event_id, series_id, CASE WHEN q3 - q1 > 0 AND (value < q1 - 2.5 * (q3 - q1) OR value > q3 + 2.5 * (q3 - q1)) THEN NULL ELSE value END AS value FROM ({0}) JOIN (SELECT series_id, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM ({0}) GROUP BY 1) USING (series_id)"


@query("l3_iqr_outliers", f"SELECT event_id, value FROM ({L3.format(DIRTY)})")
def l3(spark, sf):
    return clean.drop_iqr_outliers(dirty(spark, sf)).select("event_id", "value")


@query("l4_median_clip", f"WITH d AS ({DIRTY}) SELECT event_id, CASE WHEN n >= 10 AND mid <> 0 AND abs(value - mid) > abs(mid) * 0.5 THEN NULL ELSE value END AS value FROM d JOIN (SELECT series_id, median(value) AS mid, count(value) AS n FROM d GROUP BY 1) USING (series_id)")
def l4(spark, sf):
    return clean.drop_far_from_median(dirty(spark, sf)).select("event_id", "value")


L5 = "SELECT event_id, series_id, CASE WHEN n >= 10 AND (value < lo OR value > hi) THEN NULL ELSE value END AS value FROM ({0}) JOIN (SELECT series_id, quantile_cont(value, 0.001) AS lo, quantile_cont(value, 0.999) AS hi, count(value) AS n FROM ({0}) GROUP BY 1) USING (series_id)"


@query("l5_quantile_clip", f"SELECT event_id, value FROM ({L5.format(DIRTY)})")
def l5(spark, sf):
    return clean.drop_extreme_quantiles(dirty(spark, sf)).select("event_id", "value")


@query("l6_cleaning_chain", f"WITH a AS ({L2}), b AS ({L3.format('SELECT * FROM a')}), c AS ({L5.format('SELECT * FROM b')}) SELECT event_id, value FROM c")
def l6(spark, sf):
    return clean.clean(dirty(spark, sf)).select("event_id", "value")


@query("l7_floor_to_minute", "SELECT event_type AS series_id, date_trunc('minute', ts) AS ts, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY event_type, date_trunc('minute', ts) ORDER BY event_id) = 1")
def l7(spark, sf):
    return rounded(clean.floor_to_minute(events(spark, sf).select("series_id", "ts", "event_id", "value"), "event_id"), 12)


@query("w4_gap_runs", "WITH" + HOURLY + GAPS + " SELECT series_id, t, CAST(run AS BIGINT) AS run_id, count(*) OVER (PARTITION BY series_id, run) AS run_length FROM r")
def w4(spark, sf):
    return fill.runs(hourly(spark, sf)).select("series_id", "t", F.col("run_id").cast("long").alias("run_id"), "run_length")


@query("w5_interpolate_inside", "WITH" + HOURLY + "," + NEIGHBOURS + " SELECT series_id, t, round(CASE WHEN value IS NOT NULL THEN value ELSE pv + (nv - pv) * (t - pt) / (nt - pt) END, 9) AS value FROM near")
def w5(spark, sf):
    return rounded(fill.interpolate(hourly(spark, sf)).select("series_id", "t", "value"), 9)


@query("w6_interpolate_edges", "WITH" + FILLED + " SELECT series_id, t, round(value, 9) AS value FROM filled")
def w6(spark, sf):
    return rounded(filled(spark, sf).select("series_id", "t", "value"), 9)


@query("w7_time_difference", "SELECT event_id, date_diff('microsecond', lag(ts) OVER (PARTITION BY event_type ORDER BY ts, event_id), ts) AS micros FROM events")
def w7(spark, sf):
    e = events(spark, sf).withColumn("u", s.micros(F.col("ts")))
    return e.select("event_id", (F.col("u") - F.lag("u").over(grid.in_order("ts", "event_id"))).alias("micros"))


L8 = NEIGHBOURS.replace("FROM series", "FROM runs") + ", filled AS (SELECT series_id, t, CASE WHEN value IS NOT NULL THEN value WHEN run_length <= 2 THEN pv + (nv - pv) * (t - pt) / (nt - pt) END AS value FROM near)"
RUNS = GAPS + ", runs AS (SELECT series_id, t, ts, value, count(*) OVER (PARTITION BY series_id, run) AS run_length FROM r)"


@query("l8_short_gaps", "WITH" + HOURLY + RUNS + "," + L8 + " SELECT series_id, t, round(value, 9) AS value FROM filled")
def l8(spark, sf):
    return rounded(fill.interpolate_short_gaps(hourly(spark, sf), 2).select("series_id", "t", "value"), 9)


STATS = "SELECT series_id, CAST(sum(CASE WHEN v = 0 THEN n ELSE 0 END) AS BIGINT) AS na_count, round(sum(CASE WHEN v = 0 THEN n ELSE 0 END) / sum(n), 6) AS na_ratio, count(*) FILTER (v = 0) AS gap_count, coalesce(max(n) FILTER (v = 0), 0) AS max_gap, count(*) FILTER (v = 0 AND n > 2) AS long_gap_count FROM {0} GROUP BY 1"
AFTER = GAPS.replace("FROM series", "FROM kept").replace("m AS", "m2 AS").replace("r AS", "r2 AS").replace("FROM m)", "FROM m2)").replace("g AS", "g2 AS").replace("FROM r ", "FROM r2 ")


@query(
    "l9_u1_o2_interpolation_report",
    "WITH" + HOURLY + RUNS + "," + L8 + ", ok AS (SELECT series_id, avg(CASE WHEN value IS NULL THEN 0.0 ELSE 1.0 END) AS vr FROM series GROUP BY 1), kept AS (SELECT f.* FROM filled f JOIN ok USING (series_id) WHERE vr >= 0.4)" + AFTER
    + f", before AS ({STATS.format('g')}), after AS ({STATS.format('g2')}) SELECT b.series_id, round(vr, 6) AS valid_ratio, b.na_count AS na_count_before, b.na_ratio AS na_ratio_before, b.gap_count AS gap_count_before, b.max_gap AS max_gap_before, b.long_gap_count AS long_gap_count_before, "
    "coalesce(a.na_count, b.na_count) AS na_count_after, coalesce(a.na_ratio, b.na_ratio) AS na_ratio_after, coalesce(a.gap_count, b.gap_count) AS gap_count_after, coalesce(a.max_gap, b.max_gap) AS max_gap_after, coalesce(a.long_gap_count, b.long_gap_count) AS long_gap_count_after, "
    "a.series_id IS NOT NULL AS processed, b.na_count - coalesce(a.na_count, b.na_count) AS filled_count FROM before b JOIN ok USING (series_id) LEFT JOIN after a ON a.series_id = b.series_id",
)
def l9(spark, sf):
    return fill.interpolation_report(hourly(spark, sf), 0.4, 2).orderBy(F.desc("na_ratio_before"), F.desc("max_gap_before"), "series_id")


@query("n1_n4_calendar", "SELECT event_id, round((hour(ts) * 60 + minute(ts)) / 1440.0, 9) AS time_of_day, round((epoch_us(ts) % 86400000000) / 86400000000.0, 9) AS by_remainder, round((isodow(ts) - 1) / 7.0, 9) AS day_of_week, round((day(ts) - 1) / 31.0, 9) AS day_of_month, round((dayofyear(ts) - 1) / 366.0, 9) AS day_of_year FROM events")
def n1(spark, sf):
    ts = F.col("ts")
    e = events(spark, sf)
    return rounded(e.select("event_id", s.time_of_day(ts).alias("time_of_day"), s.time_of_day_by_remainder(ts).alias("by_remainder"), s.day_of_week(ts).alias("day_of_week"), s.day_of_month(ts).alias("day_of_month"), s.day_of_year(ts).alias("day_of_year")), 9)


@query("n1b_n2_positional_calendar", "WITH" + HOURLY + " SELECT series_id, t, round((t % 24) / 24.0, 9) AS time_of_day, round(((t // 24) % 7) / 7.0, 9) AS day_of_week FROM series")
def n1b(spark, sf):
    return rounded(hourly(spark, sf).select("series_id", "t", s.time_of_day_by_position(F.col("t"), 24).alias("time_of_day"), s.day_of_week_by_position(F.col("t"), 24).alias("day_of_week")), 9)


@query("string_functions", "SELECT event_id, lpad(CAST(event_id AS VARCHAR), 8, '0') AS padded, trim('  ' || event_type || ' ') AS trimmed, strftime(ts, '%Y-%m-%d %H:%M:%S') AS text FROM events")
def strings(spark, sf):
    return events(spark, sf).select("event_id", F.lpad(F.col("event_id").cast("string"), 8, "0").alias("padded"), F.trim(F.concat(F.lit("  "), "series_id", F.lit(" "))).alias("trimmed"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("text"))


@query("config_identity", "SELECT event_id, md5(props) AS identity FROM events")
def config(spark, sf):
    return events(spark, sf).select("event_id", s.config_identity(F.col("props")).alias("identity"))


@query("f24_activations", "SELECT event_id, round(greatest(x, 0.0), 6) AS relu, round(1 / (1 + exp(-x)), 6) AS sigmoid, round(tanh(x), 6) AS tanh, round(x / (1 + exp(-x)), 6) AS silu, round(CASE WHEN x > 0 THEN x ELSE exp(x) - 1 END, 6) AS elu, round(0.5 * x * (1 + tanh(0.7978845608028654 * (x + 0.044715 * x * x * x))), 6) AS gelu FROM (SELECT event_id, (value - 50) / 25 AS x FROM events)")
def f24(spark, sf):
    x = (F.col("value") - 50) / 25
    return rounded(events(spark, sf).select("event_id", *(s.activation(n, x).alias(n) for n in ("relu", "sigmoid", "tanh", "silu", "elu", "gelu"))))


@query("f30_chebyshev_basis", "SELECT event_id, k, round(cos(k * acos(tanh(tanh((value - 50) / 25)))), 6) AS basis FROM events, (SELECT unnest(range(4))::INT AS k)")
def f30(spark, sf):
    rows = events(spark, sf).select("event_id", ((F.col("value") - 50) / 25).alias("x"), F.explode(F.sequence(F.lit(0), F.lit(3))).alias("k"))
    return rounded(rows.select("event_id", "k", s.chebyshev(F.col("x"), F.col("k")).alias("basis")))


@query("f18_position_table", "SELECT p AS position, f AS feature, round(CASE WHEN f % 2 = 0 THEN sin(p * exp(-ln(10000.0) * (f - f % 2) / 16)) ELSE cos(p * exp(-ln(10000.0) * (f - f % 2) / 16)) END, 6) AS value FROM range(64) a(p), range(16) b(f)")
def f18(spark, sf):
    cells = spark.range(64).select(F.col("id").alias("position"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(15).cast("long"))).alias("feature"))
    return rounded(cells.select("position", "feature", s.position_encoding(F.col("position"), F.col("feature"), 16).alias("value")))
