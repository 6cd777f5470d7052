"""Sample construction, scalers, norms and masks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from fathomline.functions import scalars as s
from fathomline.operators import grid, models, scale, windows
from fathomline.plans.base import FILLED, HOURLY, events, filled, hourly, query, rounded, table, uniform_sql

SPLIT = ", n AS (SELECT *, count(*) OVER (PARTITION BY series_id) AS n FROM {0}), parts AS (SELECT series_id, t, ts, value, CASE WHEN t < floor(n * 0.6) THEN 'train' WHEN t < floor(n * 0.6) + floor(n * 0.2) THEN 'val' ELSE 'test' END AS split FROM n)"
WINDOWS = ", w AS (SELECT series_id, t AS sample_id, list(value) OVER f AS v FROM filled WINDOW f AS (PARTITION BY series_id ORDER BY t ROWS BETWEEN CURRENT ROW AND {0} FOLLOWING))"


def arrays(df, *names, digits=6):
    """Arrays of doubles rounded as in DuckDB: the product with a power of ten, half away from zero, in doubles and not by
    decimal digits; what rounds to zero keeps its sign, as the text of an array shows it."""
    unit = float(10**digits)
    return df.select(*(F.transform(c, lambda x: F.round(F.abs(x) * unit) / unit * F.signum(x)).alias(c) if c in names else F.col(c) for c in df.columns))


def split(spark, sf, full=True):
    return grid.chronological_split((filled if full else hourly)(spark, sf), (0.6, 0.2, 0.2))


def _rounded_list(e):
    return f"list_transform({e}, lambda x: round(x, 6))"


@query("x1_w9_forecast_windows", "WITH" + FILLED + WINDOWS.format(11) + f" SELECT series_id, sample_id, {_rounded_list('v[1:8]')} AS inputs, {_rounded_list('v[9:12]')} AS targets FROM w WHERE len(v) = 12")
def x1(spark, sf):
    return arrays(windows.forecast_windows(filled(spark, sf), 8, 4), "inputs", "targets")


@query("x2_imputation_windows", "WITH" + FILLED + WINDOWS.format(7) + f" SELECT series_id, sample_id, {_rounded_list('v')} AS inputs FROM w WHERE len(v) = 8")
def x2(spark, sf):
    return arrays(windows.imputation_windows(filled(spark, sf), 8), "inputs")


@query("x3_tabular_rows", "SELECT p_partkey AS sample_id, [CAST(p_size AS DOUBLE)] AS inputs, [p_retailprice] AS targets FROM part")
def x3(spark, sf):
    return table(spark, sf, "part").select(F.col("p_partkey").alias("sample_id"), F.array(F.col("p_size").cast("double")).alias("inputs"), F.array("p_retailprice").alias("targets"))


SEQ = "seqs AS (SELECT user_id, list(value ORDER BY ts, event_id) AS seq FROM events GROUP BY 1)"


def sequences(spark, sf):
    ordered = F.array_sort(F.collect_list(F.struct("ts", "event_id", "value")))
    return events(spark, sf).groupBy("user_id").agg(F.transform(ordered, lambda x: x["value"]).alias("seq"))


@query("x4_labelled_sequences", "SELECT event_type AS label, user_id, list(value ORDER BY ts, event_id) AS series FROM events GROUP BY 1, 2")
def x4(spark, sf):
    ordered = F.array_sort(F.collect_list(F.struct("ts", "event_id", "value")))
    return events(spark, sf).groupBy(F.col("series_id").alias("label"), "user_id").agg(F.transform(ordered, lambda x: x["value"]).alias("series"))


@query("a11_sequence_statistics", "SELECT event_type AS channel, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std FROM events WHERE value < 400 GROUP BY 1")
def a11(spark, sf):
    ordered = F.array_sort(F.collect_list(F.struct("ts", "event_id", "value")))
    gaps = F.transform(ordered, lambda x: F.when(x["value"] < 400, x["value"]).otherwise(F.lit(float("nan"))))
    return rounded(scale.fit_sequences(events(spark, sf).groupBy(F.col("series_id").alias("channel"), "user_id").agg(gaps.alias("series"))))


@query("x5_chronological_split", "WITH" + HOURLY + SPLIT.format("series") + " SELECT series_id, t, split FROM parts")
def x5(spark, sf):
    return split(spark, sf, False).select("series_id", "t", "split")


@query("x6_w8_normalised_split", "WITH" + HOURLY + " SELECT series_id, t, CASE WHEN t < floor(n * (7 / 10.0)) THEN 'train' WHEN t < floor(n * (7 / 10.0)) + floor(n * (1 / 10.0)) THEN 'val' ELSE 'test' END AS split FROM (SELECT *, count(*) OVER (PARTITION BY series_id) AS n FROM series)")
def x6(spark, sf):
    return grid.chronological_split(hourly(spark, sf), (7, 1, 2), normalise=True).select("series_id", "t", "split")


@query("x7_corpus_filter", f"WITH {SEQ}, g AS (SELECT user_id, list_transform(seq, lambda x: CASE WHEN x < 20 THEN NULL ELSE x END) AS seq FROM seqs), e AS (SELECT user_id, seq, list_max(list_transform(range(1, len(seq) + 1), lambda i: CASE WHEN seq[i] IS NULL THEN 0 ELSE i END)) AS valid_end FROM g) SELECT user_id, CAST(valid_end AS INT) AS valid_end FROM e WHERE valid_end >= 4 AND list_count(seq) / valid_end >= 0.5")
def x7(spark, sf):
    gaps = sequences(spark, sf).withColumn("seq", F.transform("seq", lambda x: F.when(x >= 20, x)))
    return windows.corpus_rows(gaps, 4, 4).select("user_id", "valid_end")


MIX = f""", n AS (SELECT count(*) AS n FROM seqs), dealt AS (SELECT user_id, seq, CAST(floor({uniform_sql(11, 'user_id')} * greatest(n // 2, 1)) AS BIGINT) AS g, {uniform_sql(12, 'user_id')} AS o,
  -ln(1 - {uniform_sql(13, 'user_id')}) - ln(1 - {uniform_sql(14, 'user_id')}) * cos(2 * pi() * {uniform_sql(15, 'user_id')}) ** 2 AS w FROM seqs, n),
few AS (SELECT * FROM dealt QUALIFY row_number() OVER (PARTITION BY g ORDER BY o, user_id) <= 3),
normed AS (SELECT g, w, seq, list_avg(seq) AS m, CASE WHEN list_stddev_pop(seq) < 1e-8 THEN 1.0 ELSE list_stddev_pop(seq) END AS s FROM few),
cells AS (SELECT g, w, i, (seq[i] - m) / s AS x FROM normed, (SELECT unnest(range(1, 5)) AS i) WHERE i <= len(seq))
SELECT mixture, list(round(x, 5) ORDER BY i) AS seq FROM (SELECT g AS mixture, i, sum(w * x) / sum(w) AS x FROM cells GROUP BY 1, 2) GROUP BY 1"""


@query("x8_mixup", f"WITH {SEQ}" + MIX)
def x8(spark, sf):
    return arrays(windows.mixup(sequences(spark, sf), 3, 1.5, 11, 4, "user_id"), "seq", digits=5)


@query("x9_random_crop", f"WITH {SEQ} SELECT user_id, list_transform(range(p, p + 4), lambda i: seq[i]) AS seq FROM (SELECT user_id, seq, CAST(floor({uniform_sql(3, 'user_id')} * (len(seq) - 4 + 1)) AS BIGINT) + 1 AS p FROM seqs WHERE len(seq) >= 4)")
def x9(spark, sf):
    return windows.random_crop(windows.corpus_rows(sequences(spark, sf), 4, 4), 4, 3, "user_id").select("user_id", "seq")


@query("x10_x11_sample_norm_and_anomalies", f"WITH {SEQ}, z AS (SELECT user_id, seq, list_avg(seq) AS m, list_stddev_pop(seq) AS s FROM seqs) SELECT user_id, list_transform(seq, lambda x: round(CASE WHEN abs((x - m) / (CASE WHEN s < 1e-3 THEN 1 ELSE s END)) <= 1.5 THEN (x - m) / (CASE WHEN s < 1e-3 THEN 1 ELSE s END) END, 5)) AS seq FROM z")
def x10(spark, sf):
    return arrays(sequences(spark, sf).select("user_id", windows.mask_anomalies(windows.z_norm(F.col("seq")), 1.5).alias("seq")), "seq", digits=5)


@query("x12_autoregressive_shift", f"WITH {SEQ} SELECT user_id, seq[1:len(seq) - 1] AS inputs, seq[2:] AS targets FROM seqs")
def x12(spark, sf):
    return windows.shifted(sequences(spark, sf)).select("user_id", "inputs", "targets")


@query("x13_pad_or_cut", f"WITH {SEQ} SELECT user_id, list_transform(range(1, 9), lambda i: seq[i]) AS seq FROM seqs")
def x13(spark, sf):
    return sequences(spark, sf).select("user_id", windows.pad_to(F.col("seq"), 8).alias("seq"))


@query("x14_label_codes", "SELECT event_id, CAST(dense_rank() OVER (ORDER BY event_type) - 1 AS INT) AS label_code FROM events")
def x14(spark, sf):
    return windows.encode_labels(events(spark, sf), "series_id").select("event_id", "label_code")


@query("x15_batches", "WITH" + FILLED + " SELECT series_id, t AS sample_id, t // 64 AS batch_id FROM filled")
def x15(spark, sf):
    return grid.batches(filled(spark, sf).select("series_id", F.col("t").alias("sample_id")), 64)


@query("x17_curriculum", "WITH" + FILLED + ", c AS (SELECT series_id, t, h FROM filled, range(12) r(h)) SELECT series_id, t, h FROM c WHERE h < least(((5 - 1 - 1) // 2 + 1) * 3, 12)")
def x17(spark, sf):
    from fathomline.plans.evaluation import curriculum_length

    cells = filled(spark, sf).select("series_id", "t", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(11).cast("long"))).alias("h"))
    return cells.where(F.col("h") < curriculum_length(5, 1, 2, 3, 12))


ZFIT = ", st AS (SELECT series_id, avg(value) AS m, CASE WHEN stddev_pop(value) = 0 THEN 1 ELSE stddev_pop(value) END AS s FROM parts WHERE split = 'train' GROUP BY 1)"


@query("c1_a8_z_fit", "WITH" + FILLED + SPLIT.format("filled") + ZFIT + " SELECT series_id, round(m, 6) AS mean, round(s, 6) AS std FROM st")
def c1(spark, sf):
    return rounded(scale.fit_z(split(spark, sf)))


@query("c1_global_z_fit", "WITH" + FILLED + SPLIT.format("filled") + " SELECT round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std FROM parts WHERE split = 'train'")
def c1g(spark, sf):
    return rounded(scale.fit_z(split(spark, sf), per_channel=False))


@query("c2_z_transform_and_inverse", "WITH" + HOURLY + SPLIT.format("series") + ZFIT + " SELECT series_id, t, round(CASE WHEN value > 40 THEN (value - m) / s ELSE value END, 6) AS scaled, round(value, 6) AS restored FROM parts JOIN st USING (series_id) WHERE value > 40")
def c2(spark, sf):
    rows = split(spark, sf, False)
    stats = scale.fit_z(rows)
    out = scale.inverse(scale.transform(rows, stats, F.col("value") > 40), stats)
    return rounded(out.where("value > 40").select("series_id", "t", "scaled", "restored"))


@query("c3_a9_min_max", "WITH" + FILLED + SPLIT.format("filled") + ", st AS (SELECT series_id, min(value) AS m, max(value) - min(value) AS s FROM parts WHERE split = 'train' GROUP BY 1) SELECT series_id, t, round((value - m) / s, 6) AS scaled FROM parts JOIN st USING (series_id)")
def c3(spark, sf):
    rows = split(spark, sf)
    return rounded(scale.transform(rows, scale.fit_min_max(rows)).select("series_id", "t", "scaled"))


BAD = ", bad AS (SELECT series_id, t, ts, CASE WHEN t % 17 = 0 THEN NULL ELSE value END AS value FROM filled)"


def with_bad(spark, sf):
    return grid.chronological_split(filled(spark, sf).withColumn("value", F.when(F.col("t") % 34 == 0, F.lit(float("nan"))).when(F.col("t") % 17 == 0, F.lit(float("inf"))).otherwise(F.col("value"))), (0.6, 0.2, 0.2))


@query("c4_a10_z_finite_only", "WITH" + FILLED + BAD + SPLIT.format("bad") + ZFIT + " SELECT series_id, t, round(coalesce((value - m) / s, 0.0), 6) AS scaled FROM parts JOIN st USING (series_id)")
def c4(spark, sf):
    rows = with_bad(spark, sf)
    return rounded(scale.transform(rows, scale.fit_z_safe(rows), safe=True).select("series_id", "t", "scaled"))


@query("c5_min_max_finite_only", "WITH" + FILLED + BAD + SPLIT.format("bad") + ", st AS (SELECT series_id, min(value) AS m, max(value) - min(value) AS s FROM parts WHERE split = 'train' GROUP BY 1) SELECT series_id, t, round(coalesce((value - m) / s, 0.0), 6) AS scaled FROM parts JOIN st USING (series_id)")
def c5(spark, sf):
    rows = with_bad(spark, sf)
    return rounded(scale.transform(rows, scale.fit_min_max_safe(rows), safe=True).select("series_id", "t", "scaled"))


@query("c7_null_value_mask", "SELECT event_id, abs(v - 0.0) > 5e-5 AS zero_mask, v IS NOT NULL AS nan_mask FROM (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 0.0 WHEN event_id % 3 = 1 THEN 4e-5 ELSE value + 1 END AS v FROM events)")
def c7(spark, sf):
    v = F.when(F.col("event_id") % 3 == 0, 0.0).when(F.col("event_id") % 3 == 1, 4e-5).otherwise(F.col("value") + 1)
    return events(spark, sf).select("event_id", s.valid_mask(v, 0.0).alias("zero_mask"), s.valid_mask(v).alias("nan_mask"))


@query("c8_reconstruction_mask", "WITH" + HOURLY + " SELECT series_id, t, (t * 7919 + ascii(series_id) * 104729) % 100 >= 25 AS visible FROM series")
def c8(spark, sf):
    return hourly(spark, sf).select("series_id", "t", s.reconstruction_mask(F.col("t"), F.ascii("series_id"), 25).alias("visible"))


@query("c8_random_mask", "WITH" + HOURLY + f" SELECT series_id, t, {uniform_sql(3, 'series_id', 't')} > 0.25 AS visible FROM series")
def c8r(spark, sf):
    return hourly(spark, sf).select("series_id", "t", s.random_mask(0.25, 3, "series_id", "t").alias("visible"))


@query("c9_instance_norm", "WITH" + FILLED + ", b AS (SELECT series_id, t // 48 AS sample_id, t, value FROM filled), m AS (SELECT *, avg(value) OVER w AS c, sqrt(var_pop(value) OVER w + 1e-6) AS s FROM b WINDOW w AS (PARTITION BY series_id, sample_id)) SELECT series_id, t, round((value - c) / s, 5) AS normed, round(value, 5) AS restored FROM m")
def c9(spark, sf):
    rows = grid.batches(filled(spark, sf), 48, "t").withColumnRenamed("batch_id", "sample_id")
    out = scale.instance_norm(rows, ["series_id", "sample_id"])
    return rounded(out.select("series_id", "t", "normed", scale.instance_norm_inverse(F.col("normed")).alias("restored")), 5)


@query("c10_spatial_temporal_norm", "WITH" + FILLED + " SELECT series_id, t, round((value - avg(value) OVER (PARTITION BY t)) / sqrt(var_samp(value) OVER (PARTITION BY t) + 1e-5), 5) AS spatial, round((value - avg(value) OVER (PARTITION BY series_id)) / sqrt(var_pop(value) OVER (PARTITION BY series_id) + 1e-5), 5) AS temporal FROM filled")
def c10(spark, sf):
    return rounded(scale.temporal_norm(scale.spatial_norm(filled(spark, sf))).select("series_id", "t", "spatial", "temporal"), 5)


@query("c11_layer_and_rms_norm", "WITH" + FILLED + ", l AS (SELECT *, (value - avg(value) OVER (PARTITION BY t)) / sqrt(var_pop(value) OVER (PARTITION BY t) + 1e-5) AS n, value / sqrt(avg(value * value) OVER (PARTITION BY t) + 1e-6) AS rms FROM filled) SELECT series_id, t, round(n - avg(n) OVER (PARTITION BY series_id), 5) AS centred, round(rms, 5) AS rms FROM l")
def c11(spark, sf):
    return rounded(scale.rms_norm(scale.layer_norm_centred(filled(spark, sf))).select("series_id", "t", "centred", "rms"), 5)


@query("f6_period_fold", "WITH" + FILLED + ", n AS (SELECT series_id, max(t) + 1 AS n FROM filled GROUP BY 1), g AS (SELECT series_id, unnest(range(0, CAST(ceil(n / 50.0) * 50 AS BIGINT))) AS t FROM n) SELECT series_id, t // 50 AS row, t % 50 AS col, round(coalesce(value, 0.0), 6) AS value FROM g LEFT JOIN filled USING (series_id, t)")
def f6(spark, sf):
    return rounded(windows.fold_period(filled(spark, sf), 50))


POOL = " UNION ALL ".join(["SELECT 0 AS scale, series_id, t, value FROM filled", *(f"SELECT {k}, series_id, t // {2**k}, avg(value) FROM filled WHERE t < ((n // {2**k}) * {2**k}) GROUP BY series_id, t // {2**k}" for k in (1, 2, 3))])


@query("f11_multi_scale_average", "WITH" + FILLED.replace("filled AS", "filled0 AS") + f", filled AS (SELECT *, count(*) OVER (PARTITION BY series_id) AS n FROM filled0) SELECT scale, series_id, t, round(value, 9) AS value FROM ({POOL})")
def f11(spark, sf):
    return rounded(windows.multi_scale(filled(spark, sf)), 9)


@query("f11_multi_scale_maximum", "WITH" + FILLED.replace("filled AS", "filled0 AS") + f", filled AS (SELECT *, count(*) OVER (PARTITION BY series_id) AS n FROM filled0) SELECT scale, series_id, t, round(value, 6) AS value FROM ({POOL.replace('avg(', 'max(')})")
def f11m(spark, sf):
    return rounded(windows.multi_scale(filled(spark, sf), how="max"))


@query("f12_patches", "WITH" + FILLED + ", n AS (SELECT series_id, max(t) AS m, arg_max(value, t) AS lv FROM filled GROUP BY 1), p AS (SELECT series_id, t, value FROM filled UNION ALL SELECT series_id, unnest(range(m + 1, m + 9)), lv FROM n), k AS (SELECT series_id, unnest(range(0, (m + 9 - 16) // 8 + 1)) AS patch FROM n) SELECT series_id, patch, t - patch * 8 AS pos, round(value, 6) AS value FROM k JOIN p USING (series_id) WHERE t >= patch * 8 AND t < patch * 8 + 16")
def f12(spark, sf):
    return rounded(windows.patches(filled(spark, sf)))


@query("f13_segments", "WITH" + FILLED + ", n AS (SELECT *, count(*) OVER (PARTITION BY series_id) AS n FROM filled), s AS (SELECT series_id, t + (7 - n % 7) % 7 AS p, value FROM n UNION ALL SELECT series_id, unnest(range(0, (7 - n % 7) % 7)), value FROM n WHERE t = 0) SELECT series_id, p // 7 AS segment, p % 7 AS pos, round(value, 6) AS value FROM s")
def f13(spark, sf):
    return rounded(windows.segments(filled(spark, sf), 7))


@query("f14_two_samplings", "WITH" + FILLED + ", n AS (SELECT *, count(*) OVER (PARTITION BY series_id) // 12 AS n FROM filled) SELECT series_id, t, t // 12 AS continuous_row, t % 12 AS continuous_col, t % n AS interval_row, t // n AS interval_col FROM n")
def f14(spark, sf):
    return windows.sampled_two_ways(filled(spark, sf), 12).select("series_id", "t", "continuous_row", "continuous_col", "interval_row", "interval_col")


@query("f15_f16_phases", "WITH" + FILLED + " SELECT series_id, t % 24 AS phase, t // 24 AS cycle, round(value - avg(value) OVER (PARTITION BY series_id), 6) AS value FROM filled")
def f15(spark, sf):
    w = Window.partitionBy("series_id")
    return rounded(filled(spark, sf).select("series_id", F.pmod("t", F.lit(24)).alias("phase"), F.floor(F.col("t") / 24).alias("cycle"), (F.col("value") - F.avg("value").over(w)).alias("value")))


@query("f17_patch_merging", "WITH" + FILLED + ", n AS (SELECT *, count(*) OVER (PARTITION BY series_id) AS n FROM filled), b AS (SELECT series_id, t, value FROM n UNION ALL SELECT series_id, t + (7 - n % 7) % 7, value FROM n WHERE t >= n - (7 - n % 7) % 7) SELECT series_id, t // 7 AS \"group\", list(round(value, 6) ORDER BY t) AS \"values\" FROM b GROUP BY 1, 2")
def f17(spark, sf):
    return arrays(windows.merge_patches(filled(spark, sf), 7), "values")


@query("f27_distilling", "WITH" + FILLED + " SELECT series_id, t // 2 AS t, round(v, 6) AS value FROM (SELECT series_id, t, max(value) OVER (PARTITION BY series_id ORDER BY t ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS v FROM filled) WHERE t % 2 = 0")
def f27(spark, sf):
    return rounded(windows.distil(filled(spark, sf)))


@query("f32_nested_lookbacks", "WITH" + FILLED + ", n AS (SELECT *, count(*) OVER (PARTITION BY series_id) AS n FROM filled) SELECT series_id, t, CAST(k AS INT) AS scale FROM n, (SELECT unnest([1, 2, 4]) AS k) WHERE t >= n - k * 24")
def f32(spark, sf):
    return windows.nested_lookbacks(filled(spark, sf), 24).select("series_id", "t", "scale")


@query("f33_circular_views", "WITH" + FILLED + ", n AS (SELECT *, count(*) OVER (PARTITION BY series_id) AS n FROM filled) SELECT series_id, CAST(i AS INT) AS view, ((t - i * 24) % n + n) % n AS t, round(value, 6) AS value FROM n, (SELECT unnest([0, 1, 2]) AS i)")
def f33(spark, sf):
    return rounded(windows.circular_views(filled(spark, sf), 24, 3))


@query("f29_decoder_seeds", "WITH" + FILLED + WINDOWS.format(15) + ", s AS (SELECT series_id, sample_id, v, list_avg(v) AS m, list_transform(range(1, 17), lambda i: list_avg(list_transform(range(i - 2, i + 3), lambda j: v[greatest(1, least(16, j))]))) AS tr FROM w WHERE len(v) = 16) SELECT series_id, sample_id, list_transform(tr[13:16] || [m, m], lambda x: round(x, 9)) AS trend_seed, list_transform(list_transform(range(13, 17), lambda i: v[i] - tr[i]) || [0.0, 0.0], lambda x: round(x, 9)) AS season_seed FROM s")
def f29(spark, sf):
    samples = windows.imputation_windows(filled(spark, sf), 16)
    return arrays(models.seed_decoder(samples, 4, 2, 5).select("series_id", "sample_id", "trend_seed", "season_seed"), "trend_seed", "season_seed", digits=9)
