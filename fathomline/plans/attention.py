"""Attention over the steps of each day of a channel."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathomline.operators import attention
from fathomline.plans.base import FILLED, filled, query, rounded, uniform_sql

TOKENS = ", tok AS (SELECT series_id || '-' || (t // 24) AS sample, t % 24 AS pos, value, [value / 100, (t % 5)::DOUBLE, 1.0::DOUBLE, (t % 24) / 24.0::DOUBLE] AS vec FROM filled), n AS (SELECT sample, count(*) AS n FROM tok GROUP BY 1)"
TURN = "[vec[1] * cos(pos * 1.0) - vec[3] * sin(pos * 1.0), vec[2] * cos(pos * 0.01) - vec[4] * sin(pos * 0.01), vec[3] * cos(pos * 1.0) + vec[1] * sin(pos * 1.0), vec[4] * cos(pos * 0.01) + vec[2] * sin(pos * 0.01)]"


def tokens(spark, sf):
    t = F.col("t")
    vec = F.array(F.col("value") / 100, (t % 5).cast("double"), F.lit(1.0), (t % 24) / 24.0)
    return filled(spark, sf).select(F.concat_ws("-", "series_id", F.floor(t / 24)).alias("sample"), (t % 24).alias("pos"), "value", vec.alias("vec"))


@query(
    "f21_sparse_queries",
    "WITH" + FILLED + TOKENS + f", d AS (SELECT tok.*, n, CAST(floor({uniform_sql(9, 'tok.sample', 'pos', 'i')} * n) AS BIGINT) AS at_ FROM tok JOIN n USING (sample), (SELECT unnest(range(0, 6)) AS i)), p AS (SELECT d.sample, d.pos, d.n, list_dot_product(d.vec, k.vec) AS p FROM d JOIN tok k ON k.sample = d.sample AND k.pos = d.at_), "
    "s AS (SELECT sample, pos, max(p) - sum(p) / any_value(n) AS score FROM p GROUP BY 1, 2) SELECT sample, pos, round(score, 6) AS score FROM s QUALIFY row_number() OVER (PARTITION BY sample ORDER BY round(score, 9) DESC, pos) <= 5",
)
def f21(spark, sf):
    return rounded(attention.sparse_queries(tokens(spark, sf), "sample", 6, 5, 9))


@query("f23_rotary_positions", "WITH" + FILLED + TOKENS + f" SELECT sample, pos, list_transform({TURN}, lambda x: round(x, 8)) AS turned FROM tok")
def f23(spark, sf):
    return tokens(spark, sf).select("sample", "pos", F.transform(attention.rotary(F.col("vec"), F.col("pos"), 4), lambda x: F.round(x, 8)).alias("turned"))


@query("f23_causal_attention", "WITH" + FILLED + TOKENS + f", r AS (SELECT sample, pos, value, {TURN} AS v FROM tok), s AS (SELECT q.sample, q.pos, k.value, list_dot_product(q.v, k.v) / 2 AS s FROM r q JOIN r k ON k.sample = q.sample AND k.pos <= q.pos), w AS (SELECT *, exp(s - max(s) OVER (PARTITION BY sample, pos)) AS w FROM s) SELECT sample, pos, round(sum(w * value) / sum(w), 6) AS attended FROM w GROUP BY 1, 2")
def f23a(spark, sf):
    return rounded(attention.causal_attention(tokens(spark, sf), "sample", 4))
