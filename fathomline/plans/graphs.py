"""Graphs and similarity analytics."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathomline.operators import analytics, graph, grid
from fathomline.plans.base import FILLED, events, filled, query, rounded, table

EDGES = """edges AS (SELECT c.c_nationkey AS src, s.s_nationkey AS dst, count(*)::DOUBLE AS weight FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer c ON o_custkey = c_custkey JOIN supplier s ON l_suppkey = s_suppkey WHERE c.c_nationkey <> s.s_nationkey GROUP BY 1, 2),
nodes AS (SELECT src AS i FROM edges UNION SELECT dst FROM edges)"""


def edges(spark, sf):
    """Nations that trade: customers' to suppliers', by number of line items."""
    li, o = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey"), table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c, s = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("src")), table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("dst"))
    rows = li.join(o, li["l_orderkey"] == o["o_orderkey"]).join(c, F.col("o_custkey") == F.col("c_custkey")).join(s, F.col("l_suppkey") == F.col("s_suppkey"))
    return rows.where("src <> dst").groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight"))


def placed(spark, sf):
    return edges(spark, sf).withColumn("place", F.col("src") * 1000 + F.col("dst"))


BOTH = ", both_ AS (SELECT src, dst, weight, src * 1000 + dst AS p, 0 AS way FROM edges UNION ALL SELECT dst, src, weight, src * 1000 + dst, 1 FROM edges), sym AS (SELECT src, dst, arg_max(weight, p * 2 + way) AS weight FROM both_ GROUP BY 1, 2)"


@query("g1_symmetric_distances", "WITH " + EDGES + BOTH + " SELECT src, dst, weight FROM sym")
def g1(spark, sf):
    return graph.symmetric(placed(spark, sf), "place")


@query("g1_symmetric_connectivity", "WITH " + EDGES + BOTH + " SELECT src, dst, 1.0::DOUBLE AS weight FROM sym")
def g1c(spark, sf):
    return graph.symmetric(placed(spark, sf), "place", connectivity=True)


@query("g2_self_loops", "WITH " + EDGES + " SELECT src, dst, weight FROM edges UNION ALL SELECT i, i, 1.0 FROM nodes")
def g2(spark, sf):
    return graph.with_self_loops(edges(spark, sf))


@query("a17_degrees", "WITH " + EDGES + " SELECT src, sum(weight) AS degree FROM edges GROUP BY 1")
def a17(spark, sf):
    return graph.degrees(edges(spark, sf))


def _lap(name):
    return f"SELECT src, dst, sum(weight) AS weight FROM (SELECT i AS src, i AS dst, 1.0 AS weight FROM nodes UNION ALL SELECT e.src, e.dst, -e.weight * a.d * coalesce(b.d, 0) FROM {name} e JOIN deg a ON e.src = a.src LEFT JOIN deg b ON e.dst = b.src) GROUP BY 1, 2"


@query("g3_normalised_laplacian", "WITH " + EDGES + ", deg AS (SELECT src, 1 / sqrt(sum(weight)) AS d FROM edges GROUP BY 1), lap AS (" + _lap("edges") + ") SELECT src, dst, round(weight, 9) AS weight FROM lap")
def g3(spark, sf):
    return rounded(graph.laplacian(edges(spark, sf)), 9)


@query("g4_scaled_laplacian", "WITH " + EDGES + ", even AS (SELECT src, dst, max(weight) AS weight FROM (SELECT src, dst, weight FROM edges UNION ALL SELECT dst, src, weight FROM edges) GROUP BY 1, 2), deg AS (SELECT src, 1 / sqrt(sum(weight)) AS d FROM even GROUP BY 1), lap AS (" + _lap("even") + ") SELECT src, dst, round(weight - CASE WHEN src = dst THEN 1 ELSE 0 END, 9) AS weight FROM lap")
def g4(spark, sf):
    return rounded(graph.scaled_laplacian(edges(spark, sf)), 9)


@query("g5_renormalised_adjacency", "WITH " + EDGES + ", a AS (SELECT src, dst, sum(weight) AS weight FROM (SELECT src, dst, weight FROM edges UNION ALL SELECT i, i, 1.0 FROM nodes) GROUP BY 1, 2), deg AS (SELECT src, 1 / sqrt(sum(weight)) AS d FROM a GROUP BY 1) SELECT a.dst AS src, a.src AS dst, round(a.weight * x.d * y.d, 9) AS weight FROM a JOIN deg x ON a.src = x.src JOIN deg y ON a.dst = y.src")
def g5(spark, sf):
    return rounded(graph.renormalised(edges(spark, sf)), 9)


@query("g6_transition_matrix", "WITH " + EDGES + ", deg AS (SELECT src, sum(weight) AS d FROM edges GROUP BY 1) SELECT e.dst AS src, e.src AS dst, round(weight / d, 9) AS weight FROM edges e JOIN deg USING (src)")
def g6(spark, sf):
    return rounded(graph.transition(edges(spark, sf)), 9)


@query("g7_double_transition", "WITH " + EDGES + ", o AS (SELECT src, sum(weight) AS d FROM edges GROUP BY 1), i AS (SELECT dst, sum(weight) AS d FROM edges GROUP BY 1) SELECT 0 AS way, e.dst AS src, e.src AS dst, round(weight / d, 9) AS weight FROM edges e JOIN o USING (src) UNION ALL SELECT 1, e.src, e.dst, round(weight / d, 9) FROM edges e JOIN i USING (dst)")
def g7(spark, sf):
    first, second = graph.normalised(edges(spark, sf), "doubletransition")
    return rounded(first.select(F.lit(0).alias("way"), "*").unionByName(second.select(F.lit(1).alias("way"), "*")), 9)


PARTS = ", parts_ AS (SELECT series_id, t // 24 AS day, t % 24 AS step, value FROM filled), sums AS (SELECT p.day, p.series_id AS a, q.series_id AS b, sum(p.value * q.value) AS xy, sum(p.value * p.value) AS xx, sum(q.value * q.value) AS yy, sum((p.value - q.value) ** 2) AS sq, sum(abs(p.value - q.value)) AS l1 FROM parts_ p JOIN parts_ q USING (day, step) GROUP BY 1, 2, 3), sim AS (SELECT day, a, b, xy / ((sqrt(xx) + 1e-7) * (sqrt(yy) + 1e-7)) AS cosine, sqrt(sq) AS euclidean, l1 AS manhattan FROM sums)"


def day_similarity(spark, sf):
    rows = grid.batches(filled(spark, sf), 24, "t").withColumnRenamed("batch_id", "day").withColumn("step", F.pmod("t", F.lit(24)))
    return analytics.similarity(rows, "day", "step")


@query("j8_y1_y2_channel_similarity", "WITH" + FILLED + PARTS + " SELECT day, a, b, round(cosine, 6) AS cosine, round(euclidean, 8) AS euclidean, round(manhattan, 8) AS manhattan FROM sim")
def y1(spark, sf):
    return rounded(day_similarity(spark, sf), 8, cosine=6)


@query("y3_a19_indistinguishability", "WITH" + FILLED + PARTS + " SELECT count(*) AS pairs, count(*) FILTER (p.cosine > 0.8) AS alike, count(*) FILTER (p.cosine > 0.8 AND f.cosine < 0.75) AS split, count(*) FILTER (p.cosine > 0.8 AND f.cosine < 0.75) / count(*) AS of_all, coalesce(count(*) FILTER (p.cosine > 0.8 AND f.cosine < 0.75) / nullif(count(*) FILTER (p.cosine > 0.8), 0), 0) AS of_alike FROM sim p JOIN sim f ON f.day = p.day + 1 AND f.a = p.a AND f.b = p.b")
def y3(spark, sf):
    past = day_similarity(spark, sf)
    return analytics.indistinguishability(past, past.withColumn("day", F.col("day") - 1), "day", 0.8, 0.75)


@query("y4_kernel_density", "SELECT event_type AS series_id, CAST(p AS INT) AS point, round(0 + p * (400.0 / 99), 6) AS x, round(avg(exp(-0.5 * (((p * (400.0 / 99)) - value) / 5) ** 2)) / (5 * sqrt(2 * pi())), 9) AS density FROM events, range(100) r(p) GROUP BY 1, 2, 3")
def y4(spark, sf):
    return rounded(analytics.density(events(spark, sf), 100, 0.0, 400.0), 6, density=9)


@query("y5_principal_components")
def y5(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    return analytics.principal_components(rows, "v").select("vec_id", F.size("component").alias("k"))


@query("y6_range_slice", "WITH" + FILLED + " SELECT series_id, t, round(value, 6) AS value FROM filled WHERE t BETWEEN 100 AND 199")
def y6(spark, sf):
    return rounded(filled(spark, sf).where("t BETWEEN 100 AND 199").select("series_id", "t", "value"))


@query("f28_expert_routing", "WITH l AS (SELECT event_id, CAST(e AS INT) AS expert, ((event_id * 31 + e * 17) % 13) / 4.0 AS logit FROM events, range(5) r(e)), s AS (SELECT *, exp(logit - max(logit) OVER (PARTITION BY event_id)) AS x FROM l), g AS (SELECT *, x / sum(x) OVER (PARTITION BY event_id) AS g FROM s), k AS (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY logit DESC, expert) <= 2) SELECT event_id, expert, round(g / (sum(g) OVER (PARTITION BY event_id) + 1e-6), 6) AS gate FROM k")
def f28(spark, sf):
    rows = events(spark, sf).select("event_id", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("expert"))
    rows = rows.withColumn("logit", F.pmod(F.col("event_id") * 31 + F.col("expert") * 17, F.lit(13)) / 4.0)
    return rounded(analytics.gate_top_k(rows, 2, "event_id", "expert", "logit").select("event_id", "expert", "gate"))
