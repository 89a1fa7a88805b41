"""Neighbour graphs and feature selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import graph as gr, laplacian as lp, selection as sl
from ..operators.mcfs import mcfs
from .queries_metrics import EMB, vectors
from .queries_segments import CODED, encoded
from .registry import query
from .responses import NUMERICS, QUESTIONS, responses, table

K = 5
MIXED_NUM = ["p_size", "p_retailprice"]
MIXED_CAT = ["p_brand", "p_type"]


def _r(column: str, places: int = 6):
    return F.round(F.col(column).cast("double"), places).alias(column)


def parts(spark, sf):
    from ..operators.cleaning import encode
    return encode(table(spark, sf, "part").select(F.col("p_partkey").alias("id"), *MIXED_NUM, *MIXED_CAT), MIXED_CAT)


_GOWER = """WITH f AS (SELECT p_partkey AS id, (p_size - min(p_size) OVER ()) / CAST(max(p_size) OVER () - min(p_size) OVER () AS DOUBLE) AS a,
    (p_retailprice - min(p_retailprice) OVER ()) / (max(p_retailprice) OVER () - min(p_retailprice) OVER ()) AS b, p_brand, p_type FROM part),
  d AS (SELECT x.id AS src, y.id AS dst, round((abs(x.a - y.a) + abs(x.b - y.b) + CASE WHEN x.p_brand <> y.p_brand THEN 1 ELSE 0 END
    + CASE WHEN x.p_type <> y.p_type THEN 1 ELSE 0 END) / 4, 9) AS d FROM f x JOIN f y ON x.id <> y.id),
  near AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY d, dst) AS rn FROM d QUALIFY rn <= 5)
  SELECT src, dst, round(max(exp(-d * d / 2)), 6) AS w FROM (SELECT src, dst, d FROM near UNION ALL SELECT dst, src, d FROM near)
  GROUP BY src, dst"""


@query("g01_knn_gower", _GOWER)
def g01(spark, sf):
    return gr.affinity(parts(spark, sf), K, numeric=MIXED_NUM, codes=MIXED_CAT).select("src", "dst", _r("w"))


def _pairs_sql(same: str = "true") -> str:
    return f"""WITH v AS (SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
  u AS (SELECT id, unnest(x) AS x, unnest(range(64)) AS j FROM v),
  d AS (SELECT a.id AS src, b.id AS dst, round(sqrt(sum((a.x - b.x) * (a.x - b.x))), 9) AS d,
    sum(a.x * b.x) / sqrt(sum(a.x * a.x) * sum(b.x * b.x)) AS c FROM u a JOIN u b ON a.j = b.j AND a.id <> b.id GROUP BY a.id, b.id),
  e AS (SELECT d.*, p.label AS sl, q.label AS dl FROM d JOIN v p ON p.id = src JOIN v q ON q.id = dst WHERE {same})"""


def _knn_sql(order: str, weight: str, same: str = "true") -> str:
    return _pairs_sql(same) + f""", near AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY {order}, dst) AS rn FROM e QUALIFY rn <= 5)
  SELECT src, dst, round(max({weight}), 6) AS w FROM (SELECT src, dst, d, c FROM near UNION ALL SELECT dst, src, d, c FROM near)
  GROUP BY src, dst"""


@query("g02_knn_heat_kernel", _knn_sql("d", "exp(-d * d / 2)"))
def g02_heat(spark, sf):
    return gr.affinity(vectors(spark, sf), K, numeric=EMB, metric="euclidean").select("src", "dst", _r("w"))


@query("g02_knn_binary", _knn_sql("d", "1.0"))
def g02_binary(spark, sf):
    return gr.affinity(vectors(spark, sf), K, numeric=EMB, metric="euclidean", mode="binary").select("src", "dst", _r("w"))


@query("g02_knn_cosine", _knn_sql("c DESC", "c"))
def g02_cosine(spark, sf):
    return gr.affinity(vectors(spark, sf), K, numeric=EMB, metric="cosine", mode="cosine").select("src", "dst", _r("w"))


@query("g03_within_class", _knn_sql("d", "exp(-d * d / 2)", "p.label = q.label"))
def g03(spark, sf):
    near = gr.nearest(vectors(spark, sf), K, numeric=EMB, metric="euclidean", by="label")
    return gr.symmetric(gr.weigh(near)).select("src", "dst", _r("w"))


@query("g03_relief", _pairs_sql() + """, near AS (SELECT *, row_number() OVER (PARTITION BY src, dl ORDER BY d, dst) AS rn FROM e QUALIFY rn <= 5),
  size AS (SELECT label, least(5, count(*) - 1) AS h FROM v GROUP BY label)
  SELECT id AS src, id AS dst, CAST(1 AS DOUBLE) AS w FROM v
  UNION ALL SELECT src, dst, round(1.0 / h, 6) FROM near JOIN size ON label = sl WHERE sl = dl
  UNION ALL SELECT a.src, a.dst, round(-1.0 / (((SELECT count(*) FROM size) - 1) * 5), 6) FROM near a JOIN near b
    ON a.src = b.dst AND a.dst = b.src WHERE a.sl <> a.dl""")
def g03_relief(spark, sf):
    return gr.relief_weights(vectors(spark, sf), K, "label", numeric=EMB).select("src", "dst", _r("w"))


@query("g03_fisher", "SELECT label AS class, count(*) AS n, round(1.0 / count(*), 6) AS w FROM embeddings GROUP BY label")
def g03_fisher(spark, sf):
    return gr.fisher_groups(vectors(spark, sf), "label").select("class", "n", _r("w"))


LAP = ["e0", "e1", "e2", "e3", "e4", "e5"]
_LAP = _pairs_sql() + """, near AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY d, dst) AS rn FROM e QUALIFY rn <= 5),
  g AS (SELECT src, dst, max(exp(-d * d / 2)) AS w FROM (SELECT src, dst, d FROM near UNION ALL SELECT dst, src, d FROM near) GROUP BY src, dst),
  deg AS (SELECT src AS id, sum(w) AS d FROM g GROUP BY src),
  f AS (SELECT id, j, x FROM u WHERE j < 6),
  node AS (SELECT j, sum(d * x * x) - power(sum(d * x), 2) / sum(d) AS spread FROM f JOIN deg USING (id) GROUP BY j),
  rough AS (SELECT a.j, sum(w * (a.x - b.x) * (a.x - b.x)) / 2 AS r FROM g JOIN f a ON a.id = src JOIN f b ON b.id = dst AND a.j = b.j GROUP BY a.j),
  s AS (SELECT 'e' || j AS feature, r / spread AS score FROM rough JOIN node USING (j))
"""


def _embedding_scores(spark, sf):
    rows = vectors(spark, sf)
    return lp.laplacian_scores(rows, gr.affinity(rows, K, numeric=EMB, metric="euclidean"), LAP)


@query("g04_laplacian", _LAP + "SELECT feature, round(score, 6) AS score FROM s")
def g04(spark, sf):
    return _embedding_scores(spark, sf).select("feature", _r("score"))


@query("g06_select", _LAP + """SELECT feature, CAST(rank AS INTEGER) AS rank FROM (SELECT feature,
    row_number() OVER (ORDER BY score, feature) AS rank FROM s) WHERE rank <= 3""")
def g06(spark, sf):
    return lp.feature_ranks(_embedding_scores(spark, sf)).filter("rank <= 3").select("feature", "rank")


@query("g04_laplacian_responses")
def g04_responses(spark, sf):
    rows = encoded(spark, sf)
    return lp.laplacian_scores(rows, gr.CodedGraph(rows, 15, CODED), CODED)



FEATURES = [*CODED, *NUMERICS]


@query("g10_mcfs")
def g10(spark, sf):
    rows = encoded(spark, sf)
    return mcfs(rows, gr.CodedGraph(rows, K, CODED), CODED, 3, 4)


@query("g08_optimal_neighbours")
def g08(spark, sf):
    rows = encoded(spark, sf).persist()
    best, tried = sl.optimal_laplacian(rows, CODED)
    return sl.quality_table(spark, tried).withColumn("is_best", F.col("n_neighbours") == best["n_neighbours"]).drop("cols")


@query("g09_laplacian_only")
def g09(spark, sf):
    people = responses(spark, sf).select("id", *[c for c in CODED if "sbeh" in c])
    chosen = sl.rank_features_laplacian(people)
    return spark.createDataFrame([(c,) for c in chosen], "feature string")


@query("g12_kmeans_grid")
def g12(spark, sf):
    return sl.grid_table(spark, sl.kmeans_grid(encoded(spark, sf).persist(), FEATURES, top=4)).drop("features", "chi2_stat")


@query("g13_component_grid")
def g13(spark, sf):
    return sl.grid_table(spark, sl.component_grid(encoded(spark, sf).persist(), FEATURES)).drop("features", "chi2_stat")


@query("g14_kproto_grid")
def g14(spark, sf):
    grid = sl.kproto_grid(encoded(spark, sf).persist(), ["n_lines", "max_qty"], CODED, top=4)
    return sl.grid_table(spark, grid).drop("features", "chi2_stat")


@query("g15_chi2_ranking", """WITH s AS (SELECT c_nationkey % 4 AS k, c_mktsegment AS feature, round(avg(c_acctbal), 0) AS stat
    FROM customer WHERE NOT (c_nationkey % 4 = 1 AND c_mktsegment = 'BUILDING') GROUP BY ALL),
  g AS (SELECT a.k, b.feature, stat FROM (SELECT DISTINCT k FROM s) a JOIN (SELECT DISTINCT feature FROM s) b ON true
    LEFT JOIN s ON s.k = a.k AND s.feature = b.feature),
  r AS (SELECT *, rank() OVER (PARTITION BY k ORDER BY stat DESC NULLS LAST) + (count(*) OVER (PARTITION BY k, stat) - 1) / 2.0 AS r FROM g),
  t AS (SELECT feature, CAST(sum(r) AS DOUBLE) AS total FROM r GROUP BY feature)
  SELECT feature, total, CAST(rank() OVER (ORDER BY total) + (count(*) OVER (PARTITION BY total) - 1) / 2.0 AS DOUBLE) AS rank FROM t""")
def g15(spark, sf):
    stats = (table(spark, sf, "customer").filter("NOT (c_nationkey % 4 = 1 AND c_mktsegment = 'BUILDING')")
             .groupBy((F.col("c_nationkey") % 4).alias("k"), F.col("c_mktsegment").alias("feature"))
             .agg(F.round(F.avg("c_acctbal"), 0).alias("stat")))
    return sl.chi2_ranking(stats).select("feature", F.col("total").cast("double").alias("total"), F.col("rank").cast("double").alias("rank"))


@query("g16_first_per_variable", """SELECT p_brand AS q_code, min(p_retailprice) AS stat FROM part GROUP BY p_brand""")
def g16(spark, sf):
    parts_ = table(spark, sf, "part").select(F.col("p_brand").alias("q_code"), F.col("p_retailprice").alias("stat"))
    return sl.first_per_variable(parts_, ["q_code"], "stat")


@query("g17_rank_fusion", """WITH r AS (SELECT p_type AS method, p_brand AS feature, CAST(row_number() OVER (PARTITION BY p_type
      ORDER BY sum(p_retailprice), p_brand) AS DOUBLE) AS rank FROM part GROUP BY p_type, p_brand),
  g AS (SELECT m.method, f.feature, CASE WHEN rank <= 8 THEN rank END AS rank FROM (SELECT DISTINCT method FROM r) m
    JOIN (SELECT DISTINCT feature FROM r WHERE rank <= 8) f ON true LEFT JOIN r ON r.method = m.method AND r.feature = f.feature)
  SELECT feature, round(sum(coalesce(rank, 1.1 * 8)), 6) AS sum_rank FROM g GROUP BY feature ORDER BY sum_rank, feature LIMIT 8""")
def g17(spark, sf):
    from pyspark.sql import Window
    sums = table(spark, sf, "part").groupBy(F.col("p_type").alias("method"), F.col("p_brand").alias("feature")).agg(
        F.sum("p_retailprice").alias("s"))
    ranks = sums.withColumn("rank", F.row_number().over(Window.partitionBy("method").orderBy("s", "feature")).cast("double"))
    return sl.fuse_rankings(ranks.drop("s"), 8).select("feature", _r("sum_rank"))


@query("g18_subsample")
def g18(spark, sf):
    rows = encoded(spark, sf).persist()
    found = sl.subsample_study(rows, CODED, [0.5, 1.0])
    return spark.createDataFrame([(f["share"], f["n_neighbours"], f["n_clusters"], f["silhouette"]) for f in found],
                                 "share double, n_neighbours int, n_clusters int, silhouette double")


@query("g17_rank_features")
def g17_all(spark, sf):
    """Four rankers over all questions that a study clusters on, fused: the three best."""
    chosen = sl.rank_features(responses(spark, sf).select("id", *QUESTIONS), 3, 5, 1, 4)
    return spark.createDataFrame([(i + 1, c) for i, c in enumerate(chosen)], "place int, feature string")
