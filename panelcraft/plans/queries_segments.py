"""Segmentation methods over the responses view."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..operators import centres as ce, cleaning, joint_fit as joint, latent as la, mixture as mi, reduce as rd, search as se, segment as sg
from ..session import shared_place
from ..sources import models
from .oracle_parts import upto
from .registry import query
from .responses import NUMERICS, responses, table

THREE = ["n_lines", "spend", "max_qty"]
TWO = ["n_lines", "max_qty"]
CODED = ["sbeh_1001_lines_tgt", "sbeh_1002_returned_fb_tgt", "sbeh_1002_accepted_fb_tgt", "sbeh_1003_open_gg_tgt",
         "psy_1004_size"]
# Label codes of the coded questions, in sorted answer order.
LEVELS = {"sbeh_1001_lines_tgt": ["1-2", "3-4", "5+"], "sbeh_1002_returned_fb_tgt": ["not selected", "selected"],
          "sbeh_1002_accepted_fb_tgt": ["not selected", "selected"], "sbeh_1003_open_gg_tgt": ["not selected", "selected"],
          "psy_1004_size": ["big", "mid", "small"]}


def _r(column: str, places: int = 6):
    return F.round(F.col(column).cast("double"), places).alias(column)


def encoded(spark, sf, columns=CODED):
    return cleaning.encode(responses(spark, sf).select("id", "cluster", *columns, *NUMERICS), columns)


@query("c02_pca_variance", upto("responses", """SELECT CAST(component AS INTEGER) AS component,
    round((1 + 2 * sqrt(s / 3) * cos((acos(least(greatest(abc / power(s / 3, 1.5), -1), 1)) - 2 * pi() * (component - 1)) / 3)) / 3, 6) AS ratio
  FROM (SELECT *, unnest([1, 2, 3]) AS component FROM (
    SELECT a * a + b * b + c * c AS s, a * b * c AS abc FROM (
      SELECT corr(n_lines, spend) AS a, corr(n_lines, max_qty) AS b, corr(spend, max_qty) AS c FROM responses)))"""))
def c02(spark, sf):
    return rd.variance_table(responses(spark, sf), THREE).select("component", _r("ratio"))


@query("c04_famd_matrix", upto("responses", """SELECT id,
    round((spend - avg(spend) OVER ()) / stddev_pop(spend) OVER (), 6) AS spend,
    round((CASE WHEN psy_1004_size = 'mid' THEN 1 ELSE 0 END - s_mid) / sqrt(s_mid), 6) AS psy_mid,
    round((CASE WHEN psy_1004_size = 'small' THEN 1 ELSE 0 END - s_small) / sqrt(s_small), 6) AS psy_small
  FROM (SELECT *, avg(CASE WHEN psy_1004_size = 'mid' THEN 1.0 ELSE 0.0 END) OVER () AS s_mid,
    avg(CASE WHEN psy_1004_size = 'small' THEN 1.0 ELSE 0.0 END) OVER () AS s_small FROM responses)"""))
def c04(spark, sf):
    wide, names = rd.famd_matrix(responses(spark, sf), ["spend"], ["psy_1004_size"], ["id"])
    wide = wide.toDF("id", "spend", "psy_mid", "psy_small")
    return wide.select("id", _r("spend"), _r("psy_mid"), _r("psy_small"))


def _two_steps(distance: str, centre: str, start: str, columns: str, places: int) -> str:
    """Two assign-and-update steps written out; labels go to the first of equally near centres."""
    step = """d{i} AS (SELECT p.id, c.k, {distance} AS d FROM points p JOIN c{j} c ON true),
  a{i} AS (SELECT id, k, d FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(d, {places}), k) AS rn FROM d{i}) WHERE rn = 1)"""
    one = step.format(i=1, j=0, distance=distance, places=places)
    two = step.format(i=2, j=1, distance=distance, places=places)
    return f"points AS (SELECT {columns} FROM responses),\nc0 AS ({start}),\n{one},\nc1 AS ({centre}),\n{two}\n" \
        "SELECT CAST(k AS INTEGER) AS cluster, count(*) AS n, round(CAST(sum(d) AS DOUBLE), 3) AS cost FROM a2 GROUP BY k"


_KMEANS = _two_steps("power(p.n_lines - c.n_lines, 2) + power(p.max_qty - c.max_qty, 2)",
                     "SELECT k, avg(n_lines) AS n_lines, avg(max_qty) AS max_qty FROM a1 JOIN points USING (id) GROUP BY k",
                     "SELECT CAST(cluster AS INTEGER) AS k, avg(n_lines) AS n_lines, avg(max_qty) AS max_qty FROM responses GROUP BY cluster",
                     "id, n_lines, max_qty", 9)


def _step_table(spark, df, layout, start, gamma=1.0):
    """Sizes and costs by cluster after the second assignment."""
    once = ce.fit(df, layout, {0: start}, max_iterations=1)[0]
    labelled = ce.assign(df, layout, {"cluster": once})
    parts = []
    for k in range(once.k):
        d = F.lit(0.0)
        for j, c in enumerate(layout.numeric):
            d = d + F.pow(F.col(c) - float(once.numeric[k, j]), 2)
        for j, c in enumerate(layout.codes):
            d = d + F.when(F.col(c) != int(once.modes[k, j]), gamma).otherwise(0.0)
        parts.append(F.when(F.col("cluster") == k, d))
    return (labelled.withColumn("d", F.coalesce(*parts)).groupBy("cluster")
            .agg(F.count("*").alias("n"), F.round(F.sum("d"), 3).alias("cost")))


@query("c07_kmeans_fixed", upto("responses", "", []).rstrip() + ",\n" + _KMEANS)
def c07(spark, sf):
    people = responses(spark, sf)
    rows = people.groupBy("cluster").agg(*[F.avg(c).alias(c) for c in TWO]).orderBy("cluster").collect()
    start = ce.Centres(np.array([[r[c] for c in TWO] for r in rows]), np.zeros((len(rows), 0)))
    return _step_table(spark, people, ce.Layout(TWO, []), start)


_CODE_COLUMNS = ", ".join(f"CASE {c} " + " ".join(f"WHEN '{v}' THEN {i}" for i, v in enumerate(vs)) + f" END AS {c}"
                          for c, vs in LEVELS.items())


def _modes_sql(source: str, key: str) -> str:
    joins = []
    for c in CODED:
        joins.append(f"(SELECT k, {c} FROM (SELECT k, {c}, row_number() OVER (PARTITION BY k ORDER BY count(*) DESC, {c}) AS rn "
                     f"FROM ({source}) GROUP BY k, {c}) WHERE rn = 1)")
    sql = joins[0] + " AS t0"
    for i, j in enumerate(joins[1:], 1):
        sql += f" JOIN {j} AS t{i} USING (k)"
    return f"SELECT k, {', '.join(CODED)} FROM {sql}"


_MISMATCH = " + ".join(f"CASE WHEN p.{c} <> c.{c} THEN 1 ELSE 0 END" for c in CODED)
_KMODES = _two_steps(_MISMATCH, _modes_sql("SELECT a1.k, points.* FROM a1 JOIN points USING (id)", "k"),
                     _modes_sql("SELECT CAST(cluster AS INTEGER) AS k, * FROM points", "k"),
                     f"id, cluster, {_CODE_COLUMNS}", 9)


def _mode_starts(spark, df, columns):
    long = df.unpivot(["cluster"], columns, "q", "code").groupBy("cluster", "q", "code").count()
    best = {(r["cluster"], r["q"]): r["b"]["code"] for r in long.groupBy("cluster", "q").agg(
        F.min(F.struct((-F.col("count")).alias("n"), "code")).alias("b")).collect()}
    clusters = sorted({c for c, _ in best})
    return np.array([[float(best[(c, q)]) for q in columns] for c in clusters])


@query("c08_kmodes_fixed", upto("responses", "", []).rstrip() + ",\n" + _KMODES)
def c08(spark, sf):
    rows = encoded(spark, sf)
    modes = _mode_starts(spark, rows, CODED)
    return _step_table(spark, rows, ce.Layout([], CODED), ce.Centres(np.zeros((len(modes), 0)), modes))


_GAMMA = "(SELECT 0.5 * (stddev_pop(n_lines) + stddev_pop(max_qty)) / 2 FROM points)"
_KPROTO = _two_steps(f"power(p.n_lines - c.n_lines, 2) + power(p.max_qty - c.max_qty, 2) + {_GAMMA} * ({_MISMATCH})",
                     f"SELECT * FROM ({_modes_sql('SELECT a1.k, points.* FROM a1 JOIN points USING (id)', 'k')}) JOIN "
                     "(SELECT k, avg(n_lines) AS n_lines, avg(max_qty) AS max_qty FROM a1 JOIN points USING (id) GROUP BY k) USING (k)",
                     f"SELECT * FROM ({_modes_sql('SELECT CAST(cluster AS INTEGER) AS k, * FROM points', 'k')}) JOIN "
                     "(SELECT CAST(cluster AS INTEGER) AS k, avg(n_lines) AS n_lines, avg(max_qty) AS max_qty FROM points GROUP BY cluster) USING (k)",
                     f"id, cluster, n_lines, max_qty, {_CODE_COLUMNS}", 9)


@query("c09_kprototypes_fixed", upto("responses", "", []).rstrip() + ",\n" + _KPROTO)
def c09(spark, sf):
    rows = encoded(spark, sf)
    modes = _mode_starts(spark, rows, CODED)
    means = rows.groupBy("cluster").agg(*[F.avg(c).alias(c) for c in TWO]).orderBy("cluster").collect()
    gamma = ce.half_mean_deviation(rows, TWO)
    start = ce.Centres(np.array([[r[c] for c in TWO] for r in means]), modes, gamma)
    return _step_table(spark, rows, ce.Layout(TWO, CODED), start, gamma)


@query("c03_kmeans_pca")
def c03(spark, sf):
    return sg.kmeans_pca(encoded(spark, sf), [*CODED, *NUMERICS], mode="tune").labels


@query("c05_kmeans_famd")
def c05(spark, sf):
    return sg.kmeans_famd(responses(spark, sf), [*CODED, *NUMERICS]).labels


@query("c08_kmodes")
def c08_full(spark, sf):
    return sg.k_family(encoded(spark, sf), [], CODED).labels


@query("c09_kprototypes")
def c09_full(spark, sf):
    return sg.k_family(encoded(spark, sf), TWO, CODED).labels


@query("c11_gaussian_mixture")
def c11(spark, sf):
    found = sg.gaussian_mixture(encoded(spark, sf), [*CODED, *TWO])
    rows = [(r["run"], r["n_clusters"], r["log_likelihood"], r["bic"], r["aic"], r["settled"], r["reason"]) for r in found.runs]
    return spark.createDataFrame(rows, "run string, n_clusters int, log_likelihood double, bic double, aic double, settled boolean, "
                                       "reason string")


@query("c12_criteria", upto("responses", """SELECT cluster, round(-2 * ll + p * ln(n), 4) AS bic, round(-2 * ll + 2 * p, 4) AS aic
  FROM (SELECT cluster, count(*) AS n, -CAST(count(*) AS DOUBLE) AS ll, 2 * 3 + 2 * 2 + 2 - 1 AS p FROM responses GROUP BY cluster)"""))
def c12(spark, sf):
    rows = responses(spark, sf).groupBy("cluster").count().collect()
    out = [(r["cluster"], mi.criteria(-float(r["count"]), r["count"], 2, 2)) for r in rows]
    return spark.createDataFrame([(c, round(v["bic"], 4), round(v["aic"], 4)) for c, v in out],
                                 "cluster string, bic double, aic double")


_LCA_STEP = upto("long", """SELECT CAST(k AS INTEGER) AS cls, q_code, answer, round(r, 6) AS rho FROM (
    SELECT p.k, l.q_code, l.answer, sum(p.post) / max(s.w) AS r FROM post p JOIN coded l USING (id)
      JOIN (SELECT k, sum(post) AS w FROM post GROUP BY k) s ON s.k = p.k GROUP BY p.k, l.q_code, l.answer)""", [
    "coded AS (SELECT * FROM long WHERE q_code IN (" + ", ".join(f"'{c}'" for c in CODED) + "))",
    "pi0 AS (SELECT CAST(cluster AS INTEGER) AS k, count(*) / CAST((SELECT count(*) FROM responses) AS DOUBLE) AS w FROM responses GROUP BY cluster)",
    """levels AS (SELECT DISTINCT q_code, answer FROM coded)""",
    """rho0 AS (SELECT k, v.q_code, v.answer, greatest(coalesce(n / CAST(s AS DOUBLE), 0), 1e-12) AS rho FROM levels v JOIN pi0 ON true
      LEFT JOIN (SELECT CAST(cluster AS INTEGER) AS k, q_code, answer, count(*) AS n FROM coded GROUP BY ALL) USING (k, q_code, answer)
      JOIN (SELECT CAST(cluster AS INTEGER) AS k, count(*) AS s FROM responses GROUP BY cluster) USING (k))""",
    """joint AS (SELECT l.id, r.k, ln(max(w)) + sum(ln(rho)) AS lp FROM coded l JOIN rho0 r ON l.q_code = r.q_code AND l.answer = r.answer
      JOIN pi0 ON pi0.k = r.k GROUP BY l.id, r.k)""",
    """post AS (SELECT id, k, exp(lp - max(lp) OVER (PARTITION BY id)) / sum(exp(lp - m)) OVER (PARTITION BY id) AS post
      FROM (SELECT *, max(lp) OVER (PARTITION BY id) AS m FROM joint))"""])


@query("c14_lca_step", _LCA_STEP)
def c14_step(spark, sf):
    rows = encoded(spark, sf)
    counts = rows.unpivot(["cluster"], CODED, "q", "code").groupBy("cluster", "q", "code").count().collect()
    sizes = {r["cluster"]: r["count"] for r in rows.groupBy("cluster").count().collect()}
    names = sorted(sizes)
    answers = [np.zeros((len(names), len(LEVELS[c]))) for c in CODED]
    for r in counts:
        answers[CODED.index(r["q"])][names.index(r["cluster"]), r["code"]] = r["count"] / sizes[r["cluster"]]
    total = sum(sizes.values())
    start = la.Classes(np.array([sizes[c] / total for c in names]), answers, np.zeros((len(names), 0)), np.zeros((len(names), 0)))
    after = la.em_step(ce.patterns(rows, CODED), CODED, [], {0: start}, True)[0]
    out = [(k, q, LEVELS[q][a], round(float(after.answers[i][k, a]), 6)) for i, q in enumerate(CODED)
           for k in range(len(names)) for a in range(len(LEVELS[q]))]
    return spark.createDataFrame(out, "cls int, q_code string, answer string, rho double")


@query("c14_lca")
def c14(spark, sf):
    return sg.latent_classes(encoded(spark, sf), CODED).labels


@query("c15_mixed_lca")
def c15(spark, sf):
    return sg.latent_classes(encoded(spark, sf), CODED, TWO).labels


@query("c17_hierarchical_offsets", """SELECT branch, CAST(local AS INTEGER) AS local, CAST(CASE WHEN branch = 'BUILDING' THEN -99
    ELSE local + coalesce((SELECT sum(top + 1) FROM (SELECT c_mktsegment AS b, max(c_nationkey % 4) AS top FROM customer
      GROUP BY c_mktsegment) t WHERE t.b < c.branch AND t.b <> 'BUILDING'), 0) END AS INTEGER) AS cluster, count(*) AS n
  FROM (SELECT c_mktsegment AS branch, c_nationkey % 4 AS local FROM customer) c GROUP BY ALL""")
def c17(spark, sf):
    people = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("branch"),
                                                 (F.col("c_nationkey") % 4).cast("int").alias("local"))
    return (sg.offset_labels(people, "branch", "local", ["BUILDING"])
            .groupBy("branch", "local", "cluster").agg(F.count("*").alias("n")))


def _inside(features):
    return lambda: {"kmeans": se.k_means(features, k_min=2, k_max=3)}


@query("c17_hierarchical_kmeans")
def c17_full(spark, sf):
    return sg.search_branches(encoded(spark, sf), "cluster", _inside([*CODED, *NUMERICS]))["kmeans"].labels


def _runs_on(labels, branches):
    """Per branch: rows, and whether its labels are 0..n-1 shifted by the number of labels of all branches before it."""
    each = labels.join(branches, "id").groupBy("branch").agg(
        F.count("*").alias("n"), F.min("cluster").alias("low"), F.max("cluster").alias("high"),
        F.countDistinct("cluster").alias("different"))
    return joint.running_total(each, "branch", "different").select(
        "branch", "n", ((F.col("low") == F.col("before")) & (F.col("high") - F.col("low") + 1 == F.col("different"))
                        & F.col("different").between(1, 2)).alias("runs_on"))


@query("c17_branches_by_customer", """SELECT o_custkey AS branch, count(DISTINCT o_orderkey) AS n, TRUE AS runs_on
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_custkey""")
def c17_customers(spark, sf):
    people = encoded(spark, sf).drop("cluster").join(
        table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("branch")), "id").persist()
    found = sg.search_branches(people, "branch", _inside([*CODED, *NUMERICS]))["kmeans"]
    return _runs_on(found.labels, people.select("id", "branch"))


@query("k08_consistency")
def k08(spark, sf):
    rows = encoded(spark, sf)
    found = sg.kmeans_pca(rows, [*CODED, *NUMERICS], mode="tune")
    return spark.createDataFrame(list(sg.consistency(rows, found).items()), "metric string, value double")


@query("s08_stored_model", upto("responses", """SELECT 'kmeans' AS method, count(*) AS respondents, count(*) AS same_label FROM responses
  UNION ALL SELECT 'lca', count(*), count(*) FROM responses UNION ALL SELECT 'mixture', count(*), count(*) FROM responses"""))
def s08(spark, sf):
    """Fit, store, read back, and label the raw answers as if they were new: the labels are those of the fit."""
    people = responses(spark, sf)
    rows = encoded(spark, sf).persist()
    answers = cleaning.label_codes(people, CODED)
    fitted = sg.search_all(rows, {"kmeans": se.k_means([*CODED, *NUMERICS], k=3), "lca": se.ClassSearch(CODED, ks=[3]),
                                  "mixture": se.MixtureSearch([*CODED, *TWO], k_min=3, k_max=4, any_balance=True)})
    out = None
    for method, seg in fitted.items():
        path = f"{shared_place(spark)}/{method}"
        numeric, codes = ([], CODED) if method == "lca" else (seg.features, [])
        models.save(seg, path, numeric, codes, spark, answers)
        stored = models.load(spark, path)
        again = stored.label(stored.encode(people.drop("cluster"))).withColumnRenamed("cluster", "again")
        one = seg.labels.join(again, "id").agg(F.count("*").alias("respondents"), F.count_if(F.col("cluster") == F.col("again")).alias("same_label"))
        one = one.select(F.lit(method).alias("method"), "respondents", "same_label")
        out = one if out is None else out.unionByName(one)
    return out
