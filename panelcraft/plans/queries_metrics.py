"""Marketing metrics and cluster quality over the responses and embeddings tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.special import chi2_upper_tail
from ..operators import cleaning, crosstab as ct, metrics as mx, quality as ql
from .oracle_parts import SIZES, upto
from .queries_inference import inference
from .registry import query
from .responses import NUMERICS, QUESTIONS, ROLES, responses, table

TGT = [q for q in QUESTIONS if "tgt" in q]


def _r(column: str, places: int = 6):
    return F.round(F.col(column).cast("double"), places).alias(column)


@query("m01_uniqueness", upto("deliver", """SELECT targeting_seg AS cluster, round(1 - count(*) FILTER (
    WHERE n_seg > 1) / CAST(count(*) AS DOUBLE), 6) AS uniqueness FROM (
    SELECT d.*, (SELECT count(DISTINCT o.targeting_seg) FROM deliver o WHERE o.q_code = d.q_code
      AND o.sig_more_category = d.sig_more_category) AS n_seg FROM deliver d) GROUP BY targeting_seg"""))
def m01(spark, sf):
    return mx.uniqueness(inference(spark, sf).deliver).select("cluster", _r("uniqueness"))


@query("m02_communicability", upto("deliver", """SELECT targeting_seg AS cluster,
    CAST(count(DISTINCT q_code) AS DOUBLE) AS communicability FROM deliver WHERE regexp_matches(q_code, 'psy|ae')
    GROUP BY targeting_seg
  UNION ALL SELECT 'average', coalesce((SELECT sum(c) FROM (SELECT count(DISTINCT q_code) AS c FROM deliver
    WHERE regexp_matches(q_code, 'psy|ae') GROUP BY targeting_seg)), 0)
    / CAST((SELECT count(DISTINCT targeting_seg) FROM deliver) AS DOUBLE)"""))
def m02(spark, sf):
    return mx.communicability(inference(spark, sf).deliver)


@query("m03_social_presence", upto("responses", """SELECT cluster, round(count(*) FILTER (
    WHERE mc_2001_channel = 'Facebook') / CAST(count(*) AS DOUBLE), 3) AS presence FROM responses GROUP BY cluster"""))
def m03(spark, sf):
    return mx.social_presence(responses(spark, sf), ROLES.channels)


@query("a22_significant_counts", upto("deliver", """SELECT targeting_seg AS cluster, count(*) AS n_significant,
    count(*) FILTER (WHERE contains(q_code, '_tgt')) AS n_significant_tgt FROM deliver WHERE chi_2_result <= 0.05
    GROUP BY targeting_seg"""))
def a22(spark, sf):
    return mx.significant_counts(inference(spark, sf).deliver)


def _spread_sql(where: str) -> str:
    return upto("deliver", f"""SELECT targeting_seg AS cluster, question_group, round(n_sig / CAST(n_group AS DOUBLE), 6)
    AS spread FROM (SELECT targeting_seg, split_part(q_code, '_', 1) AS question_group,
      count(*) FILTER (WHERE chi_2_result <= 0.05) AS n_sig,
      CAST(sum(count(*)) OVER (PARTITION BY split_part(q_code, '_', 1)) AS BIGINT) AS n_group
    FROM deliver WHERE {where} GROUP BY targeting_seg, split_part(q_code, '_', 1)) WHERE n_sig > 0""")


@query("a23_spread", _spread_sql("true"))
def a23(spark, sf):
    return mx.spread(inference(spark, sf).deliver).select("cluster", "question_group", _r("spread"))


@query("a23_spread_tgt", _spread_sql("contains(q_code, '_tgt')"))
def a23_tgt(spark, sf):
    return mx.spread(inference(spark, sf).deliver, targets_only=True).select("cluster", "question_group", _r("spread"))


def _slicer_sql(final: str) -> str:
    """The greedy walk unrolled: one step per column and pass, over counts of hit patterns."""
    share, step, steps = mx.SLICE_START, 0, []
    width = len(TGT)
    steps.append(f"""st0 AS MATERIALIZED (SELECT cluster, CAST(0 AS BIGINT) AS kept, width,
      CAST({share!r} AS DOUBLE) * sum(n) AS least FROM masks GROUP BY cluster, width)""")

    def rows(need: str) -> str:
        return f"(SELECT coalesce(sum(m.n), 0) FROM masks m WHERE m.cluster = s.cluster AND (m.mask & ({need})) = ({need}))"

    while share >= mx.SLICE_FLOOR:
        for j in range(width):
            bit = 1 << j
            steps.append(f"""st{step + 1} AS MATERIALIZED (SELECT cluster, width, least,
              CASE WHEN width > {j} AND {rows(f's.kept | {bit}')} >= least THEN kept | {bit} ELSE kept END AS kept FROM st{step} s)""")
            step += 1
        share -= mx.SLICE_STEP
        steps.append(f"""st{step + 1} AS MATERIALIZED (SELECT cluster, width, kept,
          CAST({share!r} AS DOUBLE) * {rows('s.kept')} AS least FROM st{step} s)""")
        step += 1
    extra = [SIZES, f"""picks AS (SELECT targeting_seg AS cluster, q_code, pop_mode,
        row_number() OVER (PARTITION BY targeting_seg ORDER BY chi_2_result, q_code) - 1 AS j,
        count(*) OVER (PARTITION BY targeting_seg) AS width FROM deliver WHERE contains(lower(q_code), 'tgt'))""",
             """masks AS (SELECT cluster, width, mask, count(*) AS n FROM (SELECT l.id, l.cluster, width,
        CAST(sum(CASE WHEN l.answer = p.pop_mode THEN 1 << j ELSE 0 END) AS BIGINT) AS mask FROM long l
        JOIN picks p ON p.cluster = l.cluster AND p.q_code = l.q_code GROUP BY l.id, l.cluster, width)
        GROUP BY cluster, width, mask)""", *steps,
             f"""slices AS (SELECT s.cluster, coalesce((SELECT string_agg(p.q_code, '|' ORDER BY p.j) FROM picks p
        WHERE p.cluster = s.cluster AND (s.kept >> p.j) & 1 = 1), '') AS core,
        CAST({rows('s.kept')} AS BIGINT) AS n_slice, {round(share, 6)} AS retained FROM st{step} s
        UNION ALL SELECT cluster, '', CAST(n AS BIGINT), {round(share, 6)} FROM sizes
        WHERE cluster NOT IN (SELECT cluster FROM picks))"""]
    return upto("deliver", final, extra)


@query("m04_core_slice", _slicer_sql("SELECT cluster, core, n_slice, CAST(retained AS DOUBLE) AS retained FROM slices"))
def m04(spark, sf):
    people = responses(spark, sf)
    pairs = mx.slice_columns(inference(spark, sf).deliver)
    return mx.core_slices(people, pairs).select("cluster", F.array_join("core", "|").alias("core"), "n_slice", "retained")


_SIGNAL = """SELECT cluster, CASE WHEN tp > 0 THEN round((tp + total - n - (sel - tp)) / total, 3) ELSE 0 END AS signal,
    CASE WHEN tp > 0 THEN round(tp / sel, 3) ELSE 0 END AS precision, CASE WHEN tp > 0 THEN round(tp / n, 3) ELSE 0 END AS recall_score,
    CASE WHEN tp > 0 THEN round(2 * round(tp / sel, 3) * round(tp / n, 3) / nullif(round(tp / sel, 3) + round(tp / n, 3), 0), 3)
      ELSE 0 END AS f1_score"""


@query("m05_chi2_signal", upto("responses", _SIGNAL + """ FROM (SELECT cluster, CAST(n AS DOUBLE) AS n,
    CAST(total AS DOUBLE) AS total, CAST(n AS DOUBLE) AS tp, CAST(total AS DOUBLE) AS sel FROM sizes)""", [SIZES]))
def m05(spark, sf):
    return mx.chi2_signal(ct.segment_sizes(responses(spark, sf)))


@query("m06_core_signal", _slicer_sql(_SIGNAL + """ FROM (SELECT cluster, CAST(n AS DOUBLE) AS n,
    CAST(total AS DOUBLE) AS total, CAST(n_slice AS DOUBLE) AS tp, CAST(n_slice AS DOUBLE) AS sel
    FROM sizes JOIN slices USING (cluster))"""))
def m06(spark, sf):
    people = responses(spark, sf)
    slices = mx.core_slices(people, mx.slice_columns(inference(spark, sf).deliver))
    return mx.chi2_signal(ct.segment_sizes(people), slices)


@query("m07_variability", upto("responses", """SELECT cluster, round(avg(share), 3) AS variability FROM (
    SELECT cluster, round((q - 1) / q * 100, 3) AS share FROM (
      SELECT cluster, (2 * (a * a + b * b) - (a + b) * (a + b)) / (2 * (a + b) - sq) AS q FROM (
        SELECT coalesce(cluster, 'all_clusters') AS cluster, CAST(sum(x) AS DOUBLE) AS a, CAST(sum(y) AS DOUBLE) AS b,
          CAST(sum((x + y) * (x + y)) AS DOUBLE) AS sq FROM (SELECT cluster,
            CASE WHEN sbeh_1002_returned_fb_tgt = 'selected' THEN 1 ELSE 0 END AS x,
            CASE WHEN sbeh_1002_accepted_fb_tgt = 'selected' THEN 1 ELSE 0 END AS y FROM responses)
        GROUP BY GROUPING SETS ((cluster), ())) WHERE 2 * (a + b) <> sq) WHERE q <> 0 AND (q - 1) / q > 0)
    GROUP BY cluster"""))
def m07(spark, sf):
    people = responses(spark, sf).select("id", "cluster", *TGT)
    encoded = cleaning.encode(people, TGT)
    return mx.variability(encoded).filter("variability IS NOT NULL")


@query("m09_magnitude", upto("deliver", f"""SELECT * FROM (
    SELECT cluster, magnitude FROM per UNION ALL SELECT 'all_clusters', round(sum(magnitude), 3) FROM per)
    WHERE (SELECT sum(magnitude) FROM per) > 0 AND (SELECT round(sum(magnitude), 3) FROM per) <= 1""",
    [SIZES, f"""per AS (SELECT s.cluster, round(round(s.n / CAST(s.total AS DOUBLE), 2) *
      (SELECT count(*) FROM deliver d WHERE d.targeting_seg = s.cluster AND contains(lower(d.q_code), 'tgt'))
      / {len(TGT)}, 3) AS magnitude FROM sizes s)"""]))
def m09(spark, sf):
    return mx.magnitude(inference(spark, sf).deliver, ct.segment_sizes(responses(spark, sf)), len(TGT))


@query("m10_message_reach", upto("responses", """SELECT cluster, round(round(fb / CAST(n AS DOUBLE), 3)
    * round(n / CAST(total AS DOUBLE), 3), 3) AS message_reach FROM (SELECT cluster, count(*) AS n,
    count(*) FILTER (WHERE mc_2001_channel = 'Facebook') AS fb, (SELECT count(*) FROM responses) AS total
    FROM responses GROUP BY cluster)"""))
def m10(spark, sf):
    people = responses(spark, sf)
    return mx.message_reach(mx.social_presence(people, ROLES.channels), mx.chi2_signal(ct.segment_sizes(people)))


@query("m11_ml_signal")
def m11(spark, sf):
    people = responses(spark, sf).select("id", "cluster", *TGT)
    return mx.ml_signal(cleaning.encode(people, TGT))


# --- quality -----------------------------------------------------------------------------------------

DIMS = 64


def vectors(spark, sf):
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("label"),
        *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(DIMS)])


EMB = [f"e{i}" for i in range(DIMS)]
_V = ("v AS (SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),"
      "long_v AS (SELECT id, label, unnest(x) AS x, unnest(range(1, 65)) AS j FROM v),"
      "centre AS (SELECT label, j, avg(x) AS m, var_pop(x) AS s2 FROM long_v GROUP BY label, j),"
      "sizes AS (SELECT label, count(*) AS n FROM v GROUP BY label),"
      "spread AS (SELECT label, sum(s2) AS s2 FROM centre GROUP BY label)")
_R_LONG = "long_r AS (" + " UNION ALL ".join(
    f"SELECT id, cluster AS label, CAST({c} AS DOUBLE) AS x, {i} AS j FROM responses" for i, c in enumerate(NUMERICS)) + ")"
_R = [_R_LONG, "centre AS (SELECT label, j, avg(x) AS m, var_pop(x) AS s2 FROM long_r GROUP BY label, j)",
      "sizes AS (SELECT label, count(*) AS n FROM responses_l GROUP BY label)",
      "spread AS (SELECT label, sum(s2) AS s2 FROM centre GROUP BY label)"]
_R.insert(0, "responses_l AS (SELECT *, cluster AS label FROM responses)")

_SIL = """SELECT round(avg(CASE WHEN inner_d IS NULL THEN 0 ELSE (outer_d - inner_d) / greatest(outer_d, inner_d) END), 6)
    AS silhouette FROM (
    SELECT id, min(CASE WHEN own = other AND n > 1 THEN (d2 + s2) * n / (n - 1) END) AS inner_d,
      min(CASE WHEN own <> other THEN d2 + s2 END) AS outer_d FROM (
      SELECT l.id, l.label AS own, c.label AS other, sum((l.x - c.m) * (l.x - c.m)) AS d2
      FROM {long} l JOIN centre c ON l.j = c.j GROUP BY l.id, l.label, c.label) p
    JOIN sizes ON sizes.label = other JOIN spread ON spread.label = other GROUP BY id)"""
_DB = """SELECT round(avg(worst), 6) AS davies_bouldin FROM (SELECT a.label, max((a.s + b.s) / g.gap) AS worst
    FROM (SELECT label, avg(d) AS s FROM (SELECT l.id, l.label, sqrt(sum((l.x - c.m) * (l.x - c.m))) AS d
        FROM {long} l JOIN centre c ON l.j = c.j AND l.label = c.label GROUP BY l.id, l.label) GROUP BY label) a
    JOIN (SELECT label, avg(d) AS s FROM (SELECT l.id, l.label, sqrt(sum((l.x - c.m) * (l.x - c.m))) AS d
        FROM {long} l JOIN centre c ON l.j = c.j AND l.label = c.label GROUP BY l.id, l.label) GROUP BY label) b
      ON a.label <> b.label
    JOIN (SELECT p.label AS one, q.label AS two, sqrt(sum((p.m - q.m) * (p.m - q.m))) AS gap FROM centre p
      JOIN centre q ON p.j = q.j GROUP BY p.label, q.label) g ON g.one = a.label AND g.two = b.label GROUP BY a.label)"""
_CH = """SELECT round((SELECT sum(n * (m - g) * (m - g)) FROM centre JOIN sizes USING (label)
      JOIN (SELECT j, avg(x) AS g FROM {long} GROUP BY j) USING (j)) / (k - 1)
    / ((SELECT sum(n * s2) FROM spread JOIN sizes USING (label)) / (n - k)), 4) AS calinski_harabasz
    FROM (SELECT count(*) AS k, sum(n) AS n FROM sizes)"""


def _score(df, features, label, what, places=6):
    return ql.score_table(df, features, [label]).select(_r(what, places))


@query("k01_silhouette_sq", "WITH " + _V + _SIL.format(long="long_v"))
def k01(spark, sf):
    return _score(vectors(spark, sf), EMB, "label", "silhouette")


@query("k01_silhouette_responses", upto("responses", _SIL.format(long="long_r"), _R))
def k01_responses(spark, sf):
    return _score(responses(spark, sf), NUMERICS, "cluster", "silhouette")


@query("k01_silhouette_euclidean", "WITH " + _V + """, pairs AS (SELECT a.id, a.label AS own, b.label AS other, sum(sqrt(
      greatest(list_sum(list_transform(list_zip(a.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 0))) AS t FROM v a JOIN v b ON true
    GROUP BY a.id, a.label, b.label)
  SELECT round(avg(CASE WHEN i IS NULL THEN 0 ELSE (o - i) / greatest(o, i) END), 6) AS silhouette FROM (
    SELECT id, max(CASE WHEN own = other AND n > 1 THEN t / (n - 1) END) AS i, min(CASE WHEN own <> other THEN t / n END) AS o
    FROM pairs JOIN sizes ON sizes.label = other GROUP BY id)""")
def k01_euclidean(spark, sf):
    return ql.silhouette_euclidean(vectors(spark, sf), EMB, "label").select(_r("silhouette"))


_GOWER = " + ".join([f"CASE WHEN a.{q} <> b.{q} THEN 1.0 ELSE 0.0 END" for q in QUESTIONS]
                    + [f"abs(a.{c} - b.{c}) / (SELECT max({c}) - min({c}) FROM responses)" for c in NUMERICS])


@query("k01_silhouette_gower", upto("responses", f"""SELECT round(avg(CASE WHEN greatest(inner_d, outer_d) > 0
      THEN (outer_d - inner_d) / greatest(inner_d, outer_d) ELSE 0 END), 6) AS silhouette
  FROM (SELECT id, max(CASE WHEN own = other THEN d / (n - 1) END) AS inner_d, min(CASE WHEN own <> other THEN d / n END) AS outer_d
    FROM (SELECT a.id, a.cluster AS own, b.cluster AS other, sum(({_GOWER}) / {len(QUESTIONS) + len(NUMERICS)}) AS d, count(*) AS n
      FROM responses a JOIN responses b ON true GROUP BY ALL) GROUP BY id)"""))
def k01_gower(spark, sf):
    return ql.silhouette_gower(responses(spark, sf), NUMERICS, QUESTIONS, "cluster").select(_r("silhouette"))


@query("x01_large_tail", """WITH cells AS (SELECT l_linenumber, l_partkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL),
  sides AS (SELECT *, sum(n) OVER (PARTITION BY l_linenumber, l_partkey) AS a, sum(n) OVER (PARTITION BY l_linenumber, l_returnflag) AS b,
    sum(n) OVER (PARTITION BY l_linenumber) AS total FROM cells),
  tests AS (SELECT l_linenumber, (count(DISTINCT l_partkey) - 1) * (count(DISTINCT l_returnflag) - 1) AS dof,
    sum(CAST(n AS DOUBLE) * n * total / (CAST(a AS DOUBLE) * b)) - max(total) AS stat FROM sides GROUP BY l_linenumber)
SELECT l_linenumber, CAST(dof AS BIGINT) AS dof, round(stat, 4) AS stat, round(list_sum(list_transform(range(CAST(dof // 2 AS BIGINT)),
  lambda i: exp(i * ln(stat / 2) - stat / 2 - lgamma(CAST(i + 1 AS DOUBLE))))), 8) AS p FROM tests""")
def x01(spark, sf):
    """Independence of part and return flag for each line number: thousands of degrees of freedom (even, as flags are three)."""
    cells = table(spark, sf, "lineitem").groupBy("l_linenumber", "l_partkey", "l_returnflag").agg(F.count("*").alias("n"))
    parts = cells.groupBy("l_linenumber", "l_partkey").agg(F.sum("n").alias("a"))
    flags = cells.groupBy("l_linenumber", "l_returnflag").agg(F.sum("n").alias("b"))
    whole = flags.groupBy("l_linenumber").agg(F.sum("b").alias("total"), F.count("*").alias("n_flags"))
    shares = cells.join(parts, ["l_linenumber", "l_partkey"]).join(flags, ["l_linenumber", "l_returnflag"])
    stat = F.sum(F.col("n").cast("double") * F.col("n") / (F.col("a").cast("double") * F.col("b")))
    tests = shares.groupBy("l_linenumber").agg(stat.alias("share")).join(whole, "l_linenumber").join(
        parts.groupBy("l_linenumber").agg(F.count("*").alias("n_parts")), "l_linenumber")
    out = tests.select("l_linenumber", ((F.col("n_parts") - 1) * (F.col("n_flags") - 1)).cast("long").alias("dof"),
                       (F.col("share") * F.col("total") - F.col("total")).alias("stat"))
    return out.select("l_linenumber", "dof", _r("stat", 4), F.round(chi2_upper_tail(F.col("stat"), F.col("dof")), 8).alias("p"))


@query("k02_davies_bouldin", "WITH " + _V + _DB.format(long="long_v"))
def k02(spark, sf):
    return _score(vectors(spark, sf), EMB, "label", "davies_bouldin")


@query("k03_calinski_harabasz", "WITH " + _V + _CH.format(long="long_v"))
def k03(spark, sf):
    return _score(vectors(spark, sf), EMB, "label", "calinski_harabasz", 4)


@query("k03_calinski_harabasz_responses", upto("responses", _CH.format(long="long_r"), _R))
def k03_responses(spark, sf):
    return _score(responses(spark, sf), NUMERICS, "cluster", "calinski_harabasz", 4)


# Run tables derived from the parts table: one 'run' per brand, its scores from the parts of the brand.
_RUNS_SQL = """WITH runs AS (SELECT row_number() OVER (ORDER BY p_brand) + 2 AS n_clusters,
    round(avg(p_retailprice), 0) AS silhouette, round(avg(p_size), 0) AS davies_bouldin, max(p_size) * 1.0 AS calinski_harabasz,
    sum(p_retailprice) AS cost, round(stddev_pop(p_retailprice), 0) AS bic, CAST(count(*) AS DOUBLE) AS aic
  FROM part GROUP BY p_brand),
ranked AS (SELECT *, rank() OVER (ORDER BY silhouette) + (count(*) OVER (PARTITION BY silhouette) - 1) / 2.0 AS silhouette_rank,
    rank() OVER (ORDER BY davies_bouldin DESC) + (count(*) OVER (PARTITION BY davies_bouldin) - 1) / 2.0 AS davies_bouldin_rank,
    rank() OVER (ORDER BY calinski_harabasz) + (count(*) OVER (PARTITION BY calinski_harabasz) - 1) / 2.0 AS calinski_harabasz_rank,
    1.3 * (rank() OVER (ORDER BY bic DESC) + (count(*) OVER (PARTITION BY bic) - 1) / 2.0) AS bic_rank,
    rank() OVER (ORDER BY aic DESC) + (count(*) OVER (PARTITION BY aic) - 1) / 2.0 AS aic_rank FROM runs),
chord AS (SELECT *, n_clusters - 3 AS i, (SELECT count(*) FROM runs) - 1 AS dx,
    (SELECT arg_max(cost, n_clusters) FROM runs) - (SELECT arg_min(cost, n_clusters) FROM runs) AS dy,
    cost - (SELECT arg_min(cost, n_clusters) FROM runs) AS rise FROM ranked),
bent AS (SELECT *, abs(dx * rise - dy * i) / sqrt(dx * dx + dy * dy) AS distance FROM chord),
marked AS (SELECT *, n_clusters = (SELECT n_clusters FROM bent ORDER BY distance DESC, n_clusters LIMIT 1) AS is_elbow FROM bent),
summed AS (SELECT *, CAST(silhouette_rank + davies_bouldin_rank + calinski_harabasz_rank
    + CASE WHEN is_elbow THEN dx + 1 ELSE 0 END AS DOUBLE) AS total FROM marked)
"""


def brand_runs(spark, sf):
    from pyspark.sql import Window
    price, size = F.col("p_retailprice"), F.col("p_size")
    return (table(spark, sf, "part").groupBy("p_brand").agg(
        F.round(F.avg(price), 0).alias("silhouette"), F.round(F.avg(size), 0).alias("davies_bouldin"),
        F.max(size).cast("double").alias("calinski_harabasz"), F.sum(price).alias("cost"),
        F.round(F.stddev_pop(price), 0).alias("bic"), F.count("*").cast("double").alias("aic"))
        .withColumn("n_clusters", F.row_number().over(Window.orderBy("p_brand")) + 2).drop("p_brand"))


@query("k05_rank_runs", _RUNS_SQL + """SELECT CAST(n_clusters AS INTEGER) AS n_clusters, CAST(silhouette_rank + davies_bouldin_rank
    + calinski_harabasz_rank + bic_rank + aic_rank AS DOUBLE) AS rank_sum FROM ranked""")
def k05(spark, sf):
    return ql.rank_runs(brand_runs(spark, sf), criteria=True).select("n_clusters", _r("rank_sum"))


@query("k10_balanced", """WITH shares AS (SELECT c_nationkey AS run, c_mktsegment, count(*) / CAST(sum(count(*)) OVER (
    PARTITION BY c_nationkey) AS DOUBLE) AS share FROM customer GROUP BY c_nationkey, c_mktsegment)
  SELECT run, count(*) AS n_clusters FROM shares GROUP BY run HAVING min(share) > 0.02 AND max(share) < 0.55""")
def k10(spark, sf):
    cells = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("run"), "c_mktsegment").count()
    runs = cells.groupBy("run").agg(
        F.map_from_entries(F.collect_list(F.struct("c_mktsegment", F.col("count").cast("double")))).alias("sizes"),
        F.sum("count").alias("n"))
    runs = runs.select("run", F.transform_values("sizes", lambda _, v: v / F.col("n")).alias("cluster_proportions"))
    return ql.balanced(runs).select("run", F.size("cluster_proportions").cast("long").alias("n_clusters"))


@query("k11_elbow", _RUNS_SQL + "SELECT CAST(n_clusters AS INTEGER) AS n_clusters, round(distance, 4) AS distance, is_elbow FROM marked")
def k11(spark, sf):
    return ql.elbow(brand_runs(spark, sf)).select("n_clusters", _r("distance", 4), "is_elbow")


@query("k12_best_k", _RUNS_SQL + """SELECT CAST(n_clusters AS INTEGER) AS n_clusters, total AS rank_sum,
    n_clusters = (SELECT n_clusters FROM summed ORDER BY total DESC, n_clusters LIMIT 1) AS is_best FROM summed""")
def k12(spark, sf):
    return ql.best_k(brand_runs(spark, sf)).select("n_clusters", _r("rank_sum"), "is_best")


def _ari_sql(source: str, a: str, b: str) -> str:
    return f"""cells AS (SELECT {a} AS a, {b} AS b, count(*) AS c FROM {source} GROUP BY {a}, {b}),
  s AS (SELECT (SELECT sum(c * (c - 1) / 2.0) FROM cells) AS both_,
    (SELECT sum(c * (c - 1) / 2.0) FROM (SELECT sum(c) AS c FROM cells GROUP BY a)) AS r,
    (SELECT sum(c * (c - 1) / 2.0) FROM (SELECT sum(c) AS c FROM cells GROUP BY b)) AS q,
    (SELECT sum(c) * (sum(c) - 1) / 2.0 FROM cells) AS t)
  SELECT round(CAST((both_ - r * q / t) / ((r + q) / 2 - r * q / t) AS DOUBLE), 6) AS ari FROM s"""


@query("k07_adjusted_rand", "WITH " + _ari_sql("labels", "quality", "toxic"))
def k07(spark, sf):
    return ql.adjusted_rand(table(spark, sf, "labels"), "quality", "toxic").select(_r("ari"))


@query("k07_adjusted_rand_responses", upto("responses", "", []).rstrip() + ",\n" + _ari_sql(
    "responses", "cluster", "psy_1004_size"))
def k07_responses(spark, sf):
    return ql.adjusted_rand(responses(spark, sf), "cluster", "psy_1004_size").select(_r("ari"))


@query("k06_random_ratio")
def k06(spark, sf):
    return ql.random_ratios(responses(spark, sf), NUMERICS, "cluster")
