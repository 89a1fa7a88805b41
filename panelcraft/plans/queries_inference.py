"""Scans, cleaning, lookups, crosstabs, tests and deliver tables over the responses view."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cleaning, crosstab as ct, deliver as dv, lookups
from ..roles import NOT_SELECTED, ColumnRoles
from ..sources import ledger as lg
from .oracle_parts import upto
from .registry import query
from .responses import NUMERICS, QUESTIONS, ROLES, WEIGHTED_ROLES, responses, table

PCT = "CAST(round(x * 100) AS BIGINT)"


def _r(column: str, places: int = 6):
    return F.round(F.col(column).cast("double"), places).alias(column)


def inference(spark, sf, correction="bonferroni", roles=ROLES):
    return dv.infer(responses(spark, sf), roles, correction=correction)


def joined(df):
    """Arrays as text, so that both engines show the same value."""
    out = df
    for f in df.schema.fields:
        if f.dataType.simpleString() == "array<string>":
            out = out.withColumn(f.name, F.array_join(f.name, "|"))
        elif f.dataType.simpleString() == "array<double>":
            out = out.withColumn(f.name, F.array_join(F.transform(
                f.name, lambda v: F.round(v * 100).cast("long").cast("string")), "|"))
    return out


@query("s01_scan_responses", upto("responses", f"""SELECT id, cluster, {', '.join(QUESTIONS)}, round(weight, 6) AS weight,
  n_lines, round(spend, 6) AS spend, round(avg_disc, 6) AS avg_disc, round(max_qty, 6) AS max_qty FROM responses"""))
def s01(spark, sf):
    return responses(spark, sf).select("id", "cluster", *QUESTIONS, _r("weight"), "n_lines", _r("spend"),
                                       _r("avg_disc"), _r("max_qty"))


@query("s10_ledger_pending", """SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS survey, 'pending' AS status
  FROM orders WHERE month(o_orderdate) % 2 = 1""")
def s10(spark, sf):
    months = (table(spark, sf, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("survey"))
              .agg(F.max("o_orderdate").alias("modified_on")))
    even = F.substring("survey", 6, 2).cast("int") % 2 == 0
    ledger = months.withColumn("processed_by", F.when(even, F.array(F.lit("segments"))).otherwise(F.array()))
    return lg.pending(ledger, "segments").select("survey", F.lit("pending").alias("status"))


@query("p11_fill_missing", upto("responses", """SELECT id,
    CASE WHEN id % 7 = 0 OR dem_priority = '5-LOW' THEN 'not selected' ELSE dem_priority END AS dem_priority,
    CASE WHEN id % 7 = 0 THEN -999 ELSE n_lines END AS n_lines FROM responses"""))
def p11(spark, sf):
    gaps = responses(spark, sf).select(
        "id", F.when(F.col("id") % 7 != 0, F.when(F.col("dem_priority") == "5-LOW", "None")
                     .otherwise(F.col("dem_priority"))).alias("dem_priority"),
        F.when(F.col("id") % 7 != 0, F.col("n_lines")).alias("n_lines"))
    return cleaning.fill_missing(cleaning.none_text_to_missing(gaps), numbers=True)


@query("p14_numeric_coercion", upto("responses", """SELECT 'dem_priority' AS "column",
    count(*) FILTER (WHERE TRY_CAST(dem_priority AS DOUBLE) IS NULL) = 0 AS is_numeric,
    count(*) FILTER (WHERE TRY_CAST(dem_priority AS DOUBLE) IS NULL) AS n_bad FROM responses
  UNION ALL SELECT 'cluster', count(*) FILTER (WHERE TRY_CAST(cluster AS DOUBLE) IS NULL) = 0,
    count(*) FILTER (WHERE TRY_CAST(cluster AS DOUBLE) IS NULL) FROM responses
  UNION ALL SELECT 'mc_2001_channel', count(*) FILTER (WHERE TRY_CAST(mc_2001_channel AS DOUBLE) IS NULL) = 0,
    count(*) FILTER (WHERE TRY_CAST(mc_2001_channel AS DOUBLE) IS NULL) FROM responses"""))
def p14(spark, sf):
    return cleaning.numeric_report(responses(spark, sf), ["dem_priority", "cluster", "mc_2001_channel"])


@query("p17_label_encode", upto("long", """SELECT q_code, answer,
    CAST(row_number() OVER (PARTITION BY q_code ORDER BY answer) - 1 AS INTEGER) AS code
  FROM (SELECT DISTINCT q_code, answer FROM long)"""))
def p17(spark, sf):
    return cleaning.label_codes(responses(spark, sf), QUESTIONS)


@query("p18_not_shown", upto("long", """SELECT q_code, count(*) AS n_before,
    count(*) FILTER (WHERE answer <> 'Not shown') AS n_after FROM long GROUP BY q_code"""))
def p18(spark, sf):
    return cleaning.not_shown_counts(responses(spark, sf), QUESTIONS)


@query("p23_standardise", upto("responses", "SELECT id, " + ", ".join(
    f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS {c}" for c in NUMERICS) + " FROM responses"))
def p23(spark, sf):
    return cleaning.standardise(responses(spark, sf), NUMERICS).select("id", *[_r(c) for c in NUMERICS])


@query("j01_manual_labels", """SELECT o_orderkey AS alchemer_id, o_custkey AS cint_id,
    CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS qudo_market
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def j01(spark, sf):
    people = table(spark, sf, "orders").select(F.col("o_orderkey").alias("alchemer_id"),
                                               F.col("o_custkey").alias("cint_id"))
    hand = (table(spark, sf, "customer").filter("c_custkey % 3 <> 0")
            .select(F.col("c_custkey").alias("ID"), F.col("c_mktsegment").alias("Market")))
    return lookups.attach_manual_labels(people, cleaning.manual_label_names(hand))


@query("j02_attach_labels", upto("responses", """SELECT r.id, l.qudo_segment FROM responses r LEFT JOIN
    (SELECT id, CASE WHEN max_qty >= 40 THEN 1 ELSE 0 END AS qudo_segment FROM responses WHERE cluster <> '0') l
    ON r.id = l.id"""))
def j02(spark, sf):
    people = responses(spark, sf)
    labels = people.filter("cluster <> '0'").select(
        "id", F.when(F.col("max_qty") >= 40, 1).otherwise(0).alias("qudo_segment"))
    return lookups.attach_labels(people.select("id"), labels)


@query("j03_decode_answers", upto("responses", """SELECT id, coalesce(n_name, CAST(psy_1004_size AS VARCHAR)) AS psy_1004_size,
    coalesce(CASE WHEN dem_priority = '1-URGENT' THEN 'urgent' END, dem_priority) AS dem_priority
  FROM responses LEFT JOIN (SELECT 'mid' AS v, min(n_name) AS n_name FROM nation) ON v = psy_1004_size"""))
def j03(spark, sf):
    people = responses(spark, sf).select("id", "psy_1004_size", "dem_priority")
    size = table(spark, sf, "nation").agg(F.min("n_name").alias("option_text")).select(
        F.lit("psy_1004_size").alias("varname"), F.lit("mid").alias("option_value"), "option_text")
    prio = (table(spark, sf, "orders").select(F.lit("dem_priority").alias("varname"),
                                              F.col("o_orderpriority").alias("option_value")).distinct()
            .withColumn("option_text", F.when(F.col("option_value") == "1-URGENT", "urgent")
                        .otherwise(F.col("option_value"))))
    return lookups.decode_answers(people, size.unionByName(prio), ["psy_1004_size", "dem_priority"])


@query("j04_rename_segments", upto("responses", """SELECT cluster AS unencoded_seg, CASE cluster WHEN '0' THEN 'light'
    WHEN '1' THEN 'middle' ELSE 'heavy' END AS targeting_seg, count(*) AS n FROM responses GROUP BY cluster"""))
def j04(spark, sf):
    people = responses(spark, sf)
    names = people.select(F.col("cluster").alias("label"),
                          F.when(F.col("cluster") == "0", "light").when(F.col("cluster") == "1", "middle")
                          .otherwise("heavy").alias("name"))
    sizes = people.groupBy(F.col("cluster").alias("targeting_seg")).agg(F.count("*").alias("n"))
    return lookups.rename_segments(sizes, names)


@query("a01_proportions", upto("responses", """SELECT cluster, count(*) AS n,
    round(count(*) / CAST((SELECT count(*) FROM responses) AS DOUBLE), 6) AS share FROM responses GROUP BY cluster"""))
def a01(spark, sf):
    return ct.segment_sizes(responses(spark, sf)).select("cluster", "n", _r("share"))


@query("a10_weighted_proportions", upto("responses", """SELECT cluster, round(sum(weight), 4) AS weighted_n,
    round(sum(weight) / (SELECT count(*) FROM responses), 6) AS weighted_share FROM responses GROUP BY cluster"""))
def a10(spark, sf):
    return ct.segment_sizes(responses(spark, sf), weight="weight").select(
        "cluster", _r("weighted_n", 4), _r("weighted_share"))


@query("a02_crosstab", upto("usable", """SELECT a.q_code, a.answer, c.cluster, coalesce(s.n, 0) AS n
  FROM (SELECT DISTINCT q_code, answer FROM shown) a JOIN (SELECT DISTINCT q_code, cluster FROM shown) c USING (q_code)
  LEFT JOIN shown s ON s.q_code = a.q_code AND s.answer = a.answer AND s.cluster = c.cluster"""))
def a02(spark, sf):
    return ct.dense_crosstab(ct.answer_counts(responses(spark, sf), ROLES))


@query("a03_sparse_drop", upto("usable", "SELECT q_code, answer, cluster, n FROM usable"))
def a03(spark, sf):
    return ct.usable_crosstab(ct.answer_counts(responses(spark, sf), ROLES)).select("q_code", "answer", "cluster", "n")


@query("a04_percent", upto("cells", """SELECT q_code, answer, cluster, n,
    round(n / CAST(col_total AS DOUBLE) * 100, 1) AS perc FROM cells"""))
def a04(spark, sf):
    return ct.percent(ct.usable_crosstab(ct.answer_counts(responses(spark, sf), ROLES)))


@query("a05_expected", upto("cells", "SELECT q_code, answer, cluster, n, round(expected, 6) AS expected FROM cells"))
def a05(spark, sf):
    return inference(spark, sf).table.select("q_code", "answer", "cluster", "n", _r("expected"))


@query("a06_chi2", upto("tests", "SELECT q_code, round(stat, 4) AS stat, dof, round(p, 6) AS p FROM tests"))
def a06(spark, sf):
    return inference(spark, sf).tests.select("q_code", _r("stat", 4), "dof", _r("p"))


@query("a07_direction", upto("cells", "SELECT q_code, answer, cluster, n > expected AS more FROM cells"))
def a07(spark, sf):
    return ct.residuals(inference(spark, sf).table).select("q_code", "answer", "cluster", "more")


@query("a08_residuals", upto("flags", "SELECT q_code, answer, cluster, residual FROM resid"))
def a08(spark, sf):
    return ct.residuals(inference(spark, sf).table).select("q_code", "answer", "cluster", "residual")


@query("a09_post_hoc_bonferroni", upto("flags", "SELECT q_code, answer, cluster, flag FROM flagged"))
def a09(spark, sf):
    return inference(spark, sf).cells.select("q_code", "answer", "cluster", "flag")


@query("a09_post_hoc_plain", upto("plain_flags", "SELECT q_code, answer, cluster, flag FROM flagged"))
def a09_plain(spark, sf):
    return inference(spark, sf, correction=None).cells.select("q_code", "answer", "cluster", "flag")


@query("a11_modes", upto("modes", "SELECT q_code, cluster, mode, round(mode_perc, 2) AS mode_perc FROM modes"))
def a11(spark, sf):
    return ct.modes(ct.answer_counts(responses(spark, sf), ROLES))


@query("a12_weighted_modes", upto("modes", """SELECT q_code, cluster, answer AS weighted_mode,
    round(w / w_size * 100, 0) AS weighted_mode_perc FROM (
    SELECT *, row_number() OVER (PARTITION BY q_code, cluster ORDER BY round(w, 6) DESC, answer) AS rn
    FROM sized WHERE answer <> 'Not shown') WHERE rn = 1"""))
def a12(spark, sf):
    return ct.weighted_modes(ct.answer_counts(responses(spark, sf), WEIGHTED_ROLES))


@query("a19_segment_modes", upto("modes", """SELECT q_code, cluster, answer AS mode,
    round(n * 100.0 / size, 2) AS mode_perc FROM (
    SELECT *, row_number() OVER (PARTITION BY q_code, cluster ORDER BY n DESC, answer) AS rn FROM sized) WHERE rn = 1"""))
def a19(spark, sf):
    return ct.modes(ct.answer_counts(responses(spark, sf), ROLES), include_not_shown=True)


@query("a13_categories", upto("deliver", """SELECT f.q_code, f.answer, f.cluster, f.n, round(expected, 2) AS expected,
    freq_perc, weighted_perc, round(w, 4) AS weighted_n, flag, bool_or(flag = 'pos') OVER (PARTITION BY f.q_code, f.cluster) AS target
  FROM flagged f JOIN shares s ON f.q_code = s.q_code AND f.answer = s.answer AND f.cluster = s.cluster
  JOIN counts c ON f.q_code = c.q_code AND f.answer = c.answer AND f.cluster = c.cluster"""))
def a13(spark, sf):
    found = inference(spark, sf, roles=WEIGHTED_ROLES)
    return dv.categories(found.cells, found.summary).select(
        "q_code", "answer", "cluster", "n", _r("expected", 2), "freq_perc", "weighted_perc", F.round("w", 4).alias("weighted_n"),
        "flag", "target")


@query("a16_deliver", upto("deliver", """SELECT q_code, pop_mode, CAST(100 AS DOUBLE) AS response_rate, mode_pop_perc,
    chi_2_result, sig_more_category, category_percentages, targeting_seg, chi2_stat FROM deliver"""))
def a16(spark, sf):
    return joined(inference(spark, sf).deliver)


@query("a16_deliver_weighted", upto("deliver", """SELECT d.q_code, targeting_seg, sig_more_category, weighted_mode AS weighted_pop_mode,
    weighted_mode_perc AS weighted_pop_mode_perc FROM deliver d JOIN (
    SELECT q_code, cluster, answer AS weighted_mode, round(w / w_size * 100, 0) AS weighted_mode_perc FROM (
      SELECT *, row_number() OVER (PARTITION BY q_code, cluster ORDER BY round(w, 6) DESC, answer) AS rn
      FROM sized WHERE answer <> 'Not shown') WHERE rn = 1) m ON d.q_code = m.q_code AND d.targeting_seg = m.cluster"""))
def a16_weighted(spark, sf):
    return joined(inference(spark, sf, roles=WEIGHTED_ROLES).deliver).select(
        "q_code", "targeting_seg", "sig_more_category", "weighted_pop_mode", "weighted_pop_mode_perc")


@query("a18_discover", upto("deliver", """SELECT q_code, pop_mode AS mode, mode_pop_perc AS mode_perc, sig_more_category,
    category_percentages, targeting_seg, chi2_stat, rank FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY targeting_seg ORDER BY chi_2_result, q_code) AS INTEGER) AS rank
    FROM deliver WHERE pop_mode NOT IN ('not selected', 'Not shown')) WHERE rank <= 10"""))
def a18(spark, sf):
    return joined(inference(spark, sf).discover)


@query("a21_response_rate", upto("responses", """SELECT 'dem_priority' AS q_code,
    round(count(*) FILTER (WHERE id % 7 <> 0) * 100 / CAST(count(*) AS DOUBLE), 4) AS response_rate FROM responses"""))
def a21(spark, sf):
    gaps = responses(spark, sf).select("id", "cluster", F.when(F.col("id") % 7 != 0, F.col("dem_priority"))
                                       .alias("dem_priority"))
    return ct.response_rates(ct.answer_counts(gaps, ColumnRoles("id", None, ["dem_priority"])))


__all__ = ["NOT_SELECTED"]
