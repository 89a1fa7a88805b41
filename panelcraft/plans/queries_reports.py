"""Whole reports over the responses view."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cleaning, search as se, segment as sg
from ..roles import ColumnRoles
from . import report as rp
from .oracle_parts import upto
from .queries_segments import CODED, encoded
from .registry import query
from .responses import NUMERICS, QUESTIONS, ROLES, responses

FEATURES = [*CODED, *NUMERICS]


def _all_encoded(spark, sf):
    return encoded(spark, sf, QUESTIONS).drop("cluster").persist()


@query("c01_rules_based", upto("deliver", """SELECT 'rules-based - cluster' AS algorithm, targeting_seg AS unencoded_seg, 'segment ' || targeting_seg AS targeting_seg,
    q_code, pop_mode, chi_2_result, sig_more_category FROM deliver"""))
def c01(spark, sf):
    people = responses(spark, sf).withColumn("qudo_segment", F.concat(F.lit("segment "), "cluster")).drop("cluster")
    codes = cleaning.encode(people.select("id", F.col("qudo_segment").alias("cluster")), ["cluster"])
    from ..operators import deliver as dv
    from ..operators.lookups import rename_segments
    found = dv.infer(people.drop("qudo_segment").join(codes, "id"), ROLES)
    names = people.join(codes, "id").select(F.col("cluster").alias("label"), F.col("qudo_segment").alias("name"))
    return rename_segments(found.deliver, names).select(
        F.lit("rules-based - cluster").alias("algorithm"), "unencoded_seg", "targeting_seg", "q_code", "pop_mode",
        "chi_2_result", F.array_join("sig_more_category", "|").alias("sig_more_category"))


@query("m12_report")
def m12(spark, sf):
    people = responses(spark, sf).withColumnRenamed("cluster", "qudo_cluster")
    return rp.rules_based(people, ROLES, ["qudo_cluster"], CODED)[0].metrics


@query("c06_kmeans_report")
def c06(spark, sf):
    coded = _all_encoded(spark, sf)
    seg = sg.kmeans_pca(coded, FEATURES)
    return rp.report(responses(spark, sf).drop("cluster"), coded, ROLES, seg, FEATURES).metrics


@query("c18_run_all")
def c18(spark, sf):
    coded = _all_encoded(spark, sf)
    people = responses(spark, sf).withColumnRenamed("cluster", "qudo_cluster")
    roles = ColumnRoles("id", None, QUESTIONS, NUMERICS)
    searches = rp.all_searches(NUMERICS, QUESTIONS) | {"lca": se.ClassSearch(QUESTIONS), "k-modes": se.k_family([], QUESTIONS)}
    return rp.metrics_table(rp.run_all(people, coded, roles, searches, QUESTIONS, ["qudo_cluster"]))


@query("c18_run_all_hierarchical")
def c18_inside(spark, sf):
    coded = encoded(spark, sf, QUESTIONS).persist()
    people = responses(spark, sf).drop("cluster")
    return rp.metrics_table(rp.run_all_hierarchical(people, coded, ROLES, "cluster",
                                                    lambda: rp.all_searches([], QUESTIONS, True), QUESTIONS, ignored=["2"]))
