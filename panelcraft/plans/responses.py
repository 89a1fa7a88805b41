"""The responses table of the shipped test data: one row per order, answers derived from its lines.

Segments and answers depend on each other by construction; ``dem_priority`` is a negative control.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..roles import NOT_SELECTED, ColumnRoles

QUESTIONS = ["sbeh_1001_lines_tgt", "sbeh_1002_returned_fb_tgt", "sbeh_1002_accepted_fb_tgt", "sbeh_1003_open_gg_tgt",
             "psy_1004_size", "dem_priority", "mc_2001_channel"]
NUMERICS = ["n_lines", "spend", "avg_disc", "max_qty"]
ROLES = ColumnRoles("id", None, QUESTIONS, NUMERICS)
WEIGHTED_ROLES = ColumnRoles("id", "weight", QUESTIONS, NUMERICS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines are aggregated by order before the join, so both sides meet on one partitioning by order key."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        (F.sum(F.round(F.col("l_extendedprice") * 100).cast("long")) / 100).alias("spend"),
        (F.sum(F.round(F.col("l_discount") * 100).cast("long")) / (100 * F.count(F.lit(1)))).alias("avg_disc"),
        F.max("l_quantity").alias("max_qty"),
        F.bool_or(F.col("l_returnflag") == "R").alias("returned"),
        F.bool_or(F.col("l_returnflag") == "A").alias("accepted"),
        F.bool_or(F.col("l_linestatus") == "O").alias("open"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")

    def ticked(flag: str):
        return F.when(F.col(flag), "selected").otherwise(NOT_SELECTED)

    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("id"),
        F.when(F.col("spend") < 60000, "0").when(F.col("spend") < 200000, "1").otherwise("2").alias("cluster"),
        F.when(F.col("n_lines") <= 2, "1-2").when(F.col("n_lines") <= 4, "3-4").otherwise("5+")
        .alias("sbeh_1001_lines_tgt"),
        ticked("returned").alias("sbeh_1002_returned_fb_tgt"),
        ticked("accepted").alias("sbeh_1002_accepted_fb_tgt"),
        ticked("open").alias("sbeh_1003_open_gg_tgt"),
        F.when(F.col("max_qty") < 25, "small").when(F.col("max_qty") < 40, "mid").otherwise("big")
        .alias("psy_1004_size"),
        F.col("o_orderpriority").alias("dem_priority"),
        F.when(F.col("o_orderstatus") == "F", "Facebook").when(F.col("o_orderstatus") == "O", "Google")
        .otherwise("Not shown").alias("mc_2001_channel"),
        (F.lit(0.5) + F.pmod(F.col("l_orderkey"), F.lit(10)) / 10.0).alias("weight"),
        "n_lines", "spend", "avg_disc", "max_qty")


RESPONSES_SQL = """
lines AS (
  SELECT l_orderkey, count(*) AS n_lines,
    sum(CAST(round(l_extendedprice * 100) AS BIGINT)) / 100.0 AS spend,
    sum(CAST(round(l_discount * 100) AS BIGINT)) / (100.0 * count(*)) AS avg_disc,
    max(l_quantity) AS max_qty,
    bool_or(l_returnflag = 'R') AS returned, bool_or(l_returnflag = 'A') AS accepted,
    bool_or(l_linestatus = 'O') AS opened
  FROM lineitem GROUP BY l_orderkey),
responses AS (
  SELECT l_orderkey AS id,
    CASE WHEN spend < 60000 THEN '0' WHEN spend < 200000 THEN '1' ELSE '2' END AS cluster,
    CASE WHEN n_lines <= 2 THEN '1-2' WHEN n_lines <= 4 THEN '3-4' ELSE '5+' END AS sbeh_1001_lines_tgt,
    CASE WHEN returned THEN 'selected' ELSE 'not selected' END AS sbeh_1002_returned_fb_tgt,
    CASE WHEN accepted THEN 'selected' ELSE 'not selected' END AS sbeh_1002_accepted_fb_tgt,
    CASE WHEN opened THEN 'selected' ELSE 'not selected' END AS sbeh_1003_open_gg_tgt,
    CASE WHEN max_qty < 25 THEN 'small' WHEN max_qty < 40 THEN 'mid' ELSE 'big' END AS psy_1004_size,
    o_orderpriority AS dem_priority,
    CASE o_orderstatus WHEN 'F' THEN 'Facebook' WHEN 'O' THEN 'Google' ELSE 'Not shown' END AS mc_2001_channel,
    CAST(0.5 AS DOUBLE) + (l_orderkey % 10) / CAST(10 AS DOUBLE) AS weight,
    n_lines, CAST(spend AS DOUBLE) AS spend, CAST(avg_disc AS DOUBLE) AS avg_disc, max_qty
  FROM lines JOIN orders ON l_orderkey = o_orderkey)
"""
