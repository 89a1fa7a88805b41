"""Files in and out. All paths are Spark paths, so any store the cluster can reach will do."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CONFIG_SCHEMA = T.StructType([
    T.StructField("project_name", T.StringType()),
    T.StructField("essential_columns", T.StructType([
        T.StructField("overview_columns", T.ArrayType(T.StringType())),
        T.StructField("segmentation_columns", T.ArrayType(T.StringType()))])),
    T.StructField("weighting", T.StructType([
        T.StructField("perform", T.BooleanType()),
        T.StructField("utility", T.StructType([
            T.StructField("pre_completes", T.BooleanType()), T.StructField("post_completes", T.BooleanType()),
            T.StructField("census", T.BooleanType())])),
        T.StructField("targets", T.ArrayType(T.MapType(T.StringType(), T.StringType())))]))])


def run_id(now: dt.datetime | None = None) -> str:
    """Name of a run's folder; no colons, which some stores refuse."""
    return (now or dt.datetime.now(dt.timezone.utc)).strftime("%Y-%m-%d_%H-%M-%S")


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_codebook(spark: SparkSession, root: str, survey: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{survey}/{survey}.parquet").select("varname", "option_text", "option_value")


def read_manual_labels(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    return spark.read.csv(path, header=True, schema=", ".join(f"`{c}` string" for c in columns))


def read_names(spark: SparkSession, path: str) -> list[str]:
    """A JSON list of column names."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.from_json("value", "array<string>").alias("names")).first()["names"]


def write_names(spark: SparkSession, names: list[str], path: str) -> None:
    """Audit trail of the columns chosen, as the same JSON list."""
    spark.createDataFrame([(names,)], "names array<string>").select(F.to_json("names").alias("value")).coalesce(1).write.text(path)


def read_config(spark: SparkSession, path: str) -> dict:
    return spark.read.schema(CONFIG_SCHEMA).json(path, multiLine=True).first().asDict(recursive=True)


def metrics_rows(metrics: DataFrame) -> DataFrame:
    """One row per algorithm: a JSON column per metric, from segment to value. Holds metrics x segments entries."""
    entry = F.coalesce(F.col("value").cast("string"), F.col("text"), F.lit(""))
    per = metrics.groupBy("algorithm", "metric").agg(F.to_json(F.map_from_entries(
        F.array_sort(F.collect_list(F.struct("cluster", entry.alias("value")))))).alias("json"))
    return per.groupBy("algorithm").agg(F.to_json(F.map_from_entries(
        F.array_sort(F.collect_list(F.struct("metric", "json"))))).alias("metrics"))


def write_reports(reports: list, base: str) -> None:
    """Labels and inference tables as parquet by algorithm, metrics as CSV."""
    from ..plans.report import metrics_table

    metrics = metrics_table(reports).persist()
    metrics.write.mode("overwrite").parquet(f"{base}/metrics_long")
    metrics_rows(metrics).coalesce(1).write.mode("overwrite").csv(f"{base}/metrics", header=True, escape='"')
    metrics.unpersist()
    for r in reports:
        folder = r.segmentation.algorithm.replace(" ", "_")
        if r.segmentation.labels is None:
            continue
        r.segmentation.labels.write.mode("overwrite").parquet(f"{base}/labels/algorithm={folder}")
        for name in ("deliver", "discover", "modes"):
            getattr(r.inference, name).write.mode("overwrite").parquet(f"{base}/{name}/algorithm={folder}")
