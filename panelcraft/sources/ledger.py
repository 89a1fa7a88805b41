"""The ledger of surveys: what is pending for a step, and what a run did."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pending(ledger: DataFrame, step: str, key: str = "survey") -> DataFrame:
    """Surveys that ``step`` has not processed: anti-join on the exploded marks."""
    done = (ledger.select(key, F.explode("processed_by").alias("step")).filter(F.col("step") == step)
            .select(key).distinct())
    return ledger.join(done, key, "left_anti")


def mark_done(ledger: DataFrame, done: DataFrame, step: str, key: str = "survey") -> DataFrame:
    """Ledger with ``step`` added to the marks of the surveys in ``done``."""
    marks = done.select(key, F.lit(True).alias("__done")).distinct()
    return (ledger.join(marks, key, "left")
            .withColumn("processed_by", F.when(
                F.col("__done"), F.array_union("processed_by", F.array(F.lit(step)))).otherwise(F.col("processed_by")))
            .drop("__done"))


def run_pending(ledger: DataFrame, step: str, work: Callable[[str], str], key: str = "survey") -> tuple[DataFrame, DataFrame]:
    """Run ``work(survey)`` for each pending survey; a fault is recorded and the next survey goes on.

    Surveys are few and each is a Spark job of its own. Returns the marked ledger and the run log
    (survey, outcome, detail).
    """
    log = []
    for row in pending(ledger, step, key).select(key).orderBy(key).toLocalIterator():
        try:
            log.append((row[0], "done", str(work(row[0]))))
        except Exception as fault:  # one bad survey must not stop the others
            log.append((row[0], "failed", f"{type(fault).__name__}: {fault}"))
    spark = ledger.sparkSession
    runs = spark.createDataFrame(log, f"{key} string, outcome string, detail string")
    return mark_done(ledger, runs.filter("outcome = 'done'"), step, key), runs
