"""What sets a segment apart: the deliver, discover and mode tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..roles import NOT_SELECTED, NOT_SHOWN, ColumnRoles
from . import crosstab as ct

TOP_FEATURES = 10


@dataclass
class Inference:
    """Tables of one labelling; each is a lazy plan over the same small crosstab."""

    counts: DataFrame
    table: DataFrame
    tests: DataFrame
    cells: DataFrame
    summary: DataFrame
    deliver: DataFrame
    discover: DataFrame
    modes: DataFrame


def categories(cells: DataFrame, summary: DataFrame) -> DataFrame:
    """Tested cells with their shares over the whole segment and the question's target flag."""
    target = cells.groupBy("q_code", "cluster").agg(F.bool_or(F.col("flag") == "pos").alias("target"))
    return ct.with_shares(cells, summary).join(target, ["q_code", "cluster"])


def deliver_table(cells: DataFrame, summary: DataFrame, weighted: bool = False) -> DataFrame:
    """One row per segment and question with answers given more often than expected.

    'not selected' leaves answers and percentages together; rows without another answer are dropped. The
    arrays hold answers of one question only, each of them with at least ``MIN_CELL`` rows in every segment.
    """
    pos = cells.filter((F.col("flag") == "pos") & (F.col("answer") != NOT_SELECTED))
    rows = ct.with_shares(pos, summary).groupBy("q_code", "cluster").agg(
        F.array_sort(F.collect_list(F.struct("answer", "freq_perc", "weighted_perc"))).alias("found"),
        *[F.first(c).alias(c) for c in ("mode", "mode_perc", "weighted_mode", "weighted_mode_perc", "response_rate",
                                        "p", "stat")])
    columns = [
        "q_code", F.col("mode").alias("pop_mode"), "response_rate", F.col("mode_perc").alias("mode_pop_perc"),
        F.round("p", 5).alias("chi_2_result"), F.col("found.answer").alias("sig_more_category"),
        F.col("found.freq_perc").alias("category_percentages"), F.col("cluster").alias("targeting_seg"),
        F.round("stat", 2).alias("chi2_stat"),
    ]
    if weighted:
        columns += [F.col("weighted_mode").alias("weighted_pop_mode"),
                    F.col("weighted_mode_perc").alias("weighted_pop_mode_perc"),
                    F.col("found.weighted_perc").alias("weighted_category_percentages")]
    return rows.select(*columns)


def discover_table(deliver: DataFrame, top: int = TOP_FEATURES) -> DataFrame:
    """The strongest questions of each segment whose mode says something; rank 1 is the strongest."""
    order = Window.partitionBy("targeting_seg").orderBy("chi_2_result", "q_code")
    return (deliver.filter(~F.col("pop_mode").isin(NOT_SELECTED, NOT_SHOWN))
            .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .drop("response_rate", "chi_2_result")
            .withColumnsRenamed({"pop_mode": "mode", "mode_pop_perc": "mode_perc"}))


def infer(responses: DataFrame, roles: ColumnRoles, segment: str = "cluster",
          confidence: float = ct.CONFIDENCE, correction: str | None = "bonferroni") -> Inference:
    """Test every question against the segments.

    The counts, the tested table and the deliver table are kept: they are small next to the respondents, and all later tables read
    them. A lost executor only makes Spark count again.
    """
    return infer_counts(ct.answer_counts(responses, roles, segment), roles.weight is not None, confidence, correction)


def infer_counts(counts: DataFrame, weighted: bool = False, confidence: float = ct.CONFIDENCE,
                 correction: str | None = "bonferroni") -> Inference:
    counts = counts.persist()
    table = ct.expected(ct.usable_crosstab(counts)).persist()
    tests = ct.chi2_tests(table)
    cells = ct.post_hoc(table, tests, confidence, correction)
    summary = ct.segment_summary(counts)
    deliver = deliver_table(cells, summary, weighted).persist()
    return Inference(counts, table, tests, cells, summary, deliver, discover_table(deliver),
                     ct.modes(counts, include_not_shown=True))


def release(found: Inference) -> None:
    """Drop the kept tables of a labelling that is done with."""
    for kept in (found.deliver, found.table, found.counts):
        kept.unpersist()
