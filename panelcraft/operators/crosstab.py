"""Crosstabs of every question against the segments, chi-squared tests and post-hoc residuals.

Respondents are read once: unpivot, then one aggregate by (question, answer, segment). All that follows works
on that table. Its rows are spread by (question, answer), so a question with very many distinct answers does not
fall to one task; windows over a question only ever see one row per segment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.special import chi2_upper_tail, normal_two_sided
from ..roles import NOT_SELECTED, NOT_SHOWN, ColumnRoles

# Smallest usable cell, critical residual, default confidence.
MIN_CELL = 5
CRITICAL_Z = 1.96
CONFIDENCE = 0.95


def answer_counts(responses: DataFrame, roles: ColumnRoles, segment: str = "cluster") -> DataFrame:
    """(q_code, answer, cluster, n, n_present, w): the only pass over respondents.

    Missing answers and the text ``None`` count as not selected; ``n_present`` remembers how many were given.
    """
    weight = F.col(roles.weight).cast("double") if roles.weight else F.lit(1.0)
    asked = responses.select(F.col(segment).cast("string").alias("cluster"), weight.alias("w"),
                             *[F.col(c).cast("string").alias(c) for c in roles.questions])
    long = asked.unpivot(["cluster", "w"], roles.questions, "q_code", "raw")
    given = F.nullif(F.col("raw"), F.lit("None"))
    return (long.withColumn("answer", F.coalesce(given, F.lit(NOT_SELECTED)))
            .groupBy("q_code", "answer", "cluster")
            .agg(F.count(F.lit(1)).alias("n"), F.count(given).alias("n_present"), F.sum("w").alias("w")))


def _questions(counts: DataFrame) -> DataFrame:
    """(q_code, partly, segments): whether a question was not shown to some, and the segments it was shown to."""
    hidden = F.col("answer") == NOT_SHOWN
    return (counts.groupBy("q_code").agg(
        F.max(hidden).alias("partly"),
        F.collect_set(F.when(~hidden, F.col("cluster"))).alias("segments"))
        .withColumn("segments", F.when(F.col("partly"), F.array_remove("segments", NOT_SHOWN))
                    .otherwise(F.col("segments"))))


def _rows(counts: DataFrame) -> DataFrame:
    """One row per answer with its cells as an array of at most one entry per segment.

    Answers 'Not shown' leave, and for questions that have any also the segments named so.
    """
    rows = (counts.filter(F.col("answer") != NOT_SHOWN).groupBy("q_code", "answer")
            .agg(F.collect_list(F.struct("cluster", "n", "w")).alias("cells")))
    return rows.join(_questions(counts), "q_code").withColumn(
        "cells", F.filter("cells", lambda c: F.array_contains("segments", c["cluster"])))


def dense_crosstab(counts: DataFrame) -> DataFrame:
    """Every answer against every segment seen for the question, missing cells as 0."""
    n = F.aggregate("cells", F.lit(0).cast("long"), lambda acc, c: acc + F.when(
        c["cluster"] == F.col("cluster"), c["n"]).otherwise(0))
    return (_rows(counts).select("q_code", "answer", "cells", F.explode("segments").alias("cluster"))
            .select("q_code", "answer", "cluster", n.alias("n")))


def usable_crosstab(counts: DataFrame, min_cell: int = MIN_CELL) -> DataFrame:
    """Crosstab without the answers that have a cell below ``min_cell`` (an empty cell counts as 0)."""
    big = F.size(F.filter("cells", lambda c: c["n"] >= min_cell))
    total = F.aggregate("cells", F.lit(0).cast("long"), lambda acc, c: acc + c["n"])
    return (_rows(counts).filter(big == F.size("segments"))
            .select("q_code", "answer", total.alias("row_total"), F.inline("cells")))


def expected(crosstab: DataFrame) -> DataFrame:
    """Adds column and table totals with the expected count; also the table's shape.

    Every usable answer has a cell in every segment, so the rows of a table are the cells of one segment. The
    window runs over the segments of a question only.
    """
    question = Window.partitionBy("q_code")
    col = (crosstab.groupBy("q_code", "cluster")
           .agg(F.sum("n").alias("col_total"), F.count(F.lit(1)).alias("n_rows"))
           .withColumns({"total": F.sum("col_total").over(question),
                         "n_cols": F.count(F.lit(1)).over(question)}))
    return (crosstab.join(col, ["q_code", "cluster"])
            .withColumn("expected", F.col("row_total") * F.col("col_total") / F.col("total")))


def percent(crosstab: DataFrame) -> DataFrame:
    """Share of each answer within its segment in percent, one decimal."""
    col = crosstab.groupBy("q_code", "cluster").agg(F.sum("n").alias("col_total"))
    return (crosstab.join(col, ["q_code", "cluster"])
            .withColumn("perc", F.round(F.col("n") / F.col("col_total") * 100, 1))
            .select("q_code", "answer", "cluster", "n", "perc"))


def residuals(table: DataFrame) -> DataFrame:
    """Adjusted residual of each cell, three decimals, and whether the cell holds more than expected."""
    e, total = F.col("expected"), F.col("total")
    spread = F.sqrt(e * (1 - F.col("row_total") / total) * (1 - F.col("col_total") / total))
    return table.withColumns({
        "more": F.col("n") > e,
        "residual": F.round(F.when(spread > 0, (F.col("n") - e) / spread), 3),
    })


def chi2_tests(table: DataFrame) -> DataFrame:
    """(q_code, stat, dof, p) from a table of ``expected``; continuity correction when dof is 1."""
    dof = (F.col("n_rows") - 1) * (F.col("n_cols") - 1)
    gap = F.abs(F.col("n") - F.col("expected"))
    gap = F.when(dof == 1, gap - F.least(gap, F.lit(0.5))).otherwise(gap)
    tests = (table.withColumn("dof", dof)
             .groupBy("q_code", "dof").agg(F.sum(gap * gap / F.col("expected")).alias("stat")))
    stat = F.when(F.col("dof") == 0, F.lit(0.0)).otherwise(F.col("stat"))
    return (tests.withColumn("stat", stat)
            .select("q_code", "stat", F.col("dof").cast("int").alias("dof"))
            .withColumn("p", chi2_upper_tail(F.col("stat"), F.col("dof"))))


def post_hoc(table: DataFrame, tests: DataFrame, confidence: float = CONFIDENCE,
             correction: str | None = "bonferroni") -> DataFrame:
    """Flags cells ``pos``, ``neg`` or ``neu``; with the correction the bound shrinks by the table size."""
    alpha = 1.0 - confidence
    flagged = residuals(table).join(tests.select("q_code", "stat", "p"), "q_code")
    hit = (F.col("p") <= alpha) & (F.abs("residual") >= CRITICAL_Z)
    if correction == "bonferroni":
        bound = F.lit(alpha) / (F.col("n_rows") * F.col("n_cols"))
        hit = hit & (normal_two_sided(F.col("residual")) <= bound)
    elif correction is not None:
        raise ValueError("correction is 'bonferroni' or None")
    return flagged.withColumn(
        "flag", F.when(hit & F.col("more"), "pos").when(hit, "neg").otherwise("neu"))


def segment_sizes(responses: DataFrame, segment: str = "cluster", weight: str | None = None) -> DataFrame:
    """Rows and share of each segment; with a weight also its weighted size over the row count."""
    sums = [F.count(F.lit(1)).alias("n")]
    if weight:
        sums.append(F.sum(F.col(weight).cast("double")).alias("weighted_n"))
    sizes = responses.groupBy(F.col(segment).cast("string").alias("cluster")).agg(*sums)
    total = F.sum("n").over(Window.partitionBy())  # over one row per segment
    shares = {"share": F.col("n") / total}
    if weight:
        shares["weighted_share"] = F.col("weighted_n") / total
    return sizes.withColumns(shares)


def segment_summary(counts: DataFrame) -> DataFrame:
    """Per question and segment: sizes, modes and answer rate, all from one aggregate.

    The smallest (-n, answer) is the most frequent answer with ties to the smallest one. ``mode`` and
    ``weighted_mode`` leave out 'Not shown'; ``mode_all`` does not. Percentages are over the whole segment.
    """
    shown = F.col("answer") != NOT_SHOWN
    w = F.round("w", 6)
    out = counts.groupBy("q_code", "cluster").agg(
        F.sum("n").alias("size"), F.sum("w").alias("w_size"), F.sum("n_present").alias("n_present"),
        F.min(F.when(shown, F.struct((-F.col("n")).alias("n"), "answer"))).alias("m"),
        F.min(F.struct((-F.col("n")).alias("n"), "answer")).alias("ma"),
        F.min(F.when(shown, F.struct((-w).alias("w"), "answer"))).alias("mw"))
    question = Window.partitionBy("q_code")
    return out.select(
        "q_code", "cluster", "size", "w_size",
        F.col("m.answer").alias("mode"), F.round(-F.col("m.n") / F.col("size") * 100, 2).alias("mode_perc"),
        F.col("ma.answer").alias("mode_all"), F.round(-F.col("ma.n") / F.col("size") * 100, 2).alias("mode_all_perc"),
        F.col("mw.answer").alias("weighted_mode"),
        F.round(-F.col("mw.w") / F.col("w_size") * 100, 0).alias("weighted_mode_perc"),
        F.round(F.sum("n_present").over(question) / F.sum("size").over(question) * 100, 4).alias("response_rate"))


def modes(counts: DataFrame, include_not_shown: bool = False) -> DataFrame:
    """Most frequent answer per segment and question, ties to the smallest answer."""
    mode = "mode_all" if include_not_shown else "mode"
    return segment_summary(counts).select(
        "q_code", "cluster", F.col(mode).alias("mode"), F.col(mode + "_perc").alias("mode_perc"))


def weighted_modes(counts: DataFrame) -> DataFrame:
    """Answer with the largest summed weight per segment and question, ties to the smallest answer."""
    return segment_summary(counts).select("q_code", "cluster", "weighted_mode", "weighted_mode_perc")


def with_shares(cells: DataFrame, summary: DataFrame) -> DataFrame:
    """Share of each answer in its segment over all rows, plain and weighted, two decimals."""
    return cells.join(summary, ["q_code", "cluster"]).withColumns({
        "freq_perc": F.round(F.col("n") / F.col("size") * 100, 2),
        "weighted_perc": F.round(F.col("w") / F.col("w_size") * 100, 2)})


def response_rates(counts: DataFrame) -> DataFrame:
    """Share of respondents who answered, taken before missing answers are filled."""
    return counts.groupBy("q_code").agg(
        F.round(F.sum("n_present") / F.sum("n") * 100, 4).alias("response_rate"))
