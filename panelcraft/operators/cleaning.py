"""Missing values, numeric coercion, label codes, standard scores and column renames."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..roles import (GIVEN_SEGMENT_MARKS, MANUAL_KEYS, MANUAL_PREFIX, MISSING_NUMBER, NOT_SELECTED, NOT_SHOWN,
                     NUMERIC_MARK, PANEL_MARK, PLATFORM_MARKS, TARGET_MARK, is_numeric)
from ..session import cut_lineage

WINDOW_SAFE_LEVELS = 1_000_000


def _strings(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def fill_missing(df: DataFrame, numbers: bool = False) -> DataFrame:
    """Missing text means the option was not ticked; missing numbers get the sentinel when asked for."""
    df = df.na.fill(NOT_SELECTED, _strings(df))
    if numbers:
        df = df.na.fill(MISSING_NUMBER, [f.name for f in df.schema.fields if is_numeric(f.dataType)])
    return df


def none_text_to_missing(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The text ``None`` is a missing value."""
    return df.withColumns({c: F.nullif(F.col(c), F.lit("None")) for c in columns or _strings(df)})


def numeric_report(df: DataFrame, columns: list[str]) -> DataFrame:
    """One scan for all columns: how many present values do not read as a number."""
    counts = df.agg(*[F.count_if(F.col(c).isNotNull() & F.expr(f"try_cast(`{c}` AS DOUBLE)").isNull()).alias(c)
                      for c in columns])
    return (counts.unpivot([], columns, "column", "n_bad")
            .select("column", (F.col("n_bad") == 0).alias("is_numeric"), "n_bad"))


def coerce_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """Cast the columns whose every present value is a number; leave the others as they are."""
    clean = {r["column"] for r in numeric_report(df, columns).collect() if r["is_numeric"]}
    return df.withColumns({c: F.col(c).cast("double") for c in columns if c in clean})


def answer_levels(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct (q_code, answer); partial aggregation shrinks the unpivoted rows before the shuffle."""
    return (df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns])
            .unpivot([], columns, "q_code", "answer")
            .groupBy("q_code", "answer").count().drop("count"))


def label_codes(df: DataFrame, columns: list[str], window_limit: int = WINDOW_SAFE_LEVELS) -> DataFrame:
    """Dictionary (q_code, answer, code); codes count up from 0 in sorted answer order.

    A question with at most ``window_limit`` distinct answers is ranked in one window. Beyond that the
    dictionary is range-partitioned, ranked inside each range and shifted by the sizes of the ranges before.
    """
    levels = answer_levels(df, columns)
    largest = levels.groupBy("q_code").count().agg(F.max("count")).first()[0] or 0
    if largest <= window_limit:
        return levels.withColumn(
            "code", F.row_number().over(Window.partitionBy("q_code").orderBy("answer")) - 1)
    return range_ranked_codes(levels)


def range_ranked_codes(levels: DataFrame) -> DataFrame:
    ranged = cut_lineage(levels.repartitionByRange("q_code", "answer")
                         .withColumn("part", F.spark_partition_id()))
    local = ranged.withColumn(
        "rn", F.row_number().over(Window.partitionBy("q_code", "part").orderBy("answer")))
    before = Window.partitionBy("q_code").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy("q_code", "part").agg(F.count("*").alias("n"))
               .withColumn("shift", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n"))
    return (local.join(offsets, ["q_code", "part"])
            .select("q_code", "answer", (F.col("rn") + F.col("shift") - 1).cast("int").alias("code")))


def encode(df: DataFrame, columns: list[str], literal_levels: int = 64) -> DataFrame:
    """Replace each column by its label code.

    Questions with few levels become a position in a literal sorted list, which needs no join; the others
    join their part of the dictionary.
    """
    numeric = [c for c in columns if is_numeric(df.schema[c].dataType)]
    columns = [c for c in columns if c not in numeric]
    if not columns:
        return df
    codes = label_codes(df, columns)
    sizes = {r["q_code"]: r["count"] for r in codes.groupBy("q_code").count().collect()}
    few = [c for c in columns if sizes.get(c, 0) <= literal_levels]
    levels: dict[str, list[str]] = {c: [] for c in few}
    for r in codes.filter(F.col("q_code").isin(few)).orderBy("q_code", "code").collect():
        levels[r["q_code"]].append(r["answer"])
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns}
    out = df.withColumns({
        c: (F.array_position(F.array(*[F.lit(v) for v in levels[c]]), text[c]) - 1).cast("int") for c in few})
    for c in [c for c in columns if c not in few]:
        side = codes.filter(F.col("q_code") == c).select(F.col("answer").alias("__a"), F.col("code").alias("__c"))
        out = (out.withColumn("__k", F.coalesce(F.col(c).cast("string"), F.lit("")))
               .join(side, F.col("__k") == F.col("__a"), "left")
               .withColumn(c, F.col("__c")).drop("__k", "__a", "__c"))
    return out


def standardise(df: DataFrame, columns: list[str], suffix: str = "") -> DataFrame:
    """Mean 0 and population deviation 1 per column; a constant column becomes 0."""
    stats = df.agg(*[f(F.col(c).cast("double")).alias(f"{n}_{c}")
                     for c in columns for n, f in (("m", F.avg), ("s", F.stddev_pop))])
    row = stats.first()
    return df.withColumns({
        c + suffix: (F.col(c).cast("double") - F.lit(row[f"m_{c}"])) / F.lit(row[f"s_{c}"])
        if row[f"s_{c}"] else F.lit(0.0) for c in columns})


# --- names ------------------------------------------------------------------------------------------


def mark_targets(df: DataFrame, selected: list[str]) -> tuple[DataFrame, list[str]]:
    """Add the target suffix to platform questions, unless a selected column carries it already."""
    if any(TARGET_MARK in c for c in selected):
        return df, selected

    def renamed(c: str) -> str:
        return c + TARGET_MARK if any(m in c for m in PLATFORM_MARKS) else c

    return df.withColumnsRenamed({c: renamed(c) for c in df.columns}), [renamed(c) for c in selected]


def strip_numeric_mark(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({c: c.replace(NUMERIC_MARK, "") for c in df.columns})


def manual_label_names(df: DataFrame) -> DataFrame:
    """Lower-case names; every column but the keys is a given segment and gets the prefix for it."""
    def renamed(c: str) -> str:
        low = c.lower()
        return low if low in MANUAL_KEYS or PANEL_MARK in low else MANUAL_PREFIX + low

    return df.toDF(*[renamed(c) for c in df.columns])


def drop_panel_columns(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if PANEL_MARK in c or "qudo_weight" in c])


def drop_repeated_names(df: DataFrame) -> DataFrame:
    """Keep the first of columns that share a name."""
    first = [i for i, c in enumerate(df.columns) if c not in df.columns[:i]]
    positional = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return positional.select(*[F.col(f"c{i}").alias(df.columns[i]) for i in first])


def drop_given_segments(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.drop(*columns)


def not_shown_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of each question before and after the questions that were not shown are taken out."""
    long = df.select(*columns).unpivot([], columns, "q_code", "answer")
    return long.groupBy("q_code").agg(
        F.count("*").alias("n_before"), F.count_if(F.col("answer") != NOT_SHOWN).alias("n_after"))


__all__ = [n for n in dir() if not n.startswith("_")] + ["GIVEN_SEGMENT_MARKS"]
