"""The whole job for one survey: clean, decode, attach labels, choose columns, segment, explain and save."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import cleaning, lookups, segment as sg
from ..operators.selection import rank_features
from ..roles import ColumnRoles, columns_with_fragments, given_segment_columns
from ..sources import files
from .report import Report, report, rules_based

# Columns, neighbours, kernel width and clusters of the automatic selection.
SELECTION = (40, 5, 1, 4)


def prepare(df: DataFrame, codebook: DataFrame | None = None, manual: DataFrame | None = None) -> DataFrame:
    """Filled, decoded responses with hand-made segments attached."""
    df = cleaning.fill_missing(df)
    if codebook is not None:
        df = lookups.decode_answers(df, codebook, [c for c in df.columns if c != "cint_id"])
    if manual is not None:
        df = lookups.attach_manual_labels(df, cleaning.manual_label_names(manual))
    return df


def segment_survey(spark: SparkSession, data: str | DataFrame, out: str, survey: str, codebook: DataFrame | None = None,
                   columns: str | list[str] | None = None, manual: DataFrame | None = None, preprocessed: str | None = None,
                   weight: str | None = None, given: list[str] | None = None, id_col: str = "id", **search) -> str:
    """Run k-means on principal components with its report, and the given segments if asked for.

    ``columns`` is the path of a JSON list, a list of name fragments, or nothing for automatic selection. Returns
    the folder everything was written to.
    """
    run = files.run_id()
    base = f"{out}/{survey}/{run}"
    df = prepare(spark.read.parquet(data) if isinstance(data, str) else data, codebook, manual)
    numeric_view = None
    if preprocessed:
        numeric_view = cleaning.fill_missing(spark.read.parquet(preprocessed), numbers=True)
    if isinstance(columns, str):
        chosen = files.read_names(spark, columns)
    else:
        chosen = columns_with_fragments(df, columns) if columns else rank_features(
            numeric_view if numeric_view is not None else df, *SELECTION, id_col=id_col)
        files.write_names(spark, chosen, f"{base}/columns")
    df, chosen = cleaning.mark_targets(df, chosen)
    if numeric_view is not None:
        numeric_view, _ = cleaning.mark_targets(cleaning.strip_numeric_mark(numeric_view), [])
        chosen = [c.replace("_numeric", "") for c in chosen]
    segments = given if given is not None else given_segment_columns(df)
    roles = ColumnRoles.of(df, id_col, weight)
    roles = ColumnRoles(roles.id, roles.weight, [q for q in roles.questions if q not in segments], roles.numeric)
    source = numeric_view if numeric_view is not None else df
    encoded = cleaning.encode(source.select(id_col, *[c for c in source.columns if c != id_col and c in
                                                      {*roles.questions, *roles.numeric, *chosen}]),
                              [c for c in source.columns if c in {*roles.questions, *chosen}]).persist()
    seg = sg.kmeans_pca(encoded, chosen, id_col, **search)
    reports: list[Report] = [report(df, encoded, roles, seg, chosen)]
    if given:
        reports += rules_based(df, roles, given, [c for c in chosen if c in roles.questions])
    files.write_reports(reports, base)
    encoded.unpersist()
    return base
