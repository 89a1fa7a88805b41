"""What a column is follows from its name; this is decided once, on the driver, from the column list."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Name fragments and answer sentinels that carry meaning in the data sets.
STUDY_MARKS = ("sbeh", "aida")
PLATFORM_MARKS = ("_fb", "_gg")
TARGET_MARK = "_tgt"
NUMERIC_MARK = "_numeric"
GIVEN_SEGMENT_MARKS = ("qudo", "cluster")
GIVEN_SEGMENT_EXCEPTION = "qudo_weight_precompletes"
MANUAL_PREFIX = "qudo_"
MANUAL_KEYS = ("vrid", "id")
PANEL_MARK = "cint"
WEIGHT_MARKS = ("weight", "segmentation", "cint", "qudo_weight")
NOT_SELECTED = "not selected"
NOT_SHOWN = "Not shown"
MISSING_NUMBER = -999


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


@dataclass(frozen=True)
class ColumnRoles:
    """Columns of a responses table by role; built from ``df.columns`` without touching a row."""

    id: str
    weight: str | None
    questions: list[str]
    numeric: list[str] = field(default_factory=list)

    @property
    def targets(self) -> list[str]:
        return [c for c in self.questions if "tgt" in c.lower()]

    @property
    def channels(self) -> list[str]:
        return [c for c in self.questions if "mc_" in c]

    @staticmethod
    def of(df: DataFrame, id_col: str = "id", weight: str | None = None, segment: str | None = "cluster",
           include_numeric: bool = False) -> "ColumnRoles":
        numeric, questions = [], []
        for f in df.schema.fields:
            if f.name in (id_col, segment, weight):
                continue
            if any(mark in f.name.lower() for mark in WEIGHT_MARKS):
                continue
            if is_numeric(f.dataType):
                numeric.append(f.name)
                if include_numeric:
                    questions.append(f.name)
            else:
                questions.append(f.name)
        return ColumnRoles(id_col, weight, questions, numeric)


def numeric_and_categorical(df: DataFrame, columns: list[str]) -> tuple[list[str], list[str]]:
    kinds = {f.name: f.dataType for f in df.schema.fields}
    numeric = [c for c in columns if is_numeric(kinds[c])]
    return numeric, [c for c in columns if c not in numeric]


def choose_family(df: DataFrame, columns: list[str]) -> str:
    """``kmodes`` when no column is numeric, ``kprototypes`` otherwise."""
    numeric, _ = numeric_and_categorical(df, columns)
    return "kprototypes" if numeric else "kmodes"


def study_columns(df: DataFrame) -> list[str]:
    found = [c for c in df.columns if any(m in c for m in STUDY_MARKS)]
    if not found:
        raise ValueError("No SBEH columns present.")
    return found


def columns_with_fragments(df: DataFrame, fragments: list[str]) -> list[str]:
    """Columns holding each fragment, in the order of the fragments."""
    return [c for fragment in fragments for c in df.columns if fragment.lower() in c]


def given_segment_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns
            if any(m in c for m in GIVEN_SEGMENT_MARKS) and c != GIVEN_SEGMENT_EXCEPTION]


def weight_column(df: DataFrame, config: dict) -> str | None:
    """Weight column named by the flags of the study config, or none when it is not in the data."""
    utility = config["weighting"]["utility"]
    pre, post = bool(utility["pre_completes"]), bool(utility["post_completes"])
    wanted = "weight" if post else ("precompletion_weight" if pre else None)
    return wanted if wanted in df.columns else None
