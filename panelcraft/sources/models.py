"""Fitted segmentations as versioned tables: what labels new respondents, without the rows they were fitted on.

A model is a Parquet table of (name, at, text, value): every array of the model, one number a row under its place, the columns'
names, and the dictionary of answers each coded column was fitted on. A version is a folder, ``<path>/version=<n>``; the reader
takes the newest one that was written whole, or the one asked for. Nothing is pickled, so another program can read it, and a
stored model outlives the code that fitted it. FORMAT is raised when the meaning of a name changes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.batch import add_columns
from ..operators.centres import Centres
from ..operators.latent import Classes
from ..operators.mixture import Mixture
from ..operators.reduce import Axes
from ..operators.segment import Segmentation

FORMAT = 1
SCHEMA = "name string, at array<int>, text string, value double"


@dataclass
class StoredModel:
    """A model read back: its kind, its columns, and the dictionary of answers (q_code, answer, code) where it was stored."""

    algorithm: str
    numeric: list[str]
    codes: list[str]
    model: Centres | Classes | Mixture
    answers: DataFrame | None
    version: int

    def label(self, df: DataFrame, id_col: str = "id", name: str = "cluster") -> DataFrame:
        """id and label of respondents whose coded columns hold the codes of the fit; null where a code is null or unknown."""
        model, p = self.model, len(self.numeric)

        def labels(v: np.ndarray) -> list[np.ndarray]:
            x, codes, fine = v[:, :p], v[:, p:], np.isfinite(v).all(1)
            x, codes = np.where(fine[:, None], x, 0.0), np.where(fine[:, None], codes, 0).astype(np.int64)
            if isinstance(model, Classes):
                for q, a in enumerate(model.answers):
                    fine &= codes[:, q] < a.shape[1]
                    codes[:, q] = np.minimum(codes[:, q], a.shape[1] - 1)
                own = model.joint(codes, x).argmax(1) + 1
            elif isinstance(model, Mixture):
                own = model.joint(x).argmax(1)
            else:
                own = model.distances(model.axes.project(x) if model.axes is not None else x, codes).argmin(1)
            return [np.where(fine, own, -1)]

        made = add_columns(df.select(id_col, *[c for c in (*self.numeric, *self.codes) if c != id_col]),
                           [*self.numeric, *self.codes], {name: "int"}, labels)
        return made.select(id_col, F.when(F.col(name) >= 0, F.col(name)).alias(name))

    def encode(self, df: DataFrame, id_col: str = "id") -> DataFrame:
        """Respondents with their answers replaced by the codes of the fit, in one join for all columns (ids are unique).

        A missing answer is the empty answer, as when the dictionary was made; an answer the model never saw gets null.
        """
        if self.answers is None:
            return df
        coded = [c for c in [*self.codes, *self.numeric] if c in self.coded_columns()]
        plain = df.select(id_col, *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in coded])
        long = plain.unpivot([id_col], coded, "q_code", "answer").join(self.answers, ["q_code", "answer"], "left")
        wide = long.groupBy(id_col).agg(*[F.max(F.when(F.col("q_code") == c, F.col("code"))).alias(c) for c in coded])
        return df.drop(*coded).join(wide, id_col)

    def coded_columns(self) -> set[str]:
        return {r[0] for r in self.answers.select("q_code").distinct().collect()}  # at most one for each column


def _rows(seg: Segmentation, numeric: list[str], codes: list[str]) -> list[tuple]:
    rows: list[tuple] = [("format", [], None, float(FORMAT)), ("algorithm", [], seg.algorithm, None)]
    rows += [("numeric", [i], c, None) for i, c in enumerate(numeric)] + [("code", [i], c, None) for i, c in enumerate(codes)]

    def put(name: str, array) -> None:
        array = np.asarray(array, dtype=float)
        rows.append((name + ".shape", list(array.shape), None, None))
        rows.extend((name, [int(i) for i in at], None, float(x)) for at, x in np.ndenumerate(array))

    m = seg.model
    if isinstance(m, Centres):
        put("centres.numeric", m.numeric)
        put("centres.modes", m.modes)
        rows.append(("centres.gamma", [], None, float(m.gamma)))
        if m.axes is not None:
            for part in ("mean", "scale", "vectors", "ratio"):
                put("axes." + part, getattr(m.axes, part))
    elif isinstance(m, Classes):
        for part in ("weight", "mean", "variance"):
            put("classes." + part, getattr(m, part))
        for q, a in enumerate(m.answers):
            put(f"classes.answers.{q}", a)
    elif isinstance(m, Mixture):
        for part in ("log_weight", "mean", "covariance", "strength", "freedom"):
            put("mixture." + part, getattr(m, part))
    else:
        raise ValueError("only centres, latent classes and mixtures can be stored")
    return rows


def newest(spark: SparkSession, path: str) -> int | None:
    """The newest version under ``path``; none where nothing is stored."""
    try:
        return spark.read.parquet(path).agg(F.max("version")).first()[0]
    except Exception as problem:
        if "PATH_NOT_FOUND" in str(problem) or "UNABLE_TO_INFER_SCHEMA" in str(problem):
            return None
        raise


def save(seg: Segmentation, path: str, numeric: list[str], codes: list[str], spark: SparkSession,
         answers: DataFrame | None = None) -> int:
    """Write ``seg`` as the next version and give its number. ``numeric`` and ``codes`` are its columns in the order of the fit;
    ``answers`` (q_code, answer, code) is the dictionary of its coded columns, of any size."""
    version = (newest(spark, path) or 0) + 1
    table = spark.createDataFrame(_rows(seg, numeric, codes), SCHEMA)
    if answers is not None:
        table = table.unionByName(answers.where(F.col("q_code").isin(*numeric, *codes)).select(
            F.concat(F.lit("answer."), "q_code").alias("name"), F.array(F.col("code").cast("int")).alias("at"),
            F.col("answer").alias("text"), F.lit(None).cast("double").alias("value")))
    table.write.parquet(f"{path}/version={version}")
    return version


def load(spark: SparkSession, path: str, version: int | None = None) -> StoredModel:
    version = version or newest(spark, path)
    if version is None:
        raise FileNotFoundError(f"no model under {path}")
    table = spark.read.parquet(f"{path}/version={version}")
    numbers = table.where(~F.col("name").startswith("answer.")).collect()  # as many as the model has numbers
    held: dict[str, list] = {}
    for r in numbers:
        held.setdefault(r["name"], []).append(r)
    if held["format"][0]["value"] != FORMAT:
        raise ValueError(f"format {held['format'][0]['value']:g} is not {FORMAT}")

    def names(kind: str) -> list[str]:
        return [r["text"] for r in sorted(held.get(kind, []), key=lambda r: r["at"])]

    def array(name: str) -> np.ndarray:
        out = np.zeros(held[name + ".shape"][0]["at"])
        for r in held.get(name, []):
            out[tuple(r["at"])] = r["value"]
        return out

    numeric, codes = names("numeric"), names("code")
    if "centres.gamma" in held:
        axes = Axes(numeric, *[array("axes." + part) for part in ("mean", "scale", "vectors", "ratio")]) if "axes.mean.shape" in held else None
        model = Centres(array("centres.numeric"), array("centres.modes"), held["centres.gamma"][0]["value"], axes=axes)
    elif "classes.weight.shape" in held:
        model = Classes(array("classes.weight"), [array(f"classes.answers.{q}") for q in range(len(codes))],
                        array("classes.mean"), array("classes.variance"))
    else:
        model = Mixture(*[array("mixture." + part) for part in ("log_weight", "mean", "covariance", "strength", "freedom")])
    answers = table.where(F.col("name").startswith("answer.")).select(
        F.substring("name", len("answer.") + 1, 1_000).alias("q_code"), F.col("text").alias("answer"), F.col("at")[0].alias("code"))
    return StoredModel(held["algorithm"][0]["text"], numeric, codes, model, None if answers.isEmpty() else answers, version)
