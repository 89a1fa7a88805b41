"""Linear reduction of wide tables: principal axes and the mixed-data (FAMD) matrix."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batch import refuse_gaps

# Share of variance that decides the number of components.
VARIANCE_SHARE = 0.5
GRID_VARIANCE_SHARE = 0.75


@dataclass
class Axes:
    """Principal axes of a table; p x p numbers, held on the driver."""

    columns: list[str]
    mean: np.ndarray
    scale: np.ndarray
    vectors: np.ndarray
    ratio: np.ndarray

    def keep(self, n: int) -> "Axes":
        return Axes(self.columns, self.mean, self.scale, self.vectors[:, :n], self.ratio[:n])

    def share(self, wanted: float) -> "Axes":
        """As few components as reach the wanted share of variance."""
        return self.keep(int(np.searchsorted(np.cumsum(self.ratio), wanted - 1e-12) + 1))

    def project(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.vectors


@dataclass
class Gram:
    """Means, deviations and correlations of columns: all that the axes of any subset of them need."""

    columns: list[str]
    mean: np.ndarray
    deviation: np.ndarray
    correlation: np.ndarray

    def axes(self, columns: list[str] | None = None, standardise: bool = True) -> Axes:
        columns = columns or self.columns
        at = [self.columns.index(c) for c in columns]
        dev = self.deviation[at]
        target = self.correlation[np.ix_(at, at)]
        if not standardise:
            target = target * np.outer(dev, dev)
        values, vectors = np.linalg.eigh(target)
        order = np.argsort(-values)
        values, vectors = np.maximum(values[order], 0.0), vectors[:, order]
        lead = vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])]
        vectors = vectors * np.where(lead < 0, -1.0, 1.0)
        total = values.sum()
        scale = np.where(dev > 0, dev, 1.0) if standardise else np.ones(len(at))
        return Axes(columns, self.mean[at], scale, vectors, values / total if total > 0 else values)


def _gaps(name: str) -> Column:
    return F.count_if(F.col(name).isNull() | F.isnan(name))


def gram(df: DataFrame, columns: list[str]) -> Gram:
    """Correlations by ``ml.stat`` (a distributed p x p sum) and population moments by one aggregate.

    Missing values raise: no row is left out."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation

    plain = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)])
    names = plain.columns
    row = plain.agg(*[f(c).alias(k + c) for c in names for k, f in (
        ("m", F.avg), ("s", F.stddev_pop), ("g", _gaps))]).first()
    refuse_gaps({c: row["g" + x] for c, x in zip(columns, names) if row["g" + x]})
    deviation = np.array([row["s" + c] or 0.0 for c in names])
    if len(columns) == 1:
        corr = np.ones((1, 1))
    else:
        vectors = VectorAssembler(inputCols=names, outputCol="x").transform(plain).select("x")
        corr = np.nan_to_num(Correlation.corr(vectors, "x").first()[0].toArray())
        np.fill_diagonal(corr, (deviation > 0).astype(float))
    return Gram(list(columns), np.array([row["m" + c] for c in names]), deviation, corr)


def variance_table(df: DataFrame, columns: list[str], wanted: float = VARIANCE_SHARE) -> DataFrame:
    """(component, ratio, running share, kept) of the standardised columns."""
    axes = gram(df, columns).axes()
    running = np.cumsum(axes.ratio)
    kept = len(axes.share(wanted).ratio)
    return df.sparkSession.createDataFrame(
        [(i + 1, float(r), float(running[i]), i < kept) for i, r in enumerate(axes.ratio)],
        "component int, ratio double, running double, kept boolean")


def famd_matrix(df: DataFrame, numeric: list[str], categorical: list[str], keep: list[str]) -> tuple[DataFrame, list[str]]:
    """Columns of factor analysis of mixed data.

    Numerics become z-scores. Every answer but the first of a categorical becomes an indicator divided by the root
    of its share, then centred. Returns the matrix next to the ``keep`` columns and the matrix column names.
    """
    stats = [f(F.col(c).cast("double")).alias(k + c) for c in numeric for k, f in (("m_", F.avg), ("s_", F.stddev_pop))]
    row = df.agg(F.count(F.lit(1)).alias("n"), *stats).first()
    shares: dict[str, list[tuple[str, float]]] = {c: [] for c in categorical}
    if categorical:
        counts = (df.select(*[F.col(c).cast("string").alias(c) for c in categorical])
                  .unpivot([], categorical, "q_code", "answer").groupBy("q_code", "answer").count()
                  .filter("answer IS NOT NULL").orderBy("q_code", "answer").collect())
        for r in counts:
            shares[r["q_code"]].append((r["answer"], r["count"] / row["n"]))
    out = {c: ((F.col(c).cast("double") - row["m_" + c]) / row["s_" + c] if row["s_" + c] else F.lit(0.0))
           for c in numeric}
    for c in categorical:
        for answer, share in shares[c][1:]:
            hit = F.when(F.col(c) == answer, 1.0).otherwise(0.0)
            out[f"{c}={answer}"] = (hit - share) / float(np.sqrt(share))
    return df.select(*keep, *[e.alias(n) for n, e in out.items()]), list(out)
