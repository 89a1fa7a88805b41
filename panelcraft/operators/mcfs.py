"""Multi-cluster feature selection: spectral embedding of the neighbour graph, then sparse regression on features.

The embedding comes from subspace iteration on the edge list (n x few numbers per step, never n x n). Regressions
need only the cross products of features and embedding, p x p numbers from one pass.
"""

from __future__ import annotations

import warnings

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sampling import unit_hash
from ..session import cut_lineage
from .batch import partial_sums
from .graph import CodedGraph

EXTRA_VECTORS = 4
STEPS_PER_ROUND = 3


def _gram(y: DataFrame, width: int) -> np.ndarray:
    pairs = [(i, j) for i in range(width) for j in range(i, width)]
    row = y.agg(*[F.sum(F.col("y")[i] * F.col("y")[j]).alias(f"g{i}_{j}") for i, j in pairs]).first()
    out = np.zeros((width, width))
    for i, j in pairs:
        out[i, j] = out[j, i] = row[f"g{i}_{j}"] or 0.0
    return out


def _times(y: DataFrame, m: np.ndarray) -> DataFrame:
    """Rows of y times a small matrix."""
    cols = []
    for j in range(m.shape[1]):
        cols.append(sum((F.col("y")[i] * float(m[i, j]) for i in range(1, m.shape[0])), F.col("y")[0] * float(m[0, j])))
    return y.withColumn("y", F.array(*cols))


def embedding(graph: DataFrame | CodedGraph, n_vectors: int, rounds: int = 12, tolerance: float = 1e-4) -> tuple[DataFrame, np.ndarray]:
    """(id, y array): leading eigenvectors of the normalised graph after the trivial one, divided by root degree.

    ``graph`` is symmetric. Steps use (S + 1) / 2, whose spectrum is not negative; the state is checkpointed once a
    round, so a lost executor costs a round at most and plans stay short. Rows that one node stands for have equal values in the
    leading vectors; a node counts as the root of their number, and starts from their sum. How the rows of a node start apart halves with
    every step and is kept as its cross products, so the steps are those of all rows.
    """
    counted = isinstance(graph, CodedGraph)
    nodes, graph = graph, (graph.edges() if counted else graph).persist()
    if counted:
        ids = nodes.nodes.select(F.col("node").alias("id"), "ids")
        degree = (graph.join(ids.withColumnRenamed("id", "dst"), "dst").groupBy(F.col("src").alias("id")).agg(F.sum(F.col("w") * F.col("ids")).alias("d"))
                  .join(ids, "id").persist())
    else:
        degree = graph.groupBy(F.col("src").alias("id")).agg(F.sum("w").alias("d")).withColumn("ids", F.lit(1)).persist()
    edges = (graph.join(degree.select(F.col("id").alias("src"), (F.col("d") / F.col("ids")).alias("ds")), "src")
             .join(degree.select(F.col("id").alias("dst"), (F.col("d") / F.col("ids")).alias("dd")), "dst")
             .select("src", "dst", (F.col("w") / F.sqrt(F.col("ds") * F.col("dd"))).alias("s")).persist())
    width = n_vectors + 1 + EXTRA_VECTORS
    draws = [unit_hash("id", 100 + i) - 0.5 for i in range(width - 1)]
    apart = np.zeros((width, width))
    if counted:
        y = degree.join(nodes.sums(draws).withColumnRenamed("node", "id"), "id").select("id", F.concat(
            F.array(F.sqrt(F.col("d") * F.col("ids"))), F.transform("z", lambda v: v / F.sqrt("ids"))).alias("y")).persist()
        apart[1:, 1:] = (_gram(nodes.others.select(F.array(*draws).alias("y")), width - 1)
                         - _gram(y.filter(F.col("id")["kind"] == 1), width)[1:, 1:])
    else:
        y = degree.select("id", F.array(F.sqrt("d"), *draws).alias("y"))

    def multiply(y: DataFrame) -> DataFrame:
        sent = edges.join(y.select(F.col("id").alias("dst"), "y"), "dst")
        got = sent.groupBy(F.col("src").alias("id")).agg(F.array(*[F.sum(F.col("s") * F.col("y")[i]) for i in range(width)]).alias("z"))
        return got.join(y, "id").select("id", F.zip_with("z", "y", lambda a, b: (a + b) / 2).alias("y"))

    def orthonormal(y: DataFrame) -> DataFrame:
        nonlocal apart
        values, vectors = np.linalg.eigh(_gram(y, width) + apart)
        values = np.maximum(values, values.max() * 1e-14)
        m = vectors / np.sqrt(values)
        apart = m.T @ apart @ m
        return _times(y, m)

    y = orthonormal(cut_lineage(y))
    last = None
    for _ in range(rounds):
        for _ in range(STEPS_PER_ROUND):
            y, apart = multiply(y), apart / 4
        y = cut_lineage(y)
        y = orthonormal(y)
        both = multiply(y).select("id", F.col("y").alias("z")).join(y, "id")
        row = both.agg(*[F.sum(F.col("y")[i] * F.col("z")[j]).alias(f"t{i}_{j}") for i in range(width) for j in range(width)]).first()
        t = np.array([[row[f"t{i}_{j}"] for j in range(width)] for i in range(width)]) + apart / 2
        values, vectors = np.linalg.eigh((t + t.T) / 2)
        order = np.argsort(-values)
        values, vectors = values[order], vectors[:, order]
        y, apart = _times(y, vectors), vectors.T @ apart @ vectors
        top = values[:n_vectors + 1]
        if last is not None and np.abs(top - last).max() < tolerance:
            break
        last = top
    else:
        warnings.warn(f"MCFS: {rounds} rounds ended before the embedding was at rest", stacklevel=2)
    edges.unpersist()
    kept = [F.col("y")[i] / F.sqrt(F.col("d") * F.col("ids")) for i in range(1, n_vectors + 1)]
    return y.join(degree, "id").select("id", F.array(*kept).alias("y")), 2 * top - 1


def least_angle(gram: np.ndarray, cross: np.ndarray, n_nonzero: int) -> np.ndarray:
    """Least angle regression from centred cross products (Efron et al. 2004), stopped at ``n_nonzero`` features."""
    p = len(cross)
    beta, active = np.zeros(p), []
    usable = np.diag(gram) > 1e-12
    limit = min(n_nonzero, int(usable.sum()))
    residual = cross.astype(float).copy()
    while len(active) < limit:
        rest = [j for j in range(p) if usable[j] and j not in active]
        lead = max(rest, key=lambda j: abs(residual[j]))
        if abs(residual[lead]) < 1e-12:
            break
        active.append(lead)
        block = gram[np.ix_(active, active)]
        if np.linalg.matrix_rank(block) < len(active):
            active.pop()
            usable[lead] = False
            limit = min(n_nonzero, int(usable.sum()))
            continue
        signs = np.sign(residual[active])
        direction = np.linalg.solve(block, signs)
        level = abs(residual[active]).max()
        slope = gram[:, active] @ direction
        step = level
        if len(active) < limit:
            for j in range(p):
                if usable[j] and j not in active:
                    for top, bottom in ((level - residual[j], 1 - slope[j]), (level + residual[j], 1 + slope[j])):
                        if bottom > 1e-12 and 1e-12 < top / bottom < step:
                            step = top / bottom
        beta[active] += step * direction
        residual = cross - gram @ beta
    return beta


def mcfs(df: DataFrame, graph: DataFrame | CodedGraph, features: list[str], n_features: int, n_clusters: int = 5, id_col: str = "id",
         rounds: int = 12) -> DataFrame:
    """(feature, score, rank): largest absolute weight over the regressions of the embedding's vectors."""
    vectors, _ = embedding(graph, n_clusters, rounds)
    p, k = len(features), n_clusters
    if isinstance(graph, CodedGraph):
        rows = vectors.withColumnRenamed("id", "node").join(graph.nodes, "node").join(graph.values(features), "rep")
        columns = [F.col("rows"), *[F.col("x")[i] for i in range(p)], *[F.col("y")[i] for i in range(k)]]
    else:
        rows = df.withColumnRenamed(id_col, "id").join(vectors, "id")
        columns = [F.lit(1.0), *[F.col(c) for c in features], *[F.col("y")[i] for i in range(k)]]

    def products(v: np.ndarray) -> dict[str, np.ndarray]:
        one = np.column_stack([np.ones(len(v)), v[:, 1:]])
        m = one.T @ (one * v[:, :1])
        i, j = np.indices(m.shape)
        return {"i": i.ravel(), "j": j.ravel(), "value": m.ravel()}

    m = np.zeros((p + k + 1, p + k + 1))
    for r in partial_sums(rows, columns, products, ["i", "j"]).collect():
        m[r["i"], r["j"]] = r["value"]
    centred = m[1:, 1:] - np.outer(m[1:, 0], m[0, 1:]) / m[0, 0]
    gram, cross = centred[:p, :p], centred[:p, p:]
    weights = np.column_stack([least_angle(gram, cross[:, c], n_features) for c in range(k)])
    scores = np.abs(weights).max(1)
    order = sorted(range(p), key=lambda i: (-scores[i], features[i]))
    return df.sparkSession.createDataFrame(
        [(features[i], float(scores[i]), rank + 1) for rank, i in enumerate(order)], "feature string, score double, rank int")
