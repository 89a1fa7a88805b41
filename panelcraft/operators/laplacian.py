"""Laplacian score of features over a neighbour graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .graph import CodedGraph

# Neighbour counts tried and number of columns kept.
NEIGHBOURS = range(5, 31, 5)
KEPT_COLUMNS = 40


def laplacian_scores(df: DataFrame, graph: DataFrame | CodedGraph, features: list[str], id_col: str = "id") -> DataFrame:
    """(feature, score), small is good: weighted squared differences along edges over weighted variance.

    Equal rows are one node pattern to the score, so edges are first summed by pattern; what is then joined with
    the feature columns is at most as large as the number of different pattern pairs.
    """
    if isinstance(graph, CodedGraph):
        return _scores(df.sparkSession, graph.links(), graph.values(features).withColumnRenamed("rep", "p"), features)
    values = df.select(F.col(id_col).alias("id"), F.array(*[F.col(c).cast("double") for c in features]).alias("x"))
    pattern = values.groupBy("x").agg(F.min("id").alias("p"))
    owner = values.join(pattern, "x").select("id", "p")
    links = (graph.join(owner.select(F.col("id").alias("src"), F.col("p").alias("a")), "src")
             .join(owner.select(F.col("id").alias("dst"), F.col("p").alias("b")), "dst")
             .groupBy("a", "b").agg(F.sum("w").alias("w")))
    return _scores(df.sparkSession, links, pattern, features)


def _scores(spark, links: DataFrame, pattern: DataFrame, features: list[str]) -> DataFrame:
    """Scores from summed weights (a, b, w) between patterns (p, x)."""
    links = links.persist()
    left = pattern.select(F.col("p").alias("a"), F.col("x").alias("xa"))
    right = pattern.select(F.col("p").alias("b"), F.col("x").alias("xb"))
    at = range(len(features))
    rough = (links.filter("a <> b").join(left, "a").join(right, "b")
             .agg(*[(F.sum(F.col("w") * F.pow(F.col("xa")[i] - F.col("xb")[i], 2)) / 2).alias(f"r{i}") for i in at]).first())
    degree = links.groupBy(F.col("a").alias("p")).agg(F.sum("w").alias("d"))
    d, x = F.col("d"), F.col("x")
    node = (degree.join(pattern, "p").agg(
        F.sum(d).alias("d"), *[F.sum(d * x[i]).alias(f"s{i}") for i in at],
        *[F.sum(d * x[i] * x[i]).alias(f"q{i}") for i in at]).first())
    links.unpersist()
    rows = []
    for i, feature in enumerate(features):
        spread = node[f"q{i}"] - node[f"s{i}"] ** 2 / node["d"]
        rows.append((feature, float((rough[f"r{i}"] or 0.0) / spread) if spread > 1e-12 else None))
    return spark.createDataFrame(rows, "feature string, score double")


def feature_ranks(scores: DataFrame) -> DataFrame:
    """Ascending rank of the scores, ties by name; features without a score come last."""
    return scores.withColumn("rank", F.row_number().over(Window.orderBy(F.col("score").asc_nulls_last(), "feature")))


def select_features(df: DataFrame, features: list[str], n_features: int, n_neighbours: int, t: float = 1.0,
                    id_col: str = "id", graph: DataFrame | CodedGraph | None = None) -> tuple[list[str], DataFrame]:
    """The n features of smallest score, and the ranking."""
    if graph is None:
        graph = CodedGraph(df, n_neighbours, features, id_col, t)
    ranks = feature_ranks(laplacian_scores(df, graph, features, id_col))
    kept = [r["feature"] for r in ranks.orderBy("rank").limit(n_features).collect()]
    return kept, ranks


def check_neighbours(n_neighbours) -> None:
    if not isinstance(n_neighbours, int):
        raise TypeError("n_neighbours must be a positive integer.")
    if n_neighbours <= 0:
        raise ValueError("n_neighbours must be a positive integer.")


def graphs_by_size(df: DataFrame, features: list[str], sizes: list[int], t: float = 1.0, id_col: str = "id") -> dict[int, CodedGraph]:
    """One neighbour search for the largest size; the smaller graphs are its first edges."""
    whole = CodedGraph(df, max(sizes), features, id_col, t)
    return {n: whole.first(n) for n in sizes}
