"""Choosing question columns: clustering grids with chi-squared ranks, Laplacian tuning and the fusion of rankings."""

from __future__ import annotations

from functools import reduce
from time import perf_counter

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranks import average_rank
from ..functions.sampling import unit_hash
from ..roles import ColumnRoles, study_columns
from . import crosstab as ct
from . import deliver as dv
from . import joint_fit as joint
from . import laplacian as lp
from . import quality as ql
from . import search as se
from . import segment as sg
from .batch import add_columns
from .cleaning import encode
from .graph import CodedGraph
from .mcfs import mcfs
from .reduce import GRID_VARIANCE_SHARE

# Fixed values of the grids.
GRID_K = range(3, 9)
COMPONENT_K = range(3, 8)
COMPONENTS = range(2, 82, 5)
KMEANS_TOP, KPROTO_TOP = 80, 40
MISSING_RANK = 1.1
GRID_SEED = 42


def segment_stats(labelled: DataFrame, features: list[str], runs: list[str]) -> DataFrame:
    """(run, q_code, stat) of the questions that set some segment of a run apart; all runs in one plan.

    Questions of different runs are kept apart by a prefix to their code. No correction for the number of tests.
    """
    roles = ColumnRoles("id", None, features)
    parts = [ct.answer_counts(labelled, roles, run).withColumn("q_code", F.concat(F.lit(run + "|"), "q_code")) for run in runs]
    found = dv.infer_counts(reduce(DataFrame.unionByName, parts), correction=None)
    both = F.split("q_code", r"\|", 2)
    return first_per_variable(found.deliver.select(
        both[0].alias("run"), both[1].alias("q_code"), F.col("chi2_stat").alias("stat")), ["run", "q_code"], "stat")


def first_per_variable(table: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row of smallest ``order`` for each key."""
    return table.groupBy(*keys).agg(F.min(order).alias(order))


def _grid_row(run: dict, k: int, n, features: list[str], cost, stats: dict | None = None) -> dict:
    return {"k": k, "n": str(n), "silhouette": run["silhouette"], "davies_bouldin": run["davies_bouldin"],
            "calinski_harabasz": run["calinski_harabasz"], "cost": cost, "features": features,
            "chi2_stat": [stats[f] for f in features] if stats else None}


GRID_SCHEMA = ("k int, n string, silhouette double, davies_bouldin double, calinski_harabasz double, cost double, "
               "features array<string>, chi2_stat array<double>")


def _by_run(stats: DataFrame) -> dict[str, dict[str, float]]:
    out: dict[str, dict[str, float]] = {}
    for r in stats.orderBy("run", "stat", "q_code").collect():
        out.setdefault(r["run"], {})[r["q_code"]] = r["stat"]
    return out


def _fit_grid(encoded: DataFrame, wanted: dict[str, se.CentreSearch], id_col: str) -> dict[str, se.CentreSearch]:
    """All runs of a grid, each with its own columns, axes and k, in the same passes; without those that found too few rows."""
    return {run: s for run, s in joint.fit_together(encoded, wanted, id_col).items() if s.model is not None}


def _grid_labels(encoded: DataFrame, fitted: dict[str, se.CentreSearch]) -> DataFrame:
    columns = list(dict.fromkeys(c for s in fitted.values() for c in s.columns))
    at = {run: [columns.index(c) for c in s.columns] for run, s in fitted.items()}
    return add_columns(encoded, columns, {run: "int" for run in fitted},
                       lambda v: [s.label(v[:, at[run]]) for run, s in fitted.items()])


def _two_step_grid(encoded: DataFrame, features: list[str], id_col: str, ks, top: int, search) -> list[dict]:
    """``search(columns, k)`` on all columns for every k, then on each k's columns of highest chi-squared statistic."""
    fitted = _fit_grid(encoded, {f"k{k}": search(features, k) for k in ks}, id_col)
    out = [_grid_row(s.runs[0], int(run[1:]), "all", features, s.cost) for run, s in fitted.items()]
    labelled = _grid_labels(encoded, fitted).persist()  # read once for every run
    stats = _by_run(segment_stats(labelled, features, list(fitted)))
    labelled.unpersist()
    chosen = {run: list(stats[run])[-top:] for run in fitted if stats.get(run)}
    for run, s in _fit_grid(encoded, {run: search(own, int(run[1:])) for run, own in chosen.items()}, id_col).items():
        out.append(_grid_row(s.runs[0], int(run[1:]), top, chosen[run], s.cost, stats[run]))
    return out


def kmeans_grid(encoded: DataFrame, features: list[str], id_col: str = "id", ks=GRID_K, top: int = KMEANS_TOP) -> list[dict]:
    """k-means on all columns for every k, then again on each k's columns of highest chi-squared statistic."""
    return _two_step_grid(encoded, features, id_col, ks, top, lambda columns, k: se.CentreSearch(
        columns, (), GRID_VARIANCE_SHARE, seeds=[GRID_SEED], k=k, any_balance=True))


def component_grid(encoded: DataFrame, features: list[str], id_col: str = "id", ks=COMPONENT_K, components=COMPONENTS) -> list[dict]:
    """k-means for every k on growing numbers of components, all runs together."""
    counts = [*[c for c in components if c < len(features)], len(features)]
    fitted = _fit_grid(encoded, {f"n{n}_k{k}": se.CentreSearch(features, (), seeds=[GRID_SEED], k=k, any_balance=True, components=n)
                                 for n in counts for k in ks}, id_col)
    return [_grid_row(s.runs[0], int(run.split("_k")[1]), "all" if s.components == len(features) else s.components, features, s.cost)
            for run, s in fitted.items()]


def kproto_grid(encoded: DataFrame, numeric: list[str], codes: list[str], id_col: str = "id", ks=GRID_K,
                top: int = KPROTO_TOP) -> list[dict]:
    """k-prototypes for every k (k-modes without numerics, k-means without codes), then again on each k's columns of
    highest statistic."""
    def search(columns: list[str], k: int) -> se.CentreSearch:
        num, cat = [c for c in columns if c in numeric], [c for c in columns if c in codes]
        return se.CentreSearch(num, cat, None if cat else GRID_VARIANCE_SHARE, True, [GRID_SEED], k=k, any_balance=True)

    return _two_step_grid(encoded, [*numeric, *codes], id_col, ks, top, search)


def grid_table(spark, grid: list[dict]) -> DataFrame:
    return spark.createDataFrame([tuple(r.values()) for r in grid], GRID_SCHEMA)


def chi2_ranking(stats: DataFrame) -> DataFrame:
    """(feature, total, rank) from (k, feature, stat): rank within each k, missing at the bottom, summed, ranked again."""
    ks = [r[0] for r in stats.select("k").distinct().orderBy("k").collect()]
    wide = stats.groupBy("feature").pivot("k", ks).agg(F.first("stat"))
    ranks = [average_rank(str(k), ascending=False, nulls="bottom") for k in ks]
    total = wide.select("feature", sum(ranks[1:], ranks[0]).alias("total"))
    return total.withColumn("rank", average_rank("total"))


def grid_ranking(spark, grid: list[dict]) -> DataFrame:
    rows = [(r["k"], f, float(s)) for r in grid if r["n"] != "all" for f, s in zip(r["features"], r["chi2_stat"])]
    return chi2_ranking(spark.createDataFrame(rows, "k int, feature string, stat double"))


def fuse_rankings(rankings: DataFrame, n_features: int) -> DataFrame:
    """(feature, sum_rank) of the best n features: each ranker gives its best n, a missing rank counts 1.1 n."""
    best = Window.partitionBy("method").orderBy("rank", "feature")
    head = rankings.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= n_features)
    methods = [r[0] for r in rankings.select("method").distinct().orderBy("method").collect()]
    wide = head.groupBy("feature").pivot("method", methods).agg(F.first("rank"))
    parts = [F.coalesce(F.col(f"`{m}`").cast("double"), F.lit(MISSING_RANK * n_features)) for m in methods]
    return (wide.select("feature", sum(parts[1:], parts[0]).alias("sum_rank"))
            .orderBy("sum_rank", "feature").limit(n_features))


# --- Laplacian tuning ------------------------------------------------------------------------------------


def laplacian_quality(encoded: DataFrame, features: list[str], n_neighbours: int = 15, n_cols: int = lp.KEPT_COLUMNS,
                      id_col: str = "id", graph: DataFrame | CodedGraph | None = None, **search) -> dict:
    """Cluster on the columns of smallest score and report how good the clustering is."""
    if not isinstance(encoded, DataFrame):
        raise TypeError("Input must be a DataFrame.")
    lp.check_neighbours(n_neighbours)
    return _qualities(encoded, features, {n_neighbours: graph}, n_cols, id_col, **search)[0]


def _qualities(encoded: DataFrame, features: list[str], graphs: dict[int, DataFrame | CodedGraph | None], n_cols: int, id_col: str,
               **search) -> list[dict]:
    """The same for several neighbour counts: the clusterings, each on its own columns, share their passes."""
    started = perf_counter()
    picked = {n: lp.select_features(encoded, features, n_cols, n, id_col=id_col, graph=graph) for n, graph in graphs.items()}
    sets = dict.fromkeys(tuple(chosen) for chosen, _ in picked.values())
    found = dict(zip(sets, sg.search_all(encoded, {f"set{i}": se.k_means(list(own), **search) for i, own in enumerate(sets)},
                                         id_col).values()))
    out = []
    for n, (chosen, ranking) in picked.items():
        seg = found[tuple(chosen)]
        best = next((r for r in seg.runs if r["run"] == f"seed{seg.seed}"), {})
        out.append({"n_neighbours": n, "n_cols": n_cols, "n_clusters": best.get("n_clusters"),
                    **{m: best.get(m) for m in ("silhouette", "davies_bouldin", "calinski_harabasz")},
                    "time_taken": (perf_counter() - started) / len(graphs), "cols": chosen, "column_rankings": ranking})
    return out


QUALITY_SCHEMA = ("n_neighbours int, n_clusters int, silhouette double, davies_bouldin double, calinski_harabasz double, "
                  "cols array<string>")


def optimal_laplacian(encoded: DataFrame, features: list[str], min_neighbours: int = 5, max_neighbours: int = 30,
                      n_cols: int = lp.KEPT_COLUMNS, id_col: str = "id", **search) -> tuple[dict, list[dict]]:
    """Best neighbour count by rank sum; one neighbour search serves all counts."""
    if min_neighbours > max_neighbours:
        raise ValueError("min_neighbours must be less than or equal to max_neighbours.")
    if not isinstance(encoded, DataFrame):
        raise TypeError("Input must be a DataFrame.")
    sizes = list(range(min_neighbours, max_neighbours + 5, 5))
    tried = _qualities(encoded, features, lp.graphs_by_size(encoded, features, sizes, id_col=id_col), n_cols, id_col, **search)
    best = _best_quality(encoded.sparkSession, tried)
    return next(t for t in tried if t["n_neighbours"] == best), tried


def quality_table(spark, tried: list[dict]) -> DataFrame:
    names = [f.split()[0] for f in QUALITY_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(t[n] for n in names) for t in tried], QUALITY_SCHEMA)


def _best_quality(spark, tried: list[dict]) -> int:
    ranked = ql.rank_runs(quality_table(spark, tried))
    return ranked.orderBy(F.desc("rank_sum"), "n_neighbours").first()["n_neighbours"]


def rank_features_laplacian(df: DataFrame, id_col: str = "id", **search) -> list[str]:
    if not isinstance(df, DataFrame):
        raise TypeError("Input must be a DataFrame.")
    features = study_columns(df)
    encoded = encode(df.select(id_col, *features), features)
    return optimal_laplacian(encoded, features, id_col=id_col, **search)[0]["cols"]


def subsample_study(encoded: DataFrame, features: list[str], shares: list[float], id_col: str = "id", **search) -> list[dict]:
    """Laplacian tuning on growing samples; each sample holds the smaller ones, as they cut one key hash."""
    out = []
    for share in shares:
        sample = encoded.filter(unit_hash(id_col, 11) < share)
        best, _ = optimal_laplacian(sample, features, id_col=id_col, **search)
        out.append({**best, "share": share})
    return out


def rank_features(df: DataFrame, n_features: int, n_neighbours: int, t: float, n_clusters: int, id_col: str = "id",
                  **search) -> list[str]:
    """Columns of smallest summed rank over four rankers: chi-squared over k-means and over k-prototypes grids,
    multi-cluster selection, and Laplacian score."""
    for value, name in ((n_features, "n_features must be positive Integer"),
                        (n_neighbours, "n_neighbours must be a positive Integer."),
                        (n_clusters, "n_clusters must be positive Integer")):
        if not isinstance(value, int):
            raise TypeError(name)
        if value <= 0:
            raise ValueError(name)
        if value is n_features and not isinstance(df, DataFrame):
            raise TypeError("input should be a DataFrame")
    spark = df.sparkSession
    features = study_columns(df)
    if len(features) < n_features:
        raise ValueError("n_features is more than number of columns")
    encoded = encode(df.select(id_col, *features), features).persist()
    graph = CodedGraph(encoded, n_neighbours, features, id_col, t)
    best, _ = optimal_laplacian(encoded, features, id_col=id_col, **search)
    tables = {
        "chi2_kmeans": grid_ranking(spark, kmeans_grid(encoded, features, id_col)).select("feature", "rank"),
        "chi2_kproto": grid_ranking(spark, kproto_grid(encoded, [], features, id_col)).select("feature", "rank"),
        "mcfs": mcfs(encoded, graph, features, n_features, n_clusters, id_col).select("feature", "rank"),
        "laplacian": best["column_rankings"].select("feature", "rank")}
    rankings = reduce(DataFrame.unionByName, [
        t.select(F.lit(m).alias("method"), "feature", F.col("rank").cast("double").alias("rank")) for m, t in tables.items()])
    chosen = [r["feature"] for r in fuse_rankings(rankings, n_features).collect()]
    encoded.unpersist()
    return chosen
