"""Segmentation methods. Each returns labels keyed by respondent with the model and the runs it was chosen from."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sampling import unit_hash
from ..roles import numeric_and_categorical
from . import centres as ce
from . import joint_fit as joint
from . import latent as la
from . import mixture as mi
from . import quality as ql
from . import search as se
from .batch import add_columns
from .joint_fit import IGNORED_LABEL
from .reduce import famd_matrix, gram
from .search import K_MAX, K_MIN, SEEDS

HOLD_OUT = 0.1


@dataclass
class Segmentation:
    """``refit`` fits the same model on other rows and labels rows with it: (train, rows) -> (id, predicted)."""

    algorithm: str
    labels: DataFrame | None
    features: list[str]
    model: object = None
    cost: float | None = None
    seed: int | None = None
    runs: list[dict] = field(default_factory=list)
    refit: Callable[[DataFrame, DataFrame], DataFrame] | None = None
    note: str | None = None

    @property
    def n_clusters(self) -> int | None:
        return getattr(self.model, "k", None)


def _run_frame(spark, runs: list[dict]) -> DataFrame:
    keys = [("run", "string"), ("n_clusters", "int"), ("silhouette", "double"), ("davies_bouldin", "double"),
            ("calinski_harabasz", "double"), ("cluster_proportions", "map<string,double>"), ("cost", "double"),
            ("bic", "double"), ("aic", "double")]
    return spark.createDataFrame([tuple(r.get(k) for k, _ in keys) for r in runs], ", ".join(f"{k} {t}" for k, t in keys))


def choose_k(spark, runs: list[dict]) -> int:
    """k of the best rank sum over one run per k, with the bonus of the elbow."""
    return ql.best_k(_run_frame(spark, runs)).filter("is_best").select("n_clusters").first()[0]


def choose_run(spark, runs: list[dict], criteria: bool = False) -> str | None:
    """Best balanced run by rank sum, ties to the first; none when no run is balanced."""
    order = {r["run"]: i for i, r in enumerate(runs)}
    ranked = ql.rank_runs(ql.balanced(_run_frame(spark, runs)), criteria).select("run", "rank_sum").collect()
    return min(ranked, key=lambda r: (-r["rank_sum"], order[r["run"]]))["run"] if ranked else None


def _scored(df: DataFrame, features: list[str], fitted: dict[str, object], costs: dict[str, float]) -> list[dict]:
    out = []
    for s in ql.score_labellings(df, features, list(fitted)):
        out.append({**s, "run": s["labelling"], "n_clusters": fitted[s["labelling"]].k, "cost": costs.get(s["labelling"])})
    return out


def _centre_search(df: DataFrame, layout: ce.Layout, id_col: str, score_on: list[str] | None, algorithm: str,
                   gamma: float, seeds: list[int], k_min: int, k_max: int, k: int | None, dense: bool) -> Segmentation:
    """Choose k from one run per k, then the best of the seeded runs at that k."""
    spark = df.sparkSession
    pool = ce.start_pool(df, layout, id_col, gamma, k_max if k is None else k)
    rows = df if layout.numeric else ce.patterns(df, layout.codes)

    def fit(starts: dict[str, ce.Centres]) -> tuple[dict[str, ce.Centres], list[dict]]:
        fitted = dict(zip(starts, ce.fit(
            rows, layout, dict(enumerate(starts.values())), tolerance=pool.tolerance).values()))
        labelled = ce.assign(df, layout, fitted, scores=score_on is None).persist()
        on = score_on or [f"s{i}" for i in range(layout.axes.vectors.shape[1])]
        scored = _scored(labelled, on, fitted, {r: c.cost for r, c in fitted.items()})
        labelled.unpersist()
        return fitted, scored

    if k is None:
        ks = [c for c in range(k_min, k_max) if c <= len(pool)]
        firsts = {f"k{c}": ce.dense_starts(rows, layout, c, gamma) if dense and not layout.numeric
                  else ce.spread_starts(pool, layout, c, seeds[0], gamma) for c in ks}
        k = choose_k(spark, fit(firsts)[1])
    fitted, runs = fit({f"seed{s}": ce.spread_starts(pool, layout, k, s, gamma) for s in seeds})
    best = choose_run(spark, runs)
    if best is None:
        return Segmentation(algorithm, None, layout.names, runs=runs,
                            note="Unable to perform clustering due to unbalanced clusters for all k")
    model = fitted[best]

    def refit(train: DataFrame, target: DataFrame) -> DataFrame:
        own_pool = ce.start_pool(train, layout, id_col, gamma, model.k)
        again = ce.spread_starts(own_pool, layout, model.k, int(best[4:]), gamma)
        new = ce.fit(train, layout, {0: again}, tolerance=own_pool.tolerance)[0]
        return ce.assign(target, layout, {"predicted": new}).select(id_col, "predicted")

    labels = ce.assign(df, layout, {"cluster": model}).select(id_col, "cluster")
    return Segmentation(algorithm, labels, layout.names, model, model.cost, int(best[4:]), runs, refit,
                        None if model.settled else "Stopped by the number of iterations before the centres were at rest")


def _found(df: DataFrame, search: se.Search, id_col: str, refit: Callable[[], se.Search] | None = None) -> Segmentation:
    """What a finished search chose. ``refit`` makes a search for the same model alone, to be fitted on other rows."""
    if search.model is None:
        return Segmentation(search.algorithm, None, search.columns, runs=search.runs, note=search.note)

    def again(train: DataFrame, target: DataFrame) -> DataFrame:
        own = refit()
        joint.fit_together(train, {"again": own}, id_col)
        return _labelled(target, own, id_col, "predicted")

    return Segmentation(search.algorithm, _labelled(df, search, id_col, "cluster"), search.columns, search.model, search.cost,
                        search.seed, search.runs, again if refit else None, search.note)


def _labelled(df: DataFrame, search: se.Search, id_col: str, name: str) -> DataFrame:
    made = add_columns(df.select(id_col, *[c for c in search.columns if c != id_col]), search.columns, {name: "int"},
                       lambda v: [search.label(v)])
    return made.select(id_col, name)


def _refit(search: se.Search) -> Callable[[], se.Search] | None:
    model = search.model
    if model is None or isinstance(search, se.ClassSearch):
        return None
    if isinstance(search, se.MixtureSearch):
        features, k, seed = search.numeric, model.k, search.seed
        return lambda: se.MixtureSearch(features, [seed], k, k + 1, any_balance=True)
    numeric, codes, share, dense, k, seed = search.numeric, search.codes, search.share, search.dense, model.k, search.seed
    dense = dense and seed == search.seeds[0]
    return lambda: se.CentreSearch(numeric, codes, share, dense, [seed], k=k, any_balance=True)


def search_all(df: DataFrame, searches: dict[str, se.Search], id_col: str = "id", go_on: bool = False) -> dict[str, Segmentation]:
    """Segmentations of several methods, whose searches share every pass over the rows."""
    done = joint.fit_together(df, searches, id_col, go_on=go_on)
    return {name: _found(df, s, id_col, _refit(s)) for name, s in done.items()}


def search_branches(df: DataFrame, column: str, searches: Callable[[], dict[str, se.Search]], id_col: str = "id",
                    ignored: list | None = None) -> dict[str, Segmentation]:
    """Every method inside every value of ``column``: labels run on from branch to branch, ``model`` is a table of what was
    chosen in each branch, and the values of the column stay in Spark."""
    fitted = joint.fit_branches(df, column, searches, id_col)
    about = fitted.summaries()
    return {name: Segmentation(f"Hierarchical {s.algorithm} using {column}",
                               fitted.labels(name, ignored).withColumnRenamed("id", id_col), s.columns,
                               about.where(F.col("method") == name).drop("method"))
            for name, s in searches().items()}


def kmeans_pca(df: DataFrame, features: list[str], id_col: str = "id", mode: str = "eval", seeds: list[int] | None = None,
               k_min: int = K_MIN, k_max: int = K_MAX, k: int | None = None) -> Segmentation:
    """k-means on as many principal components of the standardised columns as hold half of the variance."""
    if mode not in ("tune", "eval"):
        raise ValueError('Allowed values for mode are either "tune" or "eval".')
    return search_all(df, {"found": se.k_means(features, seeds=seeds, k_min=k_min, k_max=k_max, k=k)}, id_col)["found"]


def kmeans_famd(df: DataFrame, features: list[str], id_col: str = "id", n_components: int = 2,
                seeds: list[int] | None = None, k_min: int = K_MIN, k_max: int = K_MAX, k: int | None = None) -> Segmentation:
    """k-means on the leading factors of mixed data."""
    numeric, categorical = numeric_and_categorical(df, features)
    wide, columns = famd_matrix(df, numeric, categorical, [id_col])
    safe = [f"f{i}" for i in range(len(columns))]
    wide = wide.toDF(id_col, *safe)
    axes = gram(wide, safe).axes(standardise=False).keep(n_components)
    return _centre_search(wide, ce.Layout(safe, [], axes), id_col, None, "FAMD and Kmeans", 1.0, seeds or SEEDS,
                          k_min, k_max, k, False)


def kmeans(df: DataFrame, features: list[str], id_col: str = "id", seeds: list[int] | None = None, k_min: int = K_MIN,
           k_max: int = K_MAX, k: int | None = None) -> Segmentation:
    return _centre_search(df, ce.Layout(features, []), id_col, features, "kmeans", 1.0, seeds or SEEDS, k_min, k_max, k, False)


def k_family(encoded: DataFrame, numeric: list[str], codes: list[str], id_col: str = "id", output: str = "all",
             seeds: list[int] | None = None, k_min: int = K_MIN, k_max: int = K_MAX, k: int | None = None):
    """k-modes when every column is coded, k-prototypes otherwise; ``output='cost'`` gives the cost alone."""
    search = se.k_family(numeric, codes, seeds=seeds, k_min=k_min, k_max=k_max, k=k)
    found = search_all(encoded, {"found": search}, id_col)["found"]
    return found.cost if output == "cost" else found


def latent_classes(encoded: DataFrame, codes: list[str], numeric: list[str] | None = None, id_col: str = "id", ks=None,
                   restarts: int = la.RESTARTS, max_passes: int = 600, subset: bool = False) -> Segmentation:
    """Latent classes of least BIC; without numeric columns fitted on distinct answer patterns.

    All columns are fitted; ``subset`` takes the random part that ``latent.wide_subset`` names beyond 100 of them."""
    numeric = numeric or []
    if subset and not numeric:
        codes = la.wide_subset(codes)
    search = se.ClassSearch(codes, numeric, ks, restarts, max_passes)
    if numeric:
        joint.fit_together(encoded, {"found": search}, id_col)
    else:
        joint.fit_together(ce.patterns(encoded, codes), {"found": search}, id_col, "copies")
    return _found(encoded, search, id_col)


def gaussian_mixture(encoded: DataFrame, features: list[str], id_col: str = "id", seeds: list[int] | None = None,
                     k_min: int = K_MIN, k_max: int = K_MAX) -> Segmentation:
    """Best variational mixture: best balanced seed of each k by rank sum with criteria, then best k alike.

    Runs with a class below one percent of the rows are not chosen; ``runs`` holds them with the reason.
    """
    return search_all(encoded, {"found": se.MixtureSearch(features, seeds, k_min, k_max)}, id_col)["found"]


def criteria_of(model: mi.Mixture, won: np.ndarray, n: float, d: int) -> dict:
    return {"log_likelihood": model.log_likelihood, **mi.criteria(model.log_likelihood, n, int((won > 0).sum()), d)}


# --- hierarchical ---------------------------------------------------------------------------------------


def offset_labels(branches: DataFrame, branch: str, local: str, ignored: list[str] | None = None) -> DataFrame:
    """Labels that stay apart across branches: each branch starts after the labels of the ones before it.

    A branch without labels is one segment, rows without a branch are a branch of their own; an ignored branch is marked and takes no labels.
    """
    skip = F.col(branch).isin(*ignored) if ignored else F.lit(False)
    sizes = (branches.groupBy(branch).agg(F.coalesce(F.max(local), F.lit(0)).alias("top"))
             .withColumn("width", F.when(skip, 0).otherwise(F.col("top") + 1)))
    before = Window.orderBy(branch).rowsBetween(Window.unboundedPreceding, -1)  # one row per branch
    offsets = sizes.select(F.col(branch).alias("_branch"), F.coalesce(F.sum("width").over(before), F.lit(0)).alias("offset"))
    return (branches.join(F.broadcast(offsets), F.col(branch).eqNullSafe(F.col("_branch"))).drop("_branch")
            .withColumn("cluster", F.when(skip, IGNORED_LABEL)
                        .otherwise(F.coalesce(F.col(local), F.lit(0)) + F.col("offset")).cast("int")).drop("offset"))


def hierarchical(df: DataFrame, column: str, method: Callable[[DataFrame], Segmentation], id_col: str = "id",
                 ignored: list[str] | None = None) -> Segmentation:
    """Cluster inside every value of ``column``. Values are few: each is a fit of its own."""
    values = [r[0] for r in df.select(column).distinct().orderBy(column).collect()]
    parts, models = None, {}
    for value in values:
        own = F.lit(value).cast(df.schema[column].dataType)
        branch = df.filter(F.col(column).eqNullSafe(own))
        part = branch.select(id_col, F.col(column).alias("branch"), F.lit(0).alias("local"))
        if not ignored or value not in ignored:
            found = method(branch)
            models[value] = found.model
            if found.labels is not None:
                part = (found.labels.withColumnRenamed("cluster", "local")
                        .select(id_col, own.alias("branch"), "local"))
        parts = part if parts is None else parts.unionByName(part)
    labels = offset_labels(parts, "branch", "local", ignored).select(id_col, "cluster")
    return Segmentation(f"Hierarchical using {column}", labels, [], models)


# --- stability ------------------------------------------------------------------------------------------


def consistency(df: DataFrame, seg: Segmentation, id_col: str = "id", seed: int = 42) -> dict[str, float | None]:
    """Refit on nine tenths of the rows: agreement of its predictions on the rest, and of its labels on the nine
    tenths, with the labels given. The split follows a hash of the key, so every segment is split alike."""
    if seg.refit is None or seg.labels is None:
        return {"model_consistency": None, "label_consistency": None}
    held = unit_hash(id_col, seed) < HOLD_OUT
    train = df.filter(~held)
    predicted = seg.refit(train, df).join(seg.labels, id_col).persist()
    out = {}
    for name, rows in (("model_consistency", predicted.filter(held)), ("label_consistency", predicted.filter(~held))):
        out[name] = ql.adjusted_rand(rows, "predicted", "cluster").first()[0]
    predicted.unpersist()
    return out
