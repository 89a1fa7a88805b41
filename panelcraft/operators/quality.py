"""Internal quality of labellings: silhouette, Davies-Bouldin, Calinski-Harabasz, ARI, ranks and choice of k.

A labelling is a column; several labellings of the same rows are scored together. Two passes over the rows are
enough for all three scores: cluster moments first, then distances to the k centres.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranks import average_rank
from ..functions.sampling import random_label
from ..session import cut_lineage, shared_place
from .batch import no_gaps, packed, partial_sums, unpacked
from .graph import open_store, read_blocks, write_blocks

# Fixed values.
SHARE_LOW, SHARE_HIGH = 0.02, 0.55
BIC_WEIGHT = 1.3
RANDOM_RUNS = 10


@dataclass
class Moments:
    """Per run and cluster: size, centre and spread; runs x clusters x columns numbers, held on the driver."""

    n: dict[int, np.ndarray]
    centre: dict[int, np.ndarray]
    spread: dict[int, np.ndarray]
    label: dict[int, list]


def cluster_moments(df: DataFrame, features: list[str], labels: list[str]) -> Moments:
    """Sizes, centres and summed population variances of every cluster of every labelling in one pass.

    Rows are shifted by the overall mean first, which keeps the squares small.
    """
    found = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("run"), F.col(c).cast("string").alias("label"))
                                          for i, c in enumerate(labels)])).alias("r")) \
        .filter("r.label IS NOT NULL").groupBy("r.run", "r.label").count().collect()
    out = Moments({}, {}, {}, {})
    for run in range(len(labels)):
        out.label[run] = sorted(r["label"] for r in found if r["run"] == run)
    means = df.agg(*[F.avg(F.col(f).cast("double")).alias(f"m{i}") for i, f in enumerate(features)]).first()
    shift = np.array([means[f"m{i}"] or 0.0 for i in range(len(features))])
    p, sizes = len(features), [len(out.label[run]) for run in range(len(labels))]

    def sums(values: np.ndarray) -> dict[str, np.ndarray]:
        x, own = values[:, :p] - shift, values[:, p:]
        squares = (x ** 2).sum(1)
        blocks = []
        for run, k in enumerate(sizes):
            known = np.isfinite(own[:, run])
            hot = own[known, run][:, None] == np.arange(k)[None, :]
            blocks.append(np.column_stack([hot.sum(0), hot.T @ squares[known], hot.T @ x[known]]))
        whole = np.concatenate(blocks)
        run_of = np.repeat(np.arange(len(sizes)), sizes)
        cluster_of = np.concatenate([np.arange(k) for k in sizes])
        width = whole.shape[1]
        return {"run": np.repeat(run_of, width), "cluster": np.repeat(cluster_of, width),
                "pos": np.tile(np.arange(width), len(whole)), "value": whole.reshape(-1)}

    rows = partial_sums(df, _coded(features, labels, out.label), sums, ["run", "cluster", "pos"]).collect()
    for run, k in enumerate(sizes):
        got = np.zeros((k, p + 2))
        for r in rows:
            if r["run"] == run:
                got[r["cluster"], r["pos"]] = r["value"]
        n = got[:, 0]
        moved = got[:, 2:] / n[:, None]
        out.n[run], out.centre[run] = n, moved + shift
        out.spread[run] = np.maximum(got[:, 1] / n - (moved ** 2).sum(1), 0.0)
    return out


def _coded(features: list[str], labels: list[str], levels: dict[int, list]) -> list:
    """Feature columns, then for each labelling the position of the label among its levels."""
    return [F.col(f) for f in features] + [
        F.nullif(F.array_position(F.array(*[F.lit(v) for v in levels[i]]), F.col(c).cast("string")), F.lit(0)) - 1
        for i, c in enumerate(labels)]


def calinski_harabasz(m: Moments, run: int) -> float | None:
    n, k = m.n[run].sum(), len(m.n[run])
    centre = (m.n[run][:, None] * m.centre[run]).sum(0) / n
    between = float((m.n[run] * ((m.centre[run] - centre) ** 2).sum(1)).sum())
    within = float((m.n[run] * m.spread[run]).sum())
    if k < 2 or n <= k:
        return None
    return 1.0 if within == 0 else float(between * (n - k) / (within * (k - 1)))


def davies_bouldin(centre: np.ndarray, scatter: np.ndarray) -> float | None:
    k = len(scatter)
    if k < 2:
        return None
    gap = np.sqrt(((centre[:, None, :] - centre[None, :, :]) ** 2).sum(-1))
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = (scatter[:, None] + scatter[None, :]) / gap
    ratio[~np.isfinite(ratio)] = 0.0
    np.fill_diagonal(ratio, -np.inf)
    return float(ratio.max(1).mean())


def score_labellings(df: DataFrame, features: list[str], labels: list[str]) -> list[dict]:
    """Silhouette (squared Euclidean, exact), Davies-Bouldin and Calinski-Harabasz of each label column.

    The mean squared distance of a row to a cluster is its squared distance to the centre plus the cluster's
    spread, so the silhouette needs k distances per row and not n. Clusters of one row score 0.
    """
    m = cluster_moments(df, features, labels)
    p, n_runs = len(features), len(labels)
    plan = df.select(packed(_coded(features, labels, m.label)))
    sizes, centres, spreads = m.n, m.centre, m.spread

    def run_batches(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            values = unpacked(batch)
            x, own_all = values[:, :p], values[:, p:]
            out = {"run": [], "cluster": [], "sil": [], "dist": []}
            for run in range(n_runs):
                known = np.isfinite(own_all[:, run])
                own = own_all[known, run].astype(int)
                n, c, v = sizes[run], centres[run], spreads[run]
                rows = x[known]
                middle = c.mean(axis=0)  # near it the squares stay small
                near, mid = rows - middle, c - middle
                d2 = np.maximum((near ** 2).sum(1)[:, None] - 2 * near @ mid.T + (mid ** 2).sum(1)[None, :], 0)
                at = np.arange(len(own))
                mean = d2 + v[None, :]
                inner = mean[at, own] * n[own] / np.maximum(n[own] - 1, 1)
                mean[at, own] = np.inf
                outer = mean.min(1) if len(n) > 1 else np.zeros(len(own))
                top = np.maximum(inner, outer)
                sil = np.where((n[own] > 1) & (top > 0), (outer - inner) / np.where(top > 0, top, 1), 0.0)
                out["run"].append(np.full(len(n), run))
                out["cluster"].append(np.arange(len(n)))
                out["sil"].append(np.bincount(own, sil, len(n)))
                out["dist"].append(np.bincount(own, np.sqrt(d2[at, own]), len(n)))
            yield pa.RecordBatch.from_pydict({k: np.concatenate(v) for k, v in out.items()})

    got = (plan.mapInArrow(run_batches, "run long, cluster long, sil double, dist double")
           .groupBy("run", "cluster").agg(F.sum("sil").alias("sil"), F.sum("dist").alias("dist")).collect())
    results = []
    for run, name in enumerate(labels):
        own = {r["cluster"]: r for r in got if r["run"] == run}
        k, n = len(sizes[run]), float(sizes[run].sum()) if len(sizes[run]) else 0.0
        scatter = np.array([own[c]["dist"] / sizes[run][c] for c in range(k)])
        results.append({
            "labelling": name, "n_clusters": k,
            "silhouette": float(sum(own[c]["sil"] for c in range(k)) / n) if k > 1 else None,
            "davies_bouldin": davies_bouldin(centres[run], scatter),
            "calinski_harabasz": calinski_harabasz(m, run) if k else None,
            "cluster_proportions": {m.label[run][c]: float(sizes[run][c] / n) for c in range(k)},
        })
    return results


SCORE_SCHEMA = ("labelling string, n_clusters int, silhouette double, davies_bouldin double, "
                "calinski_harabasz double, cluster_proportions map<string,double>")


def score_table(df: DataFrame, features: list[str], labels: list[str]) -> DataFrame:
    return df.sparkSession.createDataFrame(
        [tuple(r.values()) for r in score_labellings(df, features, labels)], SCORE_SCHEMA)


def silhouette_gower(df: DataFrame, numeric: list[str], coded: list[str], label: str, id_col: str = "id") -> DataFrame:
    """Mean silhouette by Gower's distance (a differing answer counts 1, a number its difference over the column's range, the
    mean over all columns), exact and without pairs.

    The summed distance of a row to a cluster falls apart by column. For an answer it is the cluster's size less its count of that
    answer; for a number v it is v (2 n - N) - 2 s + S, with n and s the number and sum of the cluster's values up to v, and N and
    S those of all. So each distinct value of a column has one row with a distance to every cluster, which rows look up. Running
    sums go over ranges of the values, each summed apart. Rows without a label stay out; clusters of one row score 0; a missing
    answer is an answer of its own, missing numbers raise. One cluster or no row has no silhouette (null).
    """
    no_gaps(df, numeric)
    long_parts = []
    rows = df.where(F.col(label).isNotNull()).select(
        F.col(id_col).alias("i"), F.col(label).cast("string").alias("c"), *[F.col(x).cast("double").alias(f"n{j}") for j, x in enumerate(numeric)],
        *[F.concat(F.lit("="), F.coalesce(F.col(x).cast("string"), F.lit(""))).alias(f"a{j}") for j, x in enumerate(coded)])
    sizes = {r["c"]: r["count"] for r in rows.groupBy("c").count().orderBy("c").collect()}  # one row for each cluster
    names = list(sizes)
    if len(names) < 2:
        return df.sparkSession.createDataFrame([(None,)], "silhouette double")
    p = len(numeric) + len(coded)
    if numeric:
        ends = rows.agg(*[f(f"n{j}").alias(f"{t}{j}") for j in range(len(numeric)) for t, f in (("a", F.min), ("b", F.max))]).first()
        spans = [ends[f"b{j}"] - ends[f"a{j}"] for j in range(len(numeric))]
        values = rows.unpivot(["i", "c"], [f"n{j}" for j in range(len(numeric))], "q", "v")
        held = values.groupBy("q", "v").agg(*[F.count_if(F.col("c") == c).alias(f"k{m}") for m, c in enumerate(names)])
        ranged = cut_lineage(held.repartitionByRange("q", "v").withColumn("part", F.spark_partition_id()))
        sums = [x for m in range(len(names)) for x in ((f"k{m}", F.col(f"k{m}").cast("double")), (f"s{m}", F.col(f"k{m}") * F.col("v")))]
        totals = ranged.groupBy("q", "part").agg(*[F.sum(e).alias(n) for n, e in sums])
        before = Window.partitionBy("q").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        every = Window.partitionBy("q")
        shifts = totals.select("q", "part", *[F.coalesce(F.sum(n).over(before), F.lit(0.0)).alias("b" + n) for n, _ in sums],
                               *[F.sum(n).over(every).alias("t" + n) for n, _ in sums])
        upto = Window.partitionBy("part", "q").orderBy("v")
        span = F.element_at(F.create_map(*[F.lit(x) for j, w in enumerate(spans) for x in (f"n{j}", w or 1.0)]), F.col("q"))
        away = [(F.col("v") * (2 * F.col(f"r{m}") - F.col(f"tk{m}")) - 2 * F.col(f"u{m}") + F.col(f"ts{m}")) / span for m in range(len(names))]
        table = ranged.withColumns({("r" if n[0] == "k" else "u") + n[1:]: F.sum(e).over(upto) for n, e in sums}).join(shifts, ["q", "part"]) \
            .withColumns({("r" if n[0] == "k" else "u") + n[1:]: F.col(("r" if n[0] == "k" else "u") + n[1:]) + F.col("b" + n) for n, _ in sums})
        table = table.select("q", "v", *[a.alias(f"d{m}") for m, a in enumerate(away)])
        long_parts.append(values.join(table, ["q", "v"]).select("i", "c", *[f"d{m}" for m in range(len(names))]))
    if coded:
        answers = rows.unpivot(["i", "c"], [f"a{j}" for j in range(len(coded))], "q", "v")
        table = answers.groupBy("q", "v").agg(*[(sizes[c] - F.count_if(F.col("c") == c)).cast("double").alias(f"d{m}")
                                                for m, c in enumerate(names)])
        long_parts.append(answers.join(table, ["q", "v"]).select("i", "c", *[f"d{m}" for m in range(len(names))]))
    every_part = long_parts[0] if len(long_parts) == 1 else long_parts[0].unionByName(long_parts[1])
    summed = every_part.groupBy("i", "c").agg(*[F.sum(f"d{m}").alias(f"d{m}") for m in range(len(names))])
    own = F.coalesce(*[F.when(F.col("c") == c, F.col(f"d{m}") / max(sizes[c] - 1, 1)) for m, c in enumerate(names)]) / p
    others = [F.when(F.col("c") != c, F.col(f"d{m}") / sizes[c] / p) for m, c in enumerate(names)]
    single = F.col("c").isin([c for c in names if sizes[c] == 1])
    inner, outer = F.col("inner"), F.col("outer")
    top = F.greatest(inner, outer)
    return summed.select(own.alias("inner"), F.array_min(F.array_compact(F.array(*others))).alias("outer"), single.alias("single")).select(
        F.avg(F.when(~F.col("single") & (top > 0), (outer - inner) / top).otherwise(0.0)).alias("silhouette"))


def silhouette_euclidean(df: DataFrame, features: list[str], label: str, block_rows: int = 2048,
                         chunk: int = 512) -> DataFrame:
    """Mean Euclidean silhouette, exact.

    Needs the distance of every row to every row; quadratic, so meant for tables where that can be afforded (the
    squared-Euclidean score above is the one for large data). Equal rows are merged first and written once, in blocks of bounded
    size; a task takes some blocks, reads all others in turn and returns two sums, never pairs. Rows without a label score 0 and
    are in no cluster; a missing number leaves no sum of distances, and all rows score 0.
    """
    names = [F.col(f).cast("double") for f in features]
    spark = df.sparkSession
    points = (df.select(F.coalesce(F.concat(F.lit("="), F.col(label).cast("string")), F.lit("null")).alias("grp"), F.array(*names).alias("x"))
              .groupBy("grp", "x").agg(F.count(F.lit(1)).alias("copies"))
              .select("grp", F.lit(0).alias("cell"), F.xxhash64("x").cast("double").alias("away"), F.lit(0).cast("long").alias("rep"), "copies", "x"))
    folder = f"{shared_place(spark)}/points"
    points = points.persist()
    if not points.filter(F.exists("x", lambda v: v.isNull() | F.isnan(v))).isEmpty():
        points.unpersist()
        return spark.createDataFrame([(0.0,)], "silhouette double")
    blocks = write_blocks(points, folder, block_rows, 1 << 62)
    points.unpersist()
    if not blocks:
        return spark.createDataFrame([(None,)], "silhouette double")
    kinds = sorted({b.grp for b in blocks} - {"null"})
    sizes = np.array([float(sum(b.ids for b in blocks if b.grp == g)) for g in kinds])
    shared = spark.sparkContext.broadcast(blocks)  # a line for each block

    def run(batches):
        blocks, files = shared.value, {}
        for block in (blocks[i] for batch in batches for i in batch.column(0).to_pylist()):
            x, _, copies = read_blocks([block], files)
            totals = np.zeros((len(kinds), len(x)))
            for other in blocks if block.grp != "null" else []:
                if other.grp != "null":
                    y, _, weight = read_blocks([other], files)
                    for at in range(0, len(x), chunk):
                        totals[kinds.index(other.grp), at:at + chunk] += _distances(x[at:at + chunk], y) @ weight
            score = np.zeros(len(x))
            own = kinds.index(block.grp) if block.grp != "null" else None
            if own is not None and sizes[own] > 1 and len(kinds) > 1:
                inner = totals[own] / (sizes[own] - 1)
                outer = np.fmin.reduce(np.delete(totals / sizes[:, None], own, axis=0))
                top = np.maximum(inner, outer)
                score = np.nan_to_num(np.divide(outer - inner, top, out=score, where=top != 0))
            yield pa.RecordBatch.from_arrays([pa.array([float(score @ copies)]), pa.array([float(copies.sum())])], names=["score", "n"])

    tasks = min(len(blocks), max(4 * spark.sparkContext.defaultParallelism, len(blocks) // 8))
    got = spark.range(0, len(blocks), 1, tasks).mapInArrow(run, "score double, n double").agg(F.sum("score").alias("s"), F.sum("n").alias("n")).first()
    store, name = open_store(folder)
    store.delete_dir(name)
    return spark.createDataFrame([(got["s"] / got["n"],)], "silhouette double")


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances by one product; pairs so near that it would lose digits are taken one by one."""
    middle = y[0]
    u, v = x - middle, y - middle
    both = (u * u).sum(1)[:, None] + (v * v).sum(1)
    d2 = both - 2 * (u @ v.T)
    a, b = np.nonzero(d2 <= 1e-5 * both)
    for at in range(0, len(a), 65536):
        i, j = a[at:at + 65536], b[at:at + 65536]
        d2[i, j] = ((x[i] - y[j]) ** 2).sum(1)
    return np.sqrt(d2, out=d2)


def adjusted_rand(df: DataFrame, left: str, right: str) -> DataFrame:
    """Adjusted Rand index of two label columns, from their contingency table."""
    cells = df.groupBy(F.col(left).alias("a"), F.col(right).alias("b")).count()

    def pairs(c):
        c = F.col(c).cast("double")
        return c * (c - 1) / 2

    def part(kind, table, c):
        return table.agg(F.sum(pairs(c)).alias("pairs"), F.sum(c).alias("n")).withColumn("kind", F.lit(kind))

    sides = (part("both", cells, "count")
             .unionByName(part("rows", cells.groupBy("a").agg(F.sum("count").alias("c")), "c"))
             .unionByName(part("cols", cells.groupBy("b").agg(F.sum("count").alias("c")), "c")))
    both, rows, cols = (F.max(F.when(F.col("kind") == k, F.col("pairs"))) for k in ("both", "rows", "cols"))
    out = sides.agg(both.alias("both"), rows.alias("rows"), cols.alias("cols"), F.max("n").alias("n"))
    chance = F.col("rows") * F.col("cols") / pairs("n")
    top = (F.col("rows") + F.col("cols")) / 2 - chance
    return out.select(F.when(top == 0, F.lit(1.0)).otherwise((F.col("both") - chance) / top).alias("ari"))


def rank_runs(runs: DataFrame, criteria: bool = False) -> DataFrame:
    """Ranks of runs by score and their sum; higher is better. Information criteria join when asked for."""
    out = runs.withColumns({
        "silhouette_rank": average_rank("silhouette"),
        "davies_bouldin_rank": average_rank("davies_bouldin", ascending=False),
        "calinski_harabasz_rank": average_rank("calinski_harabasz")})
    ranks = ["silhouette_rank", "davies_bouldin_rank", "calinski_harabasz_rank"]
    if criteria:
        out = out.withColumns({"bic_rank": average_rank("bic", ascending=False) * BIC_WEIGHT,
                               "aic_rank": average_rank("aic", ascending=False)})
        ranks += ["bic_rank", "aic_rank"]
    return out.withColumn("rank_sum", sum((F.coalesce(F.col(r), F.lit(0.0)) for r in ranks), F.lit(0.0)))


def balanced(runs: DataFrame) -> DataFrame:
    """Runs whose segments all hold more than 2 and less than 55 percent."""
    shares = F.map_values("cluster_proportions")
    return runs.filter((F.array_min(shares) > SHARE_LOW) & (F.array_max(shares) < SHARE_HIGH))


def _winner(score: str, k: str):
    """The k of the highest score over a table of runs, ties to the smallest k."""
    return F.min(F.struct((-F.col(score)).alias("s"), F.col(k).alias("k"))).over(Window.partitionBy())["k"]


def elbow(costs: DataFrame, k: str = "n_clusters", cost: str = "cost") -> DataFrame:
    """Distance of each (position, cost) from the chord between the first and the last, and the farthest one."""
    whole = Window.orderBy(k).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    at = F.row_number().over(Window.orderBy(k)) - 1
    dx, dy = F.count(F.lit(1)).over(whole) - 1, F.last(cost).over(whole) - F.first(cost).over(whole)
    rise = F.col(cost) - F.first(cost).over(whole)
    away = F.abs(dx * rise - dy * at) / F.sqrt(dx * dx + dy * dy)
    out = costs.withColumn("distance", F.coalesce(F.when(dx > 0, away), F.lit(0.0)))
    return out.withColumn("is_elbow", F.col(k) == _winner("distance", k))


def best_k(runs: DataFrame, k: str = "n_clusters", cost: str = "cost") -> DataFrame:
    """Rank sums with the elbow's bonus (one point per run tried) and the winning k, ties to the smallest."""
    ranked = rank_runs(elbow(runs, k, cost))
    n = F.count(F.lit(1)).over(Window.partitionBy())
    ranked = ranked.withColumn("rank_sum", F.col("rank_sum") + F.when(F.col("is_elbow"), n).otherwise(0))
    return ranked.withColumn("is_best", F.col(k) == _winner("rank_sum", k))


def random_ratios(df: DataFrame, features: list[str], label: str, id_col: str = "id") -> DataFrame:
    """Scores against the mean over ten random labellings, all scored in the same two passes.

    A random labelling draws one more label than there are clusters; labels hang on the respondent's key.
    """
    k = df.select(label).distinct().count()
    randoms = [f"__random{i}" for i in range(RANDOM_RUNS)]
    labelled = df.withColumns({c: random_label(id_col, i, k + 1) for i, c in enumerate(randoms)})
    real, *drawn = score_labellings(labelled, features, [label, *randoms])
    mean = {s: float(np.mean([r[s] for r in drawn])) for s in ("silhouette", "davies_bouldin", "calinski_harabasz")}
    rows = [("calinski_harabasz_random_ratio", float(real["calinski_harabasz"] / mean["calinski_harabasz"])),
            ("davies_bouldin_random_ratio", mean["davies_bouldin"] / real["davies_bouldin"]),
            ("silhouette_random_ratio", abs(real["silhouette"] / mean["silhouette"]))]
    return df.sparkSession.createDataFrame(rows, "metric string, value double")
