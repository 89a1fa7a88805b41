"""Clustering around centres: k-means, k-modes and k-prototypes, many starts at a time.

The three share one loop. A row has numeric columns (optionally projected on principal axes) and categorical
codes; its distance to a centre is the squared Euclidean distance plus gamma times the number of differing codes.
All runs (every k, every seed) advance together: one pass over the rows per iteration returns sums per run and
cluster, and only those, runs x k x columns numbers, reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sampling import unit_hash
from .batch import PACKED, add_columns, no_gaps, packed, partial_sums, unpacked
from .reduce import Axes

ROUNDS, DRAWS, POOL_BLOCK = 5, 200, 2000
MAX_ITERATIONS = 100
TOLERANCE = 1e-4


@dataclass
class Centres:
    """Centres of one run."""

    numeric: np.ndarray
    modes: np.ndarray
    gamma: float = 1.0
    cost: float = float("inf")
    sizes: np.ndarray | None = None
    iterations: int = 0
    axes: Axes | None = None
    settled: bool = False  # at rest, not stopped by the number of iterations

    @property
    def k(self) -> int:
        return max(len(self.numeric), len(self.modes))

    def distances(self, x: np.ndarray, codes: np.ndarray) -> np.ndarray:
        if self.numeric.shape[1]:
            middle = self.numeric.mean(axis=0)  # near it the squares stay small, whatever offset a column has
            c, x = self.numeric - middle, x - middle
            out = 2.0 * x @ c.T
            np.subtract((x ** 2).sum(1)[:, None], out, out=out)
            out += (c ** 2).sum(1)
            np.maximum(out, 0.0, out=out)
        else:
            out = np.zeros((len(x), self.k))
        for q in range(self.modes.shape[1]):
            out += self.gamma * (codes[:, q][:, None] != self.modes[None, :, q])
        return out


@dataclass
class Layout:
    """Which columns are numeric and which hold codes, and the axes to project the numeric ones on."""

    numeric: list[str]
    codes: list[str]
    axes: Axes | None = None
    names: list[str] = field(init=False)

    def __post_init__(self):
        self.names = [*self.numeric, *self.codes]

    def split(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = len(self.numeric)
        x = values[:, :p]
        return (self.axes.project(x) if self.axes is not None else x), values[:, p:p + len(self.codes)]


def patterns(df: DataFrame, codes: list[str]) -> DataFrame:
    """Distinct code rows with their number of copies; what k-modes and latent classes need to see."""
    return df.groupBy(*codes).agg(F.count(F.lit(1)).cast("double").alias("copies"))


@dataclass
class Pool:
    """Candidate starts of a table, the number of rows nearest to each, and the tolerance of its fits."""

    rows: np.ndarray
    weight: np.ndarray
    tolerance: float

    def __len__(self) -> int:
        return len(self.rows)


def start_pool(df: DataFrame, layout: Layout, id_col: str, gamma: float = 1.0, least: int = 0) -> Pool:
    """Candidates from all rows, after k-means|| (Bahmani et al. 2012).

    Each of ROUNDS passes draws DRAWS rows without replacement, a row's weight being its distance to the candidates so
    far (the largest ln(u) / distance, u a hash of the key). More passes follow while there are fewer than ``least``
    different candidates and rows apart from all of them. A last pass counts the rows nearest to each candidate and takes
    the variances of which the tolerance is a part.
    """
    no_gaps(df, layout.names)
    held = df.select(packed(layout.names), F.col(id_col).alias("i")).persist()
    first = held.orderBy(unit_hash("i", 7), "i").limit(1).collect()
    if not first:
        held.unpersist()
        return Pool(np.zeros((0, len(layout.names))), np.zeros(0), 0.0)
    known = np.array([first[0][0]], dtype=float)
    kind = held.schema["i"].dataType.simpleString()

    def blocks(x: np.ndarray, near: Centres):
        return (near.distances(*layout.split(x[at:at + POOL_BLOCK])) for at in range(0, len(x), POOL_BLOCK))

    def away(near: Centres):
        def step(batches):
            for batch in batches:
                if batch.num_rows:
                    d = np.concatenate([d.min(1) for d in blocks(unpacked(batch), near)])
                    yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(d)], names=[PACKED, "i", "d"])

        return step

    turn = 0
    while turn < ROUNDS or len(known) < least:
        turn += 1
        u = F.greatest(unit_hash("i", 7 + turn), F.lit(1e-300))
        drawn = (held.mapInArrow(away(Centres(*layout.split(known), gamma)), f"{PACKED} array<double>, i {kind}, d double")
                 .where("d > 0").orderBy((F.log(u) / F.col("d")).desc(), "i").limit(DRAWS).select(PACKED).collect())
        grown = np.unique(np.array([*known.tolist(), *(r[0] for r in drawn)], dtype=float), axis=0)
        if len(grown) == len(known):
            break
        known = grown
    near, m = Centres(*layout.split(known), gamma), len(known)
    middle = layout.split(known)[0].mean(0)
    p = len(middle)

    def counted(x: np.ndarray) -> dict[str, np.ndarray]:
        own = np.concatenate([d.argmin(1) for d in blocks(x, near)])
        shifted = layout.split(x)[0] - middle
        return {"pos": np.arange(m + 2 * p),
                "value": np.concatenate([np.bincount(own, minlength=m), shifted.sum(0), (shifted ** 2).sum(0)])}

    total = np.zeros(m + 2 * p)
    for r in partial_sums(held, [F.col(PACKED)[i] for i in range(len(layout.names))], counted, ["pos"]).collect():
        total[r["pos"]] = r["value"]
    held.unpersist()
    n = total[:m].sum()
    variance = total[m + p:] / n - (total[m:m + p] / n) ** 2
    return Pool(known, total[:m], TOLERANCE * float(variance.mean()) if p else 0.0)


def spread_starts(pool: Pool, layout: Layout, k: int, seed: int, gamma: float = 1.0) -> Centres:
    """k-means++ draws from the candidates, each weighing as many rows as are nearest to it."""
    rng = np.random.default_rng(seed)
    x, codes = layout.split(pool.rows)
    share = pool.weight / pool.weight.sum()
    chosen = [int(rng.choice(len(pool), p=share))]
    for _ in range(1, k):
        mass = share * Centres(x[chosen], codes[chosen], gamma).distances(x, codes).min(1)
        total = mass.sum()
        chosen.append(int(rng.choice(len(pool), p=mass / total if total > 0 else share)))
    return Centres(x[chosen], codes[chosen], gamma, axes=layout.axes)


def dense_starts(weighted: DataFrame, layout: Layout, k: int, gamma: float = 1.0) -> Centres:
    """Deterministic starts for coded rows: the densest pattern, then repeatedly the pattern whose density times
    mismatches to its nearest start is largest. Density is the mean share of a pattern's answers (Cao et al. 2009).
    """
    codes = layout.codes
    total = weighted.agg(F.sum("copies")).first()[0]
    freq: dict[str, dict[int, float]] = {c: {} for c in codes}
    long = weighted.unpivot(["copies"], codes, "q", "code").groupBy("q", "code").agg(F.sum("copies").alias("n"))
    for r in long.collect():
        freq[r["q"]][int(r["code"])] = r["n"] / total
    share = [F.element_at(F.array(*[F.lit(freq[c].get(v, 0.0)) for v in range(max(freq[c]) + 1)]),
                          F.col(c).cast("int") + 1) for c in codes]
    density = F.round(sum(share[1:], share[0]) / len(codes), 12)
    chosen: list[list[float]] = []
    while len(chosen) < k:
        score = density
        if chosen:
            gaps = [sum((F.when(F.col(c) != v, 1).otherwise(0) for c, v in zip(codes, z)), F.lit(0)) for z in chosen]
            score = density * (F.least(*gaps) if len(gaps) > 1 else gaps[0])
        best = (weighted.select(F.round(score, 9).alias("score"), *codes)
                .orderBy(F.desc("score"), *codes).limit(1).first())
        chosen.append([float(best[c]) for c in codes])
    return Centres(np.zeros((k, 0)), np.array(chosen), gamma)


def _sums(layout: Layout, runs: dict[int, Centres], weighted: bool):
    def step(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            values = unpacked(batch)
            w = values[:, -1] if weighted else np.ones(len(values))
            x, codes = layout.split(values)
            cols = {c: [] for c in ("run", "cluster", "kind", "pos", "code", "value")}

            def put(run, kind, cluster, pos, code, value):
                for name, v in (("cluster", cluster), ("pos", pos), ("code", code), ("value", value)):
                    cols[name].append(np.asarray(v).reshape(-1))
                cols["run"].append(np.full(len(cols["value"][-1]), run))
                cols["kind"].append(np.full(len(cols["value"][-1]), kind))

            for run, centres in runs.items():
                d = centres.distances(x, codes)
                own = d.argmin(1)
                k = centres.k
                near = d[np.arange(len(d)), own]
                put(run, 0, np.arange(k), np.zeros(k), np.zeros(k), np.bincount(own, w, k))
                put(run, 1, np.arange(k), np.zeros(k), np.zeros(k), np.bincount(own, w * near, k))
                if x.shape[1]:
                    hot = (own[:, None] == np.arange(k)[None, :]) * w[:, None]
                    s = hot.T @ x
                    put(run, 2, np.repeat(np.arange(k), s.shape[1]), np.tile(np.arange(s.shape[1]), k),
                        np.zeros(s.size), s)
                for q in range(codes.shape[1]):
                    code = codes[:, q].astype(np.int64)
                    width = int(code.max()) + 1
                    counts = np.bincount(own * width + code, w, k * width)
                    at = np.flatnonzero(counts)
                    put(run, 3, at // width, np.full(len(at), q), at % width, counts[at])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(cols[c]).astype(np.int64)) for c in ("run", "cluster", "kind", "pos", "code")]
                + [pa.array(np.concatenate(cols["value"]).astype(np.float64))],
                names=["run", "cluster", "kind", "pos", "code", "value"])

    return step


def fit(rows: DataFrame, layout: Layout, starts: dict[int, Centres], max_iterations: int = MAX_ITERATIONS,
        tolerance: float = 0.0) -> dict[int, Centres]:
    """Move all runs to rest, or through ``max_iterations`` steps. A run rests when its modes stay and the squared
    moves of its numeric centres sum to at most ``tolerance``.

    ``rows`` may carry ``copies``. Cost and sizes belong to the last assignment made. Modes tie to the smallest
    code, rows between equally near centres go to the first, an emptied cluster keeps its centre.
    """
    weighted = "copies" in rows.columns
    plain = rows.select(packed([*layout.names, *(["copies"] if weighted else [])])).persist()
    done: dict[int, Centres] = {}
    live = dict(starts)
    for iteration in range(1, max_iterations + 1):
        sums = (plain.mapInArrow(_sums(layout, live, weighted),
                                 "run long, cluster long, kind long, pos long, code long, value double")
                .groupBy("run", "cluster", "kind", "pos", "code").agg(F.sum("value").alias("value")))
        if layout.codes:
            sums = sums.groupBy("run", "cluster", "kind", "pos").agg(
                F.sum("value").alias("total"), F.min(F.struct((-F.col("value")).alias("v"), "code")).alias("best"))
        else:
            sums = sums.select("run", "cluster", "kind", "pos", F.col("value").alias("total"))
        top = sums.collect()
        grouped: dict[int, list] = {run: [] for run in live}
        for r in top:
            grouped[r["run"]].append(r)
        for run, own in grouped.items():
            old = live[run]
            sizes = np.zeros(old.k)
            for r in own:
                if r["kind"] == 0:
                    sizes[r["cluster"]] = r["total"]
            numeric, modes = old.numeric.copy(), old.modes.copy()
            for r in own:
                if sizes[r["cluster"]] > 0:
                    if r["kind"] == 2:
                        numeric[r["cluster"], r["pos"]] = r["total"] / sizes[r["cluster"]]
                    elif r["kind"] == 3:
                        modes[r["cluster"], r["pos"]] = r["best"]["code"]
            cost = float(sum(r["total"] for r in own if r["kind"] == 1))
            still = bool(((numeric - old.numeric) ** 2).sum() <= tolerance and (modes == old.modes).all())
            new = Centres(numeric, modes, old.gamma, cost, sizes, iteration, layout.axes, still)
            if still or iteration == max_iterations:
                done[run] = new
                del live[run]
            else:
                live[run] = new
        if not live:
            break
    plain.unpersist()
    return dict(sorted(done.items()))


def assign(df: DataFrame, layout: Layout, runs: dict[str, Centres], scores: bool = False) -> DataFrame:
    """Adds one label column per run, named by its key, and on request the projected scores s0, s1, .. ."""
    n_scores = layout.axes.vectors.shape[1] if scores and layout.axes is not None else 0
    outputs = {**{r: "int" for r in runs}, **{f"s{i}": "double" for i in range(n_scores)}}

    def label(values: np.ndarray) -> list[np.ndarray]:
        x, codes = layout.split(values)
        return [c.distances(x, codes).argmin(1) for c in runs.values()] + [x[:, i] for i in range(n_scores)]

    return add_columns(df, layout.names, outputs, label)


def half_mean_deviation(df: DataFrame, numeric: list[str]) -> float:
    """Weight of a mismatch against squared distances: half the mean population deviation."""
    row = df.agg(*[F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(numeric)]).first()
    return 0.5 * float(np.mean([row[f"s{i}"] or 0.0 for i in range(len(numeric))]))
