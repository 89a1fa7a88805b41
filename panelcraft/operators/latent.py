"""Latent classes by expectation-maximisation, for coded answers with or without numeric columns.

Rows are respondents or, when all columns are coded, distinct answer patterns with their copies. Every iteration
is one pass for all runs (class counts x restarts): the posteriors are formed inside the batch and only weighted
counts per (run, class, question, answer) leave it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batch import add_columns, packed, unpacked

# Class counts tried and restarts of each.
CODED_K = range(3, 9)
MIXED_K = range(2, 9)
RESTARTS = 30
WIDE_COLUMNS, WIDE_LEAST, WIDE_SHARE = 100, 70, 0.3
FLOOR = 1e-12
VARIANCE_FLOOR = 1e-6


@dataclass
class Classes:
    """Class weights, answer probabilities per question, and means and variances of the numeric columns."""

    weight: np.ndarray
    answers: list[np.ndarray]
    mean: np.ndarray
    variance: np.ndarray
    log_likelihood: float = float("-inf")
    iterations: int = 0
    settled: bool = True

    @property
    def k(self) -> int:
        return len(self.weight)

    def n_parameters(self) -> int:
        coded = sum(a.shape[1] - 1 for a in self.answers)
        return self.k - 1 + self.k * coded + 2 * self.mean.size

    def bic(self, n: float) -> float:
        return -2.0 * self.log_likelihood + self.n_parameters() * float(np.log(n))

    def joint(self, codes: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Log of class weight times likelihood, rows x classes."""
        out = np.tile(np.log(np.maximum(self.weight, FLOOR)), (len(codes), 1))
        for q, a in enumerate(self.answers):
            out += np.log(np.maximum(a, FLOOR)).T[codes[:, q]]
        for j in range(x.shape[1]):
            v = self.variance[:, j]
            out += -0.5 * (np.log(2 * np.pi * v) + (x[:, j][:, None] - self.mean[None, :, j]) ** 2 / v)
        return out


def posterior(joint: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    top = joint.max(1, keepdims=True)
    odds = np.exp(joint - top)
    total = odds.sum(1, keepdims=True)
    return odds / total, (top + np.log(total))[:, 0]


def levels_of(rows: DataFrame, codes: list[str]) -> list[int]:
    row = rows.agg(*[F.max(F.col(c).cast("int")).alias(f"c{i}") for i, c in enumerate(codes)]).first()
    return [row[f"c{i}"] + 1 for i in range(len(codes))]


def random_classes(levels: list[int], k: int, seed: int, mean: np.ndarray, deviation: np.ndarray) -> Classes:
    rng = np.random.default_rng(seed)
    return Classes(np.full(k, 1.0 / k), [rng.dirichlet(np.full(m, 2.0), k) for m in levels],
                   mean + deviation * rng.standard_normal((k, len(mean))), np.tile(np.maximum(deviation ** 2, VARIANCE_FLOOR), (k, 1)))


def em_step(rows: DataFrame, codes: list[str], numeric: list[str], runs: dict[int, Classes],
            weighted: bool) -> dict[int, Classes]:
    """One expectation and one maximisation for every run; the likelihood returned is that of the input classes."""
    names = [*codes, *numeric] + (["copies"] if weighted else [])
    q_n, p = len(codes), len(numeric)

    def expect(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            values = unpacked(batch)
            w = values[:, -1] if weighted else np.ones(len(values))
            c, x = values[:, :q_n].astype(np.int64), values[:, q_n:q_n + p]
            cols = {name: [] for name in ("run", "cls", "kind", "pos", "code", "value")}
            for run, classes in runs.items():
                post, ll = posterior(classes.joint(c, x))
                k = classes.k
                post = post * w[:, None]
                parts = [(0, np.arange(k), np.zeros(k), np.zeros(k), post.sum(0)),
                         (1, np.zeros(1), np.zeros(1), np.zeros(1), np.array([(ll * w).sum()]))]
                for q in range(q_n):
                    m = classes.answers[q].shape[1]
                    counts = np.stack([np.bincount(c[:, q], post[:, j], m) for j in range(k)])
                    parts.append((2, np.repeat(np.arange(k), m), np.full(k * m, q), np.tile(np.arange(m), k), counts))
                if p:
                    moved = x[None, :, :] - classes.mean[:, None, :]
                    first = np.einsum("nk,knp->kp", post, moved)
                    second = np.einsum("nk,knp->kp", post, moved ** 2)
                    at = (np.repeat(np.arange(k), p), np.tile(np.arange(p), k), np.zeros(k * p))
                    parts += [(3, *at, first), (4, *at, second)]
                for kind, cls, pos, code, value in parts:
                    for name, v in (("cls", cls), ("pos", pos), ("code", code), ("value", value)):
                        cols[name].append(np.asarray(v).reshape(-1))
                    n = len(cols["value"][-1])
                    cols["run"].append(np.full(n, run))
                    cols["kind"].append(np.full(n, kind))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(cols[n]).astype(np.int64)) for n in ("run", "cls", "kind", "pos", "code")]
                + [pa.array(np.concatenate(cols["value"]))], names=["run", "cls", "kind", "pos", "code", "value"])

    got = (rows.select(packed(names))
           .mapInArrow(expect, "run long, cls long, kind long, pos long, code long, value double")
           .groupBy("run", "cls", "kind", "pos", "code").agg(F.sum("value").alias("value")).collect())
    own: dict[int, list] = {run: [] for run in runs}
    for r in got:
        own[r["run"]].append(r)
    return {run: _maximise(runs[run], own[run]) for run in runs}


def _maximise(old: Classes, sums: list) -> Classes:
    size = np.zeros(old.k)
    counts = [np.zeros_like(a) for a in old.answers]
    first, second = np.zeros_like(old.mean), np.zeros_like(old.mean)
    ll = 0.0
    for r in sums:
        kind, cls, pos = r["kind"], r["cls"], r["pos"]
        if kind == 0:
            size[cls] = r["value"]
        elif kind == 1:
            ll = r["value"]
        elif kind == 2:
            counts[pos][cls, r["code"]] = r["value"]
        elif kind == 3:
            first[cls, pos] = r["value"]
        else:
            second[cls, pos] = r["value"]
    held = np.maximum(size, FLOOR)[:, None]
    shift = first / held
    return Classes(size / size.sum(), [c / held for c in counts], old.mean + shift,
                   np.maximum(second / held - shift ** 2, VARIANCE_FLOOR), float(ll), old.iterations + 1)


def fit_classes(rows: DataFrame, codes: list[str], numeric: list[str], starts: dict[int, Classes],
                max_iterations: int = 200, tolerance: float = 1e-6) -> dict[int, Classes]:
    """Iterate until the relative gain in likelihood falls below the tolerance, run by run."""
    weighted = "copies" in rows.columns
    held = rows.select(*codes, *numeric, *(["copies"] if weighted else [])).persist()
    live, done = dict(starts), {}
    last = {run: float("-inf") for run in live}
    for _ in range(max_iterations):
        live = em_step(held, codes, numeric, live, weighted)
        for run in list(live):
            ll = live[run].log_likelihood
            if np.isfinite(last[run]) and ll - last[run] <= tolerance * abs(ll):
                done[run] = live.pop(run)
            else:
                last[run] = ll
        if not live:
            break
    held.unpersist()
    for model in live.values():
        model.settled = False
    return dict(sorted({**done, **live}.items()))


def class_labels(df: DataFrame, codes: list[str], numeric: list[str], classes: Classes, name: str = "cluster") -> DataFrame:
    """Most probable class of every row, counted from 1."""
    def label(v: np.ndarray) -> list[np.ndarray]:
        return [classes.joint(v[:, :len(codes)].astype(np.int64), v[:, len(codes):]).argmax(1) + 1]

    return add_columns(df, [*codes, *numeric], {name: "int"}, label)


def wide_subset(columns: list[str], seed: int = 42) -> list[str]:
    """More than 100 columns: a random max(70, 30 %) of them, as the method is fitted on."""
    if len(columns) <= WIDE_COLUMNS:
        return columns
    n = max(WIDE_LEAST, int(len(columns) * WIDE_SHARE))
    picked = np.random.default_rng(seed).choice(len(columns), n, replace=False)
    return [columns[i] for i in sorted(picked)]


def search_classes(rows: DataFrame, codes: list[str], numeric: list[str], ks=None, restarts: int = RESTARTS,
                   max_iterations: int = 200) -> tuple[Classes, list[dict]]:
    """Model of least BIC over class counts, each with its best restart. ``rows`` may carry ``copies``."""
    ks = list(ks or (MIXED_K if numeric else CODED_K))
    levels = levels_of(rows, codes) if codes else []
    n = float(rows.agg(F.sum("copies") if "copies" in rows.columns else F.count(F.lit(1))).first()[0])
    mean = deviation = np.zeros(0)
    if numeric:
        row = rows.agg(*[f(F.col(c).cast("double")).alias(f"{t}{i}") for i, c in enumerate(numeric)
                         for t, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
        mean, deviation = (np.array([row[f"{t}{i}"] for i in range(len(numeric))]) for t in "ms")
    keys = [(k, s) for k in ks for s in range(restarts)]
    fitted = fit_classes(rows, codes, numeric,
                         {i: random_classes(levels, k, 1000 * k + s, mean, deviation) for i, (k, s) in enumerate(keys)},
                         max_iterations)
    table = [{"n_clusters": keys[i][0], "restart": keys[i][1], "log_likelihood": c.log_likelihood, "bic": c.bic(n)}
             for i, c in fitted.items()]
    best_per_k = {k: max((i for i in fitted if keys[i][0] == k), key=lambda i: fitted[i].log_likelihood) for k in ks}
    return fitted[min(best_per_k.values(), key=lambda i: fitted[i].bic(n))], table
