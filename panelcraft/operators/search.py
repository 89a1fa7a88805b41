"""Searches over many runs (every k, seed and restart of a method) as small state machines over packed sums.

A search says what it wants to know of the rows (``expect``: a dictionary of arrays for a block of rows), how two such answers
add up (``merge``), and what follows from the total (``update``). Between updates nothing is kept but its own parameters, so a
search is fitted the same way whether blocks are the tasks of one pass over a table, whose sums meet on the driver, or the rows of
one branch among many, whose sums meet in a table keyed by branch (``joint_fit``). All runs of a search advance in one pass, and
several searches of different kinds can share the pass.

Rows come as a matrix (numeric columns first, then codes), with a weight and a hash of the respondent's key for draws.
"""

from __future__ import annotations

import numpy as np

from . import latent as la
from . import mixture as mi
from . import quality as ql
from .batch import refuse_gaps
from .centres import DRAWS, MAX_ITERATIONS, ROUNDS, TOLERANCE, Centres
from .reduce import VARIANCE_SHARE, Axes, Gram

# Seeds and the range of k (the upper end is not tried).
SEEDS = [1, 42, 100, 200, 404, 500, 1000, 123, 321, 78]
K_MIN, K_MAX = 3, 9
UNBALANCED = "Unable to perform clustering due to unbalanced clusters for all k"
CHUNK = 2048
#: Distances to candidate starts taken at once, so that they stay in the processor's cache.
NEAR = 1 << 17


def merge(a: dict, b: dict) -> dict:
    """Sums add up, ``max:`` entries take the larger value, ``top:`` entries keep the DRAWS rows of largest first column."""
    out = dict(a)
    for key, value in b.items():
        if key not in out:
            out[key] = value
        elif isinstance(value, dict):
            out[key] = merge(out[key], value)
        elif key.startswith("max:"):
            out[key] = np.maximum(out[key], value)
        elif key.startswith("top:"):
            out[key] = _top(np.concatenate([out[key], value]))
        else:
            out[key] = out[key] + value
    return out


def _top(rows: np.ndarray) -> np.ndarray:
    return rows[np.lexsort((rows[:, 1], -rows[:, 0]))[:DRAWS]]


def unit(h: np.ndarray, turn: int) -> np.ndarray:
    """A repeatable number in (0, 1] for each key hash and turn (splitmix64)."""
    with np.errstate(over="ignore"):
        z = h.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (turn + 1)) % (1 << 64))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    return ((z >> np.uint64(11)).astype(float) + 1.0) / 2.0 ** 53


# --- choosing among runs --------------------------------------------------------------------------------


def average_ranks(values: list[float | None], ascending: bool = True) -> np.ndarray:
    """Rank 1..n with ties averaged; a missing value has rank 0."""
    out = np.zeros(len(values))
    known = [v if ascending else -v for v in values if v is not None]
    for i, v in enumerate(values):
        if v is not None:
            v = v if ascending else -v
            out[i] = 1 + sum(x < v for x in known) + (sum(x == v for x in known) - 1) / 2
    return out


def rank_sums(runs: list[dict], criteria: bool = False) -> np.ndarray:
    """Sum of ranks by score, higher is better; the numbers of ``quality.rank_runs`` for runs held on the driver or in a task."""
    out = (average_ranks([r["silhouette"] for r in runs]) + average_ranks([r["davies_bouldin"] for r in runs], False)
           + average_ranks([r["calinski_harabasz"] for r in runs]))
    if criteria:
        out = (out + ql.BIC_WEIGHT * average_ranks([r["bic"] for r in runs], False)
               + average_ranks([r["aic"] for r in runs], False))
    return out


def choose_k(runs: list[dict]) -> int:
    """k of the best rank sum, the run farthest from the chord of the costs gaining one point per run; ties to the smallest k."""
    runs = sorted(runs, key=lambda r: r["n_clusters"])
    score, cost = rank_sums(runs), np.array([r["cost"] for r in runs])
    if len(runs) > 1:
        dx, rise = len(runs) - 1, cost - cost[0]
        away = np.abs(dx * rise - (cost[-1] - cost[0]) * np.arange(len(runs))) / np.hypot(dx, cost[-1] - cost[0])
        score[int(np.argmax(away))] += len(runs)
    else:
        score[0] += 1
    return runs[int(np.argmax(score))]["n_clusters"]


def choose_run(runs: list[dict], criteria: bool = False, any_balance: bool = False) -> dict | None:
    """Best run among those whose clusters are balanced, ties to the first; none if none is."""
    fair = runs if any_balance else [r for r in runs if r["cluster_proportions"] and min(r["cluster_proportions"].values()) > ql.SHARE_LOW
            and max(r["cluster_proportions"].values()) < ql.SHARE_HIGH]
    return fair[int(np.argmax(rank_sums(fair, criteria)))] if fair else None


# --- searches -------------------------------------------------------------------------------------------


class Search:
    """Phases follow each other: ``_sum_<phase>`` is taken of the rows, ``_end_<phase>`` reads the total and names the next."""

    algorithm = ""

    def __init__(self, numeric: list[str], codes: list[str]):
        self.numeric, self.codes = list(numeric), list(codes)
        self.phase, self.passes, self.runs, self.note, self.seed, self.cost = "look", 0, [], None, None, None
        self.model = None
        self.settled = True

    @property
    def columns(self) -> list[str]:
        return [*self.numeric, *self.codes]

    @property
    def done(self) -> bool:
        return self.phase == "done"

    @property
    def asks_like(self) -> tuple | None:
        """Searches of equal value ask the same of the rows, so that one answer serves them all."""
        return None

    @property
    def by_key(self) -> bool:
        """Whether the next step hangs on the hashes of the keys; the others see weighted rows alike however they are merged."""
        return self.phase == "draw"

    def expect(self, v: np.ndarray, w: np.ndarray, h: np.ndarray) -> dict:
        total: dict | None = None
        step = getattr(self, f"_sum_{self.phase}")
        for at in range(0, len(v), CHUNK):
            part = step(v[at:at + CHUNK], w[at:at + CHUNK], h[at:at + CHUNK])
            total = part if total is None else merge(total, part)
        return total or {}

    def update(self, total: dict) -> None:
        self.passes += 1
        if not total:  # no rows
            self.note, self.phase = "No rows", "done"
            return
        self.phase = getattr(self, f"_end_{self.phase}")(total)

    def label(self, v: np.ndarray) -> np.ndarray | None:
        """Labels of rows, or None where no model was chosen."""
        raise NotImplementedError

    @property
    def summary(self) -> dict:
        return {"algorithm": self.algorithm, "n_clusters": None if self.model is None else self.model.k, "cost": self.cost,
                "seed": self.seed, "passes": self.passes, "note": self.note}

    # first look, shared by all: sizes, means, gaps, levels; then squares around the means

    def _sum_look(self, v, w, h):
        codes = v[:, len(self.numeric):]
        known = np.nan_to_num(v)
        return {"n": w.sum(), "sum": w @ known, "gaps": np.isnan(v).sum(0),
                "max:codes": np.nan_to_num(codes, nan=-1).max(0) if codes.shape[1] else np.zeros(0)}

    def _end_look(self, t):
        refuse_gaps({c: int(n) for c, n in zip(self.columns, t["gaps"]) if n})
        self.n, self.mean = float(t["n"]), t["sum"] / t["n"]
        self.levels = (t["max:codes"] + 1).astype(int)
        self.offsets = np.concatenate([[0], np.cumsum(self.levels)[:-1]]).astype(int) if len(self.levels) else np.zeros(0, int)
        return "spread"

    def _sum_spread(self, v, w, h):
        moved = v - self.mean
        return {"square": (moved * w[:, None]).T @ moved}

    def _covariance(self, t) -> np.ndarray:
        cov = t["square"] / self.n
        self.deviation = np.sqrt(np.maximum(np.diag(cov), 0.0))
        return cov

    def _codes(self, v: np.ndarray) -> np.ndarray:
        return v[:, len(self.numeric):].astype(np.int64)

    def _count(self, own: np.ndarray, codes: np.ndarray, w: np.ndarray, k: int) -> np.ndarray:
        """Weight by cluster and answer, k x all levels."""
        width = int(self.levels.sum())
        at = own[:, None] * width + self.offsets + codes
        return np.bincount(at.ravel(), np.repeat(w, codes.shape[1]), k * width).reshape(k, width)

    # scores of labellings, two passes: moments, then distances to the centres

    def _score_matrix(self, v: np.ndarray) -> np.ndarray:
        """What labellings are scored on, around its mean."""
        return v - self.mean

    def _labellings(self, v: np.ndarray) -> dict[str, np.ndarray]:
        raise NotImplementedError

    def _sum_score(self, v, w, h):
        x = self._score_matrix(v)
        out = {}
        for name, own in self._labellings(v).items():
            k = int(self.candidates[name])
            hot = (own[:, None] == np.arange(k)) * w[:, None]
            out[name] = np.column_stack([hot.sum(0), hot.T @ (x ** 2).sum(1), hot.T @ x])
        return out

    def _end_score(self, t):
        self.moments = {}
        for name, got in t.items():
            n = got[:, 0]
            size = np.maximum(n, 1e-300)
            centre = got[:, 2:] / size[:, None]
            self.moments[name] = (n, centre, np.maximum(got[:, 1] / size - (centre ** 2).sum(1), 0.0))
        return "rate"

    def _sum_rate(self, v, w, h):
        x, out = self._score_matrix(v), {}
        at = np.arange(len(v))
        for name, own in self._labellings(v).items():
            n, centre, spread = self.moments[name]
            d2 = np.maximum((x ** 2).sum(1)[:, None] - 2 * x @ centre.T + (centre ** 2).sum(1), 0)
            mean = np.where(n > 0, d2 + spread, np.inf)
            inner = mean[at, own] * n[own] / np.maximum(n[own] - 1, 1)
            mean[at, own] = np.inf
            outer = mean.min(1)
            top = np.maximum(inner, outer)
            with np.errstate(invalid="ignore"):
                sil = np.where((n[own] > 1) & (top > 0) & np.isfinite(outer), (outer - inner) / np.where(top > 0, top, 1), 0.0)
            out[name] = np.stack([np.bincount(own, w * sil, len(n)), np.bincount(own, w * np.sqrt(d2[at, own]), len(n))])
        return out

    def _rated(self, t) -> list[dict]:
        out = []
        for name, (sil, dist) in t.items():
            n, centre, spread = self.moments[name]
            kept = n > 0
            n, centre, spread, k = n[kept], centre[kept], spread[kept], int(kept.sum())
            m = ql.Moments({0: n}, {0: centre}, {0: spread}, {})
            out.append({"run": name, "n_clusters": k, "silhouette": float(sil.sum() / n.sum()) if k > 1 else None,
                        "davies_bouldin": ql.davies_bouldin(centre, dist[kept] / n),
                        "calinski_harabasz": ql.calinski_harabasz(m, 0),
                        "cluster_proportions": {str(i): float(x) for i, x in zip(np.flatnonzero(kept), n / n.sum())}})
        self.moments = {}
        return out


class CentreSearch(Search):
    """k-means (on principal axes if ``share`` of the variance or ``components`` are given), k-modes or k-prototypes: k from one run per k, then the best seed.

    Starts come from k-means|| over all rows. ``dense`` takes the densest answers instead (Cao et al. 2009) in the search for k and
    in the run of the first seed, with numeric parts drawn around the means; they leave nothing else to a seed, so the runs of the
    other seeds are spread. ``any_balance`` takes the best run whatever its clusters hold.
    """

    def __init__(self, numeric, codes=(), share: float | None = None, dense: bool = False, seeds=None, k_min=K_MIN, k_max=K_MAX,
                 k: int | None = None, algorithm: str | None = None, any_balance: bool = False, components: int | None = None):
        super().__init__(numeric, codes)
        self.any_balance, self.components = any_balance, components
        self.share, self.dense, self.seeds, self.k = share, dense and bool(self.codes), list(seeds or SEEDS), k
        self.k_min, self.k_max = k_min, k_max
        self.algorithm = algorithm or ("PCA and Kmeans" if share else "kprototypes" if self.codes and self.numeric
                                       else "kmodes" if self.codes else "kmeans")
        self.axes: Axes | None = None
        self.gamma = 1.0

    @property
    def asks_like(self):
        if self.phase not in ("look", "spread", "answers", "pick", "draw", "weigh"):
            return None
        held = [None if a is None else a.tobytes() for a in (getattr(self, n, None) for n in ("pool", "picked"))]
        return type(self), self.phase, *self.numeric, None, *self.codes, None, self.share, self.components, self.dense, self.gamma, getattr(self, "turn", 0), *held

    def _split(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = v[:, :len(self.numeric)]
        return (self.axes.project(x) if self.axes is not None else x), self._codes(v)

    def _end_spread(self, t):
        cov, p = self._covariance(t), len(self.numeric)
        dev = self.deviation[:p]
        if self.share or self.components:
            safe = np.where(dev > 0, dev, 1.0)
            corr = cov[:p, :p] / np.outer(safe, safe)
            np.fill_diagonal(corr, (dev > 0).astype(float))
            axes = Gram(self.numeric, self.mean[:p], dev, corr).axes()
            self.axes = axes.keep(self.components) if self.components else axes.share(self.share)
        elif self.codes and p:
            self.gamma = 0.5 * float(dev.mean())
        self.most = self.k_max - 1 if self.k is None else self.k
        self.pool, self.turn = np.zeros((0, len(self.columns))), 0
        if self.dense:
            return "answers"
        return "draw"

    # starts from all rows

    def _sum_draw(self, v, w, h):
        if not len(self.pool):
            score = unit(h, 7)
        else:
            d = w * np.concatenate([d.min(1) for d in self._near(v)])
            with np.errstate(divide="ignore"):
                score = np.where(d > 0, np.log(unit(h, 7 + self.turn)) / d, -np.inf)
        rows = np.column_stack([score, h.astype(float), v])
        return {"top:rows": _top(rows[np.isfinite(score)])}

    def _near(self, v):
        """Distances of some rows after the other to the candidates."""
        near, size = Centres(*self._split(self.pool), self.gamma), max(1, NEAR // len(self.pool))
        return (near.distances(*self._split(v[at:at + size])) for at in range(0, len(v), size))

    def _end_draw(self, t):
        rows = t["top:rows"][:1 if not len(self.pool) else DRAWS, 2:]
        grown = np.unique(np.concatenate([self.pool, rows]), axis=0)
        stuck = len(grown) == len(self.pool)
        self.pool, self.turn = grown, self.turn + 1
        return "weigh" if stuck or (self.turn > ROUNDS and len(grown) >= self.most) else "draw"

    def _sum_weigh(self, v, w, h):
        x, codes = self._split(v)
        own = np.concatenate([d.argmin(1) for d in self._near(v)])
        moved = x - self._split(self.mean[None, :])[0]
        return {"near": np.bincount(own, w, len(self.pool)), "one": w @ moved, "two": w @ moved ** 2}

    def _end_weigh(self, t):
        self.pool_weight = t["near"]
        variance = t["two"] / self.n - (t["one"] / self.n) ** 2
        self.tolerance = TOLERANCE * float(variance.mean()) if len(variance) else 0.0
        return self._first_fit()

    def _spread_start(self, k: int, seed: int) -> Centres:
        rng = np.random.default_rng(seed)
        x, codes = self._split(self.pool)
        share = self.pool_weight / self.pool_weight.sum()
        chosen = [int(rng.choice(len(x), p=share))]
        for _ in range(1, k):
            mass = share * Centres(x[chosen], codes[chosen], self.gamma).distances(x, codes).min(1)
            total = mass.sum()
            chosen.append(int(rng.choice(len(x), p=mass / total if total > 0 else share)))
        return Centres(x[chosen], codes[chosen].astype(float), self.gamma, axes=self.axes)

    # dense starts

    def _sum_answers(self, v, w, h):
        return {"counts": self._count(np.zeros(len(v), np.int64), self._codes(v), w, 1)[0]}

    def _end_answers(self, t):
        self.answer_share = t["counts"] / self.n
        self.picked = np.zeros((0, len(self.codes)))
        return "pick"

    def _sum_pick(self, v, w, h):
        codes = np.unique(self._codes(v), axis=0)
        density = np.round(self.answer_share[self.offsets + codes].mean(1), 12)
        if len(self.picked):
            density = density * (codes[:, None, :] != self.picked).sum(2).min(1)
        density = np.round(density, 9)
        best = np.lexsort((*codes.T[::-1], -density))[0]  # ties to the smallest answers
        return {"top:best": np.array([[density[best], np.dot(codes[best], self._places()), *codes[best]]])}

    def _places(self) -> np.ndarray:
        """Weights that order answer rows as their codes do, the first question first (for ties only)."""
        return np.array([float(np.prod(self.levels[i + 1:].astype(float))) for i in range(len(self.levels))])

    def _end_pick(self, t):
        best = t["top:best"][0]
        if best[0] <= 0 and len(self.picked):  # fewer different answers than starts
            return "draw"
        self.picked = np.concatenate([self.picked, best[None, 2:]])
        return "pick" if len(self.picked) < self.most else "draw"

    def _dense_start(self, k: int, seed: int) -> Centres:
        p = len(self.numeric)
        drawn = self.mean[:p] + self.deviation[:p] * np.random.default_rng(seed).standard_normal((k, p))
        return Centres(drawn, self.picked[:k].copy(), self.gamma)

    def _start(self, k: int, seed: int) -> Centres:
        if self.dense and seed == self.seeds[0] and k <= len(self.picked):
            return self._dense_start(k, seed)
        return self._spread_start(k, seed)

    # fits

    def _first_fit(self) -> str:
        have = len(self.pool)
        if self.k is None:
            ks = [c for c in range(self.k_min, self.k_max) if c <= have]
            if len(ks) > 1:
                return self._fit({f"k{c}": self._start(c, self.seeds[0]) for c in ks}, True)
            self.k = ks[0] if ks else None
        if self.any_balance and self.k is not None and have:
            self.k = min(self.k, have)  # clusters beyond the different rows would stay empty
        if self.k is None or self.k > have:
            self.note = "Fewer different rows than clusters"
            return "done"
        return self._seeded_fit()

    def _seeded_fit(self) -> str:
        return self._fit({f"seed{s}": self._start(self.k, s) for s in self.seeds}, False)

    def _fit(self, starts: dict[str, Centres], choosing: bool) -> str:
        self.live, self.fitted, self.choosing, self.iteration = starts, {}, choosing, 0
        self.candidates = {name: c.k for name, c in starts.items()}
        return "fit"

    def _sum_fit(self, v, w, h):
        x, codes = self._split(v)
        out = {}
        for name, c in self.live.items():
            d = c.distances(x, codes)
            own = d.argmin(1)
            hot = (own[:, None] == np.arange(c.k)) * w[:, None]
            parts = [hot.sum(0), [w @ d[np.arange(len(d)), own]], (hot.T @ x).ravel()]
            if codes.shape[1]:
                parts.append(self._count(own, codes, w, c.k).ravel())
            out[name] = np.concatenate(parts)
        return out

    def _end_fit(self, t):
        self.iteration += 1
        for name, old in list(self.live.items()):
            k, p = old.k, old.numeric.shape[1]
            sizes, cost, sums, counts = np.split(t[name], [k, k + 1, k + 1 + k * p])
            numeric, modes = old.numeric.copy(), old.modes.copy()
            some = sizes > 0
            numeric[some] = sums.reshape(k, p)[some] / sizes[some, None]
            if len(self.levels):
                counts = counts.reshape(k, -1)
                for q, (at, width) in enumerate(zip(self.offsets, self.levels)):
                    modes[some, q] = counts[some, at:at + width].argmax(1)
            still = bool(((numeric - old.numeric) ** 2).sum() <= self.tolerance and (modes == old.modes).all())
            new = Centres(numeric, modes, old.gamma, float(cost[0]), sizes, self.iteration, self.axes, still)
            if still or self.iteration == MAX_ITERATIONS:
                self.fitted[name] = new
                del self.live[name]
            else:
                self.live[name] = new
        return "fit" if self.live else "score"

    def _score_matrix(self, v):
        return self._split(v)[0] - self._split(self.mean[None, :])[0] if self.axes is not None else v - self.mean

    def _labellings(self, v):
        x, codes = self._split(v)
        return {name: self.fitted[name].distances(x, codes).argmin(1) for name in self.candidates}

    def _end_rate(self, t):
        runs = [{**r, "n_clusters": self.fitted[r["run"]].k, "cost": self.fitted[r["run"]].cost} for r in self._rated(t)]
        runs.sort(key=lambda r: list(self.candidates).index(r["run"]))
        if self.choosing:
            self.k = choose_k(runs)
            return self._seeded_fit()
        self.runs, best = runs, choose_run(runs, any_balance=self.any_balance)
        if best is None:
            self.note = UNBALANCED
        else:
            self.model = self.fitted[best["run"]]
            self.cost, self.seed, self.settled = self.model.cost, int(best["run"][4:]), self.model.settled
            if not self.settled:
                self.note = "Stopped by the number of iterations before the centres were at rest"
        self.pool = self.fitted = None
        return "done"

    def label(self, v):
        return None if self.model is None else self.model.distances(*self._split(v)).argmin(1)


class ClassSearch(Search):
    """Latent classes of least BIC over class counts and restarts, by extrapolated expectation-maximisation.

    SQUAREM (Varadhan & Roland 2008): of two steps of EM the change and the change of the change give a longer step in the
    logarithms of the parameters; it is kept only if the likelihood there is not below that of the first step, else the two
    steps stand, so the likelihood never falls. All restarts of a class count are one stack of matrices.
    """

    def __init__(self, codes, numeric=(), ks=None, restarts: int = la.RESTARTS, max_passes: int = 600, tolerance: float = 1e-6):
        super().__init__(numeric, codes)
        self.ks = list(ks or (la.MIXED_K if self.numeric else la.CODED_K))
        self.restarts, self.max_passes, self.tolerance = restarts, max_passes, tolerance
        self.algorithm = "Mixed LCA" if self.numeric else "LCA"

    def _end_spread(self, t):
        p = len(self.numeric)
        self._covariance(t)
        self.dev = np.maximum(self.deviation[:p], np.sqrt(la.VARIANCE_FLOOR))
        self.live, self.ended = {}, []
        for k in self.ks:
            starts = [la.random_classes(self.levels.tolist(), k, 1000 * k + s, self.mean[:p], self.deviation[:p])
                      for s in range(self.restarts)]
            self.live[k] = {"restart": np.arange(self.restarts), "now": np.stack([self._flat(c) for c in starts])}
        self.step = 0
        return "climb"

    # parameters of a run as one row of logarithms (means and variances in units of the columns' deviations)

    def _flat(self, c: la.Classes) -> np.ndarray:
        p = len(self.numeric)
        with np.errstate(divide="ignore"):
            return np.concatenate([np.log(np.maximum(c.weight, la.FLOOR)),
                                   np.log(np.maximum(np.concatenate(c.answers, axis=1) if c.answers else np.zeros((c.k, 0)), la.FLOOR)).ravel(),
                                   ((c.mean - self.mean[:p]) / self.dev).ravel(), np.log(c.variance / self.dev ** 2).ravel()])

    def _parts(self, flat: np.ndarray, k: int):
        r, p, width = len(flat), len(self.numeric), int(self.levels.sum())
        weight, answers, mean, variance = np.split(flat, [k, k + k * width, k + k * width + k * p], axis=1)
        return weight, answers.reshape(r, k, width), mean.reshape(r, k, p), variance.reshape(r, k, p)

    def _sum_climb(self, v, w, h):
        p = len(self.numeric)
        if not p:  # equal answers are one row
            codes, at = np.unique(self._codes(v), axis=0, return_inverse=True)
            w = np.bincount(at.ravel(), w, len(codes))
        else:
            codes = self._codes(v)
        x = (v[:, :p] - self.mean[:p]) / self.dev if p else np.zeros((len(codes), 0))
        hot = np.zeros((len(codes), int(self.levels.sum())))
        hot[np.arange(len(codes))[:, None], self.offsets + codes] = 1.0
        out = {}
        for k, group in self.live.items():
            total = None
            size = max(1, (1 << 21) // max(1, len(group["now"]) * k))
            for at in range(0, len(codes), size):
                span = slice(at, at + size)
                part = self._answer(group["now"], k, hot[span], x[span], w[span])
                total = part if total is None else total + part
            out[str(k)] = total
        return out

    def _answer(self, flat, k, hot, x, w):
        weight, answers, mean, variance = self._parts(flat, k)
        r, width, p = len(flat), answers.shape[2], x.shape[1]
        joint = (hot @ answers.reshape(r * k, width).T).reshape(len(w), r, k) + weight
        if p:
            inverse = np.exp(-variance)
            square = (x ** 2) @ inverse.reshape(r * k, p).T - 2 * x @ (inverse * mean).reshape(r * k, p).T
            joint += (-0.5 * (square.reshape(len(w), r, k) + (inverse * mean ** 2 + variance).sum(2) + p * np.log(2 * np.pi)
                              + 2 * np.log(self.dev).sum()))
        top = joint.max(2, keepdims=True)
        odds = np.exp(joint - top)
        norm = odds.sum(2, keepdims=True)
        likelihood = w @ (top + np.log(norm))[:, :, 0]
        post = (odds / norm * w[:, None, None]).reshape(len(w), r * k)
        return np.concatenate([likelihood[:, None], post.sum(0).reshape(r, k), (post.T @ hot).reshape(r, k * width),
                               (post.T @ x).reshape(r, k * p), (post.T @ x ** 2).reshape(r, k * p)], axis=1)

    def _maximised(self, t: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Likelihoods of the parameters the sums were taken at, and the parameters they lead to."""
        p, width = len(self.numeric), int(self.levels.sum())
        likelihood, size, counts, first, second = np.split(t, np.cumsum([1, k, k * width, k * p]), axis=1)
        held = np.maximum(size, la.FLOOR)
        r = len(t)
        mean = first.reshape(r, k, p) / held[:, :, None]
        variance = np.maximum(second.reshape(r, k, p) / held[:, :, None] - mean ** 2, la.VARIANCE_FLOOR / (self.dev ** 2 if p else 1))
        answers = np.log(np.maximum(counts.reshape(r, k, width) / held[:, :, None], la.FLOOR))
        return likelihood[:, 0], np.concatenate([np.log(np.maximum(size / size.sum(1, keepdims=True), la.FLOOR)), answers.reshape(r, -1),
                                                 mean.reshape(r, -1), np.log(variance).reshape(r, -1)], axis=1)

    def _normal(self, flat: np.ndarray, k: int) -> np.ndarray:
        """Probabilities that sum to 1 again, each within its question."""
        weight, answers, mean, variance = self._parts(flat.copy(), k)

        def scaled(a, axis):
            top = a.max(axis, keepdims=True)
            return np.maximum(a - top - np.log(np.exp(a - top).sum(axis, keepdims=True)), np.log(la.FLOOR))

        for at, width in zip(self.offsets, self.levels):
            answers[:, :, at:at + width] = scaled(answers[:, :, at:at + width], 2)
        r = len(flat)
        return np.concatenate([scaled(weight, 1), answers.reshape(r, -1), mean.reshape(r, -1), np.clip(variance, -40, 40).reshape(r, -1)], axis=1)

    def _end_climb(self, t):
        self.step += 1
        turn = self.step % 3
        for k, g in list(self.live.items()):
            ll, reached = self._maximised(t[str(k)], k)
            if turn == 1:  # first of two plain steps
                g.update(start=g["now"], ll=ll, now=reached)
            elif turn == 2:
                settled = ll - g["ll"] <= self.tolerance * np.abs(ll)
                self._end(k, g, settled, g["now"], ll, True)
                g = self.live.get(k)
                if g is None:
                    continue
                ll, reached = ll[~settled], reached[~settled]
                one, two = g["now"] - g["start"], reached - 2 * g["now"] + g["start"]
                length = np.sqrt((one ** 2).sum(1) / np.maximum((two ** 2).sum(1), 1e-300))[:, None]
                length = np.clip(length, 1.0, 64.0)
                far = self._normal(g["start"] + 2 * length * one + length ** 2 * two, k)
                g.update(ll=ll, plain=reached, now=far, best=g["now"])
            else:
                good = (np.isfinite(ll) & (ll >= g["ll"]))[:, None]
                g.update(now=np.where(good, reached, g["plain"]))
        if self.step >= self.max_passes:
            for k, g in list(self.live.items()):
                self._end(k, g, np.ones(len(g["now"]), bool), g.get("best", g["start"]), g["ll"], False)
        if self.live:
            return "climb"
        self._choose()
        return "done"

    def _end(self, k, g, which, flat, ll, settled):
        for i in np.flatnonzero(which):
            self.ended.append((k, int(g["restart"][i]), float(ll[i]), flat[i].copy(), settled))
        if which.all():
            del self.live[k]
        else:
            self.live[k] = {name: value[~which] for name, value in g.items()}

    def _choose(self) -> None:
        p = len(self.numeric)
        found = {}
        for k, restart, ll, flat, settled in sorted(self.ended, key=lambda e: e[:2]):
            weight, answers, mean, variance = (a[0] for a in self._parts(flat[None, :], k))
            own = [np.exp(answers[:, at:at + width]) for at, width in zip(self.offsets, self.levels)]
            c = la.Classes(np.exp(weight), own, mean * self.dev + self.mean[:p], np.exp(variance) * self.dev ** 2, ll, self.step, settled)
            self.runs.append({"run": f"k{k}_restart{restart}", "n_clusters": k, "restart": restart, "log_likelihood": ll,
                              "bic": c.bic(self.n), "settled": settled})
            if k not in found or ll > found[k].log_likelihood:
                found[k] = c
        self.model = min(found.values(), key=lambda c: c.bic(self.n))
        self.settled, self.seed = self.model.settled, None
        if not self.settled:
            self.note = "Stopped by the number of iterations before the classes were at rest"
        self.ended = []

    def label(self, v):
        p = len(self.numeric)
        return None if self.model is None else self.model.joint(self._codes(v), v[:, :p]).argmax(1) + 1


class MixtureSearch(CentreSearch):
    """Variational mixtures of every k and seed: best balanced seed of each k by rank sum with criteria, then the best k alike.

    Joint log densities of all components are one product of the rows' packed products with a matrix of coefficients, and the
    moments one product of the posteriors with the same packed products: symmetric second moments are summed once. Runs with a
    component below one percent of the rows stay in ``runs`` with the reason, and are not chosen.
    """

    def __init__(self, features, seeds=None, k_min=K_MIN, k_max=K_MAX, any_balance: bool = False):
        super().__init__(features, (), None, False, seeds, k_min, k_max, None, "Bayesian mixture", any_balance)

    def _end_spread(self, t):
        super()._end_spread(t)
        d = len(self.numeric)
        self.prior = mi.Prior(self.mean, t["square"] / max(self.n - 1, 1) + mi.RIDGE * np.eye(d))
        self.scale = np.where(self.deviation > 0, self.deviation, 1.0)
        self.upper = np.triu_indices(d)
        return "draw"

    def _first_fit(self):
        ks = [k for k in range(self.k_min, self.k_max) if k <= len(self.pool)]
        if not ks:
            self.note = "Fewer different rows than clusters"
            return "done"
        return self._fit({f"k{k}_seed{s}": self._spread_start(k, s) for k in ks for s in self.seeds}, False)

    def _end_fit(self, t):
        phase = super()._end_fit(t)
        if self.live and self.iteration == 10:
            self.fitted.update(self.live)
            self.live, phase = {}, "score"
        if phase == "score":
            self.mixtures, self.ended, self.iteration = {n: self.fitted[n] for n in self.candidates}, {}, 0
            return "mix"
        return phase

    def _packed(self, v):
        y = (v - self.mean) / self.scale
        return np.column_stack([np.ones(len(y)), y, y[:, self.upper[0]] * y[:, self.upper[1]]])

    def _coefficients(self, m: mi.Mixture) -> np.ndarray:
        """Columns so that packed rows times them are the joint log densities."""
        d, out = len(self.numeric), []
        for j in range(m.k):
            root = np.linalg.cholesky(m.covariance[j])
            half = np.linalg.solve(root, np.diag(self.scale))
            precision = half.T @ half
            at = (m.mean[j] - self.mean) / self.scale
            pull = precision @ at
            square = -0.5 * (2 * precision - np.diag(np.diag(precision)))[self.upper]
            expected = d * np.log(2.0) + mi.digamma(0.5 * (m.freedom[j] - np.arange(d))).sum()
            const = (-0.5 * (d * np.log(2 * np.pi) + 2.0 * np.log(np.diag(root)).sum() + at @ pull) - 0.5 * d * np.log(m.freedom[j])
                     + 0.5 * (expected - d / m.strength[j]) + m.log_weight[j])
            out.append(np.concatenate([[const], pull, square]))
        return np.array(out).T

    def _posteriors(self, v, packed):
        """(name, posteriors, log densities) of every live mixture."""
        started = [n for n, m in self.mixtures.items() if isinstance(m, mi.Mixture)]
        ends = np.cumsum([self.mixtures[n].k for n in started])
        joint = packed @ np.concatenate([self.coefficients[n] for n in started], axis=1) if started else None
        for n, end in zip(started, ends):
            own = joint[:, end - self.mixtures[n].k:end]
            top = own.max(1, keepdims=True)
            odds = np.exp(own - top)
            norm = odds.sum(1, keepdims=True)
            yield n, odds / norm, (top + np.log(norm))[:, 0]
        for n, m in self.mixtures.items():
            if not isinstance(m, mi.Mixture):
                own = m.distances(v, np.zeros((len(v), 0))).argmin(1)
                yield n, (own[:, None] == np.arange(m.k)).astype(float), np.zeros(len(v))

    def _sum_mix(self, v, w, h):
        packed = self._packed(v)
        names, posts, out = [], [], {}
        for n, post, ll in self._posteriors(v, packed):
            names.append((n, post.shape[1]))
            out[n] = [w @ ll, np.bincount(post.argmax(1), w, post.shape[1])]
            posts.append(post)
        sums, at = (np.concatenate(posts, axis=1) * w[:, None]).T @ packed, 0
        for n, k in names:
            out[n] = np.column_stack([np.concatenate([[out[n][0]], np.zeros(k - 1)]), out[n][1], sums[at:at + k]])
            at += k
        return out

    def _end_mix(self, t):
        d = len(self.numeric)
        for name, old in list(self.mixtures.items()):
            got = t[name]
            ll, won, block = float(got[0, 0]), got[:, 1], got[:, 2:]
            if isinstance(old, mi.Mixture):
                rest = abs(ll / self.n - old.log_likelihood) < mi.TOLERANCE
                if rest or self.iteration == 100:
                    old.log_likelihood, old.iterations = ll, self.iteration
                    self.ended[name] = (old, won, rest)
                    del self.mixtures[name]
                    continue
            second = np.zeros((old.k, d, d))
            second[:, self.upper[0], self.upper[1]] = block[:, 1 + d:]
            second[:, self.upper[1], self.upper[0]] = block[:, 1 + d:]
            second *= np.outer(self.scale, self.scale)
            parts = (block[:, 0], block[:, 1:1 + d] * self.scale, second, self.prior, self.mean)
            try:
                new = mi._update(*parts, mi.RIDGE)
                np.linalg.cholesky(new.covariance)
            except np.linalg.LinAlgError:
                new = mi._update(*parts, mi.RIDGE_RETRY)
            new.log_likelihood = ll / self.n if isinstance(old, mi.Mixture) else float("-inf")
            self.mixtures[name] = new
        self.iteration += 1
        self.coefficients = {n: self._coefficients(m) for n, m in self.mixtures.items()}
        if self.mixtures:
            return "mix"
        self.rejected, self.candidates = [], {}
        for name, (m, won, rest) in self.ended.items():
            share = won[won > 0].min() / self.n
            if share < mi.SMALLEST_SHARE and not self.any_balance:
                self.rejected.append({"run": name, "n_clusters": m.k, **self._criteria(m, won), "settled": rest,
                                      "reason": f"a class holds {100 * share:.3f} % of the rows"})
            else:
                self.candidates[name] = m.k
        if not self.candidates:
            self.runs, self.note = self.rejected, "very small clusters detected"
            return "done"
        self.coefficients = {n: self._coefficients(self.ended[n][0]) for n in self.candidates}
        return "score"

    def _criteria(self, m: mi.Mixture, won: np.ndarray) -> dict:
        return {"log_likelihood": m.log_likelihood,
                **mi.criteria(m.log_likelihood, self.n, int((won > 0).sum()), len(self.numeric))}

    def _score_matrix(self, v):
        return v - self.mean

    def _labellings(self, v):
        packed = self._packed(v)
        return {n: (packed @ self.coefficients[n]).argmax(1) for n in self.candidates}

    def _end_rate(self, t):
        scored = {r["run"]: r for r in self._rated(t)}
        runs = []
        for name in self.candidates:
            m, won, rest = self.ended[name]
            runs.append({**scored[name], **self._criteria(m, won), "n_clusters": m.k, "settled": rest, "reason": None})
        firsts = [b for k in sorted({r["n_clusters"] for r in runs})
                  if (b := choose_run([r for r in runs if r["n_clusters"] == k], True, self.any_balance))]
        best = choose_run(firsts, True, self.any_balance) if firsts else None
        for r in runs:
            if not r["cluster_proportions"] or min(r["cluster_proportions"].values()) <= ql.SHARE_LOW \
                    or max(r["cluster_proportions"].values()) >= ql.SHARE_HIGH:
                r["reason"] = "clusters are not balanced"
        self.runs = sorted(runs + self.rejected, key=lambda r: (r["n_clusters"], r["run"]))
        if best is None:
            self.note = UNBALANCED
        else:
            self.model, _, self.settled = self.ended[best["run"]]
            self.seed = int(best["run"].split("seed")[1])
            self.coefficients = {"best": self.coefficients[best["run"]]}
            if not self.settled:
                self.note = "Stopped by the number of iterations before the mixture was at rest"
        self.ended = self.pool = self.fitted = None
        return "done"

    def label(self, v):
        return None if self.model is None else (self._packed(v) @ self.coefficients["best"]).argmax(1)


def k_means(features: list[str], **search) -> CentreSearch:
    """k-means on as many principal components of the standardised columns as hold half of the variance."""
    return CentreSearch(features, (), VARIANCE_SHARE, **search)


def k_family(numeric: list[str], codes: list[str], **search) -> CentreSearch:
    """k-modes where every column is coded, k-prototypes otherwise, from dense starts."""
    return CentreSearch(numeric, codes, None, True, **search)
