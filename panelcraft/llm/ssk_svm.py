"""Toxicity by a support vector machine over a gapped subsequence kernel with Nystroem landmarks.

The kernel compares character sequences by the subsequences of three symbols that they share, each occurrence weighted by
DECAY to the power of the stretch it covers (SPAN symbols at most), so an insult with letters inserted, dropped or spread
apart stays similar to itself. Landmarks are words that labelled toxic sentences favour; the kernel against them, whitened
by their own kernel matrix, is the feature vector of a linear SVM. Since both are linear, the fitted machine folds into one
weight for each of 64^3 subsequences: scoring a word is a sum of table entries over its subsequences, exactly the machine's
value.

Instances are words and runs of single characters read as one word; a document takes its highest instance (a toxic one has
a toxic place somewhere, a clean one none), and fitting alternates between choosing the toxic documents' instances and the
machine. A logistic curve on documents' values gives the score.

Fitting takes at most FIT_DOCS labelled documents, half of them toxic where there are as many, chosen by a hash of the id.

Defined results: null texts are empty; a text without a word has the bias' score; with no toxic or no clean labelled row
every score is 0. Labels, language, source and id are never inputs of a score.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_step, below_cut, id_text, keep_rows, remainder_column, texts_of

DECAY = 0.7
SPAN = 7
LANDMARKS = 96
FIT_DOCS = 6_000
THRESHOLD = 0.3
CACHE_WORDS = 250_000
SPACED = re.compile(r"(?<!\S)\S(?:\s\S){3,}(?!\S)")
EDGES = re.compile(r"^[\W_]+|[\W_]+$")
PAIRS = [(a, b) for b in range(2, SPAN) for a in range(1, b)]
CODES = 64 ** 3


def symbol_row(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all words in a row with SPAN - 1 zeros after each, the word's number for each symbol, and lengths."""
    gap = "\0" * (SPAN - 1)
    raw = np.frombuffer("".join(w + gap for w in words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    lengths = np.array([len(w) for w in words], np.int64)
    owner = np.repeat(np.arange(len(words)), lengths + SPAN - 1)
    row = np.where((raw >= 97) & (raw <= 122), raw - 96, np.where(raw == 0, 0, 27 + raw % 37))
    return row, owner, lengths


def subsequences(words: list[str]):
    """For each pair of offsets: code of the subsequence at each place (0 where it leaves the word), its weight."""
    row, owner, lengths = symbol_row(words)
    padded = np.concatenate([row, np.zeros(SPAN, np.int64)])
    n = len(row)
    for a, b in PAIRS:
        x, y, z = row, padded[a:a + n], padded[b:b + n]
        inside = (x > 0) & (y > 0) & (z > 0)
        yield np.where(inside, (x * 64 + y) * 64 + z, 0), owner, DECAY ** (b + 1)


def norms(lengths: np.ndarray) -> np.ndarray:
    """Length of a word's weight vector when no subsequence repeats; at least that of one subsequence."""
    total = np.zeros(len(lengths))
    for _, b in PAIRS:
        total += np.maximum(0, lengths - b) * DECAY ** (2 * (b + 1))
    return np.sqrt(np.maximum(total, DECAY ** 6))


def clean(word: str) -> str:
    return EDGES.sub("", word.lower().replace("\0", " "))


@dataclass
class Machine:
    weight: np.ndarray  # by subsequence
    bias: float = 0.0
    slope: float = 1.0
    shift: float = 0.0
    known: dict[str, float] = field(default_factory=dict)

    def values(self, words: list[str]) -> np.ndarray:
        """The machine's value of each (clean) word."""
        if not words:
            return np.zeros(0)
        total = np.zeros(len(words))
        for code, owner, decay in subsequences(words):
            total += decay * np.bincount(owner, self.weight[code], len(words))
        return total / norms(np.array([len(w) for w in words], np.int64)) + self.bias

    def document_values(self, texts: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > CACHE_WORDS:
            known.clear()
        words = [instances(t) for t in texts]
        got = [[*map(known.get, w)] for w in words]
        new = list({w for own, values in zip(words, got) if None in values for w, v in zip(own, values) if v is None})
        for at in range(0, len(new), 20_000):
            part = new[at:at + 20_000]
            known.update(zip(part, self.values([clean(w) for w in part]).tolist()))
        return np.array([max((known[w] if v is None else v for w, v in zip(own, values)), default=self.bias)
                         for own, values in zip(words, got)])

    def scores(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.document_values(texts) + self.shift, -500, 500)))


def instances(text: str) -> list[str]:
    return text.split() + [re.sub(r"\s", "", m[0]) for m in SPACED.finditer(text)]


class Landmarks:
    """Normed weight vectors of the landmark words, over the subsequences that occur in any of them."""

    def __init__(self, words: list[str]):
        found = [(code, owner, np.full(len(code), decay)) for code, owner, decay in subsequences(words)]
        code, owner, decay = (np.concatenate(c) for c in zip(*found))
        self.codes = np.unique(code[code > 0])
        self.column = np.full(CODES, -1, np.int32)
        self.column[self.codes] = np.arange(len(self.codes))
        self.table = np.zeros((len(words), len(self.codes)))
        np.add.at(self.table, (owner[code > 0], self.column[code[code > 0]]), decay[code > 0])
        self.table /= norms(np.array([len(w) for w in words], np.int64))[:, None]

    def kernel(self, words: list[str], rows: int = 1_000) -> np.ndarray:
        """Kernel of words against the landmarks."""
        return np.vstack([self._kernel(words[i:i + rows]) for i in range(0, len(words), rows)])

    def _kernel(self, words: list[str]) -> np.ndarray:
        width = len(self.codes)
        counts = np.zeros(len(words) * width)
        for code, owner, decay in subsequences(words):
            column = self.column[code]
            at = np.flatnonzero(column >= 0)
            np.add.at(counts, owner[at] * width + column[at], decay)
        return counts.reshape(len(words), width) @ self.table.T / norms(np.array([len(w) for w in words], np.int64))[:, None]

    def fold(self, by_landmark: np.ndarray) -> np.ndarray:
        """Weights of all subsequences for a weight of each landmark."""
        out = np.zeros(CODES)
        out[self.codes] = by_landmark @ self.table
        return out


def hinge(x: np.ndarray, y: np.ndarray, cost: np.ndarray, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Linear SVM with squared hinge loss by gradient descent with momentum; ``cost`` by row."""
    z = np.column_stack([x, np.ones(len(x))])
    w, speed = np.zeros(z.shape[1]), np.zeros(z.shape[1])
    v = np.ones(z.shape[1])
    for _ in range(20):
        v = z.T @ (cost * (z @ v)) + v
        v /= np.linalg.norm(v)
    rate = 0.5 / (v @ (z.T @ (cost * (z @ v))) + 1)
    for _ in range(rounds):
        ahead = w + 0.9 * speed
        miss = np.maximum(0, 1 - y * (z @ ahead))
        speed = 0.9 * speed - rate * (ahead * np.r_[np.ones(x.shape[1]), 0] - 2 * z.T @ (cost * y * miss))
        w = w + speed
    return w[:-1], float(w[-1])


def spread(word: str, rng: np.random.Generator) -> str:
    """A word with characters put in between, as evasion does."""
    mark = "-._* x"[rng.integers(6)]
    if rng.random() < 0.5:
        return mark.join(word)
    at = rng.integers(1, max(2, len(word)))
    return word[:at] + mark + word[at:]


def train(texts: list[str], toxic: list[int], landmarks: int = LANDMARKS) -> Machine | None:
    y = np.array(toxic)
    if not (y == 1).any() or not (y == 0).any():
        return None
    rng = np.random.default_rng(7)
    words = [sorted({clean(w) for w in instances(t)} - {""}) for t in texts]
    df = {k: Counter(w for own, v in zip(words, y) if v == k for w in own) for k in (0, 1)}
    n1, n0 = int((y == 1).sum()), int((y == 0).sum())

    def favour(w: str) -> float:
        p, q = (df[1][w] + 0.02) / (n1 + 1), (df[0][w] + 0.5) / (n0 + 1)
        return float(np.log(p / q) * np.sqrt(df[1][w]))

    liked = sorted((w for w in df[1] if len(w) >= 3), key=lambda w: (-favour(w), w))
    marks = liked[:landmarks]
    if not marks:
        return None
    near = Landmarks(marks)
    own = near.kernel(marks)
    level, turn = np.linalg.eigh((own + own.T) / 2)
    use = level > 1e-6 * level.max()
    whiten = turn[:, use] / np.sqrt(level[use])  # features: kernel row times this
    bags = [words[i] for i in np.flatnonzero(y == 1)]
    common = [w for w, _ in df[0].most_common(4_000)]
    others = sorted(set(df[0]) - set(common))
    rare = [others[i] for i in rng.choice(len(others), min(8_000, len(others)), replace=False)] if others else []
    negative, hard = common + rare, []
    chosen = [max(b, key=favour) for b in bags if b]
    machine = Machine(np.zeros(CODES))
    for _ in range(3):
        counted = Counter(chosen)
        positive = list(counted)
        extra = [spread(w, rng) for w in positive[:200] for _ in range(2)]
        rows = positive + extra + negative + hard
        sign = np.r_[np.ones(len(positive) + len(extra)), -np.ones(len(negative) + len(hard))]
        mass = np.r_[[counted[w] for w in positive], np.full(len(extra), 0.5), np.full(len(negative), 0.2), np.full(len(hard), 5.0)]
        w, bias = hinge(near.kernel(rows) @ whiten, sign, mass * 10 / len(rows) * 50)
        machine = Machine(near.fold(whiten @ w), bias)
        value: dict[str, float] = {}
        every = sorted({x for own in words for x in own})
        for at in range(0, len(every), 20_000):
            part = every[at:at + 20_000]
            value.update(zip(part, machine.values(part).tolist()))
        chosen = [max(b, key=lambda x: (value[x] + 0.2 * (favour(x) > 3), x)) for b in bags if b]
        hard = sorted((x for x in df[0] if df[1][x] <= 2 * df[0][x] * n1 / n0), key=lambda x: -value[x])[:600]
    top = np.array([max((value[x] for x in own), default=machine.bias) for own in words])
    machine.slope, machine.shift = logistic(top, (y == 1).astype(float))
    return machine


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve by Newton steps, with the usual smoothed targets."""
    n1, n0 = y.sum(), (1 - y).sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    z, w = np.column_stack([x, np.ones(len(x))]), np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(2), z.T @ (target - p) - 1e-3 * w)
        w = w + np.clip(step, -2, 2)
    return max(float(w[0]), 1e-3), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS) -> Machine | None:
    """Machine from rows of ``labels`` (doc_id, toxic) and their documents; texts of ``fit_docs`` documents at most."""
    known = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    half = fit_docs // 2
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}  # two rows

    def some(toxic: int) -> DataFrame:
        own = known.where(F.col("toxic") == toxic)
        return own.where(below_cut(half, sizes.get(toxic, 1))).orderBy(*order).limit(half)

    taken = some(1).union(some(0))
    got = id_text(docs).join(F.broadcast(taken), "doc_id").select("doc_id", "text", "toxic").limit(2 * fit_docs).collect()  # more than fit_docs only where ids repeat
    got = sorted({r["doc_id"]: r for r in got}.values(), key=lambda r: r["doc_id"])
    return train([r["text"] or "" for r in got], [r["toxic"] for r in got])


def teaching(labels: DataFrame) -> DataFrame:
    """Rows that may teach: crc32 of the id, modulo 4, is not 2."""
    return labels.where(remainder_column("doc_id", 4) != 2)


def score(docs: DataFrame, machine: Machine | None, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32())])
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # one weight for each subsequence

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = texts_of(batch.column(1))
        made = shared.value.scores(texts) if shared.value else np.zeros(len(texts))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(made), pa.array((made >= threshold).astype(np.int32))], schema=schema)

    return id_text(docs, id_col, text_col).mapInArrow(arrow_step(step, 1), "doc_id long, score double, predicted int")


def keep_clean(docs: DataFrame, machine: Machine | None, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    return keep_rows(docs, lambda texts: [True] * len(texts) if shared.value is None
                     else (shared.value.scores(texts) < threshold).tolist(), text_col)
