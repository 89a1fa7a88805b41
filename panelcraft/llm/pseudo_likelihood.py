"""Masked pseudo-likelihood of documents under a bidirectional window network trained in numpy.

Symbols are the corpus' WORDS most frequent words and, for all others, classes by length and make-up; counts are taken over
all documents. The network reads the symbols left and right of a masked place (an embedding for each side, a hidden layer,
a softmax over all symbols). A document's score is the sum of the log probabilities of every symbol given both neighbours,
and, with ``shares``, of every word within its class.

A word's share of its class is n / (N + 1): its own count over all documents, and that of all words of the class, however
many words there are. The 1 is for a word never counted, so the shares of a class add up to 1. The most frequent words (at
most FREQUENT of them) go to the tasks; the counts of all others are joined by the word.

Texts are read twice: to count words, and to code them (a byte a word, the logarithms of frequent words' shares, the other
words). Windows are counted and documents are scored from the codes.

Training uses every window of the corpus: tasks count (left, symbol, right), Spark adds the counts up, and the table (at
most SYMBOLS^3 rows whatever the corpus) is dealt by context. In each round every task trains a copy of the network on its
contexts, weighted by counts, and the copies are averaged by weight in Spark; the driver only sees sums of fixed size.

Defined results: null and empty texts have no words: 0 words, log probability 0, mean 0; each row is scored by itself; with
an empty corpus the untrained network scores.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress, repeat
from string import ascii_letters, digits

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, shared_table, slices, texts_of

SYMBOLS = 256
WORDS = 191
EDGE = 0
WIDTH = 16
HIDDEN = 32
ROUNDS = 5
EPOCHS = 3
BATCH = 256
RATE = 0.02
SHAPES = ((SYMBOLS, WIDTH), (SYMBOLS, WIDTH), (2 * WIDTH, HIDDEN), (HIDDEN,), (HIDDEN, SYMBOLS), (SYMBOLS,))
SIZES = [int(np.prod(s)) for s in SHAPES]
FLUSH = 400_000
#: Windows that a task counts before it gives its counts out (they are 32-bit numbers).
MOST_WINDOWS = 1 << 30
FREQUENT = 1 << 17
#: Grades of counts for each doubling, by which the most frequent words are told from the others.
GRADES = 16
#: Logarithms of joined counts are added up in whole parts of this size, so their sum does not hang on the order.
UNIT = 2.0 ** -32


LETTER, DIGIT, CLOSING = (np.array([chr(k) in some for k in range(256)]) for some in (ascii_letters, digits, "aeiou.,"))


def make_up(word: str) -> int:
    """Class of a word outside the list: 8 lengths x 8 kinds."""
    n, last = len(word), word[-1:]
    length = min(n - 1, 5) if n < 9 else 6 if n < 16 else 7
    if word.isalpha():
        inner = 0 if word.isascii() else 1
    else:
        inner = 2 if word[:-1].isalpha() and not last.isdigit() else 3
    return WORDS + 1 + length * 8 + inner * 2 + (last in "aeiou.,")


def make_ups(words: pa.Array) -> np.ndarray:
    """``make_up`` of every word, from the bytes of those in ASCII."""
    if not len(words):
        return np.zeros(0, np.uint8)
    words = words.cast(pa.string())
    _, ends, raw = words.buffers()
    ends = np.frombuffer(ends, np.int32)[words.offset:words.offset + len(words) + 1]
    data = np.frombuffer(raw, np.uint8)[ends[0]:ends[-1]]
    ends = ends - ends[0]
    n, last = np.diff(ends), data[ends[1:] - 1]
    others = np.add.reduceat(~LETTER[data], ends[:-1], dtype=np.int32)
    inner = np.where(others == 0, 0, np.where((others == 1) & (n > 1) & ~LETTER[last] & ~DIGIT[last], 2, 3))
    length = np.where(n < 9, np.minimum(n - 1, 5), np.where(n < 16, 6, 7))
    out = (WORDS + 1 + length * 8 + inner * 2 + CLOSING[last]).astype(np.uint8)
    if data.max() > 127:
        for k in np.flatnonzero(np.maximum.reduceat(data, ends[:-1]) > 127):
            out[k] = make_up(words[k].as_py())
    return out


def count_words(docs: DataFrame) -> DataFrame:
    """word, n over all documents; tasks add up what they can hold, Spark the rest."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held)), pa.array(list(held.values()), pa.int64())], schema=schema)

        for batch in batches:
            for part in slices(batch, 0):
                for text in texts_of(part.column(0)):
                    held.update(text.lower().split())
                if len(held) > FLUSH:
                    yield out()
                    held.clear()
        if held:
            yield out()

    return docs.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Coder:
    """Symbols of words and, with ``shares``, what is known of their log shares without the counts of rarer words."""

    def __init__(self, words: list[str], shares: Shares | None = None):
        logs = shares.logs if shares else {}
        names = [*dict.fromkeys([*words, *logs])]
        self.places = {w: k for k, w in enumerate(names)}
        self.symbols = np.array([*range(1, len(words) + 1), *map(make_up, names[len(words):])], np.uint8)
        self.logs = np.array([logs.get(w, 0.0) for w in names])
        self.floors = shares.floors if shares else np.zeros(SYMBOLS)

    def code_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
        """Symbols and log shares of words, which of them are on no list, and these themselves."""
        place = np.fromiter(map(self.places.get, words, repeat(-1)), np.int32, len(words))
        rare = place < 0
        others = pa.array([*compress(words, rare.tolist())], pa.string())
        symbols, logs = np.zeros(len(words), np.uint8), np.zeros(len(words))
        symbols[~rare], logs[~rare] = self.symbols[place[~rare]], self.logs[place[~rare]]
        symbols[rare] = make_ups(others)
        return symbols, logs + self.floors[symbols], rare, others

    def code(self, text: str) -> np.ndarray:
        return np.array([EDGE, *self.code_words(text.lower().split())[0], EDGE], np.int32)


def coded(docs: DataFrame, words: list[str], shares: Shares | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row (any numbers), doc_id, n_words, log_share, codes (symbols with an edge before and behind), rare (words on no list).

    Without ``shares`` log_share is 0 and rare is empty."""
    shared = docs.sparkSession.sparkContext.broadcast(Coder(words, shares))  # of bounded size
    weighed = shares is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 33
        for batch in batches:
            for some in slices(batch, 1):
                split = [t.lower().split() for t in texts_of(some.column(1))]
                n = np.array([*map(len, split)], np.int64)
                symbols, logs, rare, others = shared.value.code_words([w for own in split for w in own])
                doc = np.repeat(np.arange(len(n)), n)
                codes = np.full(len(doc) + 2 * len(n), EDGE, np.uint8)
                codes[np.arange(len(doc)) + 2 * doc + 1] = symbols
                ends = np.concatenate([[0], np.cumsum(n + 2)]).astype(np.int32)
                columns = [pa.array(np.arange(at, at + len(n))), some.column(0), pa.array(n),
                           pa.array(np.bincount(doc, logs, len(n)).astype(float)),
                           pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(ends), pa.py_buffer(codes)])]
                if weighed:
                    of_rare = np.concatenate([[0], np.cumsum(np.bincount(doc[rare], minlength=len(n)))])
                    columns.append(pa.ListArray.from_arrays(pa.array(of_rare, pa.int32()), others))
                else:
                    columns.append(pa.array([[]] * len(n), pa.list_(pa.string())))
                yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "n_words", "log_share", "codes", "rare"])
                at += len(n)

    return id_text(docs, id_col, text_col).mapInArrow(
        run, "row long, doc_id long, n_words long, log_share double, codes binary, rare array<string>")


def codes_of(column: pa.Array) -> np.ndarray:
    """The symbols of a column of codes, one row after the other."""
    column = column.cast(pa.binary())
    _, ends, codes = column.buffers()
    ends = np.frombuffer(ends, np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(codes, np.uint8)[ends[0]:ends[-1]]


def windows(codes: np.ndarray) -> np.ndarray:
    """left << 16 | right << 8 | symbol at every word of texts coded with edges, one text after the other."""
    row = codes.astype(np.int32)
    key = np.zeros(len(row), np.int32)
    key[1:-1] = row[:-2] << 16 | row[2:] << 8 | row[1:-1]
    return key[row != EDGE]


def count_windows(texts: DataFrame) -> DataFrame:
    """context, symbol, n of all windows of all documents; ``texts`` is ``coded``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, held = np.zeros(SYMBOLS ** 3, np.int32), 0

        def out() -> Iterator[pa.RecordBatch]:
            keys = np.flatnonzero(counts).astype(np.int32)
            for at in range(0, len(keys), 100_000):
                part = keys[at:at + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(part >> 8), pa.array(part & 255), pa.array(counts[part].astype(np.int64))],
                                                 names=["context", "symbol", "n"])

        for batch in batches:
            for part in slices(batch, 0):
                key = windows(codes_of(part.column(0)))
                if held + len(key) > MOST_WINDOWS:
                    yield from out()
                    counts[:], held = 0, 0
                np.add.at(counts, key.astype(np.intp), np.int32(1))
                held += len(key)
        yield from out()

    return texts.select("codes").mapInArrow(run, "context int, symbol int, n long") \
        .groupBy("context", "symbol").agg(F.sum("n").alias("n"))


def start_weights() -> list[np.ndarray]:
    rng = np.random.default_rng(11)
    return [(rng.normal(0, 0.1 if len(s) > 1 else 0.0, s)).astype(np.float32) for s in SHAPES]


def flat(weights: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([w.ravel() for w in weights])


def unflat(row: np.ndarray) -> list[np.ndarray]:
    return [p.reshape(s).astype(np.float32) for p, s in zip(np.split(row, np.cumsum(SIZES)[:-1]), SHAPES)]


def log_probabilities(weights: list[np.ndarray], context: np.ndarray) -> np.ndarray:
    """Context x symbol."""
    left, right, w1, b1, w2, b2 = weights
    hidden = np.tanh(np.concatenate([left[context >> 8], right[context & 255]], axis=1) @ w1 + b1)
    logits = hidden @ w2 + b2
    logits -= logits.max(axis=1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))


def improve(weights: list[np.ndarray], context: np.ndarray, counts: np.ndarray, epochs: int, seed: int) -> list[np.ndarray]:
    """Adam steps over batches of contexts (dense counts: context x symbol)."""
    rng, weights = np.random.default_rng(seed), [w.copy() for w in weights]
    first, second, t = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    mass = counts.sum(axis=1)
    for _ in range(epochs):
        order = rng.permutation(len(context))
        for at in range(0, len(order), BATCH):
            own = order[at:at + BATCH]
            left, right, w1, b1, w2, _ = weights
            a, b = context[own] >> 8, context[own] & 255
            x = np.concatenate([left[a], right[b]], axis=1)
            hidden = np.tanh(x @ w1 + b1)
            p = np.exp(log_probabilities(weights, context[own]))
            weight = np.sqrt(mass[own])[:, None]  # between one vote a window and one vote a context
            d = (p - counts[own] / mass[own][:, None]) * (weight / weight.sum())
            dh = (d @ w2.T) * (1 - hidden * hidden)
            dx = dh @ w1.T
            slopes = [np.zeros_like(left), np.zeros_like(right), x.T @ dh, dh.sum(axis=0), hidden.T @ d, d.sum(axis=0)]
            np.add.at(slopes[0], a, dx[:, :WIDTH])
            np.add.at(slopes[1], b, dx[:, WIDTH:])
            t += 1
            for k, g in enumerate(slopes):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                weights[k] = (weights[k] - RATE * (first[k] / (1 - 0.9 ** t)) / (np.sqrt(second[k] / (1 - 0.99 ** t)) + 1e-6)).astype(np.float32)
    return weights


def dense(frames: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
    rows = [(b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_numpy()) for b in frames if b.num_rows]
    if not rows:
        return np.zeros(0, np.int64), np.zeros((0, SYMBOLS), np.float32)
    context, symbol, n = (np.concatenate(c) for c in zip(*rows))
    own, where = np.unique(context, return_inverse=True)
    counts = np.zeros((len(own), SYMBOLS), np.float32)
    np.add.at(counts, (where, symbol), n)
    return own, counts


def listed_words(counted: DataFrame) -> list[str]:
    """The WORDS most frequent words of ``counted`` (``count_words``)."""
    return [r["word"] for r in counted.orderBy(F.desc("n"), "word").limit(WORDS).collect()]


def train(docs: DataFrame, counted: DataFrame | None = None) -> tuple[list[str], list[np.ndarray]]:
    """The word list and the network; ``counted`` is ``count_words(docs)``, if that is at hand."""
    words = listed_words(count_words(docs) if counted is None else counted)
    return words, fit(coded(docs.select(F.lit(None).alias("doc_id"), "text"), words))


def fit(texts: DataFrame) -> list[np.ndarray]:
    """The network of ``texts`` (``coded``)."""
    table = shared_table(count_windows(texts).repartition("context"), "windows")
    weights = start_weights()
    for turn in range(ROUNDS):
        row = flat(weights)

        def work(batches: Iterator[pa.RecordBatch], row: np.ndarray = row, turn: int = turn) -> Iterator[pa.RecordBatch]:
            context, counts = dense(batches)
            if len(context):
                mass = float(np.sqrt(counts.sum(axis=1)).sum())
                made = flat(improve(unflat(row), context, counts, EPOCHS, turn)).astype(np.float64) * mass
                yield pa.RecordBatch.from_arrays([pa.array([mass]), pa.array([made.tobytes()], pa.binary())], names=["mass", "made"])

        def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            mass, total = 0.0, np.zeros(sum(SIZES))
            for frame in frames:
                for m, raw in zip(frame.mass, frame.made):
                    mass, total = mass + m, total + np.frombuffer(raw)
            yield pd.DataFrame({"mass": [mass], "made": [total.tobytes()]})

        copies = table.mapInArrow(work, "mass double, made binary").repartition(8).mapInPandas(add, "mass double, made binary").collect()
        mass = sum(r["mass"] for r in copies)
        if mass:
            weights = unflat(sum(np.frombuffer(r["made"]) for r in copies) / mass)
    return weights


@dataclass
class Shares:
    """What a word's share of its class hangs on."""
    logs: dict[str, float]  # log count of frequent words; 0 for listed ones, which are classes of their own
    floors: np.ndarray  # by symbol: log share of a word counted once or never
    rare: DataFrame  # word, n of all others counted more than once


def class_totals(counted: DataFrame) -> np.ndarray:
    """Words of the corpus by class, the listed ones among them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(SYMBOLS, np.int64)
        for batch in batches:
            np.add.at(held, make_ups(batch.column(0)), batch.column(1).to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(range(SYMBOLS), pa.int32()), pa.array(held)], names=["symbol", "n"])

    out = np.zeros(SYMBOLS, np.int64)
    for r in counted.select("word", "n").mapInArrow(run, "symbol int, n long").groupBy("symbol").agg(F.sum("n").alias("n")).collect():
        out[r["symbol"]] = r["n"]
    return out


def share_out(counted: DataFrame, words: list[str], frequent: int = FREQUENT) -> Shares:
    """Shares of all words that ``counted`` (``count_words``, best as a shared table) has, ``words`` being the listed ones."""
    totals = class_totals(counted)
    grade = F.floor(F.log2("n") * GRADES)
    cut, many = 1 << 62, 0
    for r in counted.groupBy(grade.alias("grade")).agg(F.count("*").alias("words")).orderBy(F.desc("grade")).collect():
        many += r["words"]
        if many > frequent:
            break
        cut = r["grade"]
    top = {r["word"]: r["n"] for r in counted.where((grade >= cut) | F.col("word").isin(words)).select("word", "n").collect()}
    for word in words:
        totals[make_up(word)] -= top.get(word, 0)
    logs = {w: float(np.log(n)) for w, n in top.items()} | dict.fromkeys(words, 0.0)
    floors = np.where(np.arange(SYMBOLS) > WORDS, -np.log(totals + 1.0), 0.0)
    return Shares(logs, floors, counted.where((grade < cut) & (F.col("n") > 1)))


def score(docs: DataFrame, words: list[str], weights: list[np.ndarray], id_col: str = "doc_id", text_col: str = "text",
          shares: Shares | None = None) -> DataFrame:
    """doc_id, n_words, log_prob (sum), mean_log_prob of every row; of symbols, or with ``shares`` of the words themselves."""
    texts = coded(docs, words, shares, id_col, text_col)
    return score_coded(shared_table(texts, "coded") if shares else texts, weights, shares)


def score_coded(texts: DataFrame, weights: list[np.ndarray], shares: Shares | None = None) -> DataFrame:
    """``score`` of ``texts``, which are ``coded`` with the same ``shares`` (with these, best as a shared table)."""
    shared = texts.sparkSession.sparkContext.broadcast(weights)  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, made = np.empty((SYMBOLS ** 2, SYMBOLS), np.float32), np.zeros(SYMBOLS ** 2, bool)
        for batch in batches:
            for some in slices(batch, 4):
                key, n = windows(codes_of(some.column(4))), some.column(2).to_numpy()
                met = np.zeros(SYMBOLS ** 2, bool)
                met[key >> 8] = True
                new = np.flatnonzero(met & ~made)
                for at in range(0, len(new), 4096):
                    table[new[at:at + 4096]] = log_probabilities(shared.value, new[at:at + 4096])
                made[new] = True
                total = np.bincount(np.repeat(np.arange(len(n)), n), table.ravel()[key], len(n)).astype(float)
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), some.column(2), pa.array(total + some.column(3).to_numpy())],
                                                 names=["row", "doc_id", "n_words", "log_prob"])

    got = texts.select("row", "doc_id", "n_words", "log_share", "codes") \
        .mapInArrow(run, "row long, doc_id long, n_words long, log_prob double")
    if shares:
        units = texts.select("row", F.explode("rare").alias("word")).join(shares.rare, "word") \
            .groupBy("row").agg(F.sum(F.round(F.log("n") / UNIT).cast("long")).alias("units"))
        got = got.join(units, "row", "left").withColumn("log_prob", F.col("log_prob") + F.coalesce("units", F.lit(0)) * UNIT)
    return got.select("doc_id", "n_words", "log_prob", (F.col("log_prob") / F.greatest("n_words", F.lit(1))).alias("mean_log_prob"))
