"""Language identification by interpolated Kneser-Ney character models, one for each language.

Texts become lower-case letters with single spaces; a gram is up to four symbols of 16 bits in one 64-bit number. For each
order a sorted array of grams holds the interpolated probability in every language, and a sorted array of contexts holds
the weight that passes to the next lower order, so one binary search serves all languages. A text goes to the language of
lowest cross-entropy a character. ``score`` is a softmax of the cross-entropies with a temperature fitted on calibration
texts; a text is rejected where its cross-entropy is beyond what calibration texts show (mean plus REJECT_SIGMAS
deviations) or where it has no letter.

Fitting takes at most FIT_DOCS labelled documents in all, dealt evenly over the languages by a hash of the id, whole texts;
every fifth of them calibrates. Prediction covers every whole text.

Defined results: null texts and texts without a letter are ``und`` with score 0, rejected; with no labelled row at all,
every text is; equal cross-entropies go to the first language in order of name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_step, below_cut, id_text, keep_rows, remainder_column, texts_of

ORDER = 4
FIT_DOCS = 2_400
REJECT_SIGMAS = 8.0
UNDETERMINED = "und"
START = 1
TEMPERATURES = (1, 2, 4, 8, 16, 32, 64, 128)
_letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts in a row, each text after ORDER - 1 start symbols, and the text's number for each symbol."""
    low = [t.lower() for t in texts]
    pad = "\x01" * (ORDER - 1)
    raw = np.frombuffer("".join(pad + t.replace("\x01", " ") + " " for t in low).encode("utf-32-le", "surrogatepass"), "<u4")
    owner = np.repeat(np.arange(len(low)), [len(t) + ORDER for t in low])
    # symbols have 16 bits: characters beyond them share the 2,048 codes that no text uses
    code = np.where(raw > 0xFFFF, 0xD800 + ((raw ^ (raw >> 11)) & 0x7FF), raw).astype(np.uint64)
    blank = ~_letters[raw] & (raw != START)
    code[blank] = 32
    keep = np.ones(len(code), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    return code[keep], owner[keep]


def grams(code: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The gram that ends at each predicted symbol, and where those symbols are."""
    at = np.flatnonzero(code != START)
    out = np.zeros(len(at), np.uint64)
    for back in range(order - 1, -1, -1):
        out = (out << np.uint64(16)) | code[at - back]
    return out, at


@dataclass
class Model:
    languages: list[str]
    keys: list[np.ndarray]  # by order, from 1
    probability: list[np.ndarray]
    contexts: list[np.ndarray]
    weight: list[np.ndarray]
    base: float
    temperature: float = 16.0
    limit: float = np.inf

    def log2(self, gram: np.ndarray) -> np.ndarray:
        """log2 probability of distinct grams of the highest order in each language."""
        return np.log2(self._p(gram, ORDER))

    def _p(self, gram: np.ndarray, order: int) -> np.ndarray:
        if order == 0:
            return np.full((len(gram), len(self.languages)), self.base)
        keys = self.keys[order - 1]
        at = np.minimum(np.searchsorted(keys, gram), len(keys) - 1)
        out, known = self.probability[order - 1][at].astype(float), keys[at] == gram
        rest = gram[~known]
        if len(rest):
            lower = self._p(rest & np.uint64((1 << 16 * (order - 1)) - 1), order - 1)
            out[~known] = lower * self._passed(rest >> np.uint64(16), order)
        return out

    def _passed(self, context: np.ndarray, order: int) -> np.ndarray:
        keys = self.contexts[order - 1]
        at = np.minimum(np.searchsorted(keys, context), len(keys) - 1)
        return np.where((keys[at] == context)[:, None], self.weight[order - 1][at], 1.0)

    def cross_entropy(self, texts: list[str]) -> np.ndarray:
        code, owner = symbols(texts)
        gram, at = grams(code, ORDER)
        distinct, where = np.unique(gram, return_inverse=True)
        bits, own = self.log2(distinct), owner[at]
        n = np.maximum(1, np.bincount(own, minlength=len(texts)))
        return np.column_stack([-np.bincount(own, bits[where, k], len(texts)) / n for k in range(bits.shape[1])])

    def predict(self, texts: list[str]) -> list[tuple[str, float, bool]]:
        if not texts:
            return []
        entropy = self.cross_entropy(texts)
        best = entropy.argmin(axis=1)
        odds = np.exp2(-self.temperature * (entropy - entropy.min(axis=1, keepdims=True)))
        score = odds.max(axis=1) / odds.sum(axis=1)
        return [(self.languages[b], float(s), bool(e <= self.limit)) if has_letter(t) else (UNDETERMINED, 0.0, False)
                for t, b, s, e in zip(texts, best, score, entropy.min(axis=1))]


def train(texts: list[str], languages: list[str]) -> Model | None:
    names = sorted(set(languages))
    if not names:
        return None
    code_of = {n: symbols([t for t, x in zip(texts, languages) if x == n])[0] for n in names}
    vocabulary = np.unique(np.concatenate([*code_of.values(), [np.uint64(32)]]))
    model = Model(names, [], [], [], [], 1.0 / (len(vocabulary) + 1))
    counts = {}
    for n in names:
        full, count = np.unique(grams(code_of[n], ORDER)[0], return_counts=True)
        counts[n] = {ORDER: (full, count)}
        for order in range(ORDER - 1, 0, -1):  # continuation counts: different symbols before the gram
            counts[n][order] = np.unique(counts[n][order + 1][0] & np.uint64((1 << 16 * order) - 1), return_counts=True)
    for order in range(1, ORDER + 1):
        union = np.unique(np.concatenate([counts[n][order][0] for n in names] + [np.zeros(1, np.uint64)]))
        contexts = np.unique(union >> np.uint64(16))
        share, weight = np.zeros((len(union), len(names))), np.ones((len(contexts), len(names)))
        for k, n in enumerate(names):
            keys, count = counts[n][order]
            if not len(keys):
                continue
            once, twice = (count == 1).sum(), (count == 2).sum()
            discount = once / (once + 2 * twice) if once and twice else 0.5
            place = np.searchsorted(contexts, keys >> np.uint64(16))
            total, kinds = np.bincount(place, count, len(contexts)), np.bincount(place, minlength=len(contexts))
            seen = total > 0
            weight[seen, k] = discount * kinds[seen] / total[seen]
            share[np.searchsorted(union, keys), k] = (count - discount) / total[place]
        model.contexts.append(contexts)
        model.weight.append(weight)
        lower = model._p(union & np.uint64((1 << 16 * (order - 1)) - 1), order - 1)
        model.keys.append(union)
        model.probability.append((share + lower * weight[np.searchsorted(contexts, union >> np.uint64(16))]).astype(np.float32))
    return model


def calibrate(model: Model, texts: list[str], languages: list[str]) -> None:
    """Temperature of least log loss, and the limit of cross-entropy."""
    rows = [(t, n) for t, n in zip(texts, languages) if has_letter(t) and n in model.languages]
    if not rows:
        return
    entropy = model.cross_entropy([t for t, _ in rows])
    own = np.array([model.languages.index(n) for _, n in rows])
    gap = entropy - entropy[np.arange(len(own)), own][:, None]
    loss = [np.log2(np.exp2(np.clip(-t * gap, -1000, 500)).sum(axis=1)).mean() for t in TEMPERATURES]
    model.temperature = float(TEMPERATURES[int(np.argmin(loss))])
    low = entropy.min(axis=1)
    model.limit = float(low.mean() + REJECT_SIGMAS * max(low.std(), 0.05))


def fit(labelled: DataFrame, fit_docs: int = FIT_DOCS) -> Model | None:
    """Model of labelled rows (doc_id, text, lang); null languages teach nothing."""
    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("size"))
    kinds = sizes.count()
    each = max(5, fit_docs // max(1, kinds))
    if kinds <= fit_docs:  # a row for each language, counted; beyond that an ordinary join
        sizes = F.broadcast(sizes)
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    few = rows.select("doc_id", "lang").join(sizes, "lang").where(below_cut(each, F.col("size")))
    places = few.select("doc_id", "lang", F.row_number().over(order).alias("place")) \
        .where(F.col("place") <= each).orderBy("lang", "place").limit(fit_docs)  # texts are read for these only
    taken = rows.join(F.broadcast(places), ["doc_id", "lang"]).orderBy("lang", "place").limit(fit_docs).collect()
    held = [r for r in taken if r["place"] % 5 == 0]
    own = [r for r in taken if r["place"] % 5]
    model = train([r["text"] for r in own], [r["lang"] for r in own])
    if model:
        calibrate(model, [r["text"] for r in held], [r["lang"] for r in held])
    return model


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, accepted of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("accepted", pa.bool_())])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the characters of fit_docs documents

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = texts_of(batch.column(1))
        rows = shared.value.predict(texts) if shared.value else [(UNDETERMINED, 0.0, False)] * len(texts)
        return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[k] for r in rows], schema.types[k + 1]) for k in range(3))],
                                          schema=schema)

    return id_text(docs, id_col, text_col).mapInArrow(arrow_step(step, 1), "doc_id long, lang_pred string, score double, accepted boolean")


def keep_identified(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language is accepted; without a model none can be, and all rows stay."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return keep_rows(docs, lambda texts: [True] * len(texts) if shared.value is None
                     else [ok for _, _, ok in shared.value.predict(texts)], text_col)


def labelled(docs: DataFrame) -> DataFrame:
    """Rows that may teach: crc32 of the id, modulo 3, is not 1."""
    return docs.select("doc_id", "text", "lang").where(remainder_column("doc_id", 3) != 1)
