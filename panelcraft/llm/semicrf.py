"""Personal data by a semi-Markov conditional random field beside the base patterns.

A text is cut into regions around tokens with a digit, an @ or a written-out at or dot (elsewhere no candidate exists, so
the best path is known). In a region every stretch of up to MOST_CHARS characters is a candidate, described as a whole: its
shape, number of digits, separators, checks, first and last characters, the words before and after it. A segmentation into
entities of a kind and single other tokens has the sum of its segments' weights; the model is the normalised distribution
over segmentations, trained by its likelihood (forward and backward sums), and the best segmentation, found by dynamic
programming bounded by the longest entity, chooses boundaries and kinds together. Long regions are read BLOCK tokens at once.

Teachers are drawn by kind from all rows: FIT_KIND regions for each kind of base span and FIT_PLAIN regions without one, those
of smallest hash, FIT_EACH of a kind from one text at most, and each distinct region once; so no text, kind or repeated line
crowds out another. The same places, rewritten in the ways people hide such data, teach too. An entity is added where it
overlaps no base span and outweighs the reading of the same tokens as ordinary ones by MARGIN.

Defined results: null texts are empty and have no spans; with nothing to learn from, only base spans are found; each row is
read by itself, also where ids repeat.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_step, id_text, shared_table, slices, texts_of
from .pii_patterns import KINDS, base_spans, luhn

MOST_CHARS = 96
#: As many tokens as MOST_CHARS characters can hold, so that this is no bound of its own.
MOST_TOKENS = (MOST_CHARS + 1) // 2
BLOCK = 512
AROUND = 2
FIT_KIND = 150
FIT_PLAIN = 400
FIT_EACH = 4
FIT_TOKENS = 40
EPOCHS = 5
MARGIN = 1.0
BUCKETS = 1 << 13
OTHER = len(KINDS)
TRIGGER = re.compile(r"[0-9@]|[\[({](?:at|dot)[\])}]", re.I)
TRIGGER_SQL = r"(?i)[0-9@]|[\[({](at|dot)[\])}]"
TOKEN = re.compile(r"\S+")
AT = re.compile(r"^[\[({]at[\])}]$|[\[({]at[\])}]|@", re.I)
DOT = re.compile(r"[\[({]dot[\])}]|\.", re.I)
TRIM = ".,;:!?\"'"

Region = list[tuple[int, int]]


def regions(text: str) -> list[Region]:
    """Token bounds of each region."""
    hits = [m.start() for m in TRIGGER.finditer(text)]
    if not hits:
        return []
    tokens = [m.span() for m in TOKEN.finditer(text)]
    starts = [a for a, _ in tokens]
    hot = sorted({bisect_right(starts, h) - 1 for h in hits})
    out, first, last = [], hot[0], hot[0]
    for t in hot[1:]:
        if t > last + 2 * AROUND:
            out.append((first, last))
            first = t
        last = t
    out.append((first, last))
    return [tokens[max(0, a - AROUND):b + 1 + AROUND] for a, b in out]


def bucket(*parts) -> int:
    return crc32("\t".join(map(str, parts)).encode("utf-8", "surrogatepass")) % BUCKETS


def shape(s: str) -> str:
    s = re.sub(r"[0-9]+", lambda m: "9" if len(m[0]) < 3 else f"9{min(len(m[0]), 20)}", s)
    return re.sub(r"[^\W\d_]+", "a", s)[:32]


def trimmed(text: str, tokens: Region, i: int, j: int) -> tuple[int, int]:
    a, b = tokens[i][0], tokens[j - 1][1]
    while b > a + 1 and text[b - 1] in TRIM:
        b -= 1
    while a < b - 1 and text[a] in TRIM:
        a += 1
    return a, b


def span_features(text: str, tokens: Region, i: int, j: int) -> list[int]:
    a, b = trimmed(text, tokens, i, j)
    s = text[a:b]
    digits = [c for c in s if "0" <= c <= "9"]
    n, letters = len(digits), sum(map(str.isalpha, s))
    before = text[slice(*tokens[i - 1])].lower().strip(TRIM) if i else "^"
    after = text[slice(*tokens[j])].lower().strip(TRIM) if j < len(tokens) else "$"
    parts = re.split(r"\[?\.\]?", s)
    numbers = len(parts) == 4 and all(p.isdigit() and len(p) <= 3 and int(p) < 256 for p in parts if p.isascii()) and s.isascii()
    check = 12 <= n <= 19 and luhn("".join(digits))
    marks = "".join(sorted({c for c in s if not c.isalnum() and not c.isspace()}))[:12]
    ats, dots = len(AT.findall(s)), len(DOT.findall(s))
    return [bucket("bias"), bucket("tokens", j - i), bucket("shape", shape(s)), bucket("digits", n, letters > 0),
            bucket("range", n >= 7, n >= 9, n >= 12, n > 15, n > 19), bucket("marks", marks), bucket("four", numbers, n > 0),
            bucket("check", check, letters > 0), bucket("at", min(ats, 2), min(dots, 3), letters > 0),
            bucket("ends", shape(s[:1]), shape(s[-1:])), bucket("before", before[:16]), bucket("after", after[:16]),
            bucket("share", letters * 4 // max(1, len(s)), j - i), bucket("inner", bool(TRIGGER.search(text[slice(*tokens[i])])),
                                                                         bool(TRIGGER.search(text[slice(*tokens[j - 1])])))]


class Lattice:
    """Candidate segments of a region with their features: those that begin at the tokens ``first`` to ``last``."""

    def __init__(self, text: str, tokens: Region, first: int = 0, last: int | None = None):
        self.n, self.segments = len(tokens), []
        last = self.n if last is None else last
        hot = [bool(TRIGGER.search(text[a:b])) for a, b in tokens[first:last + MOST_TOKENS]]
        rows = []
        for i in range(first, last):
            any_hot = False
            for j in range(i + 1, min(self.n, i + MOST_TOKENS) + 1):
                short = tokens[j - 1][1] - tokens[i][0] <= MOST_CHARS
                if not short and j > i + 1:
                    break
                any_hot = any_hot or hot[j - 1 - first]
                entity = any_hot and short
                if entity or j == i + 1:
                    self.segments.append((i, j, entity))
                    rows.append(span_features(text, tokens, i, j) if short else [bucket("long")] * 14)
        self.index = np.array(rows)

    def scores(self, weight: np.ndarray) -> np.ndarray:
        """Segment x kind; impossible readings are -inf."""
        out = weight[:, self.index].sum(axis=2).T
        single = np.array([j == i + 1 for i, j, _ in self.segments])
        entity = np.array([e for _, _, e in self.segments])
        out[~single, OTHER] = -np.inf
        out[~entity, :OTHER] = -np.inf
        return out

    def expected(self, scores: np.ndarray) -> np.ndarray:
        """Probability of each segment and kind under the model."""
        with np.errstate(divide="ignore"):
            total = np.logaddexp.reduce(scores, axis=1)
        ahead, behind = np.full(self.n + 1, -np.inf), np.full(self.n + 1, -np.inf)
        ahead[0] = behind[self.n] = 0.0
        for k, (i, j, _) in enumerate(self.segments):  # in order of i
            ahead[j] = np.logaddexp(ahead[j], ahead[i] + total[k])
        for k in range(len(self.segments) - 1, -1, -1):
            i, j, _ = self.segments[k]
            behind[i] = np.logaddexp(behind[i], behind[j] + total[k])
        ends = np.array([(ahead[i], behind[j]) for i, j, _ in self.segments])
        return np.exp(scores + ends.sum(axis=1)[:, None] - ahead[self.n])


def best(text: str, tokens: Region, weight: np.ndarray) -> list[tuple[int, int, int, float]]:
    """Segments (i, j, kind) of the best segmentation, with what each outweighs its tokens as ordinary ones by."""
    n = len(tokens)
    value, back, plain = [0.0] + [-np.inf] * n, [None] * (n + 1), [0.0] * n
    for first in range(0, n, BLOCK):
        lattice = Lattice(text, tokens, first, min(n, first + BLOCK))
        scores = lattice.scores(weight)
        top, kind = scores.max(axis=1).tolist(), scores.argmax(axis=1).tolist()
        for k, (i, j, _) in enumerate(lattice.segments):  # in order of i
            if j == i + 1:
                plain[i] = scores[k, OTHER]
            if value[i] + top[k] > value[j]:
                value[j], back[j] = value[i] + top[k], (i, j, kind[k], top[k])
    out, at = [], n
    while at:
        i, j, kind, own = back[at]
        out.append((i, j, kind, own - sum(plain[i:j])))
        at = i
    return out[::-1]


def gold(text: str, tokens: Region, spans: list[tuple[int, int, int]]) -> dict[tuple[int, int], int] | None:
    """Segments of the given spans; None where one has no segment."""
    out, used = {}, set()
    for a, kind, b in spans:
        own = [t for t, (x, y) in enumerate(tokens) if x < b and y > a]
        if not own:
            continue
        if len(own) > MOST_TOKENS or used & {*own} or tokens[own[-1]][1] - tokens[own[0]][0] > MOST_CHARS:
            return None
        used |= {*own}
        out[own[0], own[-1] + 1] = kind
    return out


def disguised(value: str, kind: int, turn: int) -> str:
    """One of the ways to write such data past a pattern."""
    digits = re.sub(r"\D", "", value)
    if kind == 0:
        name, host = value.split("@", 1)
        if turn // 5 % 2:  # names and hosts of letters only
            name, host = (re.sub(r"\.?[0-9]+", "", x) or "a" for x in (name, host))
        return [f"{name} [at] {host.replace('.', ' [dot] ')}", f"{name}(at){host}", f"{name} (at) {host.replace('.', ' (dot) ')}",
                f"{name}[at]{host.replace('.', '[dot]')}", f"{name} @ {host}"][turn % 5]
    if kind == 1:
        return [value.replace(".", "[.]"), value.replace(".", "(dot)"), value.replace(".", "[dot]")][turn % 3]
    if kind == 2:
        return [".".join(digits[i:i + 4] for i in range(0, len(digits), 4)), "_".join(digits[i:i + 4] for i in range(0, len(digits), 4)),
                "/".join(digits[i:i + 4] for i in range(0, len(digits), 4))][turn % 3]
    return [value[1:].strip(), "00" + digits, f"({digits[:3]}) {digits[3:6]}-{digits[6:]}", f"tel:{digits}",
            f"{digits[:3]}-{digits[3:6]}-{digits[6:]}"][turn % 5]


def stretches(tokens: Region, spans: list[tuple[int, int, int]]) -> Iterator[Region]:
    """A region in stretches of FIT_TOKENS tokens at most, cut where no span goes on (a longer span makes none)."""
    starts = [a for a, _ in tokens]
    joined_on = {t for a, _, b in spans for t in range(bisect_right(starts, a), bisect_left(starts, b))}
    at = 0
    while at < len(tokens):
        end = min(len(tokens), at + FIT_TOKENS)
        while end < len(tokens) and end > at and end in joined_on:
            end -= 1
        if end > at:
            yield tokens[at:end]
        at = end if end > at else at + FIT_TOKENS


def teachers(text: str) -> list[tuple[int, int, str, list[tuple[int, int, int]]]]:
    """(kind or OTHER, hash, stretch, its spans): FIT_EACH of each kind at most, those of smallest hash."""
    spans, found = base_spans(text), [{} for _ in range(OTHER + 1)]
    starts = [a for a, _, _ in spans]
    for region in regions(text):
        held = spans[bisect_left(starts, region[0][0]):bisect_left(starts, region[-1][1])]
        for tokens in stretches(region, held):
            low, high = tokens[0][0], tokens[-1][1]
            inside = [(a - low, k, b - low) for a, k, b in held[bisect_left(held, (low,)):bisect_left(held, (high,))] if b <= high]
            if any(x[2] > y[0] for x, y in zip(inside, inside[1:])):
                continue  # overlapping kinds have no one segmentation
            part = text[low:high]
            if inside and gold(part, [(a - low, b - low) for a, b in tokens], inside) is None:
                continue
            key = xxhash.xxh64_intdigest(part.encode("utf-8", "surrogatepass")) - (1 << 63)
            for kind in {k for _, k, _ in inside} or {OTHER}:
                found[kind][key] = (kind, key, part, inside)
                if len(found[kind]) > FIT_EACH:
                    del found[kind][max(found[kind])]
    return [row for own in found for row in own.values()]


class Drawn:
    """Distinct stretches of smallest hash, by kind."""

    def __init__(self):
        self.kept = [{} for _ in range(OTHER + 1)]

    def add(self, text: str) -> None:
        for row in teachers(text):
            own, limit = self.kept[row[0]], quota(row[0])
            own[row[1]] = row
            if len(own) > 2 * limit:
                self.kept[row[0]] = {key: own[key] for key in sorted(own)[:limit]}

    def rows(self) -> list[tuple[int, int, str, list[tuple[int, int, int]]]]:
        return [own[key] for kind, own in enumerate(self.kept) for key in sorted(own)[:quota(kind)]]


def quota(kind: int) -> int:
    return FIT_PLAIN if kind == OTHER else FIT_KIND


def lessons(drawn: list[tuple[str, list[tuple[int, int, int]]]]) -> list[tuple[Lattice, dict[tuple[int, int], int]]]:
    out: list = []
    for turn, (part, inside) in enumerate(drawn):
        cases = [(part, inside)]
        if inside:
            made, at, moved = "", 0, []
            for nth, (a, k, b) in enumerate(inside):
                made += part[at:a]
                new = disguised(part[a:b], k, turn + nth)
                moved.append((len(made), k, len(made) + len(new)))
                made, at = made + new, b
            cases.append((made + part[at:], moved))
        for string, marks in cases:
            bounds = [m.span() for m in TOKEN.finditer(string)]
            segments = gold(string, bounds, marks)
            if segments is not None and bounds:
                out.append((Lattice(string, bounds), segments))
    return out


def train(texts: list[str]) -> np.ndarray | None:
    """Weights by kind and feature, from teachers drawn of ``texts``."""
    drawn = Drawn()
    for text in texts:
        drawn.add(text)
    return learn(drawn.rows())


def learn(rows: list[tuple[int, int, str, list[tuple[int, int, int]]]]) -> np.ndarray | None:
    taught = lessons([*{key: (part, spans) for _, key, part, spans in rows}.values()])
    if not any(g for _, g in taught):
        return None
    weight, seen = np.zeros((OTHER + 1, BUCKETS)), np.full((OTHER + 1, BUCKETS), 1e-6)
    rng = np.random.default_rng(3)
    for _ in range(EPOCHS):
        for k in rng.permutation(len(taught)):
            lattice, segments = taught[k]
            slope = -lattice.expected(lattice.scores(weight))
            covered = {t for i, j in segments for t in range(i, j)}
            for s, (i, j, entity) in enumerate(lattice.segments):
                kind = segments.get((i, j))
                if kind is not None and entity:
                    slope[s, kind] += 1
                elif j == i + 1 and i not in covered:
                    slope[s, OTHER] += 1
            for y in range(OTHER + 1):
                change = np.bincount(lattice.index.ravel(), np.repeat(slope[:, y], lattice.index.shape[1]), BUCKETS)
                at = np.flatnonzero(change)
                change = change[at] - 1e-3 * weight[y, at]
                seen[y, at] += change * change
                weight[y, at] += 0.3 * change / np.sqrt(seen[y, at])
    return weight


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray | None:
    """Weights from teachers drawn of all rows; a task gives its smallest hashes of each kind, so their table stays small."""
    schema = pa.schema([("kind", pa.int32()), ("key", pa.int64()), ("part", pa.string()), ("spans", pa.list_(pa.int32()))])

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawn = Drawn()
        for batch in batches:
            for some in slices(batch, 1):
                for text in texts_of(some.column(1)):
                    drawn.add(text)
        rows = [(kind, key, part, [x for span in spans for x in span]) for kind, key, part, spans in drawn.rows()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    found = id_text(docs, id_col, text_col).where(F.col("text").rlike(TRIGGER_SQL)) \
        .mapInArrow(draw, "kind int, key long, part string, spans array<int>")
    found = shared_table(found, "teachers").dropDuplicates(["kind", "key"])
    sizes = {r["kind"]: r["count"] for r in found.groupBy("kind").count().collect()}  # a row for each kind
    rows = []
    for kind, n in sorted(sizes.items()):
        # The smallest keys of a kind; what is sorted is cut first to about twice as many.
        cut = F.col("key") / 2.0 ** 64 + 0.5 <= (2.0 * quota(kind) + 50) / n
        rows += found.where((F.col("kind") == kind) & cut).orderBy("key").limit(quota(kind)).collect()
    return learn([(r["kind"], r["key"], r["part"], [(*r["spans"][i:i + 3],) for i in range(0, len(r["spans"]), 3)]) for r in rows])


def added_spans(text: str, weight: np.ndarray | None, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    if weight is None:
        return []
    out = []
    for tokens in regions(text):
        for i, j, kind, gain in best(text, tokens, weight):
            if kind != OTHER and gain >= MARGIN:
                a, b = trimmed(text, tokens, i, j)
                if not any(x < b and y > a for x, _, y in base):
                    out.append((a, kind, b))
    return out


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find(docs: DataFrame, weight: np.ndarray | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, spans array<struct<start, end, kind, base, value>> in order, of every row."""
    kind = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("base", pa.bool_()), ("value", pa.string())])
    schema = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(kind))])
    shared = docs.sparkSession.sparkContext.broadcast(weight)  # a number for each kind and feature bucket

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text in texts_of(batch.column(1)):
            base = base_spans(text)
            every = sorted([(*s, True) for s in base] + [(*s, False) for s in added_spans(text, shared.value, base)])
            rows.append([{"start": a, "end": b, "kind": KINDS[k], "base": o, "value": text[a:b]} for a, k, b, o in every])
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(kind))], schema=schema)

    return id_text(docs, id_col, text_col).mapInArrow(
        arrow_step(step, 1), "doc_id long, spans array<struct<start: long, end: long, kind: string, base: boolean, value: string>>")


def digest(found: DataFrame) -> DataFrame:
    """Counts by kind and the joined spans, from the operator's spans."""
    line = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, KINDS),
                        F.sha2(line(base).cast("binary"), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"),
                        F.size(F.filter("spans", lambda s: ~s["base"])).cast("long").alias("n_added"))


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each stretch of spans replaced by its first kind in brackets."""
    out, at = [], 0
    for a, kind, b in spans:
        if a >= at:
            out += [text[at:a], f"[{KINDS[kind]}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, weight: np.ndarray | None, text_col: str = "text"):
    """``docs`` with personal data replaced in ``text_col``; null texts stay null, all other columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(weight)
    place = docs.columns.index(text_col)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = []
        for text in batch.column(place).to_pylist():
            base = base_spans(text or "")
            made.append(text and redacted(text, sorted(base + added_spans(text, shared.value, base))))
        columns = [*batch.columns]
        columns[place] = pa.array(made, pa.string())
        return pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(arrow_step(step, place), docs.schema)
