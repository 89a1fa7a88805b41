"""Document fingerprints by one-permutation MinHash.

Hashes of five-word shingles (all words where a text has fewer) are dealt once into BINS bins by their high bits, and each
bin keeps its smallest value. An empty bin takes the value of a bin that a universal hash of (bin, attempt) names, with as
many attempts as it takes to hit a filled one: optimal densification. LOW_BITS low-order bits of each bin are packed into
the fingerprint. Two fingerprints agree in a share m of bins; b-bit values agree by chance, so likeness is
(m - 2^-b) / (1 - 2^-b), not below 0.

Defined results: a text without words has the fingerprint ``EMPTY``, whose likeness to itself is 1 and to any other 0;
equal texts have equal fingerprints, a null text that of the empty text.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from .common import arrow_step, id_text, texts_of

WORDS = 5
BINS = 256
LOW_BITS = 8
EMPTY = ""
MIX = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser by xor-shifts and odd multipliers."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


@cache
def word_cache() -> dict[str, int]:
    return {}


def word_hashes(words: list[str]) -> np.ndarray:
    known = word_cache()
    if len(known) > 400_000:
        known.clear()
    got = [*map(known.get, words)]
    for i, x in enumerate(got):
        if x is None:
            got[i] = known[words[i]] = xxhash.xxh64_intdigest(words[i].encode("utf-8"))
    return np.array(got, dtype=np.uint64)


def shingle_hashes(text: str, words: int = WORDS) -> np.ndarray:
    w = word_hashes(text.lower().split())
    k = min(words, len(w))
    if not k:
        return w
    n = len(w) - k + 1
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out = mix(out * MIX + w[i:i + n])
    return out


@cache
def attempts(bins: int) -> np.ndarray:
    """Row t: the bin that each bin asks at attempt t; rows repeat beyond the last by a fixed shift."""
    at = np.arange(bins, dtype=np.uint64)[None, :] + np.arange(1, 65, dtype=np.uint64)[:, None] * np.uint64(1 << 32)
    return (mix(at * MIX) % np.uint64(bins)).astype(np.int64)


def sketch(text: str, words: int = WORDS, bins: int = BINS) -> np.ndarray | None:
    """The densified bins, or None for a text without words."""
    hashes = shingle_hashes(text, words)
    if not len(hashes):
        return None
    low = np.full(bins, np.iinfo(np.uint64).max, np.uint64)
    place = (hashes >> np.uint64(40)) % np.uint64(bins)
    np.minimum.at(low, place.astype(np.int64), mix(hashes))
    filled = np.zeros(bins, bool)
    filled[place.astype(np.int64)] = True
    asks, t = attempts(bins), 0
    empty, out = np.flatnonzero(~filled), low.copy()
    while len(empty):
        target = (asks[t % 64, empty] + (t // 64) * (2 * empty + 1)) % bins
        hit = filled[target]
        out[empty[hit]] = low[target[hit]]
        empty, t = empty[~hit], t + 1
        if t >= 64 * bins:  # in reach of no filled bin: the first filled one
            out[empty], empty = low[filled.argmax()], empty[:0]
    return out


def packed(values: np.ndarray | None, low_bits: int = LOW_BITS) -> str:
    """Low-order bits of each bin, packed, as hexadecimal digits."""
    if values is None:
        return EMPTY
    bits = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little", count=low_bits)
    return np.packbits(bits, bitorder="little").tobytes().hex()


def fingerprint(text: str) -> str:
    return packed(sketch(text))


def likeness(a: str, b: str, low_bits: int = LOW_BITS) -> float:
    """Estimated Jaccard similarity of the shingle sets behind two fingerprints."""
    if EMPTY in (a, b):
        return float(a == b)
    x, y = (np.unpackbits(np.frombuffer(bytes.fromhex(v), np.uint8), bitorder="little").reshape(-1, low_bits) for v in (a, b))
    chance = 2.0 ** -low_bits
    return max(0.0, (float((x == y).all(axis=1).mean()) - chance) / (1 - chance))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("fingerprint", pa.string())])

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([fingerprint(t) for t in texts_of(batch.column(1))], pa.string())], schema=schema)

    return id_text(docs, id_col, text_col).mapInArrow(arrow_step(step, 1), "doc_id long, fingerprint string")
