"""Byte-level BPE by rank files: encoding with a hierarchical-bitmap rank queue, and decoding.

The queue has a bucket for each merge rank, holding the positions (in a linked list of symbols) of pairs with that rank,
and three levels of 64-bit words that tell which buckets hold something. Find-first-set gives the next rank, the
leftmost position of its bucket is merged, and entries whose pair has changed meanwhile are skipped. A pre-token of n
bytes costs O(n log n), so a pre-token of a whole very long text is no special case.

Defined results: null and empty texts have no ids and decode to no bytes; every row is encoded by itself.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from functools import cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow_step, id_text, texts_of
from .spaced_cache import SpacedCache

#: Pre-tokens whose ids a worker keeps; beyond it the cache starts anew.
CACHE_PIECES = 800_000


class RankQueue:
    """Merges the pre-tokens of one rank file. Rank r is bit ``r & 63`` of word ``r >> 6``; bits of ``middle`` tell which
    words have a bit, bits of ``top`` which words of ``middle`` do. A pre-token ends with the queue empty, so the words
    serve the next one."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        words = (max(ranks.values(), default=0) >> 6) + 1
        self.bottom, self.middle, self.buckets = [0] * words, [0] * ((words >> 6) + 1), {}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        get = self.ranks.get
        whole = get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        bottom, middle, buckets, top = self.bottom, self.middle, self.buckets, 0
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]  # a symbol is known by its first byte; n closes the list
        pair = [get(piece[i:i + 2]) for i in range(n - 1)]
        pair.append(None)
        fresh = [(rank, i) for i, rank in enumerate(pair) if rank is not None]
        while True:
            for rank, i in fresh:
                bucket = buckets.get(rank)
                if bucket:
                    heappush(bucket, i)
                else:
                    buckets[rank] = [i]
                    word, group = rank >> 6, rank >> 12
                    bottom[word] |= 1 << (rank & 63)
                    middle[group] |= 1 << (word & 63)
                    top |= 1 << group
            if not top:
                break
            group = (top & -top).bit_length() - 1
            bits = middle[group]
            word = group << 6 | (bits & -bits).bit_length() - 1
            low = bottom[word]
            rank = word << 6 | (low & -low).bit_length() - 1
            bucket = buckets[rank]
            i = heappop(bucket)
            if not bucket:
                del buckets[rank]
                low = bottom[word] = low & (low - 1)
                if not low:
                    bits = middle[group] = bits & (bits - 1)
                    if not bits:
                        top &= top - 1
            fresh = []
            if pair[i] != rank:
                continue  # stale
            gone = after[i]
            end = after[i] = after[gone]
            pair[gone] = pair[i] = None
            if end < n:
                before[end] = i
                new = pair[i] = get(piece[i:after[end]])
                if new is not None:
                    fresh.append((new, i))
            left = before[i]
            if left >= 0:
                new = pair[left] = get(piece[left:end])
                if new is not None:
                    fresh.append((new, left))
        ids, i = [], 0
        while i < n:
            ids.append(self.ranks[piece[i:after[i]]])
            i = after[i]
        return ids


class RankCodec:
    """Encoder and decoder of a rank file (lines of base64 bytes and rank) with a pre-token pattern."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, lines))}
        self.bytes_of = {v: k for k, v in self.ranks.items()}
        self.find, self.pieces, self.merge = regex.compile(pattern).findall, {}, RankQueue(self.ranks).merge
        self.cache = SpacedCache(self._encode_many)

    def _encode_many(self, texts: list[str]) -> list[bytes]:
        return [b"".join(map(self._piece, self.find(t))) for t in texts]

    def _piece(self, piece: str) -> bytes:
        got = self.pieces.get(piece)
        if got is None:
            if len(self.pieces) >= CACHE_PIECES:
                self.pieces.clear()
            got = array("I", self.merge(piece.encode("utf-8"))).tobytes()
            if len(piece) <= 64:
                self.pieces[piece] = got
        return got

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(x, "<u4") for x in self.cache.encode(texts)]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))


@cache
def codec(path: str, pattern: str) -> RankCodec:
    return RankCodec(path, pattern)


def default_file() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def encode(docs: DataFrame, ranks: tuple[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids array<long> of every row."""
    path, pattern = ranks or default_file()
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int64()))])

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = codec(path, pattern).encode(texts_of(batch.column(1)))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.astype(np.int64) for x in ids], pa.list_(pa.int64()))],
                                          schema=schema)

    return id_text(docs, id_col, text_col).mapInArrow(arrow_step(step, 1), "doc_id long, ids array<long>")


def decode(encoded: DataFrame, ranks: tuple[str, str] | None = None) -> DataFrame:
    """doc_id, decoded binary from doc_id, ids; null ids decode to no bytes."""
    path, pattern = ranks or default_file()
    schema = pa.schema([("doc_id", pa.int64()), ("decoded", pa.binary())])

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                raw = [codec(path, pattern).decode(np.asarray(x or [], np.int64)) for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(raw, pa.binary())], schema=schema)

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary")


def round_trip(docs: DataFrame, ranks: tuple[str, str] | None = None, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encoding and decoding in one step, so that no ids leave the task."""
    path, pattern = ranks or default_file()
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                        ("decoded_sha256", pa.string())])

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        use = codec(path, pattern)
        ids = use.encode(texts_of(batch.column(1)))
        sha = [hashlib.sha256(x.tobytes()).hexdigest() for x in ids]
        back = [hashlib.sha256(use.decode(x)).hexdigest() for x in ids]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in ids], pa.int64()), pa.array(sha),
                                           pa.array(back)], schema=schema)

    return id_text(docs, id_col, text_col).mapInArrow(
        arrow_step(step, 1), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
