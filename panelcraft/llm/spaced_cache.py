"""Encoding of whole texts through a cache of space-separated chunks.

Pre-token patterns of the byte-level vocabularies never cross a single space between two characters that are no white
space: the space opens the next pre-token. So a text's ids are those of its first chunk, then of ' ' + chunk for every
further one, and most chunks repeat. A text in which a chunk is empty or has white space at an end is encoded whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

#: Chunks held by a worker; beyond it the cache starts anew (its size, never a result, depends on it).
CACHE_CHUNKS = 1_200_000


class SpacedCache:
    """Turns texts into little-endian unsigned 32-bit ids; ``encode_many`` encodes a list of strings to such bytes."""

    def __init__(self, encode_many: Callable[[list[str]], Iterable[bytes]], size: int = CACHE_CHUNKS):
        self.encode_many, self.size, self.later = encode_many, size, {}

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.later) > self.size:
            self.later.clear()
        get, split, known, holes = self.later.get, [], [], []
        for text in texts:
            head, *chunks = text.split(" ")
            parts = [*map(get, chunks)]
            split.append((head, chunks))
            known.append(parts)
            holes.append([i for i, x in enumerate(parts) if x is None] if None in parts else [])
        wanted = {chunks[i] for (_, chunks), at in zip(split, holes) for i in at}
        good = [c for c in wanted if c and not c[0].isspace() and not c[-1].isspace()]
        self.later.update(zip(good, self.encode_many([" " + c for c in good])))
        out: list[bytes | None] = []
        for (head, chunks), parts, at, first in zip(split, known, holes, self.encode_many([h for h, _ in split])):
            for i in at:
                parts[i] = get(chunks[i])
            apart = at and None in parts or chunks and head[-1:].isspace()
            out.append(None if apart else first + b"".join(parts))
        whole = [i for i, x in enumerate(out) if x is None]
        for i, x in zip(whole, self.encode_many([texts[i] for i in whole])):
            out[i] = x
        return out
