"""Ids of the public byte-level tokenizer, one encoder for each Python worker.

The library cuts a text into pre-tokens, of which each is encoded by itself, and some of their ends show in two neighbours alone
(``Encoder.cuts``). So a text's ids are those of its pieces between such ends, mostly a word with the space before it, or marks, and
most pieces repeat. All pieces of a slice are told apart by Arrow, each different one is looked up once, and their ids are laid out
by Arrow. Pieces not seen before are joined to one text, encoded in one call, and cut apart where an id's token begins with the
space, or at line ends put between them. Texts that hold a special token's string are encoded whole by the same call.
"""

from __future__ import annotations

import json
import os
from array import array
from functools import cache
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Id appended to each document.
END_ID = 2
#: Bytes (keys, ids and about what Python adds to them) of pieces that a worker keeps, in an older and a younger half; their
#: size, never a result, depends on it. Pieces beyond LONGEST characters are not kept, nor are those met for the first time:
#: DOOR flags by hash tell which were met before, so that pieces that never return do not push out those that do.
CACHE_BYTES, ENTRY_BYTES, LONGEST, DOOR = 64 << 20, 190, 64, 1 << 23
#: CACHE_BYTES of a job that only encodes, so that its workers keep nothing for other stages.
ALONE_BYTES = 320 << 20
#: The same for a job that keeps pieces when it first meets them: fuller from the start, and fewer are encoded twice.
FIRST_BYTES = 256 << 20
#: Pieces encoded in one call.
JOINED_CHUNKS = 1 << 13
#: Bytes and rows of texts to give to ``encode`` at once: the more, the more of their pieces repeat.
ENCODED_BYTES, ENCODED_ROWS = 4_000_000, 20_000

#: Classes of bytes: what may be white space, letters and digits, marks, and all else that is none of these. The apostrophe is no
#: mark, as letters after it may belong to it.
SPACE, WORD, MARK, OTHER = range(4)
CLASSES = bytes(SPACE if i < 33 or i == 127 else OTHER if i > 127 or i == 39 else WORD if chr(i).isalnum() else MARK
                for i in range(256))
#: First bytes of two whose characters are letters, but for the signs of multiplication and division.
LETTER_LEADS = np.isin(np.arange(256), [0xC3, 0xC4, 0xC5, 0xD0, 0xD1])
#: White space beyond ASCII, as three bytes.
WIDE = np.array([int.from_bytes(chr(c).encode().ljust(3, b"\0"), "big") for c in range(128, 1 << 16) if chr(c).isspace()])


class Encoder:
    """Texts to little-endian unsigned 32-bit ids, as ``Tokenizer.encode(text, add_special_tokens=False)`` gives them."""

    def __init__(self, path: str, cache_bytes: int = CACHE_BYTES, first: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)
        self.opens[[i for token, i in vocabulary.items() if token.startswith("Ġ")]] = True
        self.line_end = vocabulary.get("Ċ", -1)
        before = json.loads(self.tokenizer.pre_tokenizer.__getstate__()) if self.tokenizer.pre_tokenizer else {}
        self.by_class = (self.tokenizer.normalizer is None and before.get("type") == "ByteLevel" and before["use_regex"]
                         and not before["add_prefix_space"])
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cache_bytes, self.young, self.old, self.held = cache_bytes, {}, {}, 0
        self.first, self.met, self.n_met = first, np.zeros(0 if first else DOOR, bool), 0

    def whole(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _joined(self, chunks: list[str]) -> list[bytes]:
        """Ids of each chunk behind a space."""
        text = " " + " ".join(chunks)
        ids = array("I", self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids)
        at = np.flatnonzero(self.opens[np.frombuffer(ids, np.uint32)])
        if len(at) != len(chunks):  # a rule of another vocabulary: one by one
            return self.whole([" " + c for c in chunks])
        raw, ends = ids.tobytes(), (4 * at).tolist()
        return [raw[a:b] for a, b in zip(ends, [*ends[1:], len(raw)])]

    def _lines(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece that has no line end and no white space before it."""
        ids = array("I", self.tokenizer.encode_batch_fast(["\n".join(pieces)], add_special_tokens=False)[0].ids)
        at = np.flatnonzero(np.frombuffer(ids, np.uint32) == self.line_end)
        if len(at) != len(pieces) - 1:
            return self.whole(pieces)
        raw, ends = ids.tobytes(), (4 * at).tolist()
        return [raw[a:b] for a, b in zip([0, *(e + 4 for e in ends)], [*ends, len(raw)])]

    def _met_before(self, pieces: list[str]) -> list[str]:
        """Those of ``pieces`` whose flag is up; the flags of all go up. Half of all flags at most are up at once."""
        if self.n_met + len(pieces) > DOOR // 2:
            self.met[:], self.n_met = False, 0
        at = np.fromiter(map(hash, pieces), np.int64, len(pieces)) & (DOOR - 1)
        known = self.met[at]
        self.met[at] = True
        self.n_met += len(pieces) - int(known.sum())
        return list(compress(pieces, known.tolist()))

    def _learn(self, pieces: set[str]) -> dict[str, bytes]:
        """Ids of pieces that the younger half lacks: from the older one, or encoded."""
        old = self.old.get
        found = {p: x for p in pieces if (x := old(p)) is not None}
        new = [*(pieces - found.keys())]
        kept = [*found, *(p for p in (new if self.first else self._met_before(new)) if len(p) <= LONGEST)]
        spaced, lines, rest = [], [], []
        for p in new:
            bare = len(p.strip())
            if bare and bare == len(p) - 1 and p.rfind(" ") == 0:
                spaced.append(p)
            elif self.by_class and bare == len(p) and "\n" not in p:
                lines.append(p)
            else:
                rest.append(p)
        for at in range(0, len(spaced), JOINED_CHUNKS):
            some = spaced[at:at + JOINED_CHUNKS]
            found.update(zip(some, self._joined([p[1:] for p in some])))
        for at in range(0, len(lines), JOINED_CHUNKS):
            some = lines[at:at + JOINED_CHUNKS]
            found.update(zip(some, self._lines(some)))
        found.update(zip(rest, self.whole(rest)))
        ids = [*map(found.__getitem__, kept)]
        self.young.update(zip(kept, ids))
        self.held += sum(map(len, kept)) + sum(map(len, ids)) + ENTRY_BYTES * len(kept)
        return found

    def _ids_of(self, pieces: list[str]) -> pa.Array:
        ids = [*map(self.young.get, pieces)]
        at = [i for i, x in enumerate(ids) if x is None]
        if at:
            found = self._learn({pieces[i] for i in at})
            for i in at:
                ids[i] = found[pieces[i]]
        ends = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)), out=ends[1:])
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(ends), pa.py_buffer(b"".join(ids))])

    def cuts(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Where pieces begin in the bytes of texts that begin and end at ``bounds``.

        A pre-token ends, whatever is beyond its neighbours, before one space between characters that are no white space; with
        the byte-level pattern also between a letter or digit and a mark, and on both sides of such a line end.
        """
        classes = np.frombuffer(bytearray(data).translate(CLASSES), np.uint8)
        at = np.flatnonzero(data >= 0xC2)
        lead, after = data[at], data[at + 1]
        letters = at[LETTER_LEADS[lead] & ((lead != 0xC3) | (after & 0xDF != 0x97))]
        classes[letters] = classes[letters + 1] = WORD
        third = np.where(lead < 0xE0, 0, data[np.minimum(at + 2, len(data) - 1)])
        blank = at[np.isin((lead.astype(np.int64) << 16) + (after.astype(np.int64) << 8) + third, WIDE)]
        for k in range(3):
            classes[np.minimum(blank + k, len(data) - 1)] = SPACE
        begins = np.zeros(len(data) + 1, bool)
        begins[bounds] = True
        seen = classes != SPACE
        between = np.zeros(len(data), bool)  # characters that are no white space on both sides, in the same text
        between[1:-1] = seen[:-2] & seen[2:] & ~begins[1:-2] & ~begins[2:-1]
        begins[:-1] |= between & (data == 32)
        if self.by_class:
            word, mark = classes == WORD, classes == MARK
            begins[1:-1] |= word[:-1] & mark[1:] | mark[:-1] & word[1:]
            lines = between & (data == 10)
            begins[:-1] |= lines
            begins[1:] |= lines
        return np.flatnonzero(begins)

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Ids of each text; null is empty."""
        if 2 * self.held > self.cache_bytes:
            self.old, self.young, self.held = self.young, {}, 0
        column = pc.fill_null(pa.array(texts, pa.string()) if isinstance(texts, list) else texts, "").cast(pa.large_string())
        _, bounds, data = column.buffers()
        bounds = np.frombuffer(bounds, np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, int)
        data, bounds = np.frombuffer(data or b"", np.uint8)[bounds[0]:bounds[-1]], bounds - bounds[0]
        cuts = self.cuts(data, bounds)
        pieces = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), pa.py_buffer(data)).dictionary_encode()
        ids = self._ids_of(pieces.dictionary.to_numpy(zero_copy_only=False).tolist()).take(pieces.indices)
        ends = np.frombuffer(ids.buffers()[1], np.int64)[np.searchsorted(cuts, bounds)].tolist()
        raw = memoryview(ids.buffers()[2] or b"")
        out = [bytes(raw[a:b]) for a, b in zip(ends, ends[1:])]
        for s in self.special:
            at = np.flatnonzero(pc.match_substring(column, s).to_numpy(zero_copy_only=False))
            for i, x in zip(at.tolist(), self.whole(column.take(pa.array(at)).to_pylist())):
                out[i] = x
        return out


@cache
def encoder(path: str, cache_bytes: int = CACHE_BYTES, first: bool = False) -> Encoder:
    return Encoder(path, cache_bytes, first)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
