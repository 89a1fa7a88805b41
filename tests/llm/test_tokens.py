import base64
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from panelcraft.llm import packing, rank_queue_bpe, token_planes
from panelcraft.llm.linear_grouping import Plan
from panelcraft.llm.public_ids import ALONE_BYTES, CACHE_BYTES, FIRST_BYTES, Encoder, default_path, encoder

from .conftest import ODD


def plain_ids(text):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(default_path())
    return tokenizer.encode(text, add_special_tokens=False).ids


@cache
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(default_path())


def library_ids(texts):
    return [library().encode(t, add_special_tokens=False).ids for t in texts]


@given(st.lists(st.integers(0, 2 ** 32 - 1), max_size=300))
@settings(max_examples=50, deadline=None)
def test_planes_come_back(ids):
    row = np.array(ids, "<u4")
    assert (token_planes.unpack(token_planes.pack(row, block_ids=64)) == row).all()


@given(st.lists(st.text(alphabet="ab '\n\tsé1.,日", max_size=30), max_size=5))
@settings(max_examples=40, deadline=None)
def test_chunk_cache_encodes_as_the_library(texts):
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder(default_path()).encode(texts)] == [plain_ids(t) for t in texts]


@pytest.mark.parametrize("cache_bytes", [0, 4_000, 1 << 28])
def test_encoder_at_any_cache_size(cache_bytes):
    words = ["tion", "re", "Éa", "the", "日本", "x1", "it's", "end.", "a\nb", "¶", "word" * 40, "<|endoftext|>", "Ġa", "½"]
    rng = np.random.default_rng(1)
    texts = [" ".join(words[i] for i in rng.integers(0, len(words), 40)) for _ in range(60)] + ["", " ", "a  b", " a", "a ", "\n x"]
    own = Encoder(default_path(), cache_bytes)
    for at in range(0, len(texts), 7):
        some = texts[at:at + 7]
        assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(some)] == [plain_ids(t) for t in some]
    assert np.frombuffer(own.encode(["a <|endoftext|> b"])[0], "<u4").tolist().count(50256) == 1


def test_cache_of_an_encoding_job_keeps_what_returns(spark, odd):
    words = [f"w{k:x}q" for k in range(500_000)]
    encoded = {}
    for size in (CACHE_BYTES, ALONE_BYTES):
        own, encoded[size] = Encoder(default_path(), size), []
        own._joined = lambda some, seen=encoded[size]: seen.extend(some) or [b""] * len(some)  # what is encoded, not how
        for turn in range(4):
            for at in range(0, len(words), 20_000):
                own.encode([" " + " ".join(words[at:at + 20_000])])
    assert len(words) < len(encoded[ALONE_BYTES]) <= 2 * len(words) < len(encoded[CACHE_BYTES])
    small, large = [{r[:5] for r in packing.pack(odd, cache_bytes=n).collect()} for n in (4_000, ALONE_BYTES)]
    assert small == large and len(small) >= len(ODD)


def test_words_are_encoded_once_whatever_marks_are_around_them():
    words = [f"{a}{b}{c}éß" for a in "bdfgklmnprstvz" for b in "aeiouyäöü" for c in "bdfgklmnprstvz"]
    around = ["{}", "{}.", "{},", "({})", "{}!?", "$$${}", "'x' {}", "x.\n{}", "{}\nx"]
    texts = [" ".join(["x", *(a.format(w) for w in words)]) for a in around]
    own, seen = Encoder(default_path(), FIRST_BYTES, True), []
    inner, lines = own._joined, own._lines
    own._joined = lambda some: seen.extend(some) or inner(some)
    own._lines = lambda some: seen.extend(some) or lines(some)
    for text in texts:
        assert [np.frombuffer(x, "<u4").tolist() for x in own.encode([text])] == library_ids([text])
    # Behind a space and without one: twice at most for each word, not once for each way of writing it.
    assert sum(any(c.isalpha() for c in x) for x in seen) <= 2 * len(words) + 3  # and x
    batch = pa.array([None, "", *texts, "a  b"], pa.string()).slice(1)
    assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(batch)] == library_ids(batch.to_pylist())


BLANKS = [" ", "  ", "\n", "\n\n", "\r\n", "\t", "\v", "\x1c", "\x85", "\xa0", "\u1680", "\u2003", "\u2028", "\u205f", "\u3000"]
SIGNS = ["a", "Z", "é", "ß", "ÿ", "ſ", "Я", "ҁ", "×", "÷", "½", "²", "ª", "1", "٣", "日", "क्ि", "\u200b", "\u0301", "😀", "’", "“", "'", "'s",
         "'re", "don't", ".", "-", "_", "$$", "<|", "<|endoftext|>", "Ġ", "\0", "\x7f"]


@given(st.lists(st.lists(st.sampled_from(BLANKS + SIGNS), max_size=12).map("".join), max_size=6))
@settings(max_examples=150, deadline=None)
def test_pieces_of_odd_signs_encode_as_the_library(texts):
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder(default_path()).encode(texts)] == library_ids(texts)


def test_other_patterns_are_cut_at_spaces_only(tmp_path):
    from tokenizers import Regex, Tokenizer, pre_tokenizers

    other = Tokenizer.from_file(default_path())
    other.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(r"[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}| ?[^\s\p{L}\p{N}]+[\r\n]*|\s*[\r\n]+|\s+(?!\S)|\s+"), "isolated"),
        pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    other.save(str(tmp_path / "other.json"))
    texts = ["(the) end.\nThe $re-start, of.the\n\nend", "x.\n\ny the\nend", "it's  the end. "]
    got = Encoder(str(tmp_path / "other.json")).encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [other.encode(t, add_special_tokens=False).ids for t in texts]


def test_first_chunks_are_kept_and_planes_are_the_same(spark, odd, tmp_path):
    texts = [t or "" for _, t in ODD] + ["tion re Éa the 日本 x1 it's end. ½"] * 2
    own, seen = Encoder(default_path(), FIRST_BYTES, True), []
    inner = own._joined
    own._joined = lambda some: seen.extend(some) or inner(some)
    for _ in range(3):
        assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(texts)] == [plain_ids(t) for t in texts]
    short = [c for c in seen if len(c) <= 64]
    assert "Éa" in short and len(short) == len(set(short))
    rows = []
    for name, size, first in (("a", CACHE_BYTES, False), ("b", FIRST_BYTES, True), ("c", 0, True)):
        token_planes.write(odd, str(tmp_path / name), cache_bytes=size, first=first)
        rows.append({tuple(r) for r in token_planes.read(spark, str(tmp_path / name)).drop("start").collect()})
    assert rows[0] == rows[1] == rows[2]


def test_planes_are_encoded_in_slices_whose_pieces_repeat(documents, tmp_path, monkeypatch):
    log, texts = tmp_path / "log", ["the " * 500 + f"end{i}." for i in range(1_200)]

    def encode(self, some, inner=Encoder.encode):
        with open(log, "a") as lines:
            lines.write(f"{len(some)}\n")
        return inner(self, some)

    monkeypatch.setattr(token_planes, "encoder", lambda *a: type("Logged", (Encoder,), {"encode": encode})(*a))
    token_planes.write(documents([(i, t) for i, t in enumerate(texts)]).coalesce(1), str(tmp_path / "ids"))
    calls = [int(n) for n in log.read_text().split()]
    got = token_planes.read(documents([]).sparkSession, str(tmp_path / "ids")).collect()
    assert {(r["doc_id"], r["n_tokens"]) for r in got} == {(i, len(x) + 1) for i, x in enumerate(library_ids(texts))}
    assert sum(calls) == len(texts) and max(calls) > 250  # 500 KB hold 249 of them


def test_files_of_odd_rows(spark, odd, tmp_path):
    token_planes.write(odd, str(tmp_path / "ids"))
    got = sorted(token_planes.read(spark, str(tmp_path / "ids")).collect(), key=lambda r: r["start"])
    want = {(i, len(x) + 1, zlib.crc32(np.array([*x, 2], "<u4").tobytes())) for i, t in ODD for x in [plain_ids(t or "")]}
    assert {(r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got} == want and len(got) == len(ODD)
    ends = np.cumsum([r["n_tokens"] for r in got])
    assert [r["start"] for r in got] == [0, *ends[:-1].tolist()] and got[0]["doc_id"] is None


def test_empty_tables(spark, odd, tmp_path):
    none = odd.limit(0)
    token_planes.write(none, str(tmp_path / "none"))
    assert token_planes.read(spark, str(tmp_path / "none")).count() == 0
    assert packing.pack(none).count() == 0 and rank_queue_bpe.round_trip(none).count() == 0


def test_rank_queue_is_the_library(spark, odd):
    import tiktoken

    path, pattern = rank_queue_bpe.default_file()
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    texts = [t or "" for _, t in ODD] + ["a" * 3_000, "é" * 2_000, "abab" * 900 + "c", "x1_" * 500]
    use = rank_queue_bpe.codec(path, pattern)
    got = use.encode(texts)
    assert [g.tolist() for g in got] == [library.encode_ordinary(t) for t in texts]
    assert [use.decode(g).decode() for g in got] == texts
    back = rank_queue_bpe.decode(rank_queue_bpe.encode(odd)).collect()
    assert sorted(bytes(r["decoded"]).decode() for r in back) == sorted(t or "" for _, t in ODD)


def check_plan(capacity, histogram):
    plan = Plan(capacity, histogram)
    ends, seen = {}, {}
    for length, rank, count, sequence, offset in plan.rows:
        assert rank == seen.get(length, 0)
        seen[length] = rank + count
        for k in range(sequence, sequence + count):
            ends.setdefault(k, []).append((offset, length))
    assert seen == {n: c for n, c in histogram.items() if c}
    for items in ends.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= capacity
    return plan.sequences


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=20))
@settings(max_examples=60, deadline=None)
def test_plans_are_whole(histogram):
    assert check_plan(64, histogram) >= -(-sum(n * c for n, c in histogram.items()) // 64)


def test_plan_is_tight():
    rng = np.random.default_rng(1)
    lengths = np.clip(rng.lognormal(5.5, 1, 50_000).astype(int), 1, 1024)
    values, counts = np.unique(lengths, return_counts=True)
    assert check_plan(1024, dict(zip(values.tolist(), counts.tolist()))) <= 1.01 * lengths.sum() / 1024
    with pytest.raises(ValueError):
        Plan(10, {11: 1})


def test_packing_of_odd_rows(odd):
    got = packing.pack(odd).collect()
    assert sum(r["length"] for r in got) == sum(len(plain_ids(t or "")) + 1 for _, t in ODD)
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for items in by_sequence.values():
        assert sum(n for _, n in items) <= 1024
        assert [o for o, _ in sorted(items)] == [0, *np.cumsum([n for _, n in sorted(items)])[:-1].tolist()]


def test_first_piece_of_a_long_document_is_the_short_one(documents):
    texts = {1: "ab " * 1_500, 2: "one two three " * 700, 3: "short"}
    rows = {i: [*plain_ids(t), 2] for i, t in texts.items()}
    capacity = len(rows[1]) // 2 if len(rows[1]) % 2 == 0 else len(rows[1])  # row 1 has full pieces only
    for size in (1024, capacity):
        want = set()
        for i, ids in rows.items():
            first = len(ids) % size or size
            starts = [0, *range(first, len(ids), size)]
            want |= {(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))
                     for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)]))}
        got = packing.pack(documents(list(texts.items())), size).collect()
        assert {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got} == want and len(got) == len(want)
