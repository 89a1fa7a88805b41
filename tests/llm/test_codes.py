import hashlib
import os

import duckdb
import numpy as np
import pytest

from panelcraft.llm import fill_in_middle, hilbert_blocks
from panelcraft.llm.queries import ORACLES, QUERIES

from .conftest import ODD

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    got = QUERIES[name](spark, SF)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({ORACLES[name]})").fetchall()
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str) and want


def codes(rows, parts=4, entries=256, rounds=4):
    """Plain loops over whole numbers."""
    kept = sorted(((i, v, label) for i, v, label in rows if v and all(x is not None and np.isfinite(x) for x in v)),
                  key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    q = [[int(np.floor(1024 * x)) for x in v] for _, v, _ in kept]
    w = len(q[0]) // parts
    cut = [[v[p * w:(p + 1) * w] for v in q] for p in range(parts)]
    books = [[list(v) for v in c[:entries]] for c in cut]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(v, e)), i) for i, e in enumerate(books[p])) for v in cut[p]] for p in range(parts)]

    for _ in range(rounds):
        best = assign()
        for p in range(parts):
            for i in range(len(books[p])):
                own = [v for v, b in zip(cut[p], best[p]) if b[1] == i]
                if own:
                    books[p][i] = [sum(c) // len(own) for c in zip(*own)]
    best = assign()
    errors = [sum(best[p][r][0] for p in range(parts)) for r in range(len(q))]
    by_label = {}
    for (_, _, label), e in zip(kept, errors):
        by_label[label] = by_label.get(label, 0) + e
    sha = hashlib.sha256(",".join(str(x) for p in books for e in p for x in e).encode()).hexdigest()
    return sorted([(i, "".join(f"{best[p][r][1]:02x}" for p in range(parts)), errors[r], by_label[label], sha)
                   for r, (i, _, label) in enumerate(kept)], key=str)


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, label int, row int, code string")


def test_codes_of_odd_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), [float(np.float32(x)) for x in rng.normal(size=8)], int(i) % 3 if i % 5 else None) for i in rng.permutation(700)]
    rows += [(1000, None, 1), (1001, [1.0, None] * 4, 1), (1002, [float("nan")] * 8, 1), (1003, [float("inf")] * 8, 1), (1004, [], 1),
             (None, [0.5] * 8, 2), (None, [-0.5] * 8, None), (3, [2.0] * 8, 0), (3, [1.0] * 8, 0), (1005, [3.0e4] * 8, 4),
             *[(2000 + i, [0.25] * 8, 7) for i in range(400)]]
    assert sorted(map(tuple, hilbert_blocks.digest(table(spark, rows)).collect()), key=str) == codes(rows)


def test_few_rows_and_none(spark):
    rows = [(2, [0.1, 0.2, 0.3, 0.4], 1), (1, [0.1, 0.2, 0.3, 0.4], None), (5, [0.0009, -0.0009, 0.0, 1.0], None)]
    assert sorted(map(tuple, hilbert_blocks.digest(table(spark, rows)).collect()), key=str) == codes(rows)
    assert hilbert_blocks.digest(table(spark, rows).limit(0)).collect() == []


@pytest.mark.parametrize("rows, what", [([(1, [1.0] * 4, 1), (2, [1.0] * 8, 1)], "components"), ([(1, [1.0] * 6, 1)], "components"),
                                        ([(1, [1.0e6] * 4, 1)], "beyond")])
def test_vectors_that_cannot_be_coded(spark, rows, what):
    with pytest.raises(Exception, match=what):
        hilbert_blocks.digest(table(spark, rows)).collect()


def test_decoded_vectors_are_near(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=8)], 0) for i in range(300)]
    coded, codec = hilbert_blocks.compress(table(spark, rows))
    for r in coded.collect():
        assert sum((np.floor(1024 * x) - 1024 * y) ** 2 for x, y in zip(np.float32(rows[r["vec_id"]][1]).astype(float), codec.decode(r["code"]))) \
            == pytest.approx(r["error"])


def test_shortlists_lose_no_nearest_entry_and_are_short_on_clustered_rows():
    rng = np.random.default_rng(3)
    centres = rng.integers(-5000, 5000, (256, 6))
    rows = centres[rng.integers(0, 256, 6000)] + rng.integers(-200, 200, (6000, 6))
    room = rows.max(0) - rows.min(0) + 1
    rows = rows[np.argsort(hilbert_blocks.hilbert_key(((rows - rows.min(0)) << 8) // room, 8))]
    book = np.concatenate([centres[:200], centres[:20], rng.integers(-5000, 5000, (36, 6))])  # with equal entries
    cut = [rows[i:i + 16] for i in range(0, len(rows), 16)]
    can = hilbert_blocks.shortlists(np.array([c.min(0) for c in cut]), np.array([c.max(0) for c in cut]), book)
    for c, names in zip(cut, can):
        far = np.square(c[:, None, :] - book).sum(2)
        own, least = hilbert_blocks.nearest_entries(c, book, np.flatnonzero(names))
        assert (own == far.argmin(1)).all() and (least == far.min(1)).all()
    assert can.sum(1).mean() < 60


def test_hilbert_steps_are_single():
    bits, n = 3, 3
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * n, indexing="ij"), -1).reshape(-1, n)
    key = hilbert_blocks.hilbert_key(cells, bits)
    walk = cells[np.argsort(key)]
    assert sorted(key) == list(range(len(cells))) and (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def brute_fim(i, text):
    import re

    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    h = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    form = "plain" if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90 else "spm" if h4 % 100 < 20 else "psm"
    out = {"plain": text, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in (out, text)]
    return (i, n, form, None if form == "plain" else len(p), None if form == "plain" else len(m), *sha)


def test_fill_in_middle_of_odd_rows(spark, documents):
    rows = ODD + [(20 + i, x) for i, x in enumerate(["<P> held", "a<S>b", "<M>", "<<<P", "P><S", "$1 \\2 $", "𝒜bc 𝒟 é́\n\r\n", "word" * 200_000,
                                                     "x y " * 100_000, "<", ">", "<P", "S><M ><P"] * 9)]
    got = sorted(map(tuple, fill_in_middle.digest(documents(rows)).collect()), key=str)
    assert got == sorted([brute_fim(i, t) for i, t in rows], key=str)
    assert fill_in_middle.digest(documents(rows).limit(0)).collect() == []


def test_parts_and_other_sentinels(spark, documents):
    transform = fill_in_middle.FillInMiddle(prefix="[$PRE\\]", suffix="[SUF]", middle="[MID]", share=100, spm_share=50, seed="s")
    rows = [(i, f"some words {i}, and more $words") for i in range(60)]
    made = transform.apply(documents(rows)).withColumn("cut", transform.parts()).withColumn("back", transform.restore()).collect()
    assert {r["form"] for r in made} == {"psm", "spm"} and all(r["back"] == r["text"] for r in made)
    assert all(r["cut"]["prefix"] + r["cut"]["middle"] + r["cut"]["suffix"] == r["text"] for r in made)
