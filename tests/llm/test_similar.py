import hashlib

import numpy as np
from pyspark.sql import functions as F

from panelcraft.llm import embed_tiles, neighbours_in_order, oph, simhash_gray
from panelcraft.llm.components import components

from .conftest import ODD


def closure(near):
    label = np.arange(len(near))
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            return label
        label = new


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7)]
    got = {r["id"]: r["root"] for r in components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + k: 100 for k in range(30)}
    assert components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_groups_against_all_pairs(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2 ** 63, 60, dtype=np.uint64)
    fps = {int(b) for b in base}
    for b in base[:30]:
        at = int(b)
        for _ in range(8):
            at ^= 1 << int(rng.integers(64))
            fps.add(at)
    values = np.array(sorted(fps), np.uint64)
    table = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    roots = {r["id"]: r["root"] for r in components(simhash_gray.links(table, 2, block_rows=16)).collect()}
    want = closure(np.bitwise_count(values[:, None] ^ values[None, :]) <= 2)
    own = [roots.get(int(v), int(v)) for v in values.view(np.int64)]
    assert len(set(zip(own, want))) == len(set(own)) == len(set(want))


def test_groups_of_odd_rows(odd):
    got = {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash_gray.groups(odd).collect()}
    by_id = {i: (f, c) for i, f, c in got}
    assert by_id[1] == by_id[2] == by_id[8] == ("0" * 16, 1)
    assert by_id[5] == by_id[4] and by_id[4][1] == 4 and by_id[None][1] is None
    kept = simhash_gray.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "3", "4", "7", "9", "None"]
    assert simhash_gray.groups(odd.limit(0)).count() == 0


def test_fingerprints_estimate_similarity():
    rng = np.random.default_rng(2)
    words = [f"w{k}" for k in range(400)]
    for share in (0.0, 0.5, 0.9, 1.0):
        text = " ".join(rng.choice(words, 300))
        cut = int(len(text) * share)
        other = text[:cut] + " ".join(rng.choice(words, 300))[:len(text) - cut]
        a, b = (set(zip(*[t.split()[k:] for k in range(5)])) for t in (text, other))
        assert abs(oph.likeness(oph.fingerprint(text), oph.fingerprint(other)) - len(a & b) / len(a | b)) < 0.12
    assert oph.likeness("", "") == 1 and oph.likeness("", oph.fingerprint("a b")) == 0


def test_neighbours_of_odd_rows(spark, odd):
    order = [r for r in ODD if r[0] is None] + sorted((r for r in ODD if r[0] is not None), key=lambda r: r[0])
    texts = [t or "" for _, t in order]
    want = set()
    for (i, _), a, b in zip(order, texts, texts[1:] + texts[:1]):
        edited = a[:len(a) - len(a) // 4] + b[:len(a) // 4]
        want.add((i, len(a), hashlib.sha256(edited.encode()).hexdigest()))
    got = neighbours_in_order.against_next(odd).collect()
    assert len(got) == len(ODD) and {(r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got} == want
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert neighbours_in_order.against_next(odd.limit(0)).count() == 0
    assert neighbours_in_order.against_next(odd.where("doc_id = 3")).first()["near_next"] == 1


def test_vectors_against_all_pairs(spark):
    rng = np.random.default_rng(4)
    rows = []
    for k in range(12):
        centre = rng.normal(size=8)
        rows += [(len(rows) + j, (centre + rng.normal(0, 0.08, 8)).tolist(), int(k % 3)) for j in range(15)]
    n = len(rows)
    rows += [(n + k, rows[0][1], rows[0][2]) for k in range(4)]
    bad = [(900, None, 1), (901, [0.0] * 8, 1), (902, [None] + [1.0] * 7, 1), (903, [float("nan")] + [1.0] * 7, 1),
           (904, rows[0][1], None), (905, [1.0, 2.0], 0)]
    table = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, label int").withColumn("v", F.lit(1))
    got = {r["vec_id"]: r for r in embed_tiles.links(table).collect()}
    v, label = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    cosine = v @ v.T / np.outer(np.linalg.norm(v, axis=1), np.linalg.norm(v, axis=1))
    near = (cosine >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, True)
    root = closure(near)
    for k in range(len(rows)):
        assert (got[k]["n_links"], got[k]["component_id"], got[k]["kept"]) == (near[k].sum() - 1, root[k], root[k] == k)
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i, _, _ in bad)
    assert near.sum() > len(rows) + 50 and embed_tiles.links(table.limit(0)).count() == 0
