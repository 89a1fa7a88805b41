import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcraft.operators import centres as ce, graph as gr, latent as la, laplacian as lp, mixture as mi, quality as ql, segment as sg
from panelcraft.operators import selection as sl
from panelcraft.operators.mcfs import embedding, least_angle, mcfs
from panelcraft.operators.reduce import gram


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(0)
    rows = [(i, int(i % 3), *map(float, rng.normal([0, 5, 10][i % 3], 0.6, 4)), int(i % 3), int(i % 2)) for i in range(300)]
    return spark.createDataFrame(rows, "id long, truth int, a double, b double, c double, d double, q int, r int").persist()


def ari(labels, blobs):
    return ql.adjusted_rand(labels.join(blobs.select("id", "truth"), "id"), "cluster", "truth").first()[0]


def test_kmeans_pca_finds_blobs_and_is_stable(spark, blobs):
    found = sg.kmeans_pca(blobs, ["a", "b", "c", "d"], mode="tune", seeds=[1, 2], k_max=5)
    assert found.model.k == 3 and ari(found.labels, blobs) == pytest.approx(1.0)
    assert sg.consistency(blobs, found)["model_consistency"] == pytest.approx(1.0)
    with pytest.raises(ValueError, match='either "tune" or "eval"'):
        sg.kmeans_pca(blobs, ["a"], mode="other")


def test_cost_never_rises_and_repartition_changes_nothing(blobs):
    layout = ce.Layout(["a", "b"], ["q"])
    start = ce.Centres(np.array([[0.0, 1.0], [1.0, 0.0], [9.0, 2.0]]), np.array([[0.0], [1.0], [1.0]]), 0.7)
    costs = [ce.fit(blobs, layout, {0: start}, max_iterations=i)[0].cost for i in range(1, 6)]
    assert all(b <= a + 1e-9 for a, b in zip(costs, costs[1:]))
    again = ce.fit(blobs.repartition(11), layout, {0: start}, max_iterations=5)[0]
    assert again.cost == pytest.approx(costs[-1], rel=1e-12)


def test_kmodes_patterns_equal_rows(blobs):
    layout = ce.Layout([], ["q", "r"])
    start = ce.dense_starts(ce.patterns(blobs, ["q", "r"]), layout, 3)
    a = ce.fit(blobs, layout, {0: start})[0]
    b = ce.fit(ce.patterns(blobs, ["q", "r"]), layout, {0: start})[0]
    assert a.cost == b.cost and (a.modes == b.modes).all() and (a.sizes == b.sizes).all()


def test_latent_classes_separate_and_likelihood_rises(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(600):
        hi = i % 3
        rows.append((i, hi, *[int(rng.random() < (0.95 if j % 3 == hi else 0.05)) for j in range(9)]))
    cols = [f"q{j}" for j in range(9)]
    df = spark.createDataFrame(rows, "id long, truth int, " + ", ".join(f"{c} int" for c in cols)).persist()
    found = sg.latent_classes(df, cols, ks=[2, 3, 4], restarts=3)
    assert found.model.k == 3 and ari(found.labels, df) > 0.95
    pats = ce.patterns(df, cols)
    state, last = {0: la.random_classes([2] * 9, 3, 5, np.zeros(0), np.zeros(0))}, -np.inf
    for _ in range(5):
        state = la.em_step(pats, cols, [], state, True)
        assert state[0].log_likelihood >= last - 1e-9
        last = state[0].log_likelihood
    assert la.wide_subset([f"c{i}" for i in range(300)]) == la.wide_subset([f"c{i}" for i in range(300)])
    assert len(la.wide_subset([f"c{i}" for i in range(300)])) == 90


def test_gaussian_mixture_finds_blobs(spark, blobs):
    found = sg.gaussian_mixture(blobs, ["a", "b"], seeds=[1, 2], k_max=5)
    assert found.labels is not None and ari(found.labels, blobs) > 0.9
    assert float(mi.digamma(np.array([1.0]))[0]) == pytest.approx(-0.5772156649, abs=1e-9)
    assert mi.criteria(-100.0, 50, 2, 2)["n_parameters"] == 11


def test_hierarchical_offsets_and_ignored(spark, blobs):
    found = sg.hierarchical(blobs, "r", lambda part: sg.kmeans_pca(part, ["a", "b"], seeds=[1], k_min=3, k_max=4))
    labels = found.labels.join(blobs, "id")
    assert sorted(r[0] for r in labels.select("cluster").distinct().collect()) == [0, 1, 2, 3, 4, 5]
    frame = spark.createDataFrame([("a", 0), ("a", 1), ("b", 0), ("c", None)], "branch string, local int")
    got = {(r["branch"], r["local"]): r["cluster"] for r in sg.offset_labels(frame, "branch", "local", ["b"]).collect()}
    assert got == {("a", 0): 0, ("a", 1): 1, ("b", 0): -99, ("c", None): 2}


def test_pca_against_numpy(blobs):
    x = np.array([list(r) for r in blobs.select("a", "b", "c", "d").collect()])
    values = np.sort(np.linalg.eigvalsh(np.corrcoef(x.T)))[::-1]
    assert gram(blobs, ["a", "b", "c", "d"]).axes().ratio == pytest.approx(values / values.sum(), abs=1e-9)


def test_silhouettes_against_brute_force(blobs):
    x = np.array([list(r) for r in blobs.select("a", "b", "truth").collect()])
    d2 = ((x[:, None, :2] - x[None, :, :2]) ** 2).sum(-1)

    def brute(d):
        out = []
        for i in range(len(x)):
            own = x[:, 2] == x[i, 2]
            inner = d[i, own].sum() / (own.sum() - 1)
            outer = min(d[i, x[:, 2] == k].mean() for k in set(x[:, 2]) - {x[i, 2]})
            out.append((outer - inner) / max(outer, inner))
        return np.mean(out)

    assert ql.score_labellings(blobs, ["a", "b"], ["truth"])[0]["silhouette"] == pytest.approx(brute(d2), abs=1e-9)
    small = ql.silhouette_euclidean(blobs, ["a", "b"], "truth", block_rows=64).first()[0]
    assert small == pytest.approx(brute(np.sqrt(d2)), abs=1e-9)


def test_euclidean_silhouette_reads_points_written_once(spark, monkeypatch):
    written, write = [], ql.write_blocks
    monkeypatch.setattr(ql, "write_blocks", lambda *a: written.extend(write(*a)) or written)
    x = np.random.default_rng(3).normal(size=(90, 3)) + 1e4
    x[60:70] = x[:10]
    label = [None if i % 30 == 29 else "ab"[i % 2] if i else "c" for i in range(90)]
    df = spark.createDataFrame([(label[i], *map(float, x[i])) for i in range(90)], "l string, a double, b double, c double")
    got = ql.silhouette_euclidean(df, ["a", "b", "c"], "l", block_rows=8).first()[0]
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    score, kinds = np.zeros(90), np.array([k or "" for k in label])
    for i in range(90):
        if kinds[i] in ("a", "b"):
            inner = d[i, kinds == kinds[i]].sum() / ((kinds == kinds[i]).sum() - 1)
            outer = min(d[i, kinds == k].mean() for k in "abc" if k != kinds[i])
            score[i] = (outer - inner) / max(outer, inner)
    assert got == pytest.approx(score.mean(), abs=1e-9)
    assert sum(b.rows for b in written) == len({(k, *r) for k, r in zip(kinds, x.tolist())}) and len(written) > 8
    gap = spark.createDataFrame([("d", None, 1.0, 1.0)], df.schema)
    assert ql.silhouette_euclidean(df.unionByName(gap), ["a", "b", "c"], "l").first()[0] == 0.0


def test_equal_labels_have_ari_one(spark):
    df = spark.createDataFrame([(i, i % 2, 1 - i % 2) for i in range(8)], "id long, a int, b int")
    assert ql.adjusted_rand(df, "a", "b").first()[0] == 1.0


def test_elbow_and_best_k(spark):
    runs = spark.createDataFrame([(3, 10.0, 0.5, 1.0, 5.0), (4, 4.0, 0.5, 1.0, 5.0), (5, 3.0, 0.5, 1.0, 5.0), (6, 2.5, 0.5, 1.0, 5.0)],
                                 "n_clusters int, cost double, silhouette double, davies_bouldin double, calinski_harabasz double")
    assert ql.best_k(runs).filter("is_best").first()["n_clusters"] == 4
    one = ql.best_k(runs.limit(1)).first()
    assert one["is_best"] and one["rank_sum"] == 4.0


# --- graphs -------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("across", [False, True])
def test_neighbours_against_brute_force_with_hot_pattern(spark, monkeypatch, across):
    monkeypatch.setattr(gr, "BLOCK_ROWS", 7)
    monkeypatch.setattr(gr, "ASKERS", 11)
    rng = np.random.default_rng(2)
    x = rng.integers(0, 4, (120, 3)).astype(float)
    x[:45] = 1.0  # one pattern holds more than a third of the rows
    group = rng.integers(0, 2, 120)
    df = spark.createDataFrame([(int(i), str(group[i]), *map(float, x[i])) for i in range(120)], "id long, g string, a double, b double, c double")
    got = gr.nearest(df, 4, numeric=["a"], codes=["b", "c"], by="g" if across else None, across=across).collect()
    span = np.ptp(x[:, 0])
    d = (np.abs(x[:, None, 0] - x[None, :, 0]) / span + (x[:, None, 1:] != x[None, :, 1:]).sum(-1)) / 3
    want = set()
    for i in range(120):
        for g in (("0", "1") if across else (None,)):
            others = [j for j in range(120) if j != i and (g is None or str(group[j]) == g)]
            for rn, j in enumerate(sorted(others, key=lambda j: (round(d[i, j], 9), j))[:4]):
                want.add((i, j, rn + 1))
    assert {(r["src"], r["dst"], r["rn"]) for r in got} == want


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
def test_patterns_are_written_once_and_neighbours_are_exact(spark, monkeypatch, metric):
    monkeypatch.setattr(gr, "BLOCK_ROWS", 16)
    monkeypatch.setattr(gr, "ASKERS", 40)
    monkeypatch.setattr(gr, "MEMBERS", 32)
    written, write = [], gr.write_blocks
    monkeypatch.setattr(gr, "write_blocks", lambda *a: written.extend(write(*a)) or written)
    x = np.random.default_rng(8).normal(size=(200, 12)) + 3.0
    x[150:] = x[:50]
    names = [f"c{i}" for i in range(12)]
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], ["id", *names])
    got = {(r["src"], r["dst"], r["rn"]) for r in gr.nearest(df, 4, numeric=names, metric=metric).collect()}
    if metric == "cosine":
        x = x / np.linalg.norm(x, axis=1)[:, None]
    d = np.round(np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)), 9)
    assert got == {(i, j, rn + 1) for i in range(200) for rn, j in enumerate(
        sorted((j for j in range(200) if j != i), key=lambda j: (d[i, j], j))[:4])}
    assert sum(b.rows for b in written) == 150 and len(written) > 12


def test_laplacian_against_matrices(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(60, 3))
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, a double, b double, c double")
    graph = gr.affinity(df, 4, numeric=["a", "b", "c"], metric="euclidean").persist()
    w = np.zeros((60, 60))
    for r in graph.collect():
        w[r["src"], r["dst"]] = r["w"]
    assert (w == w.T).all()
    deg = w.sum(1)
    for r in lp.laplacian_scores(df, graph, ["a", "b", "c"]).collect():
        f = x[:, "abc".index(r["feature"])]
        f = f - (f * deg).sum() / deg.sum()
        assert r["score"] == pytest.approx(f @ (np.diag(deg) - w) @ f / (f * f * deg).sum(), abs=1e-9)


def test_embedding_spans_leading_eigenvectors(spark):
    rng = np.random.default_rng(5)
    n = 60
    w = np.zeros((n, n))
    for i in range(n):
        for j in range(i):
            if i // 20 == j // 20 or rng.random() < 0.03:
                w[i, j] = w[j, i] = rng.random()
    graph = spark.createDataFrame([(int(i), int(j), float(w[i, j])) for i, j in zip(*np.nonzero(w))], "src long, dst long, w double")
    vectors, _ = embedding(graph, 2, rounds=10, tolerance=1e-9)
    deg = w.sum(1)
    values, full = np.linalg.eigh(w / np.sqrt(np.outer(deg, deg)))
    want = full[:, -3:-1]
    got = np.array([r["y"] for r in vectors.orderBy("id").collect()]) * np.sqrt(deg)[:, None]
    got /= np.linalg.norm(got, axis=0)
    assert np.linalg.norm(want - got @ (got.T @ want)) < 1e-3


def test_coded_graph_is_the_graph_of_all_rows_with_few_nodes(spark):
    """Rows that are nobody's neighbour are one node of their pattern; scores and embedding are those of all rows."""
    rng = np.random.default_rng(9)
    x = np.column_stack([rng.integers(0, 5, 120), rng.integers(0, 3, 120), rng.integers(0, 4, 120)])
    x[30:90] = [2, 1, 2]
    df = spark.createDataFrame([(i, *map(int, r)) for i, r in enumerate(x)], "id long, a int, b int, c int").persist()
    codes = ["a", "b", "c"]
    graphs = lp.graphs_by_size(df, codes, [5, 8])
    for k in (5, 8):
        full, small = gr.affinity(df, k, codes=codes).persist(), graphs[k]
        assert small.nodes.agg(F.sum("rows")).first()[0] == 120 and small.nodes.count() < 75 and small.edges().count() < full.count()
        assert small.links().agg(F.sum("w")).first()[0] == pytest.approx(full.agg(F.sum("w")).first()[0])
        want = {r["feature"]: r["score"] for r in lp.laplacian_scores(df, full, codes).collect()}
        assert {r["feature"]: r["score"] for r in lp.laplacian_scores(df, small, codes).collect()} == pytest.approx(want)
    want, got = ({r["feature"]: r["score"] for r in mcfs(df, g, codes, 2, 2, rounds=3).collect()} for g in (full, small))
    assert got == pytest.approx(want, rel=1e-3)


def test_least_angle_ends_at_least_squares():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(100, 5))
    y = x @ np.array([3.0, 0, -2, 0, 0.5]) + rng.normal(size=100) * 0.1
    x, y = x - x.mean(0), y - y.mean()
    assert least_angle(x.T @ x, x.T @ y, 5) == pytest.approx(np.linalg.lstsq(x, y, rcond=None)[0], abs=1e-8)
    two = least_angle(x.T @ x, x.T @ y, 2)
    assert set(np.flatnonzero(two)) == {0, 2}


# --- error contract -----------------------------------------------------------------------------------------


@pytest.mark.parametrize("args, fault, text", [
    (("4", 5, 1, 4), TypeError, "n_features must be positive Integer"), ((0, 5, 1, 4), ValueError, "n_features must be positive Integer"),
    ((2, 5.5, 1, 4), TypeError, "n_neighbours must be a positive Integer."), ((2, 0, 1, 4), ValueError, "n_neighbours must be a positive Integer."),
    ((2, 5, 1, 0), ValueError, "n_clusters must be positive Integer"), ((9, 5, 1, 4), ValueError, "more than number")])
def test_rank_features_arguments(spark, args, fault, text):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "id long, sbeh_a string")
    with pytest.raises(fault, match=text):
        sl.rank_features(df, *args)


def test_laplacian_arguments(spark):
    df = spark.createDataFrame([(1, 0)], "id long, a int")
    for bad, fault in ((-1, ValueError), (2.5, TypeError)):
        with pytest.raises(fault, match="positive integer"):
            sl.laplacian_quality(df, ["a"], bad)
    with pytest.raises(TypeError, match="Input must be a DataFrame"):
        sl.laplacian_quality([1], ["a"])
    with pytest.raises(ValueError, match="min_neighbours"):
        sl.optimal_laplacian(df, ["a"], 10, 5)


def test_missing_feature_raises(blobs):
    from pyspark.errors import AnalysisException
    with pytest.raises(AnalysisException):
        blobs.select("nope").collect()


def test_rows_without_a_branch_keep_labels(spark):
    from panelcraft.operators.segment import Segmentation, hierarchical

    rows = spark.createDataFrame([(i, ["a", "b", None][i % 3], i % 2) for i in range(60)], "id long, part string, side int")
    seg = hierarchical(rows, "part", lambda branch: Segmentation(
        "parity", branch.select("id", F.col("side").alias("cluster")), [], None))
    got = rows.join(seg.labels, "id").groupBy("part").agg(F.countDistinct("cluster").alias("n"), F.count("*").alias("rows")).collect()
    assert {(r["part"], r["n"], r["rows"]) for r in got} == {("a", 2, 20), ("b", 2, 20), (None, 2, 20)}
    assert seg.labels.select("cluster").distinct().count() == 6


def test_distances_survive_a_large_offset():
    from panelcraft.operators.centres import Centres

    shift = 1.7e9
    centres = Centres(numeric=np.array([[0.0], [10.0], [20.0]]) + shift, modes=np.zeros((3, 0), int), gamma=0.0)
    x = np.array([[0.5], [9.0], [21.0]]) + shift
    assert np.allclose(centres.distances(x, np.zeros((3, 0), int)).min(axis=1), [0.25, 1.0, 1.0])


def test_a_segment_without_findings_is_its_own_slice(spark):
    from panelcraft.operators.metrics import core_slices

    rows = spark.createDataFrame([(i, "ab"[i % 2], "x" if i % 4 else "y") for i in range(40)], "id long, cluster string, q_tgt string")
    got = {r["cluster"]: r for r in core_slices(rows, {"a": [("q_tgt", "x")]}).collect()}
    assert (got["b"]["core"], got["b"]["n_slice"], got["b"]["n_slice_in"]) == ([], 20, 20)
    assert got["b"]["retained"] <= 0.15


def test_starts_come_from_all_rows(spark):
    """A far cluster of 30 among 30,000 rows is a start, however few of the smallest key hashes it holds."""
    df = spark.range(30_000).select("id", F.when(F.col("id") % 1000 == 7, 1e4).otherwise(F.col("id") % 10).cast("double").alias("x"))
    layout = ce.Layout(["x"], [])
    pool = ce.start_pool(df, layout, "id")
    assert pool.weight.sum() == 30_000 and 1e4 in pool.rows
    assert pool.tolerance == pytest.approx(ce.TOLERANCE * df.agg(F.var_pop("x")).first()[0], rel=1e-6)
    assert all(1e4 in ce.spread_starts(pool, layout, 2, seed).numeric for seed in range(5))
    again = ce.start_pool(df.repartition(7), layout, "id")
    assert (again.rows == pool.rows).all() and (again.weight == pool.weight).all()
    few = ce.start_pool(df.withColumn("x", F.lit(2.0)), layout, "id", least=5)
    assert len(few) == 1 and ce.start_pool(df.limit(0), layout, "id").rows.shape == (0, 1)


def test_missing_numbers_are_refused(spark):
    df = spark.createDataFrame([(i, None if i == 3 else float(i), float(i % 4)) for i in range(20)], "id long, a double, b double")
    for work in (lambda: sg.kmeans(df, ["a", "b"], k=2, seeds=[1]), lambda: gram(df, ["a", "b"]),
                 lambda: gr.nearest(df, 2, numeric=["a", "b"])):
        with pytest.raises(ValueError, match=r"Missing values.*a \(1 rows\)"):
            work()
