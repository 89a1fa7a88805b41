"""Searches in one pass, alone and inside branches: equal to plain fits, to each other, and at any number of parts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcraft.operators import centres as ce, joint_fit as joint, latent as la, mixture as mi, quality as ql, search as se, segment as sg


@pytest.fixture(scope="module")
def people(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(1200):
        t = i % 3
        branch = ["a", "a", "a", "b", None, "tiny"][min(i // 220, 5)] if i < 1195 else "tiny"
        rows.append((i, branch, float(rng.normal(6 * t, 1)), float(rng.normal(-4 * t, 1)), float(rng.normal(0, 1)),
                     *[int(t if rng.random() < 0.9 else rng.integers(0, 3)) for _ in range(5)]))
    return spark.createDataFrame(rows, "id long, branch string, x double, y double, z double, "
                                       + ", ".join(f"q{i} int" for i in range(5))).repartition(5, "id").persist()


NUM, COD = ["x", "y", "z"], [f"q{i}" for i in range(5)]


def truth(df):
    return df.withColumn("truth", F.col("id") % 3)


def ari(labels, df):
    return ql.adjusted_rand(labels.join(truth(df), "id"), "cluster", "truth").first()[0]


def test_ranks_and_choices_are_those_of_the_tables(spark):
    rng = np.random.default_rng(2)
    runs = [{"run": f"r{i}", "n_clusters": 3 + i, "silhouette": float(rng.integers(0, 3)) if i != 2 else None, "cost": float(100 / (i + 1)),
             "davies_bouldin": float(rng.integers(0, 3)), "calinski_harabasz": float(rng.integers(0, 3)), "bic": float(rng.integers(0, 4)),
             "aic": float(i), "cluster_proportions": {"0": 0.4, "1": 0.6 - 0.12 * (i % 2), "2": 0.12 * (i % 2)}} for i in range(6)]
    frame = sg._run_frame(spark, runs)
    for criteria in (False, True):
        want = {r["run"]: r["rank_sum"] for r in ql.rank_runs(frame, criteria).collect()}
        assert dict(zip([r["run"] for r in runs], se.rank_sums(runs, criteria))) == pytest.approx(want)
        assert se.choose_run(runs, criteria)["run"] == sg.choose_run(spark, runs, criteria)
    assert se.choose_k(runs) == sg.choose_k(spark, runs)


def test_all_methods_in_one_pass_find_the_groups(spark, people):
    methods = {"kmeans": se.k_means(NUM, seeds=[1, 2], k_max=6), "family": se.k_family([], COD, seeds=[1, 2], k_max=5),
               "proto": se.k_family(["x", "y"], COD, seeds=[1, 2], k_max=5), "lca": se.ClassSearch(COD, ks=[2, 3, 4], restarts=4),
               "mixed": se.ClassSearch(COD, ["x", "y"], ks=[2, 3], restarts=3), "mixture": se.MixtureSearch(["x", "y"], [1, 2], k_max=5)}
    together = sg.search_all(people, methods)
    assert {n: ari(s.labels, people) > 0.85 for n, s in together.items()} == dict.fromkeys(methods, True)
    assert all(r["settled"] for n in ("lca", "mixed") for r in together[n].runs)
    alone = sg.search_all(people, {"kmeans": se.k_means(NUM, seeds=[1, 2], k_max=6)})["kmeans"]
    assert alone.cost == pytest.approx(together["kmeans"].cost) and alone.seed == together["kmeans"].seed
    assert sg.consistency(people.drop("branch"), together["mixture"])["model_consistency"] > 0.9


def test_scores_of_a_search_are_those_of_the_labelling(spark, people):
    found = sg.search_all(people, {"f": se.CentreSearch(["x", "y"], (), seeds=[1], k=3)})["f"]
    want = ql.score_labellings(people.join(found.labels, "id"), ["x", "y"], ["cluster"])[0]
    got = found.runs[0]
    for name in ("silhouette", "davies_bouldin", "calinski_harabasz"):
        assert got[name] == pytest.approx(want[name], rel=1e-9)
    x = np.array([list(r) for r in people.join(found.labels, "id").select("x", "y", "cluster").collect()])
    cost = sum(((x[x[:, 2] == k, :2] - x[x[:, 2] == k, :2].mean(0)) ** 2).sum() for k in range(3))
    assert found.cost == pytest.approx(cost, rel=1e-3) and found.cost >= cost - 1e-6


def test_extrapolated_steps_reach_what_plain_ones_reach(spark, people):
    rows = ce.patterns(people, COD)
    fast = se.ClassSearch(COD, ks=[3, 4], restarts=6)
    joint.fit_together(rows, {"f": fast}, "id", "copies")
    plain = la.fit_classes(rows, COD, [], {i: la.random_classes([3] * 5, k, 1000 * k + s, np.zeros(0), np.zeros(0))
                                           for i, (k, s) in enumerate((k, s) for k in (3, 4) for s in range(6))}, 300)
    best = {k: max(c.log_likelihood for c in plain.values() if c.k == k) for k in (3, 4)}
    mine = {k: max(r["log_likelihood"] for r in fast.runs if r["n_clusters"] == k) for k in (3, 4)}
    assert all(mine[k] >= best[k] - 1e-4 * abs(best[k]) for k in best) and all(r["settled"] for r in fast.runs)
    assert fast.model.log_likelihood == pytest.approx(la.em_step(rows, COD, [], {0: fast.model}, True)[0].log_likelihood, abs=1e-6)
    lasts = []
    one, x = se.ClassSearch(COD, ks=[4], restarts=1), np.array([list(r) for r in people.select(*COD).collect()], float)
    while not one.done:
        one.update(one.expect(x, np.ones(len(x)), np.arange(len(x))))
        if one.phase == "climb" and one.live and "ll" in one.live[4] and one.step % 3 == 2:
            lasts.append(one.live[4]["ll"][0])
    assert all(b >= a - 1e-9 for a, b in zip(lasts, lasts[1:]))


def test_packed_mixture_is_the_plain_one(people):
    x = np.array([list(r) for r in people.select("x", "y", "z").collect()])
    own = se.MixtureSearch(["x", "y", "z"], [1], 3, 4)
    while not own.done:
        own.update(own.expect(x, np.ones(len(x)), np.arange(len(x))))
    joint_plain = own.model.joint(x)
    assert own._packed(x) @ own.coefficients["best"] == pytest.approx(joint_plain, abs=1e-8)
    assert (own.label(x) == joint_plain.argmax(1)).all()


def test_rejected_mixtures_say_why(spark):
    rng = np.random.default_rng(1)
    rows = [(i, float(rng.normal() + (50 if i < 3 else 0)), float(rng.normal())) for i in range(600)]
    found = sg.gaussian_mixture(spark.createDataFrame(rows, "id long, x double, y double"), ["x", "y"], seeds=[1, 42], k_max=5)
    assert len(found.runs) == 4 and any(r["reason"] and "%" in r["reason"] for r in found.runs)


def test_branches_equal_fits_of_their_own_rows(spark, people, monkeypatch):
    def searches():
        return {"kmeans": se.k_means(NUM, seeds=[1, 2], k_min=2, k_max=4), "lca": se.ClassSearch(COD, ks=[2, 3], restarts=2)}

    whole = joint.fit_branches(people, "branch", searches)
    assert whole.rounds <= 400
    labels = {n: whole.labels(n).toPandas().set_index("id")["cluster"] for n in searches()}
    assert all(len(x) == 1200 and x.index.is_unique for x in labels.values())
    for value in ("a", "b", None):
        own = people.where(F.col("branch").eqNullSafe(F.lit(value)))
        for name, s in joint.fit_together(own, searches()).items():
            alone = sg._labelled(own, s, "id", "cluster").toPandas().set_index("id")["cluster"] if s.model else None
            mine = labels[name].loc[[r[0] for r in own.select("id").collect()]]
            if alone is None:
                assert mine.nunique() == 1
            else:
                assert ql_same(alone, mine)
    about = {(r["b"], r["method"]): r["n_clusters"] for r in whole.summaries().collect()}
    assert about[("=tiny", "lca")] is not None and len(about) == 8
    tops = [labels["kmeans"].loc[[r[0] for r in people.where(F.col("branch").eqNullSafe(F.lit(v))).select("id").collect()]]
            for v in (None, "a", "b", "tiny")]
    assert tops[0].min() == 0 and all(a.max() + 1 == b.min() for a, b in zip(tops, tops[1:]))
    skipped = whole.labels("kmeans", ["a", None]).toPandas().set_index("id")["cluster"]
    assert (skipped == -99).sum() == people.where("branch = 'a' OR branch IS NULL").count() and skipped[skipped >= 0].min() == 0


def ql_same(a, b):
    """Equal partitions."""
    return len(set(zip(a.sort_index(), b.sort_index()))) == a.nunique() == b.nunique()


def test_no_branches_and_no_rows(spark, people):
    none = joint.fit_branches(people.limit(0), "branch", lambda: {"kmeans": se.k_means(NUM)})
    assert none.labels("kmeans").count() == 0
    assert joint.fit_together(people.limit(0), {"k": se.k_means(NUM)})["k"].note == "No rows"


def test_unsettled_latent_classes_say_so(spark):
    rows = spark.createDataFrame([(i, i % 2, i % 3, i * 7 % 5) for i in range(60)], "id long, a int, b int, c int")
    short = sg.latent_classes(rows, ["a", "b", "c"], ks=[2], restarts=1, max_passes=1)
    assert not short.model.settled and "Stopped" in short.note
    whole = sg.latent_classes(rows, ["a", "b", "c"], ks=[1], restarts=1)
    assert whole.model.settled and whole.note is None


def test_missing_values_are_refused_or_reported(spark, people):
    holed = people.withColumn("x", F.when(F.col("id") > 3, F.col("x")))
    with pytest.raises(ValueError, match="x"):
        sg.kmeans_pca(holed, NUM)
    both = sg.search_all(holed, {"bad": se.k_means(NUM), "good": se.k_means(["y", "z"], seeds=[1], k=3)}, go_on=True)
    assert both["bad"].labels is None and "x" in both["bad"].note and both["good"].model is not None


def test_equal_rows_are_counted_once(spark, monkeypatch):
    """Steps that need no key hash read one row for each different one, and find the same."""
    rng = np.random.default_rng(4)
    x = np.column_stack([rng.integers(0, 3, 4000), rng.integers(0, 2, 4000), rng.integers(0, 6, 4000)])
    x[:2000, 2] += 20
    df = spark.createDataFrame([(i, *map(int, r)) for i, r in enumerate(x)], "id long, a int, b int, n int")
    made = lambda: {"lca": se.ClassSearch(["a", "b"], ["n"], [2], 2), "family": se.k_family(["n"], ["a", "b"], k_max=5),
                    "mixture": se.MixtureSearch(["a", "n"], [1], 2, 3, any_balance=True)}
    seen, held = [], joint._pass
    monkeypatch.setattr(joint, "_pass", lambda rows, both, names, *a: seen.append(
        (rows.count(), [both.searches[n].phase for n in names])) or held(rows, both, names, *a))
    merged = joint.fit_together(df, made())
    assert all(n <= 72 for n, phases in seen if "draw" not in phases) and any(n == 4000 for n, _ in seen)
    monkeypatch.setattr(joint, "MERGED_FROM", 1e9)
    plain = joint.fit_together(df, made())
    for name in merged:
        assert (merged[name].label(x[:, [["a", "b", "n"].index(c) for c in merged[name].columns]].astype(float))
                == plain[name].label(x[:, [["a", "b", "n"].index(c) for c in plain[name].columns]].astype(float))).all()
        assert merged[name].n == plain[name].n == 4000


def test_searches_that_ask_alike_are_answered_once(monkeypatch):
    """The draws of runs that differ in k alone are taken of the rows once."""
    asked, draw = [], se.CentreSearch._sum_draw
    monkeypatch.setattr(se.CentreSearch, "_sum_draw", lambda self, v, w, h: asked.append(self.phase) or draw(self, v, w, h))
    rng = np.random.default_rng(5)
    v, h = rng.normal(size=(500, 3)), rng.integers(-2 ** 60, 2 ** 60, 500)

    def run(ks):
        both = joint.Together({f"k{k}": se.CentreSearch(["a", "b", "c"], (), 0.9, seeds=[42], k=k, any_balance=True) for k in ks})
        while not both.done:
            both.update(both.expect(v, np.ones(500), h))
        return both.searches

    alone = run([3]) | run([4])
    n, asked[:] = len(asked), []
    together = run([3, 4])
    assert len(asked) == n // 2
    for name in alone:
        assert (alone[name].label(v) == together[name].label(v)).all() and alone[name].cost == together[name].cost
