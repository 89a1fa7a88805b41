import math

import pytest
from pyspark.sql import functions as F

from panelcraft.functions.special import chi2_upper_tail, erfc
from panelcraft.operators import cleaning, crosstab as ct, deliver as dv, lookups, metrics as mx
from panelcraft.plans import segmentation
from panelcraft.roles import (ColumnRoles, choose_family, columns_with_fragments, given_segment_columns, study_columns,
                              weight_column)


def expand(spark, cells, question="q_1001_tgt"):
    rows, i = [], 0
    for answer, cluster, n in cells:
        for _ in range(n):
            rows.append((i, cluster, answer))
            i += 1
    return spark.createDataFrame(rows, f"id long, cluster string, {question} string")


def infer_on(df, **kw):
    return dv.infer(df, ColumnRoles.of(df), **kw)


def test_erfc_and_tails(spark):
    row = spark.range(1).select(*[erfc(F.lit(z)).alias(f"z{i}") for i, z in enumerate((0.0, 0.3, 1.0, 2.5, 4.0, 7.0))]).first()
    for got, z in zip(row, (0.0, 0.3, 1.0, 2.5, 4.0, 7.0)):
        assert got == pytest.approx(math.erfc(z), abs=1e-13)
    cases = [(5.4, 1, math.erfc(math.sqrt(2.7))), (3.0, 2, math.exp(-1.5)), (7.81472790325118, 3, 0.05), (11.0704976935164, 5, 0.05),
             (15.5073130558655, 8, 0.05), (0.0, 0, 1.0), (3000.0, 4, 0.0),
             (1600.0, 1600, 0.49529838757844), (67.5048065495412, 50, 0.05), (2000.0, 2000, 0.49579475581993)]
    df = spark.createDataFrame([(x, d) for x, d, _ in cases], "x double, d int")
    for r, (_, _, want) in zip(df.select(chi2_upper_tail(F.col("x"), F.col("d")).alias("p")).collect(), cases):
        assert r["p"] == pytest.approx(want, abs=1e-9)


def test_continuity_correction(spark):
    df = expand(spark, [("a", "0", 10), ("a", "1", 20), ("b", "0", 20), ("b", "1", 10)])
    r = infer_on(df).tests.first()
    assert (r["dof"], round(r["stat"], 6)) == (1, 5.4)


def test_sparse_answer_is_dropped_and_one_answer_left_is_kept(spark):
    df = expand(spark, [("a", "0", 10), ("a", "1", 10), ("a", "2", 10), ("b", "0", 4), ("b", "1", 20), ("b", "2", 9)])
    r = infer_on(df).tests.collect()
    assert [(x["dof"], x["stat"], x["p"]) for x in r] == [(0, 0.0, 1.0)]
    gone = expand(spark, [("a", "0", 3), ("a", "1", 10)])
    assert infer_on(gone).tests.count() == 0


def test_not_shown_only_touches_its_question(spark):
    df = spark.createDataFrame([(i, str(i % 2), "Not shown" if i < 4 else "x", "y") for i in range(24)],
                               "id long, cluster string, q_a string, q_b string")
    counts = ct.answer_counts(df, ColumnRoles.of(df))
    used = {(r["q_code"], r["answer"]): r["row_total"] for r in ct.usable_crosstab(counts).collect()}
    assert used == {("q_a", "x"): 20, ("q_b", "y"): 24}


def test_tied_mode_takes_smallest_and_weights_decide(spark):
    df = spark.createDataFrame([(1, "0", "b", 1.0), (2, "0", "a", 1.0), (3, "0", "b", 1.0), (4, "0", "a", 5.0)],
                               "id long, cluster string, q_x string, weight double")
    counts = ct.answer_counts(df, ColumnRoles("id", "weight", ["q_x"]))
    assert ct.modes(counts).first()["mode"] == "a"
    r = ct.weighted_modes(counts).first()
    assert (r["weighted_mode"], r["weighted_mode_perc"]) == ("a", 75.0)


def test_not_selected_leaves_arrays_together(spark):
    df = expand(spark, [("not selected", "0", 60), ("not selected", "1", 10), ("x", "0", 10), ("x", "1", 60)])
    rows = {r["targeting_seg"]: r for r in infer_on(df).deliver.collect()}
    assert list(rows) == ["1"] and rows["1"]["sig_more_category"] == ["x"] and len(rows["1"]["category_percentages"]) == 1


def test_hot_answer_and_repartition_change_nothing(spark):
    df = expand(spark, [("a", "0", 500), ("a", "1", 30), ("b", "0", 40), ("b", "1", 70), ("c", "0", 9), ("c", "1", 8)])
    one = infer_on(df).tests.first()["stat"]
    assert infer_on(df.repartition(13)).tests.first()["stat"] == pytest.approx(one, rel=1e-12)


def test_missing_counts_as_not_selected_but_not_as_answered(spark):
    df = spark.createDataFrame([(1, "0", None), (2, "0", "x"), (3, "0", "None"), (4, "0", "x")], "id long, cluster string, q string")
    counts = ct.answer_counts(df, ColumnRoles.of(df))
    assert {r["answer"]: r["n"] for r in counts.collect()} == {"not selected": 2, "x": 2}
    assert ct.response_rates(counts).first()["response_rate"] == 50.0


def test_label_codes_by_ranges_match_window(spark):
    df = spark.createDataFrame([(f"v{i % 50:02d}", f"w{i % 7}") for i in range(300)], "a string, b string")
    key = lambda d: sorted((r["q_code"], r["answer"], r["code"]) for r in d.collect())
    assert key(cleaning.label_codes(df, ["a", "b"])) == key(cleaning.label_codes(df, ["a", "b"], window_limit=3))


def test_encode_literal_and_join_agree(spark):
    df = spark.createDataFrame([(i, f"v{i % 5}", None if i % 3 else "z") for i in range(20)], "id long, a string, b string")
    few = sorted(map(tuple, cleaning.encode(df, ["a", "b"]).collect()))
    assert few == sorted(map(tuple, cleaning.encode(df, ["a", "b"], literal_levels=0).select("id", "a", "b").collect()))
    assert few[0] == (0, 0, 1) and few[1] == (1, 1, 0)


def test_decode_by_literal_and_by_join_agree(spark):
    df = spark.createDataFrame([(1, "1", "x"), (2, "2", "y"), (3, None, "z")], "id long, q string, r string")
    book = spark.createDataFrame([("q", "one", "1"), ("q", "2", "2"), ("r", "why", "y")], "varname string, option_text string, option_value string")
    a = sorted(map(tuple, lookups.decode_answers(df, book, ["q", "r"]).select("id", "q", "r").collect()))
    b = sorted(map(tuple, lookups.decode_answers(df, book, ["q", "r"], literal_entries=0).select("id", "q", "r").collect()))
    assert a == b == [(1, "one", "x"), (2, "2", "why"), (3, None, "z")]


@pytest.mark.parametrize("entries", [0, 6, 2500])
def test_survey_is_decoded_with_a_book_of_any_size(spark, entries):
    df = spark.createDataFrame([(1, "3", 5, "p"), (1, "2499", 6, "q"), (2, None, 5, "r")], "id long, q string, n long, cint_id string")
    rows = [("q", f"text {i}", str(i)) for i in range(entries)] + [("q", "text 3 again", "3"), ("n", "five", "5")][:entries]
    book = spark.createDataFrame(rows, "varname string, option_text string, option_value string")
    got = sorted(map(tuple, segmentation.prepare(df, book).select("id", "q", "n", "cint_id").collect()), key=str)
    far = "text 2499" if entries == 2500 else "2499"
    few, five = ("text 3 again", "five") if entries else ("3", "5")
    plain = [(i, q, str(n), c) for i, q, n, c in got]
    assert plain[:2] == [(1, far, "6", "q"), (1, few, five, "p")] and plain[2][0] == 2 and plain[2][2] == five


def test_names(spark):
    df = spark.createDataFrame([("1",) * 4], ["sbeh_a_fb", "dem_b_gg", "qudo_x", "age_numeric"])
    marked, chosen = cleaning.mark_targets(df, ["sbeh_a_fb"])
    assert marked.columns == ["sbeh_a_fb_tgt", "dem_b_gg_tgt", "qudo_x", "age_numeric"] and chosen == ["sbeh_a_fb_tgt"]
    assert cleaning.mark_targets(df, ["x_tgt"])[0].columns == df.columns
    assert cleaning.strip_numeric_mark(df).columns[-1] == "age"
    assert columns_with_fragments(df, ["DEM", "sbeh"]) == ["dem_b_gg", "sbeh_a_fb"]
    assert given_segment_columns(df) == ["qudo_x"] and study_columns(df) == ["sbeh_a_fb"]
    with pytest.raises(ValueError, match="No SBEH columns present."):
        study_columns(df.select("qudo_x"))
    manual = spark.createDataFrame([("1", "2", "3", "4")], ["ID", "VRID", "Cint_Id", "Group"])
    assert cleaning.manual_label_names(manual).columns == ["id", "vrid", "cint_id", "qudo_group"]
    twice = df.select("qudo_x", F.col("dem_b_gg").alias("qudo_x"))
    assert cleaning.drop_repeated_names(twice).columns == ["qudo_x"]
    assert choose_family(df, ["qudo_x"]) == "kmodes"


@pytest.mark.parametrize("pre, post, columns, want", [
    (False, False, ["weight"], None), (True, True, ["weight"], "weight"), (True, False, ["precompletion_weight"], "precompletion_weight"),
    (True, False, ["x"], None), (False, True, ["weight"], "weight")])
def test_weight_column(spark, pre, post, columns, want):
    df = spark.createDataFrame([(1.0,) * len(columns)], columns)
    assert weight_column(df, {"weighting": {"utility": {"pre_completes": pre, "post_completes": post}}}) == want


def test_question_codes():
    assert mx.question_codes(["sbeh_1234_a_tgt", "sbeh_1234_b_tgt", "x_99999_tgt"]) == ["1234", "99999"]
    assert mx.question_codes(["sbeh_brandaware_a_tgt", "sbeh_brandaware_b_tgt"]) == ["brandaware"]


def test_variability_by_hand(spark):
    block = [(1, 1, 0), (1, 1, 0), (1, 0, 0), (1, 1, 1), (0, 1, 0), (1, 0, 0)]
    df = spark.createDataFrame([(i, "0", *b) for i, b in enumerate(block)], "id long, cluster string, a_1000_tgt int, b_1000_tgt int, c_1000_tgt int")
    c, r = [sum(x) for x in zip(*block)], [sum(b) for b in block]
    q = 2 * (3 * sum(v * v for v in c) - sum(c) ** 2) / (3 * sum(c) - sum(v * v for v in r))
    got = {x["cluster"]: x["variability"] for x in mx.variability(df).collect()}
    assert got["0"] == got["all_clusters"] == round(round((q - 2) / q * 100, 3), 3)


def test_slicer_matches_plain_walk(spark):
    import random
    rng = random.Random(3)
    rows = [(i, rng.choice("01"), *[rng.choice("aab") for _ in range(9)]) for i in range(400)]
    cols = [f"q{j}_tgt" for j in range(9)]
    df = spark.createDataFrame(rows, "id long, cluster string, " + ", ".join(f"{c} string" for c in cols))
    pairs = {s: [(c, "a") for c in cols] for s in "01"}
    got = {r["cluster"]: r for r in mx.core_slices(df, pairs).collect()}
    for s in "01":
        data = [dict(zip(cols, r[2:])) for r in rows if r[1] == s]
        share, core = 0.25, []
        least = share * len(data)
        while len(core) < 6 and share >= 0.15:
            core = []
            for c in cols:
                kept = [d for d in data if d[c] == "a"]
                if len(kept) >= least:
                    data = kept
                    core.append(c)
            share -= 0.01
            least = share * len(data)
        assert (got[s]["core"], got[s]["n_slice"], got[s]["retained"]) == (core, len(data), round(share, 6))


def test_no_channel_question_means_no_presence(spark):
    df = spark.createDataFrame([(1, "0", "Google")], "id long, cluster string, mc_1 string")
    assert mx.social_presence(df, ["mc_1"]) is None and mx.message_reach(None, df) is None
