import json

from panelcraft.operators import cleaning
from panelcraft.plans import segmentation
from panelcraft.plans.responses import responses
from panelcraft.sources import files, ledger
from panelcraft.streaming.ledger_stream import run_arrivals


def test_names_and_config_round_trip(spark, tmp_path):
    files.write_names(spark, ["a", "b"], str(tmp_path / "names"))
    assert files.read_names(spark, str(tmp_path / "names")) == ["a", "b"]
    config = {"project_name": "p", "weighting": {"perform": True, "utility": {"pre_completes": True, "post_completes": False}}}
    (tmp_path / "c.json").write_text(json.dumps(config, indent=2))
    assert files.read_config(spark, str(tmp_path / "c.json"))["weighting"]["utility"]["pre_completes"] is True
    (tmp_path / "m.csv").write_text("ID,Group\n1,x\n")
    manual = cleaning.manual_label_names(files.read_manual_labels(spark, str(tmp_path / "m.csv"), ["ID", "Group"]))
    assert [tuple(r) for r in manual.collect()] == [("1", "x")] and manual.columns == ["id", "qudo_group"]


def _ledger(spark):
    return spark.createDataFrame([("a", ["segments"]), ("b", []), ("c", ["other"])], "survey string, processed_by array<string>")


def test_ledger_runs_pending_and_survives_faults(spark):
    def work(name):
        if name == "c":
            raise RuntimeError("broken")
        return "fine"

    marked, log = ledger.run_pending(_ledger(spark), "segments", work)
    assert sorted((r["survey"], r["outcome"]) for r in log.collect()) == [("b", "done"), ("c", "failed")]
    assert [r["survey"] for r in ledger.pending(marked, "segments").collect()] == ["c"]


def test_ledger_stream_runs_each_survey_once(spark, tmp_path):
    inbox, seen = tmp_path / "in", []
    inbox.mkdir()
    for i, name in enumerate(["x", "y"]):
        (inbox / f"{i}.json").write_text(json.dumps({"survey": name, "processed_by": []}))
        run_arrivals(spark, str(inbox), str(tmp_path / "out"), str(tmp_path / "ck"), "segments", lambda s: seen.append(s) or "ok")
    assert seen == ["x", "y"]


def test_whole_survey_job(spark, tmp_path):
    people = responses(spark, "/root/testdata/sf0.001").drop("cluster", "weight")
    base = segmentation.segment_survey(spark, people, str(tmp_path), "demo", columns=["sbeh", "psy"], seeds=[1, 42], k_max=5)
    labels = spark.read.parquet(f"{base}/labels")
    assert labels.count() == people.count() and labels.select("id").distinct().count() == people.count()
    metrics = spark.read.parquet(f"{base}/metrics_long")
    assert metrics.select("metric").distinct().count() > 31
    assert spark.read.csv(f"{base}/metrics", header=True, escape='"').count() == 1
    assert spark.read.parquet(f"{base}/deliver").count() > 0
    assert files.read_names(spark, f"{base}/columns")[0].startswith("sbeh")
