"""Stages and their state, logs that are written anew, exports and layouts."""

import json
import threading

import pytest
from pyspark.sql import functions as F

from quire.cli import main
from quire.plans import corpus_run
from quire.sources import files, sinks, synthetic


def test_run_and_status(spark, tmp_path, capsys):
    forms = synthetic.forms(spark, {k: (6, 3) for k in synthetic.FORMS})
    forms.withColumn("source", F.concat(F.lit("vrdu_"), "source")).write.parquet(f"{tmp_path}/a")
    forms.union(forms).withColumn("source", F.lit("funsd")).write.parquet(f"{tmp_path}/b")
    out = f"{tmp_path}/out"
    assert main(["status", "--out", out], spark) == 0
    assert [json.loads(x)["status"] for x in capsys.readouterr().out.split("\n") if x] == ["pending"] * 5
    assert main(["run", "--all", "--part", f"{tmp_path}/a", "--part", f"{tmp_path}/none", "--part", f"{tmp_path}/b", "--out", out], spark) == 0
    said = capsys.readouterr().out
    assert "FAILED" in said and "generate: done" in said
    state = {s["stage"]: s["status"] for s in corpus_run.status(spark, out)}
    assert state == {"ingest": "complete", "order": "complete", "consolidate": "pending", "generate": "complete", "test": "complete"}
    master = spark.read.parquet(f"{out}/master")
    assert master.count() == spark.read.json(f"{out}/documents").count() > spark.read.parquet(f"{out}/ordered").count()
    assert main(["run", "--stage", "test", "--out", out], spark) == 0


@pytest.mark.parametrize("argv", [["run", "--out", "x"], ["run", "--stage", "order", "--out", "x"], ["run", "--stage", "generate", "--out", "x"]])
def test_dependent_stages_do_not_run_alone(spark, argv):
    with pytest.raises(SystemExit):
        main(argv, spark)


def test_marks_of_two_writers_survive(spark, tmp_path):
    path = f"{tmp_path}/state/state.json"
    threads = [threading.Thread(target=lambda k=k: [sinks.mark_stage(spark, path, f"{k}-{i}") for i in range(6)]) for k in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert set(sinks.stage_state(spark, path)) == {f"{k}-{i}" for k in range(4) for i in range(6)} and sinks.latest(spark, path)[0] == 24
    assert not sinks.put_new(spark, f"{path}.v3", "x") and sinks.get_text(spark, f"{path}.v3") != "x"


def test_a_failed_log_leaves_the_old_one(spark, tmp_path):
    path = f"{tmp_path}/run"
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "doc_id string, n int")
    sinks.write_run_log(rows, path)
    with pytest.raises(Exception, match="broken"):
        sinks.write_run_log(rows.withColumn("n", F.raise_error(F.lit("broken")).cast("int")), path)
    assert {r.doc_id: r.n for r in files.run_log(spark, path).collect()} == {"a": 1, "b": 2}
    sinks.write_run_log(files.run_log(spark, path).withColumn("n", F.col("n") + 1), path)
    assert {r.doc_id: r.n for r in files.run_log(spark, path).collect()} == {"a": 2, "b": 3} and len(list(tmp_path.iterdir())) >= 1


def test_exports_count_their_field_files(spark):
    docs = spark.createDataFrame([("s", "a/b", "val"), ("s", "c", "val"), ("s", "d", "train"), ("t", "c", "val")], "source string, doc_id string, split string")
    there = spark.createDataFrame([("/x/s_a_b.json",), ("/x/y/s_c.json",), ("/x/s_c.json",), ("s_d.json",)], "path string")
    assert sorted((r.source, r.doc_id) for r in corpus_run.export_rows(docs, "val", there).collect()) == [("s", "a/b"), ("s", "c")]


def test_layouts_take_values_or_none(spark):
    layout = spark.createDataFrame([("1", "a"), ("1", "b"), ("2", "a"), ("2", "a")], "doc_id string, field_id string")
    truth = spark.createDataFrame([("1", "a", "x"), ("2", "z", "y"), ("1", "b", None)], "doc_id string, field_id string, value string")
    assert sorted(tuple(r) for r in corpus_run.layout_values(layout, truth).collect()) == [("1", "a", "x"), ("1", "b", ""), ("2", "a", ""), ("2", "a", "")]
