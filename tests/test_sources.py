"""Log folders, rubric folders, join errors, generation resume."""

import json
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from evalframe.operators import generate as G
from evalframe.operators import samples as SM
from evalframe.sources import logs as LG


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)


def test_list_and_read_logs(spark, tmp_path):
    a, b = tmp_path / "src_logs", tmp_path / "logs"
    a.mkdir(), b.mkdir()
    _write(a / "run1.json", json.dumps({"status": "success", "results": {"accuracy": 0.5}}))
    _write(b / "run1.json", json.dumps({"status": "other"}))
    _write(b / "run2.json", "{not json")
    _write(b / "run3.eval", "binary decoy")
    os.utime(b / "run1.json", (1_700_000_000, 1_700_000_000))
    listed = LG.list_eval_logs(spark, [str(a), str(b)]).collect()
    assert [r["name"] for r in listed] == ["run1.json", "run2.json", "run1.json"]
    assert [r["dir_rank"] for r in listed] == [0, 1, 1]
    logs = {r["name"]: r for r in LG.read_eval_logs(spark, [str(a), str(b)]).collect()}
    assert set(logs) == {"run1.json", "run2.json"}
    assert logs["run1.json"]["dir_rank"] == 0 and logs["run1.json"]["is_valid"]
    assert not logs["run2.json"]["is_valid"]


NAMES = ["2024-05-29T12-38-43+00-00_math_X.json", "a b.json", "pct%20x.json", "pct%2Bx.json", "caf\u00e9.json"]


def test_log_names_are_kept_whatever_they_hold(spark, tmp_path):
    a, b = tmp_path / "logs a+b", tmp_path / "second"
    a.mkdir(), b.mkdir(), (a / "inner").mkdir()
    for i, n in enumerate(NAMES):
        _write(a / n, json.dumps({"i": i}))
        _write(b / n, json.dumps({"i": -1}))
    _write(a / "inner" / "nested.json", "{}")
    dirs = [str(tmp_path / "absent"), str(a), str(b)]
    assert sorted(r["name"] for r in LG.list_eval_logs(spark, dirs).collect()) == sorted(NAMES * 2)
    got = LG.read_eval_logs(spark, dirs).select("name", "dir_rank", F.try_variant_get("doc", "$.i", "int").alias("i")).collect()
    assert sorted((r["name"], r["dir_rank"], r["i"]) for r in got) == sorted((n, 1, i) for i, n in enumerate(NAMES))
    assert LG.list_eval_logs(spark, dirs[:1]).count() == 0 and LG.read_eval_logs(spark, dirs[:1]).count() == 0
    assert "inner" not in str(got) and LG.list_eval_logs(spark, [str(a)], nested=True).count() == len(NAMES) + 1


def test_a_dataset_written_twice_is_there_once(spark, tmp_path):
    from evalframe.sources import datasets as DS
    df = spark.createDataFrame([(1, "test"), (2, "test"), (3, "dev")], "sample_id long, split string")
    for part in (df, df, df.filter("split = 'dev'")):
        DS.write_eval_dataset(part, str(tmp_path / "d"), "q")
    assert DS.scan_eval_dataset(spark, str(tmp_path / "d"), "q").count() == 2 and DS.scan_eval_dataset(spark, str(tmp_path / "d"), "q", "dev").count() == 1


def test_generation_shows_prompts_keeps_tasks_apart_and_refuses_repeated_keys(spark, tmp_path):
    seen_columns = str(tmp_path / "columns")

    def model(pdf):
        with open(seen_columns, "w") as f:
            f.write(",".join(pdf.columns))
        return [f"{s}|{p}" for s, p in zip(pdf["system_prompt"], pdf["prompt"])]

    work = spark.createDataFrame([("t1", "m", 1, 1, "sys", "q1"), ("t2", "m", 1, 1, "sys2", "q2"), ("t2", "m", None, 1, "sys2", "q3")],
                                 "task string, model string, sample_id long, epoch int, system_prompt string, prompt string")
    out = G.generate_completions(work, model, temperature=0.5)
    assert sorted(r.completion for r in out.collect()) == ["sys2|q2", "sys2|q3", "sys|q1"]
    assert open(seen_columns).read().split(",") == ["task", "model", "sample_id", "epoch", "system_prompt", "prompt", "temperature"]
    left = G.generate_completions(work, model, done=out.filter("task = 't1'")).collect()
    assert sorted((r.task, r.sample_id is None) for r in left) == [("t2", False), ("t2", True)]
    with pytest.raises(Exception, match="key twice"):
        G.generate_completions(work.unionByName(work), model).collect()
    path = str(tmp_path / "slices")
    done = G.run_in_slices(work, lambda part: G.generate_completions(part, model, max_connections=2), path, slices=3)
    assert done.count() == 3
    graders = work.withColumn("judge_model", F.lit("j"))
    assert G.generate_judgements(graders, model).count() == 3
    with pytest.raises(ValueError, match="names its graders"):
        G.generate_judgements(graders, model, ["a"])


def test_scan_rubrics_flat_folder(spark, tmp_path):
    _write(tmp_path / "amf_configuration.txt", "AMF rubric {sbi}")
    _write(tmp_path / "notes.md", "skip")
    got = [tuple(r) for r in LG.scan_rubrics(spark, str(tmp_path)).collect()]
    assert got == [("amf_configuration", "AMF rubric {sbi}")]


def test_join_rubrics_fails_on_missing(spark):
    samples = spark.createDataFrame([(1, "Slice Deployment"), (2, "Unknown Thing")], "sample_id long, category string")
    rubrics = spark.createDataFrame([("slice_deployment", "r")], "category_key string, rubric string")
    assert [r["category"] for r in SM.rubric_gaps(samples, rubrics).collect()] == ["Unknown Thing"]
    with pytest.raises(Exception, match="no rubric"):
        SM.join_rubrics(samples, rubrics).collect()


def test_resolve_task_alias_rejects_unknown(spark):
    df = spark.createDataFrame([("teleqna_bench",), ("nope",)], "requested_task string")
    with pytest.raises(Exception, match="Unsupported task"):
        SM.resolve_task_alias(df).collect()


def test_work_grid_drops_blank_models_and_limits_first(spark):
    s = spark.createDataFrame([(i, i) for i in range(10)], "sample_id long, ord int")
    g = SM.expand_work_grid(s, ["a", "", "b"], epochs=2, limit=3)
    assert g.count() == 12 and {r["model"] for r in g.collect()} == {"a", "b"}


def test_generation_skips_done_keys(spark, tmp_path):
    def echo(pdf: pd.DataFrame):
        return [f"{m}:{p}" for m, p in zip(pdf["model"], pdf["prompt"])]

    s = spark.createDataFrame([(i, f"q{i}") for i in range(4)], "sample_id long, prompt string")
    grid = SM.expand_work_grid(s, ["m"], epochs=2)
    done = G.persist_completions(G.generate_completions(SM.expand_work_grid(s, ["m"], 1), echo), str(tmp_path / "c"))
    more = G.generate_completions(grid, echo, max_connections=2, done=done)
    assert more.count() == 4 and {r["epoch"] for r in more.collect()} == {2}
    assert done.count() + more.count() == grid.count()
    assert more.filter(F.col("completion") != F.concat(F.lit("m:q"), F.col("sample_id").cast("string"))).count() == 0
