"""The suite's seven tasks: samples, prompts, grader inputs, scoring and
reports, including a run through a stub generator."""

import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from evalframe import suite as SU
from evalframe.operators import generate as G
from evalframe.operators import rubric as RB

# the stub generator below runs on Python workers, which cannot import this test module
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHOICE_RECORDS = "sample_id long, ord int, question string, choices array<string>, answer int, subject string"


def choice_records(spark):
    rows = [(i, 10 - i, f"q{i}", ["x", "y", "z"], i % 3, "Standards Overview" if i % 2 else "Research Overview")
            for i in range(1, 7)]
    return spark.createDataFrame(rows, CHOICE_RECORDS)


def config_records(spark):
    rows = [(1, "Make a slice", "ok", "5G core", "Slice Deployment", "keep {Category} as text"),
            (2, "Make an AMF", "ok", "5G core", "AMF Configuration", "none")]
    return spark.createDataFrame(rows, "sample_id long, Question string, Answer string, `Main Category` string, "
                                       "Category string, Context string")


def test_unknown_task_fails():
    with pytest.raises(ValueError, match="Unsupported task"):
        SU.task("nope")


def test_slice_and_limit(spark):
    s = SU.load_samples("teleqna", choice_records(spark), "Standards Overview")
    assert sorted(r.sample_id for r in s.collect()) == [1, 3, 5]
    first = SU.load_samples("teleqna", choice_records(spark), limit=2)
    assert sorted(r.sample_id for r in first.collect()) == [5, 6]          # smallest ord first
    assert SU.load_samples("telelogs", choice_records(spark), "Standards Overview").count() == 6   # no slice


def test_work_grid_prompts(spark):
    s = SU.load_samples("three_gpp", choice_records(spark).withColumnRenamed("question", "input")
                        .withColumn("index", F.col("answer").cast("string")))
    w = SU.work("three_gpp", s, ["lab/a", "", "lab/b"], epochs=2)
    rows = w.collect()
    assert len(rows) == 6 * 2 * 2
    r = rows[0]
    assert "A) x\nB) y\nC) z" in r.prompt and "step by step" in r.prompt
    assert r.system_prompt.strip().startswith("You are a distinguished expert")
    logs = SU.work("telelogs", SU.load_samples("telelogs", choice_records(spark)), ["m"])
    assert logs.select("epoch").distinct().count() == 4                     # the task's default epochs
    assert logs.first().system_prompt is None


def test_config_system_prompt_single_pass(spark):
    s = SU.load_samples("teleyaml", config_records(spark))
    p = {r.sample_id: r.system_prompt for r in SU.work("teleyaml", s, ["m"]).collect()}
    assert "assisting a user with 5G core" in p[1] and "for Slice Deployment." in p[1]
    assert "keep {Category} as text" in p[1]                                # values are not re-rendered
    math = SU.work("telemath", SU.load_samples("telemath", spark.createDataFrame(
        [(1, "q", "3", "c", ["t"], "basic")], "sample_id long, question string, answer string, category string, "
                                            "tags array<string>, difficulty string")), ["m"]).first()
    assert r"`\$\boxed{...}\$`" in math.system_prompt


def test_grader_inputs(spark):
    s = SU.load_samples("teleyaml", config_records(spark))
    comp = spark.createDataFrame([("m", 1, 1, "kind: NetworkSlice"), ("m", 2, 1, "amf: {}")],
                                 "model string, sample_id long, epoch int, completion string")
    rubrics = RB.rubric_table(spark)
    g = SU.grader_work("teleyaml", comp, s, ["j1", "j2"], rubrics).collect()
    assert len(g) == 4 and {r.judge_model for r in g} == {"j1", "j2"}
    assert all("kind: NetworkSlice" in r.prompt for r in g if r.sample_id == 1)
    with pytest.raises(Exception, match="no rubric"):
        SU.grader_work("teleyaml", comp, s, ["j1"], rubrics.filter("category_key <> 'amf_configuration'")).collect()
    m = SU.grader_work("legacy_teleyaml", comp, s, ["j"]).first().messages
    assert [x.role for x in m] == ["system", "user"] and "[Ground Truth]\nok" in m[1].content
    with pytest.raises(ValueError):
        SU.score("teleyaml", comp, s)


def test_graded_reports(spark):
    replies = spark.createDataFrame(
        [("m", 1, 1, "a", "$FINAL_SCORE: 80"), ("m", 1, 1, "b", "no grade"), ("m", 2, 1, "a", "$final_score: 30")],
        "model string, sample_id long, epoch int, judge_model string, judge_output string")
    r = SU.report("teleyaml", SU.score_replies("teleyaml", replies)).first()
    assert r.n_samples == 2 and r.accuracy == pytest.approx((40 + 30) / 2)
    js = replies.withColumn("judge_output", F.when(F.col("sample_id") == 1, '{"overall_score": 4, "reasoning": "r"}')
                            .otherwise("not json"))
    r = SU.report("legacy_teleyaml", SU.score_replies("legacy_teleyaml", js)).first()
    assert r.mean == pytest.approx((4 + 0) / 2) and r.stderr == pytest.approx(2.0)


def stub_votes(pdf):
    """Epochs 1-2 answer the target letter, 3-4 answer B; sample 3 never answers."""
    out = []
    for sid, ep in zip(pdf["sample_id"], pdf["epoch"]):
        if sid == 3:
            out.append("no idea")
        else:
            out.append(f"ANSWER: {'ABC'[sid % 3] if ep <= 2 else 'B'}")
    return out


def test_stub_run_end_to_end(spark):
    s = SU.load_samples("telelogs", choice_records(spark))
    comp = G.generate_completions(SU.work("telelogs", s, ["lab/m"]), stub_votes, max_connections=2)
    scores = SU.score("telelogs", comp, s)
    r = SU.report("telelogs", scores).first()
    # the target is chr(65 + i % 3), the stub's epoch-1/2 letter: samples 1 and 4 (target B) score
    # every epoch, the others with an answer half of them, sample 3 none
    per = {1: 1.0, 2: 0.5, 3: 0.0, 4: 1.0, 5: 0.5, 6: 0.5}
    assert r.n_samples == 6 and r.accuracy == pytest.approx(sum(per.values()) / 6)
    # ties (2 votes each) go to the earliest epoch, i.e. the target letter: all answered samples win
    assert r.maj_at_k == pytest.approx(5 / 6)


def stub_grader(pdf):
    """Grades 90 from grader a, 30 from grader b; one reply without a grade."""
    return [("$FINAL_SCORE: 90" if j == "a" else "$FINAL_SCORE: 30") if sid != 2 or j == "a" else "no grade"
            for sid, j in zip(pdf["sample_id"], pdf["judge_model"])]


def test_graded_task_through_generation(spark):
    s = SU.load_samples("teleyaml", config_records(spark))
    comp = spark.createDataFrame([("m", 1, 1, "kind: NetworkSlice"), ("m", 2, 1, "amf: {}")],
                                 "model string, sample_id long, epoch int, completion string")
    gw = SU.grader_work("teleyaml", comp, s, ["a", "b"], RB.rubric_table(spark))
    replies = G.generate(gw, stub_grader, keys=SU.KEYS + ["judge_model"], out_col="judge_output")
    r = SU.report("teleyaml", SU.score_replies("teleyaml", replies)).first()
    assert r.n_samples == 2 and r.accuracy == pytest.approx(((90 + 30) / 2 + (90 + 0) / 2) / 2)


def test_eval_set_work_and_report(spark):
    recs = {"teleqna": choice_records(spark), "telelogs": choice_records(spark), "teleyaml": config_records(spark)}
    w = SU.eval_set_work(recs, ["m1", "m2"], limit=2)
    per = {r["task"]: r["count"] for r in w.groupBy("task").count().collect()}
    assert per == {"teleqna": 2 * 2 * 1, "telelogs": 2 * 2 * 4, "teleyaml": 2 * 2 * 1}   # each task's own epochs
    assert w.columns == ["task", "model", "sample_id", "epoch", "system_prompt", "prompt"]
    comp = spark.createDataFrame([("teleqna", "m1", 5, 1, "ANSWER: C"), ("telelogs", "m1", 5, 1, "ANSWER: A")],
                                 "task string, model string, sample_id long, epoch int, completion string")
    with pytest.raises(ValueError, match="grader replies"):
        SU.eval_set_report(recs, comp, limit=2)
    out = {r["task"]: r for r in SU.eval_set_report({k: recs[k] for k in ("teleqna", "telelogs")}, comp, limit=2)
           .collect()}
    assert out["teleqna"].accuracy == 1.0 and out["teleqna"].maj_at_k is None       # 5 % 3 = 2 -> C
    assert out["telelogs"].accuracy == 0.0 and out["telelogs"].maj_at_k == 0.0


def test_records_without_order_use_the_id(spark):
    recs = choice_records(spark).drop("ord")
    first = SU.load_samples("teleqna", recs, limit=2)
    assert sorted(r.sample_id for r in first.collect()) == [1, 2]
