"""Votes, means and standard errors on small hand-made score tables."""

import math

from pyspark.sql import functions as F

from evalframe.operators import metrics as M

SCHEMA = "model string, sample_id long, epoch int, answer string, value double"


ROWS = [
    # tie between B (epoch 1) and C (epoch 2): earliest wins -> B, which is wrong
    ("m", 1, 1, "B", 0.0), ("m", 1, 2, "C", 1.0),
    # majority C correct despite a wrong first answer
    ("m", 2, 1, "A", 0.0), ("m", 2, 2, "C", 1.0), ("m", 2, 3, "C", 1.0),
    # nothing answered: stays in the denominator
    ("m", 3, 1, "", 0.0), ("m", 3, 2, None, 0.0),
    # empty answers do not out-vote a single real one
    ("m", 4, 1, "", 0.0), ("m", 4, 2, "", 0.0), ("m", 4, 3, "D", 1.0),
    ("n", 1, 1, "A", 1.0),
]


def test_maj_at_k(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = {r["model"]: r["maj_at_k"] for r in M.maj_at_k(df).collect()}
    assert got == {"m": 0.5, "n": 1.0}  # samples 2 and 4 of the four of m


def test_majority_answer_ties(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = {(r["model"], r["sample_id"]): (r["answer"], r["votes"], r["correct"])
           for r in M.majority_answer(df).collect()}
    assert got[("m", 1)] == ("B", 1, False)
    assert got[("m", 2)] == ("C", 2, True)
    assert ("m", 3) not in got
    assert got[("m", 4)] == ("D", 1, True)


def test_maj_at_1_equals_accuracy_with_one_answer(spark):
    rows = [("m", i, 1, "A" if i % 3 else "B", float(i % 3 == 0)) for i in range(50)]
    df = spark.createDataFrame(rows, SCHEMA)
    acc = M.accuracy(df).first()["accuracy"]
    maj = M.maj_at_k(df, k=1).first()["maj_at_k"]
    assert math.isclose(acc, maj)


def test_stderr_rules(spark):
    one = spark.createDataFrame([("m", 1, 1, "A", 1.0)], SCHEMA)
    assert M.stderr(one).first()["stderr"] == 0.0
    vals = [1.0, 0.0, 1.0, 1.0]
    df = spark.createDataFrame([("m", i, 1, "A", v) for i, v in enumerate(vals)], SCHEMA)
    mean = sum(vals) / 4
    var = sum((v - mean) ** 2 for v in vals) / 3
    assert math.isclose(M.stderr(df).first()["stderr"], math.sqrt(var / 4))


def test_pass_at_1_averages_epochs_first(spark):
    rows = [("m", 1, 1, "A", 1.0), ("m", 1, 2, "A", 1.0), ("m", 1, 3, "B", 0.0), ("m", 2, 1, "A", 0.0)]
    got = M.pass_at_1(spark.createDataFrame(rows, SCHEMA)).first()
    assert math.isclose(got["pass_at_1"], (2 / 3 + 0) / 2) and got["n_samples"] == 2


def test_eval_report_invariant_under_repartition(spark):
    df = spark.createDataFrame(ROWS * 3, SCHEMA)
    a = sorted(tuple(r) for r in M.eval_report(df).collect())
    b = sorted(tuple(r) for r in M.eval_report(df.repartition(7, "epoch")).collect())
    assert a == b


def test_metrics_by_slice_full_row(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    slices = spark.createDataFrame([(1, "x"), (2, "x"), (3, None), (4, "y")], "sample_id long, subject string")
    rows = M.metrics_by_slice(df.filter(F.col("model") == "m"), slices, "subject").collect()
    full = [r for r in rows if r["is_full"] == 1]
    null_slice = [r for r in rows if r["is_full"] == 0 and r["subject"] is None]
    assert len(full) == 1 and full[0]["n_samples"] == 4 and len(null_slice) == 1


def test_slice_errors_do_not_cancel(spark):
    """Scores near a million that differ by thousandths: the slices' errors equal those of the plain metric."""
    rows = [("m", i, 1, "a", 1e6 + (i % 7) / 1000) for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA)
    slices = spark.createDataFrame([(i, "xy"[i % 2]) for i in range(400)], "sample_id long, subject string")
    got = {(r.is_full, r.subject): r.stderr for r in M.metrics_by_slice(df, slices, "subject").collect()}
    assert math.isclose(got[1, None], M.stderr(df).first().stderr, rel_tol=1e-6)
    assert math.isclose(got[0, "x"], M.stderr(df.filter("sample_id % 2 = 0")).first().stderr, rel_tol=1e-6)


def test_empty_scores_give_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert M.eval_report(empty).count() == 0 and M.maj_at_k(empty).count() == 0


def test_transcript_pieces_keep_turn_order(spark):
    from evalframe.operators.prompts import assemble_transcript
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"m{t}") for t in range(700)][::-1]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    got = assemble_transcript(df, piece_turns=64).first()
    assert got["n_turns"] == 700
    assert got["transcript"] == "\n\n".join(f"{'user' if t % 2 == 0 else 'assistant'}: m{t}" for t in range(700))


def test_task_metrics_share_one_scan(spark):
    from evalframe import tasks as TK
    s = spark.createDataFrame(ROWS, SCHEMA)
    names = ["accuracy", "stderr", "maj_at_k", "pass_at_1"]
    fused = {r["model"]: r for r in TK.compute_metrics(s, names).collect()}
    for n in names:
        one = {r["model"]: r[n] for r in TK._BUILTIN[n](s, ["model"]).collect()}
        assert all(math.isclose(fused[m][n], v, abs_tol=1e-12) for m, v in one.items()), n
    plan = TK.compute_metrics(s, names)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan                      # one aggregate chain, no per-metric joins
    saved = TK.METRICS["accuracy"]
    try:
        TK.METRICS["accuracy"] = lambda sc, k: sc.groupBy(*k).agg(F.lit(7.0).alias("accuracy"))
        got = {r["model"]: r for r in TK.compute_metrics(s, ["accuracy", "stderr"]).collect()}
        assert all(r["accuracy"] == 7.0 and r["stderr"] is not None for r in got.values())
    finally:
        TK.METRICS["accuracy"] = saved
