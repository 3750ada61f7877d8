"""Generation with a journal never pays twice."""

from collections import Counter

import pytest

from evalframe.operators import generate as G


def client(calls, fail_after=None):
    """Answers a prompt and notes each key it was paid for; fails when it has answered ``fail_after`` rows in this process's folder."""
    def answer(pdf):
        import os
        import uuid
        if fail_after is not None and len(os.listdir(calls)) + len(pdf) > fail_after:
            raise RuntimeError("the executor is lost")
        for key in pdf["sample_id"].astype(str) + "-" + pdf["epoch"].astype(str):
            open(f"{calls}/{key}.{uuid.uuid4().hex}", "w").close()
        return [None if i % 13 == 0 else f"a{i}" for i in pdf["sample_id"]]
    return answer


def work(spark, n=200):
    return spark.createDataFrame([("m", i, 1 + i % 2, f"p{i}") for i in range(n)], "model string, sample_id long, epoch int, prompt string")


def paid(calls):
    return Counter(p.name.split(".")[0] for p in calls.iterdir())


def test_what_was_paid_is_found_again(spark, tmp_path):
    calls, journal = tmp_path / "calls", str(tmp_path / "journal")
    calls.mkdir()
    rows = work(spark)
    lost = G.generate_completions(rows, client(str(calls), fail_after=90), max_connections=1, journal=journal, call_rows=7)
    with pytest.raises(Exception, match="the executor is lost"):
        lost.collect()
    first = paid(calls)
    assert 0 < len(first) <= 90
    again = G.generate_completions(rows, client(str(calls)), max_connections=3, journal=f"file://{journal}", call_rows=7)   # a restarted driver, other tasks
    got = {(r.sample_id, r.epoch): r.completion for r in again.collect()}
    assert got == {(i, 1 + i % 2): None if i % 13 == 0 else f"a{i}" for i in range(200)}
    assert set(paid(calls).values()) == {1} and len(paid(calls)) == 200          # every key was paid once, those of the lost run too
    assert again.count() == 200 and len(list(calls.iterdir())) == 200            # and none again when the query runs a second time


def test_the_same_query_after_a_loss_goes_on(spark, tmp_path):
    """The rows of a task that is run again are the same; only those without a result are asked for."""
    calls, journal = tmp_path / "calls", str(tmp_path / "journal")
    calls.mkdir()
    switch = tmp_path / "lost"

    def answer(pdf, calls=str(calls), switch=str(switch)):
        import os
        import uuid
        if len(os.listdir(calls)) > 40 and not os.path.exists(switch):
            open(switch, "w").close()
            raise RuntimeError("lost")
        for i in pdf["sample_id"]:
            open(f"{calls}/{i}.{uuid.uuid4().hex}", "w").close()
        return [str(i) for i in pdf["sample_id"]]

    made = G.generate_completions(work(spark, 120), answer, max_connections=1, journal=journal, call_rows=5)
    with pytest.raises(Exception, match="lost"):
        made.collect()
    again = made.select("*")                     # the same plan, which knows nothing of the journal's rows: the tasks find them
    assert sorted(int(r.completion) for r in again.collect()) == list(range(120))
    assert set(paid(calls).values()) == {1} and len(paid(calls)) == 120


def test_judgements_and_done_rows(spark, tmp_path):
    rows = work(spark, 10)
    done = rows.where("sample_id < 4").select("model", "sample_id", "epoch")
    fn = lambda pdf: [f"{j}:{p}" for j, p in zip(pdf["judge_model"], pdf["prompt"])]
    args = {"judges": ["g1", "g2"], "journal": str(tmp_path / "j"), "call_rows": 3}
    a = sorted(map(tuple, G.generate_judgements(rows, fn, **args).collect()))
    assert len(a) == 20 and sorted(map(tuple, G.generate_judgements(rows, lambda pdf: 1 / 0, **args).collect())) == a
    left = G.generate_completions(rows, lambda pdf: ["x"] * len(pdf), done=done, journal=str(tmp_path / "k")).collect()
    assert sorted(r.sample_id for r in left) == list(range(4, 10))
