"""Progress fold and history against a sequential fold over the same lines."""

import datetime as dt
import json
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from evalframe.operators import progress as PR


def py_fold(lines):
    """Sequential reading of the job-log rules, one line at a time."""
    completed, total, hist = 0, None, []
    for line in lines:
        try:
            p = json.loads(line)
        except json.JSONDecodeError:
            p = None
        if isinstance(p, dict):
            def ints(d, k):
                v = d.get(k) if isinstance(d, dict) else None
                return v if isinstance(v, int) and not isinstance(v, bool) else None
            for key, tk, ck in (("results", "total_samples", "completed_samples"), ("progress", "total", "completed")):
                d = p.get(key)
                if isinstance(d, dict):
                    if ints(d, tk) is not None:
                        total = d[tk]
                    if ints(d, ck) is not None:
                        completed = d[ck]
            d = p.get("sample")
            if isinstance(d, dict):
                if ints(d, "total") is not None:
                    total = d["total"]
                if ints(d, "completed") is not None and d["completed"] > completed:
                    completed = d["completed"]
                if ints(d, "index") is not None and d["index"] + 1 > completed:
                    completed = d["index"] + 1
            if p.get("event") in ("sample_complete", "sample_success", "sample") and ints(p, "completed") is not None \
                    and p["completed"] > completed:
                completed = p["completed"]
        hist.append((completed, total))
    return hist


def line_strategy():
    n = st.integers(-5, 60)
    obj = st.one_of(
        st.builds(lambda a, b: {"results": {"total_samples": a, "completed_samples": b}}, n, n),
        st.builds(lambda a, b: {"progress": {"total": a, "completed": b}}, n, n),
        st.builds(lambda a, b, c: {"sample": {"total": a, "completed": b, "index": c}}, n, n, n),
        st.builds(lambda e, c: {"event": e, "completed": c}, st.sampled_from(["sample", "other", "sample_success"]), n),
        st.builds(lambda a, c: {"progress": {"completed": a}, "sample": {"index": c}}, n, n),
        st.just({"progress": {"completed": 2.5}}), st.just({"progress": {"completed": True}}),
    )
    return st.one_of(obj.map(json.dumps), st.sampled_from(["INFO text", "[1, 2]", "{broken", ""]))


def _frame(spark, jobs):
    t0 = dt.datetime(2024, 1, 1)
    rows, seq = [], 0
    for job, lines in jobs.items():
        for line in lines:
            rows.append((job, seq, t0 + dt.timedelta(seconds=seq), line))
            seq += 1
    random.Random(7).shuffle(rows)   # order must come from seq, never from input order
    return spark.createDataFrame(rows, "job_id long, seq long, ts timestamp_ntz, line string")


@settings(max_examples=12, deadline=None)
@given(st.dictionaries(st.integers(1, 4), st.lists(line_strategy(), min_size=1, max_size=40), min_size=1, max_size=3))
def test_fold_and_history_equal_sequential_fold(spark, jobs):
    df = _frame(spark, jobs)
    fold = {r["job_id"]: (r["samples_completed"], r["total_samples"]) for r in PR.progress_fold(df, bucket=4).collect()}
    hist = {}
    for r in PR.progress_history(df, bucket=4).collect():
        hist[(r["job_id"], r["seq"])] = (r["samples_completed"], r["total_samples"])
    seq = 0
    for job, lines in jobs.items():
        expect = py_fold(lines)
        assert fold[job] == expect[-1]
        for e in expect:
            assert hist[(job, seq)] == e
            seq += 1


def test_hot_job_fold(spark):
    # one job owns almost every line; pieces keep each window bounded
    lines = {1: [json.dumps({"sample": {"index": i}}) for i in range(3000)] + [json.dumps({"progress": {"completed": 5}})],
             2: ["INFO"]}
    got = {r["job_id"]: r["samples_completed"] for r in PR.progress_fold(_frame(spark, lines), bucket=256).collect()}
    assert got == {1: 5, 2: 0}


def test_log_tail_keeps_last_lines(spark):
    lines = {1: [f"line {i}   " for i in range(250)], 2: ["only"]}
    tail = PR.log_tail(_frame(spark, lines), 200).collect()
    one = sorted((r["seq"], r["line"]) for r in tail if r["job_id"] == 1)
    assert len(one) == 200 and one[0][1] == "line 50" and one[-1][1] == "line 249"


@settings(max_examples=10, deadline=None)
@given(st.dictionaries(st.integers(1, 4), st.tuples(st.lists(line_strategy(), min_size=1, max_size=30),
                                                     st.floats(0, 1)), min_size=1, max_size=3))
def test_fold_continues_across_a_cut(spark, jobs):
    """fold(all lines) = continue(fold(lines before a cut), summary(lines after)),
    with jobs seen only before or only after the cut."""
    from pyspark.sql import functions as F
    full = {j: lines for j, (lines, _) in jobs.items()}
    df = _frame(spark, full)
    before = F.lit(False)
    start = 0
    for j, (lines, f) in jobs.items():          # _frame numbers seq job by job in this order
        before = before | ((F.col("job_id") == j) & (F.col("seq") < start + int(f * len(lines))))
        start += len(lines)
    got = PR.continue_progress(PR.progress_fold(df.filter(before), bucket=4),
                               PR.progress_summary(df.filter(~before), bucket=4))
    res = {r["job_id"]: (r["samples_completed"], r["total_samples"], r["n_lines"]) for r in got.collect()}
    for j, lines in full.items():
        assert res[j] == (*py_fold(lines)[-1], len(lines))
