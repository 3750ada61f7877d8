"""Scorers over batches: errors stay with their rows, batches stay small."""

import pyarrow as pa
from pyspark.sql import functions as F

from evalframe import tasks as TK
from evalframe.operators import batch_scorer as B


def frame(spark, n=500):
    return spark.createDataFrame([(i, None if i % 50 == 7 else f"{i}", "x" * (i % 9)) for i in range(n)], "id long, reply string, target string").repartition(3)


def test_errors_stay_with_their_rows(spark):
    calls = spark.sparkContext.accumulator(0)

    def scorer(rows):
        calls.add(1)
        if any(int(r) % 100 == 13 for r in rows["reply"] if r):
            raise ArithmeticError("thirteen")
        return {"value": [float(len(r)) if r else None for r in rows["reply"]], "explanation": [f"n={r}" for r in rows["reply"]]}

    got = {r.id: r for r in B.score_batches(frame(spark), scorer, ["id"], {"reply": F.col("reply")}, batch_bytes=1000).collect()}
    assert len(got) == 500
    for i, r in got.items():
        if i % 100 == 13:
            assert (r.value, r.answer, r.explanation, r.error) == (None, None, None, "ArithmeticError: thirteen")
        else:
            assert r.error is None and r.value == (None if i % 50 == 7 else float(len(str(i)))) and r.explanation == f"n={None if i % 50 == 7 else i}"
    assert calls.value < 500                             # halves, not rows one by one


def test_batches_are_cut_by_bytes():
    b = pa.RecordBatch.from_pydict({"a": ["x" * n for n in (10, 10, 500, 1, 1, 1)] + [None]})
    assert B.cuts(b, 40) == [(0, 2), (2, 3), (3, 7)] and B.cuts(b, 1) == [(i, i + 1) for i in range(7)] and B.cuts(b, 10 ** 6) == [(0, 7)]
    assert B.cuts(b.slice(0, 0), 40) == []


def test_wrong_lengths_and_registration(spark):
    @TK.batch_scorer("short_scorer", metrics=("accuracy",))
    def short_scorer(rows):
        return {"value": [1.0]}                          # one result, however many rows

    got = TK.apply_scorer(frame(spark, 5), "short_scorer", ["id", "target"], reply=F.col("reply"))
    assert got.columns == ["id", "target", "value", "answer", "explanation", "error"]
    assert [r.value for r in got.collect()] == [1.0] * 5 and got.where("error is not null").count() == 0
    assert TK.SCORERS["short_scorer"].metrics == ("accuracy",) and TK.apply_scorer(frame(spark, 5).limit(0), "short_scorer", ["id"], reply=F.col("reply")).count() == 0
