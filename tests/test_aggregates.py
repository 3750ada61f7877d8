"""Mergeable user metrics."""

import math

from evalframe import tasks as TK
from evalframe.operators import aggregates as A


def kurtosis_metric():
    """Sums of the values' powers (functions made here travel to the workers by value)."""
    def update(b, rows):
        v = [x for x in rows["value"].to_pylist() if x is not None]
        return [b[0] + len(v), *(b[p] + sum(x ** p for x in v) for p in (1, 2, 3, 4))]

    def finish(b):
        n, s1, s2, s3, s4 = b
        if n < 2:
            return None
        m = s1 / n
        var = s2 / n - m * m
        return (s4 / n - 4 * m * s3 / n + 6 * m * m * s2 / n - 3 * m ** 4) / var ** 2 if var > 1e-12 else None

    return A.Aggregate("kurtosis", ("value",), lambda: [0, 0.0, 0.0, 0.0, 0.0], update, lambda a, b: [x + y for x, y in zip(a, b)], finish)


KURTOSIS = kurtosis_metric()


def plain(values):
    v = [x for x in values if x is not None]
    if len(v) < 2:
        return None
    m = sum(v) / len(v)
    var = sum((x - m) ** 2 for x in v) / len(v)
    return sum((x - m) ** 4 for x in v) / len(v) / var ** 2 if var > 1e-12 else None


def frame(spark, parts=6):
    rows = [(None if i % 50 == 0 else "hot" if i % 3 else f"m{i % 7}", i % 2, None if i % 11 == 0 else (i * 37 % 101) / 10) for i in range(3000)]
    return rows, spark.createDataFrame(rows, "model string, epoch int, value double").repartition(parts)


def test_equals_the_plain_metric_by_group(spark, monkeypatch):
    rows, df = frame(spark)
    got = {(r.model, r.epoch): r.kurtosis for r in A.aggregate(df, KURTOSIS, ["model", "epoch"]).collect()}
    want = {}
    for m, e, v in rows:
        want.setdefault((m, e), []).append(v)
    assert set(got) == set(want) and all(math.isclose(got[k], plain(v), rel_tol=1e-9) for k, v in want.items())
    monkeypatch.setattr(A, "HELD", 2)                    # buffers are sent early and often
    again = {(r.model, r.epoch): r.kurtosis for r in A.aggregate(df, KURTOSIS, ["model", "epoch"]).collect()}
    assert all(math.isclose(again[k], got[k], rel_tol=1e-9) for k in got)
    whole = A.aggregate(df, KURTOSIS, []).collect()
    assert len(whole) == 1 and math.isclose(whole[0].kurtosis, plain([v for *_, v in rows]), rel_tol=1e-9)


def test_no_group_meets_in_one_task(spark):
    _, df = frame(spark, parts=5)
    a = A.Aggregate("rows_met", ("value",), lambda: (0, 0), lambda b, rows: (b[0] + len(rows["value"]), b[1] + 1), lambda a, b: (a[0] + b[0], max(a[1], b[1])), lambda b: float(b[0]))
    out = A.aggregate(df, a, ["model"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("MapInArrow") > plan.index("Exchange")         # rows are folded before anything is dealt out
    assert sum(r.rows_met for r in out.collect()) == 3000


def test_registered_metric_and_empty_input(spark):
    import pyarrow.compute as pc

    @TK.aggregate_metric("largest", ["value"], init=lambda: None, merge=lambda a, b: b if a is None else a if b is None else max(a, b), finish=lambda b: b)
    def largest(best, rows):
        here = pc.max(rows["value"]).as_py()
        return here if best is None else best if here is None else max(best, here)

    _, df = frame(spark)
    got = {r.model: r.largest for r in TK.METRICS["largest"](df, ["model"]).collect()}
    assert got["hot"] == 10.0 and None in got
    assert TK.METRICS["largest"](df.limit(0), ["model"]).collect() == []
    assert A.aggregate(df.limit(0), KURTOSIS, []).collect() == []
