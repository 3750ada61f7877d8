"""The first N samples for large N equal the plain limit."""

import random

import pytest

from evalframe.operators.samples import limit_samples
from evalframe.operators.selection import first_samples

SCHEMA = "task string, sample_id long, ord long, _x string"


def frame(spark, seed=1, n=900):
    rng = random.Random(seed)
    rows = [(rng.choice(["a", "a", "b", None]), i, rng.choice([None, 5, 5, 5, rng.randrange(-40, 40), rng.randrange(10 ** 12)]), "x") for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.mark.parametrize("n,bins,most", [(1, 4, 3), (150, 4, 3), (400, 16, 10), (5000, 4, 3), (333, 1024, 200_000)])
def test_equals_the_plain_limit(spark, n, bins, most):
    df = frame(spark)
    for task in (None, "task"):
        got = first_samples(df, n, task, bins=bins, most=most)
        assert got.columns == df.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, limit_samples(df, n, task).collect()))


def test_edges(spark):
    df = frame(spark, n=50)
    assert first_samples(df, None).count() == 50 and first_samples(df, 0).count() == 50 and first_samples(df.limit(0), 5).count() == 0
    same = spark.createDataFrame([("a", 3, 1, "x")] * 20, SCHEMA)        # rows that agree in order and id
    assert first_samples(same, 7, most=2).count() == 7
    texts = spark.createDataFrame([(f"s{i:02}", 1) for i in range(30)], "sample_id string, ord long")
    assert sorted(r.sample_id for r in first_samples(texts, 4, most=2).collect()) == ["s00", "s01", "s02", "s03"]


def test_only_the_cut_is_ranked(spark):
    df = spark.range(20_000).selectExpr("id as sample_id", "id as ord", "'a' as task")
    out = first_samples(df, 15_000, "task", bins=64, most=400)
    assert out.count() == 15_000 and out.agg({"ord": "max"}).first()[0] == 14_999
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window") >= 1 and "Union" in plan
