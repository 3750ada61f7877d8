"""What one task sorts stays bounded as the table grows."""

from pyspark.sql import functions as F

from evalframe import tasks as TK
from evalframe.operators import generate as G


def work(spark, n):
    return spark.range(n).select(F.lit("t").alias("task"), F.lit("m").alias("model"), F.col("id").alias("sample_id"), F.lit(1).alias("epoch"), F.lit("p").alias("prompt"))


def test_generation_deals_many_rows_to_more_tasks(spark, monkeypatch):
    monkeypatch.setattr(G, "TASK_ROWS", 100)
    made = G.generate_completions(work(spark, 5000), lambda rows: ["x"] * len(rows))
    sizes = [r["count"] for r in made.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == 5000 and len(sizes) == 50 and max(sizes) < 200


def test_connections_hold_with_a_constant_key(spark):
    made = G.generate_completions(work(spark, 50), lambda rows: ["x"] * len(rows), max_connections=2)
    assert made.select(F.spark_partition_id()).distinct().count() == 2


def test_scoring_joins_many_samples_in_more_tasks(spark, monkeypatch):
    monkeypatch.setattr(TK, "SCORED_SAMPLES", 20)
    samples = spark.range(400).select(F.col("id").alias("sample_id"), F.col("id").cast("string").alias("target"))
    replies = samples.select(F.lit("m").alias("model"), "sample_id", F.lit(1).alias("epoch"), F.concat(F.lit("\\boxed{"), F.col("sample_id") % 300, F.lit("}")).alias("completion"))
    task = TK.Task("t", lambda s, d: samples, lambda s, d: replies, "boxed_number", {"completion": "completion", "target": "target"})
    from evalframe.plans import live_plans  # noqa: F401 - registers boxed_number
    scores = task.scores(spark, "")
    assert scores.select(F.spark_partition_id()).distinct().count() == 20
    assert (scores.count(), scores.agg(F.sum("value")).first()[0]) == (400, 300.0)
