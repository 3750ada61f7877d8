"""Physical plan shapes that matter at scale."""

import __spark_entry__ as E
from pyspark.sql import functions as F
from conftest import SF_SMALL


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_join_rubrics_broadcasts_the_dimension(spark):
    assert "BroadcastHashJoin" in plan_text(E.queries()["join_rubrics"](spark, SF_SMALL))


def test_log_tail_limits_before_shuffle(spark):
    df = E.queries()["log_tail"](spark, SF_SMALL)
    df._jdf.queryExecution().executedPlan()
    assert "WindowGroupLimit" in df._jdf.queryExecution().sparkPlan().toString()


def test_votes_aggregate_partially(spark):
    p = plan_text(E.queries()["eval_report"](spark, SF_SMALL))
    assert "partial_" in p and "Python" not in p


def test_parsers_have_no_python(spark):
    for k in ("score_choice", "score_boxed", "score_working_group", "parse_judge_json", "progress_fold"):
        assert "Python" not in plan_text(E.queries()[k](spark, SF_SMALL)), k


def test_metrics_without_a_vote_do_not_shuffle_answers(spark):
    from evalframe.operators import metrics as M
    scores = spark.createDataFrame([("m", 1, 1, "a", 1.0)], "model string, sample_id long, epoch int, answer string, value double")
    slices = spark.createDataFrame([(1, "x")], "sample_id long, subject string")
    for df in (M.accuracy(scores), M.stderr(scores), M.pass_at_1(scores), M.metrics_by_slice(scores, slices, "subject")):
        assert "answer" not in plan_text(df).split("Scan")[0].split("Project")[0] and all(
            "answer" not in line for line in plan_text(df).splitlines() if "Exchange" in line or "Aggregate" in line)


def test_building_plans_starts_no_job(spark):
    """But for fixture writes: joins with dimensions probe nothing."""
    from evalframe.operators import samples as SM
    samples = spark.createDataFrame([(1, "A b")], "sample_id long, category string")
    rubrics = spark.createDataFrame([("a_b", "r")], "category_key string, rubric string")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-build", "plan build")
    try:
        SM.join_rubrics(samples, rubrics), SM.rubric_gaps(samples, rubrics)
        assert list(tracker.getJobIdsForGroup("plan-build")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_work_grid_has_no_join(spark):
    p = plan_text(E.queries()["expand_work_grid"](spark, SF_SMALL))
    assert "Join" not in p and "Generate" in p


def test_scan_prunes_columns(spark):
    df = E.queries()["last_completion"](spark, SF_SMALL)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(role), EqualTo(role,assistant)]" in p


def test_log_bodies_are_not_shuffled(spark):
    df = E.queries()["read_eval_logs"](spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()
    p = plan_text(df)
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p and "Window" not in p


def test_dataset_scan_prunes_partitions(spark):
    import contextlib
    import io
    df = E.queries()["scan_eval_dataset"](spark, SF_SMALL)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")       # the formatted plan lists scan metadata untruncated
    line = next(x for x in buf.getvalue().splitlines() if x.startswith("PartitionFilters:"))
    assert "= teleqna)" in line and "= default)" in line and "= test)" in line


def test_made_configurations_are_not_broadcast(spark, tmp_path):
    """Texts made from small columns look small to the planner."""
    from evalframe.plans import rubric_plans as RP
    rows = [(i, i % 25) for i in range(40)]
    spark.createDataFrame(rows, "c_custkey long, c_nationkey int").write.parquet(str(tmp_path / "customer.parquet"))
    for name, truth in (("fx_slice_yaml", "fx_slice_truth"), ("fx_amf_yaml", "fx_amf_truth"), ("fx_sub_yaml", "fx_sub_truth")):
        df = RP._configs(spark, str(tmp_path), name, truth)
        assert df.count() == 40 and "Broadcast" not in plan_text(df), name


def test_made_configurations_keep_their_tasks(spark, tmp_path):
    """Few bytes that take long to parse aren't put together in one task."""
    from evalframe.plans import rubric_plans as RP
    spark.createDataFrame([(i, i % 25) for i in range(400)], "c_custkey long, c_nationkey int").write.parquet(str(tmp_path / "customer.parquet"))
    df = RP._configs(spark, str(tmp_path), "fx_slice_yaml", "fx_slice_truth")
    assert df.groupBy(F.spark_partition_id().alias("task")).count().count() >= 2 * spark.sparkContext.defaultParallelism
