"""Streaming operators: restart from the checkpoint keeps the state."""

import datetime as dt
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalframe.operators import progress as PR
from evalframe.sources import lines as LN
from evalframe.streaming import state as S
from evalframe.streaming import tables as STR
from evalframe.streaming.runner import BatchTable, read_state, write_in_order


def _lines(spark, start, n, jobs=3):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i % jobs, i, t0 + dt.timedelta(seconds=i), f'{{"sample": {{"index": {i}}}}}' if i % 5 else "INFO")
            for i in range(start, start + n)]
    return spark.createDataFrame(rows, "job_id long, seq long, ts timestamp_ntz, line string")


def test_log_tail_survives_driver_restart(spark, tmp_path):
    src, table, ckpt = str(tmp_path / "src"), str(tmp_path / "tail"), str(tmp_path / "ckpt")
    _lines(spark, 0, 300).coalesce(1).write.parquet(src)
    STR.stream_log_tail(spark, LN.scan_progress_lines(spark, src, stream=True), table, ckpt, n=50)
    # new files arrive; a fresh run (new driver-side objects) resumes from the checkpoint
    _lines(spark, 300, 120).coalesce(1).write.mode("append").parquet(src)
    tail = STR.stream_log_tail(spark, LN.scan_progress_lines(spark, src, stream=True), table, ckpt, n=50)
    want = PR.log_tail(_lines(spark, 0, 420), 50)
    assert sorted(map(tuple, tail.collect())) == sorted(map(tuple, want.collect()))


def test_stream_progress_equals_batch_fold(spark, tmp_path):
    src = str(tmp_path / "src")
    for start in (0, 100, 200):
        _lines(spark, start, 100).coalesce(1).write.mode("append").parquet(src)
    stream = LN.scan_progress_lines(spark, src, stream=True, max_files_per_trigger=1)
    got = STR.stream_progress(spark, stream, str(tmp_path / "out"), str(tmp_path / "ckpt"))
    want = PR.progress_fold(_lines(spark, 0, 300))
    cols = ["job_id", "samples_completed", "total_samples", "n_lines"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))
    assert got.filter(F.col("last_update").isNull()).count() == 0


def test_stream_progress_survives_driver_restart(spark, tmp_path):
    src, out, ckpt = str(tmp_path / "src"), str(tmp_path / "state"), str(tmp_path / "ckpt")
    _lines(spark, 0, 150).coalesce(1).write.parquet(src)
    STR.stream_progress(spark, LN.scan_progress_lines(spark, src, stream=True), out, ckpt)
    _lines(spark, 150, 150).coalesce(1).write.mode("append").parquet(src)
    got = STR.stream_progress(spark, LN.scan_progress_lines(spark, src, stream=True), out, ckpt)
    want = PR.progress_fold(_lines(spark, 0, 300))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(got.columns).collect()))


def test_feeder_keeps_each_jobs_range_in_one_file(spark, tmp_path):
    path = str(tmp_path / "fed")
    write_in_order(_lines(spark, 0, 600, jobs=5).repartition(4), path, "seq", pieces=3, key_col="job_id")
    back = spark.read.parquet(path).withColumn("f", F.input_file_name())
    per = back.groupBy("job_id", F.floor(F.col("seq") / 200).alias("r")).agg(F.countDistinct("f").alias("files"))
    assert per.count() == 15 and per.filter("files > 1").count() == 0
    assert back.count() == 600


PATTERNS = ('{{"progress":{{"completed":{n}}}}}', '{{"results":{{"completed_samples":{n},"total_samples":{t}}}}}', '{{"sample":{{"index":{n},"total":{t}}}}}',
            '{{"sample":{{"completed":{n}}}}}', '{{"event":"sample","completed":{n}}}', "INFO {n}")


def _random_lines(n, seed, jobs=("a", "b", None)):
    rng = random.Random(seed)
    t0 = dt.datetime(2024, 1, 1)
    return [(rng.choice(jobs), i, t0 + dt.timedelta(seconds=i), rng.choice(PATTERNS[:2] if rng.random() < 0.1 else PATTERNS[2:]).format(n=rng.randrange(50), t=rng.randrange(90)))
            for i in range(n)]


LINES = "job_id string, seq long, ts timestamp_ntz, line string"


def _progress(rows):
    return sorted(map(tuple, rows), key=str)


def test_late_and_shuffled_lines_equal_the_batch_fold(spark, tmp_path):
    rows = _random_lines(900, 3)
    src = str(tmp_path / "src")
    shuffled = random.Random(4).sample(rows, len(rows))
    columns = ["job_id", "samples_completed", "total_samples", "last_update", "n_lines"]
    for at in range(0, 900, 300):                       # each batch holds lines from anywhere, each run is a restart
        spark.createDataFrame(shuffled[at:at + 300], LINES).repartition(3).write.mode("append").parquet(src)
        stream = LN.scan_progress_lines(spark, src, stream=True, schema=T._parse_datatype_string(LINES))
        got = STR.stream_progress(spark, stream, str(tmp_path / "out"), str(tmp_path / "ckpt"), state_partitions=2)
        want = PR.progress_fold(spark.createDataFrame(shuffled[:at + 300], LINES))
        assert _progress(got.select(columns).collect()) == _progress(want.select(columns).collect())
    table = BatchTable(spark, str(tmp_path / "out"), "job_id string, samples_completed long, total_samples long, last_update timestamp_ntz, n_lines long")
    assert _progress(table.newest("job_id").select(columns).collect()) == _progress(got.select(columns).collect())
    stairs = read_state(spark, str(tmp_path / "ckpt"), "stairs").collect()
    assert len(stairs) <= 3 * 50                        # distinct counts a job, whatever the number of lines


EVENTS = st.lists(st.tuples(st.booleans(), st.integers(-3, 9)), max_size=12)


@given(EVENTS, st.randoms())
@settings(max_examples=300, deadline=None)
def test_summaries_merge_in_any_order(events, rng):
    c = 0
    for is_set, v in events:
        c = v if is_set else max(c, v)
    none = (None, None, [], None, None, None, None, 0)
    parts = [(seq, v, [], None, None, seq, seq, 1) if is_set else (None, None, [(seq, v)], seq, v, seq, seq, 1) for seq, (is_set, v) in enumerate(events)]
    rng.shuffle(parts)
    while len(parts) > 1:                               # any bracketing
        at = rng.randrange(len(parts) - 1)
        parts[at:at + 2] = [S.merged(parts[at], parts[at + 1])]
    got = S.merged(none, parts[0]) if parts else none
    assert S.count(got) == c and got[7] == len(events) and got[5] == (len(events) - 1 if events else None)
    stairs = got[2]
    assert stairs == sorted(stairs) and all(a[1] > b[1] for a, b in zip(stairs, stairs[1:]))


def test_tail_takes_late_lines_and_a_new_state_field(spark, tmp_path, monkeypatch):
    src, ckpt = str(tmp_path / "src"), str(tmp_path / "ckpt")

    def run():
        return STR.stream_log_tail(spark, LN.scan_progress_lines(spark, src, stream=True), str(tmp_path / "t"), ckpt, n=4, state_partitions=2)

    lines = _lines(spark, 0, 60, jobs=2)
    lines.where("seq % 3 = 0").repartition(2).write.parquet(src)
    run()

    class Wider(S.TailState):                           # a later version keeps one field more
        def init(self, handle):
            self.tail = handle.getListState("tail", "seq bigint, line string, level string")

        def handleInputRows(self, key, rows, timer_values):
            held = [(x[0], x[1], x[2]) for x in self.tail.get()] if self.tail.exists() else []
            held = sorted([*held, *((r.seq, r.line, "new") for r in rows)])[-self.n:]
            self.tail.put(held)
            yield Row(job_id=key[0], n_lines=len(held))

    lines.where("seq % 3 != 0").repartition(2).write.mode("append").parquet(src)
    monkeypatch.setattr(S, "TailState", Wider)
    tail = run()
    assert sorted(map(tuple, tail.collect())) == sorted(map(tuple, PR.log_tail(lines, 4).collect()))
    levels = {r[0].level: 0 for r in read_state(spark, ckpt, "tail").select("list_element").collect()}
    assert set(levels) == {None, "new"}


def test_run_status_counts_follow_the_newest_rows(spark, tmp_path):
    schema = "run_id string, job_id string, status string, last_update timestamp_ntz, update_seq int"
    t0 = dt.datetime(2024, 1, 1)
    day = dt.timedelta(days=1)
    batches = [[("r1", "a", "running", t0 + day, 1), ("r1", "b", "queued", None, 0), ("r2", None, "queued", t0, 0)],
               [("r1", "a", "queued", t0, 0), ("r1", "b", "running", t0, 1), ("r1", "b", "complete", t0, 2)],       # the first row is late
               [("r2", "b", "failed", t0 + day, 0), ("r2", None, "queued", t0, 1)]]                                     # a job moves to another run
    want = [{"r1": (2, 0, 0, 0, 1, 1), "r2": (1, 0, 0, 0, 0, 1)}, {"r1": (2, 1, 0, 0, 1, 0), "r2": (1, 0, 0, 0, 0, 1)}, {"r1": (1, 0, 0, 0, 1, 0), "r2": (2, 0, 1, 0, 0, 1)}]
    for rows, counts_then in zip(batches, want):
        spark.createDataFrame(rows, schema).repartition(2).write.mode("append").parquet(str(tmp_path / "src"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "src"))
        jobs, counts = STR.stream_run_status(spark, stream, str(tmp_path / "t"), str(tmp_path / "c"), schema, state_partitions=2)
        assert {r[0]: tuple(r[1:]) for r in counts.collect()} == counts_then
    assert sorted((r.job_id or "", r.status) for r in jobs.collect()) == [("", "queued"), ("a", "running"), ("b", "failed")]


def test_a_batch_that_runs_again_replaces_itself(spark, tmp_path):
    table = BatchTable(spark, str(tmp_path / "t"), "task string, model string, v long", ("task", "model"))
    assert table.read().count() == 0
    rows = spark.createDataFrame([("t", "a", 1), ("t", "b", 2), ("u", "a", 3)], "task string, model string, v long")
    table.write(rows, 0)
    table.write(rows.limit(1), 1)
    table.write(rows.limit(1), 1)
    table.write(rows, 0)                                # a replay of the first batch
    assert sorted((r.task, r.model, r.v, r.batch_id) for r in table.read().collect()) == [("t", "a", 1, 0), ("t", "a", 1, 1), ("t", "b", 2, 0), ("u", "a", 3, 0)]
    assert (tmp_path / "t" / "batch_id=0" / "task=u" / "model=a").is_dir()


def test_results_sink_repeats_a_batch_that_failed(spark, tmp_path, monkeypatch):
    schema = "task string, model string, sample_id long, value double"
    rows = [("t", f"m{i % 3}", i, i / 7) for i in range(40)]
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(tmp_path / "src"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "src"))
    real = BatchTable.write

    def half_way(self, batch, batch_id):
        real(self, batch.limit(5), batch_id)
        raise RuntimeError("the driver is lost")

    monkeypatch.setattr(BatchTable, "write", half_way)
    with pytest.raises(Exception, match="the driver is lost"):
        STR.stream_eval_results(spark, stream, str(tmp_path / "t"), str(tmp_path / "c"))
    monkeypatch.setattr(BatchTable, "write", real)
    got = STR.stream_eval_results(spark, stream, str(tmp_path / "t"), str(tmp_path / "c"))
    assert sorted(map(tuple, got.collect())) == rows or sorted(map(tuple, got.collect())) == sorted(rows)


def test_late_lines_fail_instead_of_miscounting(spark):
    from evalframe.operators import progress as PR
    schema = "job_id long, seq long, ts timestamp_ntz, line string"
    line = lambda n: f'{{"progress":{{"completed":{n}}}}}'
    first = PR.progress_summary(spark.createDataFrame([(1, 5, None, line(3)), (1, 6, None, line(9)), (2, 1, None, line(1))], schema))
    none = spark.createDataFrame([], "job_id long, samples_completed long, total_samples long, last_update timestamp_ntz, n_lines long, last_seq long")
    state = PR.continue_progress(none, first)
    later = PR.continue_progress(state, PR.progress_summary(spark.createDataFrame([(1, 7, None, line(2)), (None, 1, None, line(4))], schema)))
    assert sorted(((r.job_id, r.samples_completed, r.n_lines) for r in later.collect()), key=str) == [(1, 2, 3), (2, 1, 1), (None, 4, 1)]
    with pytest.raises(Exception, match="late line"):
        PR.continue_progress(state, PR.progress_summary(spark.createDataFrame([(1, 4, None, line(7))], schema))).collect()


def test_history_keeps_lines_without_a_job(spark):
    from evalframe.operators import progress as PR
    lines = spark.createDataFrame([(None, 1, None, "x"), (1, 1, None, "x")], "job_id long, seq long, ts timestamp_ntz, line string")
    assert PR.progress_history(lines).count() == 2


def test_streams_take_text_job_ids(spark, tmp_path):
    from evalframe.operators import progress as PR
    from evalframe.streaming import tables as STR
    rows = [("ab12" if i % 2 else "cd34", i, None, f'{{"progress":{{"completed":{i}}}}}') for i in range(20)]
    lines = spark.createDataFrame(rows, "job_id string, seq long, ts timestamp_ntz, line string")
    lines.write.parquet(str(tmp_path / "lines"))
    stream = spark.readStream.schema(lines.schema).parquet(str(tmp_path / "lines"))
    got = STR.stream_progress(spark, stream, str(tmp_path / "t"), str(tmp_path / "c"))
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in PR.progress_fold(lines).select(*got.columns).collect())
    tail = STR.stream_log_tail(spark, spark.readStream.schema(lines.schema).parquet(str(tmp_path / "lines")), str(tmp_path / "t2"), str(tmp_path / "c2"), n=3)
    assert sorted(r.job_id for r in tail.collect()) == ["ab12"] * 3 + ["cd34"] * 3


def joined_by_merge(spark, monkeypatch, query):
    """Whether the query's stream meets its samples in a merge join; its rows."""
    from evalframe.plans import live_plans as LP
    from conftest import SF_SMALL
    met, real = [], LP.score_choice_table

    def seen(df, *args):
        if df.isStreaming:
            met.append(df._jdf.queryExecution().analyzed().toString())
        return real(df, *args)

    monkeypatch.setattr(LP, "score_choice_table", seen)
    rows = query(spark, SF_SMALL)
    batch = LP.choice_scores(spark, SF_SMALL).select("model", "sample_id", "epoch", "answer", "value")
    assert sorted(map(tuple, rows.select(*batch.columns).collect())) == sorted(map(tuple, batch.collect()))
    return bool(met) and all("strategy=merge" in p for p in met)


def test_eval_results_stream_broadcasts_no_batch(spark, monkeypatch):
    from evalframe.plans import live_plans as LP
    assert joined_by_merge(spark, monkeypatch, LP.q_stream_eval_results)


def test_score_stream_broadcasts_no_batch(spark, monkeypatch):
    from evalframe.plans import live_plans as LP
    assert joined_by_merge(spark, monkeypatch, LP.q_stream_score)
