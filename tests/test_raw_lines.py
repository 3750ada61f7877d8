"""Text logs as a table and as a stream."""

import json
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from evalframe.operators import progress as PR
from evalframe.sources import raw_lines as RL
from evalframe.streaming import state as S
from evalframe.streaming import tables as STR


def write(path, lines, end=True):
    data = b"\n".join(lines) + (b"\n" if end and lines else b"")
    path.write_bytes(data)
    at, out = 0, []
    for raw in lines:
        out.append((path.stem, at, raw.removesuffix(b"\r").decode("utf-8", "replace")))
        at += len(raw) + 1
    return out


def logs(folder, seed=1):
    rng = random.Random(seed)
    folder.mkdir()
    want = []
    for j in range(3):
        lines = [("x" * rng.choice([0, 1, 5, 50, 300]) + f" {i} é").encode() if i % 9 else b"" for i in range(150)]
        want += write(folder / f"job{j}.log", lines, end=j != 1)
    want += write(folder / "odd.log", [b"", b"\r", b"a\r", b"\xff\xfe bad", b"{}"])
    (folder / "empty.log").write_bytes(b"")
    want += write(folder / "ends.log", [b"", b""])
    write(folder / ".hidden.log", [b"no"])
    write(folder / "notes.txt", [b"no"])
    return want


def rows(df):
    return sorted((r.job_id, r.seq, r.line) for r in df.collect())


@pytest.mark.parametrize("size", [1 << 20, 997, 3])
def test_every_line_is_read_once(spark, tmp_path, size):
    want = logs(tmp_path / "l")
    if size == 3:      # a range a line or less: one short log is enough
        want = [w for w in want if w[0] in ("odd", "ends")]
        df = RL.scan_raw_lines(spark, str(tmp_path / "l"), "[eo]*.log", range_bytes=size)
    else:
        df = RL.scan_raw_lines(spark, str(tmp_path / "l"), "*.log", range_bytes=size)
    assert rows(df) == sorted(want) and df.where("ts is null").count() == 0


def test_blocks_are_smaller_than_lines(tmp_path, monkeypatch):
    monkeypatch.setattr(RL, "BLOCK", 7)
    want = logs(tmp_path / "l")
    files = RL.LogFiles({"path": str(tmp_path / "l"), "glob": "*.log", "rangebytes": "40"})
    got = [(r["job_id"], r["seq"], r["line"]) for path, size, m in files.listed() for part in files.ranges(path, 0, size, size, m) for b in files.read(part) for r in b.to_pylist()]
    assert got == sorted(want) and all(files.whole_lines(p, s, 0) == len(open(p, "rb").read().rpartition(b"\n")[0]) + 1 for p, s, _ in files.listed() if s)


def test_jobs_are_named_by_folder_or_file(tmp_path):
    assert [RL.LogFiles.job_of(p) for p in ("/a/run.1.log", "/a/job_id=7/part-0.txt", "/a/plain")] == ["run.1", "7", "plain"]
    with pytest.raises(ValueError):
        RL.LogFiles({})


def follow(spark, folder, ckpt):
    got = []
    q = (RL.scan_raw_lines(spark, f"file://{folder}", stream=True, range_bytes=64).writeStream.option("checkpointLocation", str(ckpt)).trigger(availableNow=True)
         .foreachBatch(lambda b, i: got.extend((r.job_id, r.seq, r.line) for r in b.collect())).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return sorted(got)


def test_stream_leaves_torn_lines_and_goes_on_from_its_offset(spark, tmp_path):
    folder, ckpt = tmp_path / "l", tmp_path / "c"
    folder.mkdir()
    assert follow(spark, folder, ckpt) == []
    (folder / "a.log").write_bytes(b"one\ntwo\nthr")
    (folder / "b.log").write_bytes(b"torn")
    assert follow(spark, folder, ckpt) == [("a", 0, "one"), ("a", 4, "two")]
    with open(folder / "a.log", "ab") as f:
        f.write(b"ee\n\nfi")
    with open(folder / "b.log", "ab") as f:
        f.write(b"\n" + b"y" * 300 + b"\n")
    assert follow(spark, folder, ckpt) == [("a", 8, "three"), ("a", 14, ""), ("b", 0, "torn"), ("b", 5, "y" * 300)]
    assert follow(spark, folder, ckpt) == []
    (folder / "a.log").write_bytes(b"x\n")
    with open(folder / "b.log", "ab") as f:
        f.write(b"z\n")
    with pytest.raises(Exception, match="shorter"):
        follow(spark, folder, ckpt)


def test_progress_of_growing_logs(spark, tmp_path):
    folder = tmp_path / "l"
    folder.mkdir()
    lines = [f'{{"sample":{{"index":{i},"total":90}}}}\n' if i % 4 else f'{{"progress":{{"completed":{i // 2}}}}}\n' for i in range(60)]
    for upto in (25, 60):
        for j in range(2):
            (folder / f"j{j}.log").write_text("".join(lines[: upto - j]) + '{"sample":{"ind')
        stream = RL.scan_raw_lines(spark, str(folder), stream=True)
        got = STR.stream_progress(spark, stream, str(tmp_path / "t"), str(tmp_path / "c"), state_partitions=2)
        whole = RL.scan_raw_lines(spark, str(folder)).where(F.col("line") != '{"sample":{"ind')
        want = PR.progress_fold(whole, bucket=1 << 20)
        columns = ["job_id", "samples_completed", "total_samples", "n_lines"]
        assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, want.select(columns).collect()))


def test_written_logs_come_back(spark, tmp_path):
    lines = spark.createDataFrame([(j, s, f"{j} {s}") for j in range(3) for s in range(20)], "job_id long, seq long, line string").repartition(4)
    path = RL.write_raw_logs(lines, str(tmp_path / "w"))
    got = RL.scan_raw_lines(spark, path)
    assert [(r.job_id, r.line) for r in got.orderBy("job_id", "seq").collect()] == [(str(j), f"{j} {s}") for j in range(3) for s in range(20)]


def test_tasks_write_logs_of_odd_jobs(spark, tmp_path):
    lines = spark.createDataFrame([("a/b", 2, None), ("a/b", 1, "é\r"), (None, 1, "x"), ("", 2, "y"), ("k=1 %", 1, "z")], "job_id string, seq long, line string").repartition(3)
    path = RL.write_raw_logs(lines, str(tmp_path / "w"))
    old = str(tmp_path / "old")
    lines.select("job_id", lines.line.alias("value")).write.partitionBy("job_id").text(old)
    folders = lambda p: {f.name for f in (tmp_path / p).iterdir() if f.name.startswith("job_id=")}
    assert folders("w") == folders("old") == {"job_id=a%2Fb", "job_id=__HIVE_DEFAULT_PARTITION__", "job_id=k%3D1 %25"}
    assert rows(RL.scan_raw_lines(spark, path)) == sorted([("a%2Fb", 0, "é"), ("a%2Fb", 4, ""), ("k%3D1 %25", 0, "z"), *[("__HIVE_DEFAULT_PARTITION__", a, t) for a, t in
                                                          got_default(path)]])
    assert not any(f.name.startswith(".") for f in (tmp_path / "w").rglob("*"))     # each moved to its name when whole, by its task; no table writer
    assert not (tmp_path / "w" / "_SUCCESS").exists()
    with pytest.raises(FileExistsError):
        RL.write_raw_logs(lines, path)


def got_default(path):
    """The lines of jobs without a name: one log if a task had them all, else two."""
    import pathlib
    files = sorted(pathlib.Path(path, "job_id=__HIVE_DEFAULT_PARTITION__").iterdir())
    texts = [f.read_text() for f in files]
    assert sorted("".join(texts).split()) == ["x", "y"]
    return [(at, line) for t in texts for at, line in zip((0, 2), t.split())]


def test_many_ranges_share_tasks(tmp_path):
    (tmp_path / "a.log").write_bytes(b"x\n" * 50_000)
    files = RL.LogFiles({"path": str(tmp_path), "rangebytes": "4"})
    ranges = [r for path, size, m in files.listed() for r in files.ranges(path, 0, size, size, m)]
    dealt = files.tasks(ranges)
    assert [r for t in dealt for r in t.ranges] == ranges and len(ranges) == 25_000 and len(dealt) <= 2 * RL.MOST_TASKS
    assert [len(t.ranges) for t in files.tasks(ranges[:100])] == [1] * 100


def test_stream_of_many_short_logs_has_a_bounded_number_of_tasks(tmp_path, monkeypatch):
    monkeypatch.setattr(RL, "MOST_TASKS", 10)
    for i in range(300):
        (tmp_path / f"j{i}.log").write_bytes(b"x" * 9 + b"\n")
    reader = RL.LogStreamReader({"path": str(tmp_path), "rangebytes": "10"})
    end = reader.latestOffset()
    dealt = reader.partitions({}, end)
    assert len(dealt) <= 20 and {r.path: r.end for t in dealt for r in t.ranges} == end
    assert sum(r.num_rows for t in dealt for r in reader.read(t)) == 300


def test_planner_reads_no_more_than_the_ends_of_logs(tmp_path):
    for i in range(20):
        (tmp_path / f"j{i}.log").write_bytes(b"x" * 99 + b"\n" if i % 2 else (b"x" * 99 + b"\n") * 2000 + b"torn")
    (tmp_path / "torn.log").write_bytes(b"a\n" + b"y" * 300_000)
    reader, got = RL.LogStreamReader({"path": str(tmp_path)}), []

    class Counting:
        def __init__(self, inner):
            self.inner = inner

        def __getattr__(self, name):
            return getattr(self.inner, name)

        def open_input_file(self, path):
            f = self.inner.open_input_file(path)

            class File:
                __enter__, __exit__, seek = (lambda s: s), (lambda s, *x: f.close()), (lambda s, at: f.seek(at))

                def read(s, n):
                    got.append((path, n))
                    return f.read(n)
            return File()

    reader.files.fs = Counting(reader.files.fs)
    end = reader.latestOffset()
    assert {p.rpartition("/")[2]: e for p, e in end.items()} == {"torn.log": 2} | {f"j{i}.log": 100 if i % 2 else 200_000 for i in range(20)}
    assert sum(n for p, n in got if not p.endswith("torn.log")) <= 20 * 1024     # 2 MB of lines
    assert len(got) <= 20 + 10


def test_planner_lists_a_folder_once_a_batch_and_tasks_see_a_log_that_shrinks(tmp_path):
    for i in range(5):
        (tmp_path / f"j{i}.log").write_bytes(b"x\n" * 10)
    reader, lists = RL.LogStreamReader({"path": str(tmp_path)}), []
    listed = reader.files.listed
    reader.files.listed = lambda: lists.append(1) or listed()
    end = reader.latestOffset()
    dealt = reader.partitions({}, end)
    assert len(lists) == 1 and sum(b.num_rows for t in dealt for b in reader.read(t)) == 50
    later = RL.LogStreamReader({"path": str(tmp_path)})     # plans again what an earlier run had planned
    assert [t.ranges for t in later.partitions({}, end)] == [t.ranges for t in dealt]
    (tmp_path / "j3.log").write_bytes(b"x\n")
    with pytest.raises(ValueError, match="shorter"):
        RL.LogStreamReader({"path": str(tmp_path)}).partitions({}, end)
    with pytest.raises(ValueError, match="shorter"):
        [b for t in dealt for b in reader.read(t)]


def test_offset_over_many_logs_is_short(tmp_path, monkeypatch):
    monkeypatch.setattr(RL, "PLAIN_LOGS", 10)
    folder = tmp_path / ("deep" * 20)
    folder.mkdir()
    new = lambda: RL.LogStreamReader({"path": str(folder)})
    for i in range(8):
        (folder / f"j{i}.log").write_bytes(b"x\n" * i)
    plain = new().latestOffset()
    assert plain == {str(folder / f"j{i}.log"): 2 * i for i in range(1, 8)}
    for i in range(4, 400):
        (folder / f"j{i}.log").write_bytes(b"x\n" * i)
    end = json.loads(json.dumps(new().latestOffset()))
    assert len(json.dumps(end)) < 400 * 20 and end == new().latestOffset()
    whole = {str(folder / f"j{i}.log"): 2 * i for i in range(1, 400)}
    assert {r.path: r.end for t in new().partitions({}, end) for r in t.ranges} == whole
    assert {r.path for t in new().partitions(plain, end) for r in t.ranges} == set(whole) - set(plain)      # an offset kept plain goes on
    assert new().partitions(end, end) == []
    (folder / "j9.log").write_bytes(b"x\n" * 10)
    assert [tuple(r)[2:4] for t in new().partitions(end, new().latestOffset()) for r in t.ranges] == [(18, 20)]


@pytest.mark.parametrize("kind", [RL.LogTableReader, RL.LogStreamReader])
def test_short_logs_share_batches(tmp_path, kind):
    for i in range(300):
        (tmp_path / f"j{i}.log").write_bytes(b"".join(b"%d %d\n" % (i, k) for k in range(50)))
    reader = kind({"path": str(tmp_path)})
    dealt = reader.partitions() if kind is RL.LogTableReader else reader.partitions({}, reader.latestOffset())
    got = [b for t in dealt for b in reader.read(t)]
    assert len(got) == 2 and max(b.num_rows for b in got) <= RL.ROWS
    assert sorted((r["job_id"], r["line"]) for b in got for r in b.to_pylist()) == sorted((f"j{i}", f"{i} {k}") for i in range(300) for k in range(50))


def test_state_of_a_job_takes_few_calls():
    calls = []

    class Var:
        def __init__(self, name):
            self.name, self.value = name, None

        def __getattr__(self, call):
            def run(*x):
                calls.append((self.name, call))
                if call in ("update", "put", "clear"):
                    self.value = x[0] if x else None
                return self.value is not None if call == "exists" else iter(self.value or ()) if self.name == "stairs" else self.value
            return run

    class Handle:
        getValueState = staticmethod(lambda name, schema: Var(name))
        getListState = staticmethod(lambda name, schema: Var(name))

    state = S.ProgressState()
    state.init(Handle)

    def step(seq, value, stairs):
        calls.clear()
        row = Row(set_seq=seq, set_value=value, stairs=[{"seq": a, "value": b} for a, b in stairs], total_seq=None, total=None, last_seq=seq, last_update=None, n_lines=1)
        done = next(iter(state.handleInputRows(("j",), iter([row]), None)))
        return done.samples_completed, done.n_lines, len(calls)

    assert step(1, 5, []) == (5, 1, 2)                  # read and written once
    assert step(2, 6, [(3, 9)])[:2] == (9, 2)
    assert step(4, 7, [])[:2] == (7, 3) and ("stairs", "clear") in calls      # stairs before a SET go
