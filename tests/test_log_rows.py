"""Logs to header, sample and score rows."""

import json

from pyspark.sql import functions as F

from evalframe.sources import log_rows as LR
from evalframe.sources import logs as LG


def folder(tmp_path):
    (tmp_path / "a").mkdir()
    big = {"status": "success", "eval": {"task": "t", "model": "m/1", "created": "2024"}, "results": {"total_samples": 3000, "completed_samples": 2999},
           "samples": [{"id": i, "epoch": 1 + i % 2, "input": "x" * 50, "scores": {"s": {"value": i % 5, "answer": f"a{i}"}}} for i in range(3000)]}
    odd = {"eval": {"task": "u"}, "samples": [{"id": "q7", "scores": {"a": {"value": True}, "b": {"value": "C", "explanation": "why"}, "c": {"value": "zzz"}, "d": {"value": 0.25}, "e": 5,
                                                                          "f": {"value": None}, "g": {"value": [1]}}}, {"scores": []}, 5, None, {"id": 1.5}]}
    for name, body in {"big": json.dumps(big), "odd": json.dumps(odd), "bad": '{"samples": [', "none": '{"status": "started"}', "kind": '{"samples": {"id": 1}, "results": 4}', "list": "[1]"}.items():
        (tmp_path / "a" / f"{name}.json").write_text(body)
    return [str(tmp_path / "a")]


def test_headers(spark, tmp_path):
    got = {r.name: r for r in LR.log_headers(LG.read_eval_logs(spark, folder(tmp_path))).collect()}
    assert len(got) == 6 and not got["bad.json"].is_valid
    b = got["big.json"]
    assert (b.status, b.task, b.model, b.created, b.total_samples, b.completed_samples, b.n_samples) == ("success", "t", "m/1", "2024", 3000, 2999, 3000)
    assert {n: r.n_samples for n, r in got.items() if r.n_samples is not None} == {"big.json": 3000, "odd.json": 5}
    assert got["kind.json"].total_samples is None


def test_samples_and_scores(spark, tmp_path):
    samples = LR.log_samples(LG.read_eval_logs(spark, folder(tmp_path)))
    rows = {(r.name, r.pos): (r.task, r.model, r.sample_id, r.epoch) for r in samples.collect()}
    assert len(rows) == 3005 and rows["big.json", 2999] == ("t", "m/1", "2999", 2)
    assert [rows["odd.json", i][2:] for i in range(5)] == [("q7", 1), (None, 1), (None, 1), (None, 1), ("1.5", 1)]
    scores = LR.log_scores(samples)
    assert scores.where("name = 'big.json'").agg(F.sum("value")).first()[0] == sum(i % 5 for i in range(3000))
    got = {r.scorer: (r.value, r.value_text, r.explanation) for r in scores.where("name = 'odd.json'").collect()}
    assert got == {"a": (1.0, "true", None), "b": (1.0, "C", "why"), "c": (None, "zzz", None), "d": (0.25, "0.25", None), "e": (None, None, None), "f": (None, None, None),
                   "g": (None, "[1]", None)}


def test_shredded_samples_read_only_what_is_asked_for(spark, tmp_path):
    samples = LR.log_samples(LG.read_eval_logs(spark, folder(tmp_path)))
    before = spark.conf.get("spark.sql.variant.writeShredding.enabled")
    path = LR.write_log_samples(samples, str(tmp_path / "s"))
    LR.write_log_samples(samples.where("task = 'u'"), path)             # replaces its own partition only
    assert spark.conf.get("spark.sql.variant.writeShredding.enabled") == before
    back = LR.scan_log_samples(spark, path)
    key = ["name", "pos", "sample_id", "epoch", "task", "model"]
    as_rows = lambda df: sorted((tuple(r[c] for c in key) + (r.j,) for r in df.select(*key, F.to_json("sample").alias("j")).collect()), key=str)
    assert as_rows(back) == as_rows(samples)
    one = back.select("name", F.try_variant_get("sample", "$.scores.s.answer", "string").alias("a"))
    scan = one._jdf.queryExecution().executedPlan().toString()
    assert "sample:struct<" in scan and "sample:variant" not in scan       # the path is read as a column of its own
    assert one.where("name = 'big.json' and a is not null").count() == 3000
    assert sorted(map(str, LR.log_scores(back).collect())) == sorted(map(str, LR.log_scores(samples).collect()))


def test_large_sample_logs_are_several(spark, tmp_path, monkeypatch):
    """A log stays one document of bounded size however many samples there are; the sample rows are the same."""
    from evalframe.plans import live_plans as LP
    parts = [(i, f"p{i}", "b", "t", i % 7) for i in range(50)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int").write.parquet(str(tmp_path / "part.parquet"))
    lines = [(i, i % 50, i % 9, i % 4, float(i % 11), float(i)) for i in range(300)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double").write.parquet(str(tmp_path / "lineitem.parquet"))
    whole = LP._sample_logs(spark, str(tmp_path)).select("name").collect()
    want = sorted(map(str, LP.q_read_log_samples(spark, str(tmp_path)).collect()))
    monkeypatch.setattr(LP, "LOG_SAMPLES", 10)
    logs = LP._sample_logs(spark, str(tmp_path))
    sizes = [r.n_samples for r in LR.log_headers(logs).collect()]
    assert len(sizes) > len(whole) and max(sizes) < 30 and len({r.name for r in logs.select("name").collect()}) == len(sizes)
    assert sorted(map(str, LP.q_read_log_samples(spark, str(tmp_path)).collect())) == want and len(want) == 600
