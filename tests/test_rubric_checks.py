"""Rubrics as rows: the suite's three equal the coded ones, a fourth needs no code."""

import random

import pytest
from pyspark.sql import functions as F

from evalframe.operators import rubric as RB
from evalframe.operators import rubric_checks as RC
from test_rubric import GOOD


def broken(text, rng):
    """A config with lines dropped, values changed, quotes added or removed."""
    lines = text.split("\n")
    for _ in range(rng.randrange(4)):
        at = rng.randrange(len(lines))
        lines[at] = rng.choice([lines[at].replace('"', ""), lines[at].replace("high", "LOW"), lines[at] + "x", "", lines[at].upper(), lines[at].replace("7", "8"), "\t" + lines[at]])
    return "\n".join(lines)


def test_suite_rubrics_equal_the_coded_ones(spark):
    rng = random.Random(7)
    amf = """amf:
  sbi: {server: [{address: 127.0.0.6, port: 7777}]}
  ngap: {server: [{address: 192.168.1.7, port: 38412}]}
  guami: [{plmn_id: {mcc: "001", mnc: "07"}}]
  tai: [{plmn_id: {mcc: "001", mnc: "07"}, tac: 7}]
  plmn_support: [{plmn_id: {mcc: "001", mnc: "07"}}]
  security: {integrity_order: [NIA2, NIA1, NIA0], ciphering_order: [NEA2, NEA1, NEA0]}
nrf:
  sbi: {server: [{address: 192.168.1.77, port: 7777}]}
"""
    sub = """imsi: "001070000000007"
msisdn: "87"
security: {k: "465B5CE8B199B49FAA5F0A2EE238A6BC", opc: "E8ED289DEBA952E4283B54E88E6183CA", amf: "8000"}
subscribed_rau_tau_timer: 12
network_access_mode: 0
subscriber_status: 0
access_restriction_data: 32
slice: [{sst: 1, sd: "000007", default_indicator: true}]
"""
    inputs = {"slice_deployment": (GOOD, ["sst", "sd", "region"]), "amf_configuration": (amf, ["tac", "mcc", "mnc"]), "ue_provisioning": (sub, ["imsi", "sd"])}
    schema = "sample_id long, rubric string, submission string, reference string, sst int, sd string, region string, tac int, mcc string, mnc string, imsi string"
    rows = [(i, k, t if i % 60 == 0 else None if i % 60 == 1 else broken(t, rng), t, 1 if i % 7 else 2, "000007" if i % 5 else "7", "dc-1", 7, "001", "07" if i % 4 else "08", "001070000000007")
            for k, (t, _) in inputs.items() for i in range(120)]
    df = spark.createDataFrame(rows, schema).repartition(4)
    names = ["sst", "sd", "region", "tac", "mcc", "mnc", "imsi"]
    got = {(r.rubric, r.sample_id): (r.status, dict(r.criteria), r.total, round(r.score, 9)) for r in RC.score_by_checks(df, *RC.suite_checks(spark), {n: n for n in names}).collect()}
    assert len(got) == len(rows)
    for key, (_, task) in inputs.items():
        ids = [c for c, _ in RB.RUBRICS[key].criteria]
        for r in RB.score_rubric(key, df.where(F.col("rubric") == key), {n: n for n in task}).collect():
            assert got[key, r.sample_id] == (r.status, {c: r[c] for c in ids}, r.total, round(r.score, 9)), (key, r.sample_id)
    assert len({v[2] for v in got.values()}) > 15


def test_a_fourth_rubric_is_rows(spark):
    checks = spark.createDataFrame([("net", "A", None, 0, "host", "exists", None), ("net", "A", None, 1, "port", "between", "[1, 1023]"), ("net", "B", 9, 0, "mode", "one_of", '["x", "y"]'),
                                    ("net", "B", 4, 1, "mode", "one_of_any_case", '["x", "y"]')], RC.CHECKS)
    bands = spark.createDataFrame([("net", "A", 6, 2), ("net", "A", 2, 1), ("net", "B", 9, 1), ("net", "B", 4, 1)], RC.BANDS)
    docs = spark.createDataFrame([(1, "net", "host: a\nport: 80\nmode: x"), (2, "net", "port: 99999\nhost: b\nmode: Y"), (3, "net", "- 1"), (4, "net", "other: 1"), (5, "none", "host: a")],
                                 "id long, rubric string, submission string").withColumn("reference", F.lit(None).cast("string"))
    got = {r.id: (dict(r.criteria), r.total, r.score) for r in RC.score_by_checks(docs, checks, bands, id_col="id").collect()}
    assert got == {1: ({"A": 6, "B": 9}, 15, 100.0), 2: ({"A": 2, "B": 4}, 6, 40.0), 3: ({"A": 1, "B": 1}, 2, 2 * 100 / 15), 4: ({"A": 1, "B": 1}, 2, 2 * 100 / 15)}


def test_unknown_predicates_fail(spark):
    checks = spark.createDataFrame([("net", "A", None, 0, "host", "resembles", None)], RC.CHECKS)
    docs = spark.createDataFrame([(1, "net", "host: a", "host: a")], "sample_id long, rubric string, submission string, reference string")
    with pytest.raises(Exception, match="unknown predicate resembles"):
        RC.score_by_checks(docs, checks, spark.createDataFrame([("net", "A", 5, 1)], RC.BANDS)).collect()


def test_texts_stay_in_their_task(spark):
    df = spark.createDataFrame([(1, "slice_deployment", GOOD, GOOD)], "sample_id long, rubric string, submission string, reference string")
    plan = RC.score_by_checks(df, *RC.suite_checks(spark))._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan =="):]
    parsed = physical.index("MapInArrow")
    above = physical[:parsed]              # from the parsed documents to the result: the checks come by broadcast, only counts are dealt out
    assert above.count("BroadcastHashJoin") >= 1 and above.count("Exchange hashpartitioning(sample_id") <= 3 and "s_nodes" not in "".join(x for x in above.split("\n") if "Exchange" in x)


def test_a_submission_stays_one_row(spark):
    """Checks meet a submission as one book a rubric: no row a check, and rows are dealt out by their keys once."""
    rows = [(i, "slice_deployment", GOOD, GOOD) for i in range(20)]
    df = spark.createDataFrame(rows, "sample_id long, rubric string, submission string, reference string")
    plan = RC.score_by_checks(df, *RC.suite_checks(spark))._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan =="):]
    above = physical[:physical.index("MapInArrow")]
    assert above.count("Exchange hashpartitioning(sample_id") == 1 and "hashpartitioning(sample_id" in above and ", criterion" not in above.split("Exchange hashpartitioning(sample_id")[1].split("\n")[0]


def test_rows_of_one_key_count_together(spark):
    """Two checks of which each row holds another one, or the same one twice; keys may be null; another status is another row."""
    checks = spark.createDataFrame([("net", "A", None, 0, "x", "exists", None), ("net", "A", None, 1, "y", "exists", None), ("net", "B", 7, 0, "x", "eq", "1"), ("net", "C", 3, 0, "x", "eq", "1")], RC.CHECKS)
    bands = spark.createDataFrame([("net", "A", 5, 2), ("net", "A", 3, 1), ("net", "B", 7, 2), ("net", "C", 4, 0), ("net", "C", 3, 1), ("net", "D", 5, 1)], RC.BANDS)
    docs = spark.createDataFrame([(1, "net", "x: 1"), (1, "net", "y: 1"), (None, "net", "x: 1"), (None, "net", "x: 1"), (2, "net", "x: 1"), (2, "net", "```\nx: 1\n```"), (3, "net", None), (4, None, "x: 1")],
                                 "id long, rubric string, submission string").withColumn("reference", F.lit(None).cast("string"))
    got = sorted((r.id or 0, r.status, dict(r.criteria), r.total, r.score) for r in RC.score_by_checks(docs, checks, bands, id_col="id").collect())
    assert got == [(0, "valid", {"A": 5, "B": 7, "C": 4}, 16, 16 * 100 / 21), (1, "valid", {"A": 5, "B": 1, "C": 4}, 10, 10 * 100 / 21), (2, "minor", {"A": 3, "B": 1, "C": 4}, 8, 8 * 100 / 21),
                   (2, "valid", {"A": 3, "B": 1, "C": 4}, 8, 8 * 100 / 21), (3, "unparseable", {"A": 1, "B": 1, "C": 1}, 3, 3 * 100 / 21)]
