"""Rubric scoring: statuses, floor and ceiling, single criteria."""

from pyspark.sql import functions as F

from evalframe.operators import rubric as RB

GOOD = ("apiVersion: v1\nkind: NetworkSlice\nmetadata:\n  name: slice-embb-app7\n  labels:\n    region: dc-1\n"
        "spec:\n  sst: 1\n  sd: \"000007\"\n  uplink_throughput: 50Mbps\n  downlink_throughput: 100Mbps\n"
        "  max_latency: 10ms\n  ue_density: high\n")


def _score(spark, subs):
    rows = [(i, s, GOOD, 1, "000007", "dc-1") for i, s in enumerate(subs)]
    df = spark.createDataFrame(rows, "sample_id long, submission string, reference string, sst int, sd string, "
                                     "region string")
    out = RB.score_rubric("slice_deployment", df, {"sst": "sst", "sd": "sd", "region": "region"})
    return {r["sample_id"]: r for r in out.collect()}


def test_parse_config_statuses():
    assert RB.parse_config("a: 1")[0] == "valid"
    assert RB.parse_config("```yaml\na: 1\n```")[0] == "minor"
    assert RB.parse_config("a:\n\tb: 1")[0] == "minor"
    assert RB.parse_config("just text")[0] == "unparseable"
    assert RB.parse_config("spec: [unclosed")[0] == "unparseable"
    assert RB.parse_config(None)[0] == "unparseable"


def test_floor_and_ceiling(spark):
    got = _score(spark, [GOOD, "spec: [broken", "```\n" + GOOD + "```\n", "kind: Other\n"])
    assert got[0]["score"] == 100.0 and got[0]["status"] == "valid"
    assert got[1]["score"] == 20.0 and got[1]["status"] == "unparseable"
    assert got[2]["status"] == "minor" and got[2]["S1"] == 3 and got[2]["total"] == 78
    assert 20.0 <= got[3]["score"] < 100.0


def test_single_criteria(spark):
    wrong_case = GOOD.replace("ue_density: high", "ue_density: HIGH").replace("sd: \"000007\"", "sd: \"7\"")
    got = _score(spark, [wrong_case])[0]
    assert got["F3"] == 3 and got["T2"] == 3 and got["G4"] == 3 and got["S4"] == 5


def test_flatten_rows(spark):
    df = spark.createDataFrame([(1, "a:\n  b: [1, 2]\n  c: x\n"), (2, "::bad: [")], "sample_id long, submission string")
    rows = {(r["sample_id"], r["path"]): (r["value"], r["vtype"], r["status"]) for r in RB.flatten_yaml(df).collect()}
    assert rows[(1, "a.b")] == ("[1, 2]", "list", "valid")
    assert rows[(1, "a.b[1]")] == ("2", "int", "valid")
    assert rows[(1, "a.c")] == ("x", "str", "valid")
    assert rows[(2, None)] == (None, None, "unparseable")


def test_rubric_table_has_three_rubrics(spark):
    keys = sorted(r["category_key"] for r in RB.rubric_table(spark).collect())
    assert keys == ["amf_configuration", "slice_deployment", "ue_provisioning"]
    assert RB.rubric_table(spark).filter(F.col("rubric").contains("(100 / 80)")).count() == 1


def test_node_maps_can_drop_the_texts(spark):
    df = spark.createDataFrame([(1, "a: 1\nb: [x, y]\n", "a: '1'\n", 7)],
                               "sample_id long, sub string, ref string, extra int")
    keep = RB.node_maps(df, {"s": "sub", "t": "ref"}, ["a", "b"])
    lean = RB.node_maps(df, {"s": "sub", "t": "ref"}, ["a", "b"], keep_text=False)
    assert {"sub", "ref"} <= set(keep.columns) and not {"sub", "ref"} & set(lean.columns)
    assert set(keep.columns) - set(lean.columns) == {"sub", "ref"}
    r = lean.first()
    assert r.extra == 7 and r.s_status == "valid" and r.s_nodes["a"].vtype == "int"
    assert r.s_nodes["b"].value == '["x", "y"]' and r.t_nodes["a"].vtype == "str"


HOSTILE = {
    "dotted key": "spec.sst: 1\n" + GOOD, "impossible date": GOOD.replace("NetworkSlice", "2024-99-99"), "cycle": "a: &x\n  b: *x\n" + GOOD,
    "deep": "a: " + "[" * 3000 + "]" * 3000 + "\n" + GOOD, "aliases": "l0: &l0 [x]\n" + "".join(f"l{i}: &l{i} [" + ", ".join([f"*l{i - 1}"] * 9) + "]\n" for i in range(1, 12)) + GOOD,
    "keys of any kind": "? [1, 2]\n: x\n1: y\ntrue: z\n" + GOOD, "merge": "<<: 3\n" + GOOD, "null": None, "number": "99999999999999999999",
}


def test_no_document_ends_the_job(spark):
    got = _score(spark, list(HOSTILE.values()))
    marks = dict(zip(HOSTILE, (got[i] for i in range(len(HOSTILE))), strict=True))
    assert marks["dotted key"].status == "valid" and marks["dotted key"].total == 80 and marks["cycle"].total == 80 and marks["aliases"].total == 80
    assert marks["null"].status == marks["number"].status == marks["impossible date"].status == "unparseable" and marks["deep"].total in (16, 80)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(HOSTILE.values())], "sample_id long, submission string")
    assert RB.flatten_yaml(df).count() < 4000


def test_huge_port_is_a_wrong_port(spark):
    df = spark.createDataFrame([("a", "amf:\n  ngap:\n    server:\n      - port: 99999999999999999999\nnrf: {}\n", "amf: {}", "1", "2", "3")],
                               "sample_id string, submission string, reference string, tac string, mcc string, mnc string")
    r = RB.score_rubric("amf_configuration", df, {"tac": "tac", "mcc": "mcc", "mnc": "mnc"}).first()
    assert r.G2 == 1 and r.status == "valid" and r.sample_id == "a"


def test_keys_of_any_type_and_shared_references(spark):
    rows = [("m1", 9007199254740993, 1, GOOD), ("m2", None, 1, GOOD), ("m2", 9007199254740993, 2, "kind: x")]
    subs = spark.createDataFrame(rows, "model string, sample_id long, epoch int, submission string").withColumn("sst", F.lit(1)) \
        .withColumn("sd", F.lit("000007")).withColumn("region", F.lit("dc-1"))
    task = {"sst": "sst", "sd": "sd", "region": "region"}
    keys = ["model", "sample_id", "epoch"]
    inline = RB.score_rubric("slice_deployment", subs.withColumn("reference", F.lit(GOOD)), task, keys).collect()
    assert {(r.model, r.sample_id, r.epoch): r.total == 80 for r in inline} == {r[:3]: r[3] == GOOD for r in rows}
    refs = spark.createDataFrame([(9007199254740993, GOOD)], "sample_id long, reference string")
    joined = RB.score_rubric("slice_deployment", subs, task, keys, references=refs).collect()
    assert sorted(tuple(r) for r in joined) == sorted(tuple(r) for r in inline if r.sample_id is not None)
    assert RB.flatten_yaml(subs, keys).filter("sample_id is null").count() > 0


def test_plain_documents_need_no_loader(monkeypatch):
    import yaml
    nested = "a:\n- b: 1\n  c:\n    - x\n    - 'y z'\n  # a remark\n- d\ne: [p, 2, true] # end\nf:\ng: \"#\"\nh: 10.0.0.1\n"
    want = yaml.safe_load(nested)
    monkeypatch.setattr(yaml, "load", lambda *a, **k: 1 / 0)
    assert RB.parse_config(nested) == ("valid", want) and want["a"][0]["c"] == ["x", "y z"] and want["f"] is None
    assert RB.parse_config(GOOD)[0] == "valid"


def test_plain_reader_and_loader_agree():
    """Whatever the plain reader takes is what the loader makes of it, on lines put together at random; mistakes and everything else are left to the loader."""
    import random

    import yaml
    rng = random.Random(3)
    values = ["", "", "1", "x", "007", "-1", "+1", "1.5", "1e3", "0x1f", "1_0", "1:30", "1.2.3.4", "true", "Yes", "n", "null", "~", "2024-01-01", "2024-99-99", "a b", "a:b", "a: b", "- a", "---", "[a, 1]", "[a,]", "[]",
              "{}", "'x'", '"x"', "'it''s'", '"\\n"', "#c", "x #c", "x#c", "&a x", "*a", "!!str 1", "|", "=", "\t", ".inf", "x\t", "\u00e9", "9" * 5000]
    keys = ["a", "b", "c", "a.b", "yes", "n", "1", "on", "null", "<<", "=", "'q'", "_x", "x" * 1100]
    taken = 0
    for _ in range(6000):
        text = "\n".join(" " * rng.choice([0, 0, 0, 2, 2, 4, 3]) + rng.choice(["", "", "", "- ", "-  "]) + rng.choice(["", rng.choice(keys) + ":", rng.choice("abc") + ": ", rng.choice("abc") + ": "])
                         + rng.choice(["", "1", "x", rng.choice(values)]) for _ in range(rng.randrange(1, 7))) + rng.choice(["", "\n"])
        doc = RB._read_plain(text)
        if doc is not None:
            taken += 1
            assert repr(doc) == repr(yaml.load(text, Loader=getattr(yaml, "CSafeLoader", yaml.SafeLoader))), text
    assert taken > 300
