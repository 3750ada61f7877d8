"""Parsers and scorers on inputs with hand-worked results."""

from pyspark.sql import functions as F

from conftest import one
from evalframe.functions import parse as P
from evalframe.functions import score as SC
from evalframe.operators.scoring import score_judge_json_table


#: reply -> answer, worked out by hand
BOXED = [
    (r"so $\boxed{42}$", "42"), (r"\boxed{0} then \boxed{17}", "17"), (r"\boxed{:12./}", "12"), (r"\boxed{\text{5}}", r"\text{5}"),
    ("\\boxed{ 7\n  }", "7"), ("no box", ""), ("", ""), (r"\boxed{}", ""), (r"\boxed{a{b}c}", "a{b}c"), (r"\boxed{unbalanced", ""),
    (r"\boxed{{x}}", "{x}"), ("\\boxed{ 3.\n}", "3"), ("\\boxed{1\n 2\n  3}", "123"), (r"\boxed{5.0}", "5.0"),
    ("\\boxed{\u00a012\u2003}", "12"), (r"\boxed{" + "9" * 20000 + "}", "9" * 20000), (r"\boxed{" + "{a}" * 5000 + "}", "{a}" * 5000), (None, ""),
]


def test_parse_boxed_matches_rule(spark):
    got = one(spark, P.parse_boxed("s"), "s string", [(p,) for p, _ in BOXED])
    assert got == [want for _, want in BOXED]


#: reply -> working group, worked out by hand
GROUPS = [("The group is sa1.", "SA1"), ("  geran ", "geran"), ("Group RAN2, or CT3", "RAN2"), ("sa3-li", "SA3-LI"), ("", ""), ("SA3-LI plus", "SA3-LI"),
          ("no digits", "no digits"), ("\tspaced\u00a0", "spaced"), ("ct1-x9", "CT1-X"), ("RAN", "RAN"), (None, "")]


def test_parse_working_group(spark):
    got = one(spark, P.parse_working_group("s"), "s string", [(p,) for p, _ in GROUPS])
    assert got == [want for _, want in GROUPS]


def test_score_working_group_explanation(spark):
    s = SC.score_working_group(F.col("c"), F.col("t"))
    rows = spark.createDataFrame([("sa1 it is", "SA1"), ("", "")], "c string, t string") \
        .select(s["value"], s["explanation"]).collect()
    assert rows[0][0] == 1.0 and rows[0][1] == "Predicted: SA1, Ground Truth: SA1. Match: True"
    # both sides empty counts as correct
    assert rows[1][0] == 1.0 and rows[1][1] == "Predicted: , Ground Truth: . Match: True"


def test_parse_choice_last_valid_letter(spark):
    rows = [("First ANSWER: D\nthen ANSWER: b", ["x", "y", "z", "w"]),
            ("ANSWER: E", ["x", "y", "z", "w"]),
            ("answer : (c)", ["x", "y", "z"]),
            ("I am not sure.", ["x"]),
            ("ANSWER: AB", ["x", "y"]),
            (None, ["x"])]
    got = one(spark, P.parse_choice("c", "ch"), "c string, ch array<string>", rows)
    assert got == ["B", "", "C", "", "", ""]


def test_score_choice_perfect_completion_is_one(spark):
    s = SC.score_choice(F.concat(F.lit("ANSWER: "), F.col("t")), F.col("ch"), F.col("t"))
    got = spark.createDataFrame([("C", ["a", "b", "c"])], "t string, ch array<string>").select(s["value"]).first()[0]
    assert got == 1.0


def test_parse_judge_grade(spark):
    rows = [("Step. $FINAL_SCORE: 87.5",), ("$final_score : 3",), ("No score.",), ("$FINAL_SCORE: -4",),
            ("$FINAL_SCORE: 1 then $FINAL_SCORE: 9",), ("$FINAL_SCORE:\u00a085",), ("$FINAL_SCORE\u202f:\u2003 7",)]
    got = one(spark, P.parse_judge_grade("s"), "s string", rows)
    assert got == [87.5, 3.0, None, None, 1.0, 85.0, 7.0]
    assert one(spark, P.parse_judge_grade("s", r"GRADE=(\d+)"), "s string", [("GRADE=4",), ("$FINAL_SCORE: 1",)]) == [4.0, None]


#: text -> whether the whole of it is one JSON object, as a strict reader that takes NaN sees it
JSON_TEXTS = [('{"a":1}', True), (' \n{"a":1} ', True), ('{"a":NaN,"b":-Infinity}', True), ('{"a":1,"a":2}', True), ("{}", True), ('{"a":1} x', False),
              ('{"a":1},{"b":2}', False), ('{"a":1}]', False), ('{"a":1}}', False), ('{"a":1', False), ("{'a':1}", False), ("[1]", False), ("1", False), ("null", False),
              ("", False), ('{"a":1,}', False), ('{"a":01}', False), (None, False), ('{"a":"x\ty"}', False), ('{"a":"\\u00e9"}', True)]


def test_json_objects(spark):
    got = one(spark, P.is_json_object("s"), "s string", [(t,) for t, _ in JSON_TEXTS])
    assert got == [want for _, want in JSON_TEXTS]
    last = one(spark, P.json_object("s", "a: bigint, b: string"), "s string", [('{"a":1,"a":2,"b":"x"}',), ('{"a":1.0,"b":NaN}',), ('{"a":"3","b":[1]}',)])
    assert [(r.a, r.b) for r in last] == [(2, "x"), (None, '"NaN"'), (None, "[1]")]


def test_score_judge_json(spark):
    rows = [('{"overall_score": 7, "reasoning": "fine", "is_safe": true}',),
            ('Here:\n{"overall_score": 7.5,\n"reasoning": "x"}\nbye',),
            ('{"reasoning": "no score"}',), ('{"overall_score": 7,',), ("plain",), ('{"overall_score": "6"}',),
            ("[1, 2]",)]
    rows += [('{"overall_score": 2, "overall_score": 9}',), ('{"confidence": NaN, "overall_score": 3, "reasoning": "n"}',), ('{"overall_score": 1} or {"overall_score": 2}',)]
    out = score_judge_json_table(spark.createDataFrame(rows, "judge_output string"), []).collect()
    assert [r.value for r in out] == [7.0, 7.5, 0.0, 0.0, 0.0, 6.0, 0.0, 9.0, 3.0, 0.0]
    assert out[0].explanation == "fine" and out[3].explanation == 'Failed to parse JSON: {"overall_score": 7,' and out[7].explanation == rows[7][0]
    assert [r.parsed for r in out] == [True, True, True, False, False, True, False, True, True, False]


def test_parsers_stay_in_the_jvm(spark):
    df = spark.createDataFrame([("x", ["a"], "A")], "c string, ch array<string>, t string")
    s = SC.score_choice("c", "ch", "t")
    plan = df.select(s["value"], P.parse_boxed("c"), P.parse_working_group("c"), P.parse_judge_grade("c"),
                     P.parse_judge_json("c")["overall_score"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan
