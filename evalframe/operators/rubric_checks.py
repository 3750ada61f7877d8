"""Rubrics as data: a table of checks and a table of bands, read by one plan. A new rubric is rows, not code.

A *check* belongs to a criterion of a rubric and holds if all its conditions hold. A condition names a path of the submission, a predicate and an
operand (text; lists and ranges as JSON):

    exists                  the node is there
    eq                      its value is the operand
    eq_reference            its value is the reference's at this path
    eq_path                 its value is the value at the path in the operand
    eq_task                 its value is the task input named by the operand
    eq_task_loosely         the same up to case and leading zeros
    one_of, one_of_any_case its value is in the list
    matches, ends_with      regular expression (found anywhere), suffix
    type_is, type_is_not    its type is, or is not, in the list (a node that isn't there is of no type)
    type_as_reference       its type is the reference's, or one of the two isn't there
    between                 an integer in the range [low, high]

The path ``$status`` stands for the document's state: valid, minor or unparseable. A *band* says how many checks of a criterion earn how
many points; a check with a ``level`` counts for the band of these points only, others count for all. A criterion earns the most points of the bands
it reaches, else 1; an unparseable document earns 1 everywhere.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evalframe.operators import rubric as RB

CHECKS = "rubric string, criterion string, level int, check int, path string, predicate string, operand string"
BANDS = "rubric string, criterion string, points int, need int"
STATUS = "$status"
FLOOR = 1
#: Rows of a check table that are broadcast; a larger one is joined as the planner sees fit.
MOST_BROADCAST = 100_000


# ---- the suite's three rubrics as rows ----------------------------------------------------------

def _rows(key: str, criteria: dict[str, tuple[Iterable, dict[int, int]]]) -> tuple[list, list]:
    """``criteria``: id -> (checks, {points: need}); a check is (level, [(path, predicate, operand)])."""
    checks, bands = [], []
    for criterion, (listed, need) in criteria.items():
        for no, (level, conditions) in enumerate(listed):
            checks += [(key, criterion, level, no, *c) for c in conditions]
        bands += [(key, criterion, points, n) for points, n in need.items()]
    return checks, bands


def _each(paths: Sequence[str], predicate: str, operand: str | None = None) -> list:
    """One check of one condition for each path."""
    return [(None, [(p, predicate, operand)]) for p in paths]


def _band(checks: list, for5: int, for3: int) -> tuple[list, dict[int, int]]:
    return checks, {5: for5, 3: for3}


def _levels(five: list, three: list) -> tuple[list, dict[int, int]]:
    """A criterion of one check for 5 points and another for 3."""
    return [(5, five), (3, three)], {5: 1, 3: 1}


_S1 = _levels([(STATUS, "eq", "valid")], [(STATUS, "one_of", '["valid", "minor"]')])


def _types(leaves: Sequence[str]):
    return _band(_each(leaves, "type_as_reference"), len(leaves), len(leaves) - 2)


def _near(path: str, port: int):
    return _levels([(path, "between", f"[{port}, {port}]")], [(path, "between", f"[{port - 2}, {port + 2}]")])


# ---- fixed values: the three rubrics' criteria (paths, constants and bands of ``rubric``) ----
_SPEC = "spec.{}".format
SLICE_ROWS = _rows("slice_deployment", {
    "S1": _S1,
    "S2": _band(_each(RB.SLICE_ROOT, "exists"), 4, 2),
    "S3": _band(_each(RB.SLICE_SPEC, "exists"), 6, 4),
    "S4": _types(RB.SLICE_LEAVES),
    "G1": _band(_each(["apiVersion", "kind"], "eq_reference"), 2, 1),
    "G2": _band(_each([_SPEC("sst"), _SPEC("sd")], "eq_reference"), 2, 1),
    "G3": _band(_each([_SPEC("uplink_throughput"), _SPEC("downlink_throughput")], "eq_reference"), 2, 1),
    "G4": _band(_each([_SPEC("max_latency"), _SPEC("ue_density")], "eq_reference"), 2, 1),
    "G5": _band(_each(["metadata.name", "metadata.labels.region"], "eq_reference"), 2, 1),
    "T1": _levels([(_SPEC("sst"), "type_is", '["int"]'), (_SPEC("sst"), "eq_task", "sst")], [(_SPEC("sst"), "type_is", '["int"]'), (_SPEC("sst"), "one_of", '["1", "2", "3", "4"]')]),
    "T2": _levels([(_SPEC("sd"), "eq_task", "sd")], [(_SPEC("sd"), "eq_task_loosely", "sd")]),
    "T3": _levels([("metadata.labels.region", "eq_task", "region")], [("metadata.labels.region", "exists", None)]),
    "F1": _band([(None, [(_SPEC(p), "type_is", '["str"]'), (_SPEC(p), "ends_with", "Mbps")]) for p in ("uplink_throughput", "downlink_throughput")], 2, 1),
    "F2": _levels([(_SPEC("max_latency"), "type_is", '["str"]'), (_SPEC("max_latency"), "ends_with", "ms")],
                  [(_SPEC("max_latency"), "matches", r"^\s*[0-9]+(\.[0-9]+)?\s*[A-Za-z]+\s*$")]),
    "F3": _levels([(_SPEC("ue_density"), "one_of", '["high", "low"]')], [(_SPEC("ue_density"), "one_of_any_case", '["high", "low"]')]),
    "F4": _levels([("metadata.name", "matches", "^slice-[a-z]+-.+")], [("metadata.name", "matches", "^slice-")]),
})
_MCC, _MNC = ([f"{p}.{k}" for p in RB.AMF_PLMN] for k in ("mcc", "mnc"))
AMF_ROWS = _rows("amf_configuration", {
    "S1": _S1,
    "S2": _band(_each(RB.AMF_ROOT, "exists"), 2, 1),
    "S3": _band(_each(RB.AMF_NESTED, "exists"), 7, 4),
    "S4": _types(RB.AMF_LEAVES),
    "G1": _band([(None, [("amf.sbi.server[0].address", "eq", RB.AMF_SBI_ADDRESS)]), (None, [("amf.sbi.server[0].port", "between", f"[{RB.AMF_SBI_PORT}, {RB.AMF_SBI_PORT}]")])], 2, 1),
    "G2": _near("amf.ngap.server[0].port", RB.AMF_NGAP_PORT),
    "G3": _near("nrf.sbi.server[0].port", RB.NRF_SBI_PORT),
    "G4": _band([(None, [("amf.security.integrity_order", "eq", RB.json.dumps(RB.AMF_INTEGRITY_ORDER))]), (None, [("amf.security.ciphering_order", "eq", RB.json.dumps(RB.AMF_CIPHERING_ORDER))])], 2, 1),
    "G5": _band([(None, [("amf.tai[0].tac", "eq_task", "tac")]), (None, [(p, "eq_task", "mcc") for p in _MCC]), (None, [(p, "eq_task", "mnc") for p in _MNC])], 3, 1),
    "F1": _band(_each([*_MCC, *_MNC], "type_is", '["str"]'), 6, 3),
    "F2": _band([(None, [(p[i], "eq_path", p[0]) for p in (_MCC, _MNC) for i in (1, 2)]), (None, [(p, "matches", r"^192\.168\.[0-9]{1,3}\.[0-9]{1,3}$") for p in RB.AMF_ADDRESSES])], 2, 1),
})
SUBSCRIBER_ROWS = _rows("ue_provisioning", {
    "S1": _S1,
    "S2": _band(_each(RB.SUB_ROOT, "exists"), 8, 5),
    "S3": _band(_each(RB.SUB_NESTED, "exists"), 6, 4),
    "S4": _types(RB.SUB_LEAVES),
    "G1": _band(_each(["imsi", "msisdn"], "eq_reference"), 2, 1),
    "G2": _band(_each([f"security.{k}" for k in ("k", "opc", "amf")], "eq_reference"), 3, 1),
    "G3": _band(_each([f"slice[0].{k}" for k in ("sst", "sd", "default_indicator")], "eq_reference"), 3, 1),
    "G4": _band(_each(RB.SUB_FIXED, "eq_reference"), 4, 2),
    "G5": _band([(None, [("imsi", "eq_task", "imsi")]), (None, [("slice[0].sd", "eq_task", "sd")])], 2, 1),
    "F1": _band(_each(["security.k", "security.opc"], "matches", "^[0-9A-Fa-f]{32}$"), 2, 1),
    "F2": _band(_each(RB.SUB_NUMERIC_STRINGS, "type_is_not", '["int", "float"]'), 3, 2),
})
# ---- end of fixed values ----


def suite_checks(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """The check and band tables of the suite's three rubrics."""
    parts = (SLICE_ROWS, AMF_ROWS, SUBSCRIBER_ROWS)
    return spark.createDataFrame([r for c, _ in parts for r in c], CHECKS), spark.createDataFrame([r for _, b in parts for r in b], BANDS)


# ---- the plan ----------------------------------------------------------------------------------

def _holds(c: Column) -> Column:
    """A condition on the row's nodes; an unknown predicate fails the query."""
    path, predicate, operand = c["path"], c["predicate"], c["operand"]
    node, truth = F.try_element_at(F.col("s_nodes"), path), F.try_element_at(F.col("t_nodes"), path)
    value, kind = F.when(path == STATUS, F.col("s_status")).otherwise(node["value"]), node["vtype"]
    task = F.try_element_at(F.col("_task"), operand)
    loose = lambda x: F.lower(F.regexp_replace(x, "^0+", ""))
    listed, span = c["listed"], c["span"]
    number = F.when(kind == "int", value.try_cast("bigint"))
    rules = {"type_as_reference": ~F.coalesce(kind != truth["vtype"], F.lit(False)), "exists": kind.isNotNull(), "eq_reference": value == truth["value"], "eq_task": value == task,
             "type_is": F.array_contains(listed, kind), "matches": F.regexp_like(value, operand), "eq_path": value == F.try_element_at(F.col("s_nodes"), operand)["value"],
             "eq": value == operand, "type_is_not": ~F.coalesce(F.array_contains(listed, kind), F.lit(False)), "ends_with": F.endswith(value, operand),
             "between": number.between(F.try_element_at(span, F.lit(1)), F.try_element_at(span, F.lit(2))), "one_of": F.array_contains(listed, value),
             "one_of_any_case": F.array_contains(listed, F.lower(value)), "eq_task_loosely": loose(value) == loose(task)}  # the usual ones first: they are tried in turn
    out = F.when(predicate.isNull(), F.raise_error(F.lit("a condition without a predicate")).cast("boolean"))
    for name, rule in rules.items():
        out = out.when(predicate == name, rule)
    return F.coalesce(out.otherwise(F.when(~predicate.isin(*rules), F.raise_error(F.concat(F.lit("unknown predicate "), predicate)).cast("boolean"))), F.lit(False))


def score_by_checks(configs: DataFrame, checks: DataFrame, bands: DataFrame, task_cols: dict[str, str] | None = None, id_col: str | Sequence[str] = "sample_id",
                    submission_col: str = "submission", reference_col: str = "reference", rubric_col: str = "rubric") -> DataFrame:
    """Score each submission by the rubric its row names: id columns, rubric, ``status``, ``criteria`` (map id -> points), ``total`` and ``score`` (of 100).

    ``task_cols`` maps task inputs to columns. Rows of a rubric that has no checks or bands don't come out (``rubric_gaps`` finds such). Submission and reference are parsed
    once a row, for the paths that the checks name. A row meets its rubric's whole book (criteria, their checks and bands: one row a rubric) in a broadcast join and stays one row;
    what is shuffled is one flag a check, so neither texts nor nodes leave their task. Rows of the same id columns, rubric and status count together."""
    keys = [id_col] if isinstance(id_col, str) else list(id_col)
    lists = ["one_of", "one_of_any_case", "type_is", "type_is_not"]
    condition = F.struct("path", "predicate", "operand", F.when(F.col("predicate").isin(lists), F.from_json("operand", "array<string>")).alias("listed"),
                         F.when(F.col("predicate") == "between", F.from_json("operand", "array<bigint>")).alias("span"))
    rules = checks.join(bands, ["rubric", "criterion"], "left_semi").groupBy("rubric", "criterion", "level", "check").agg(F.collect_list(condition).alias("conditions"))
    # Checks of a criterion and level count together: a slot, with a place among its rubric's slots. A band counts the slots of its points and those without a level.
    slots = rules.groupBy("rubric", "criterion", "level").agg(F.collect_list("conditions").alias("checks")) \
        .withColumn("at", F.row_number().over(Window.partitionBy("rubric").orderBy("criterion", "level")) - 1)
    tests = slots.groupBy("rubric").agg(F.sort_array(F.collect_list(F.struct("at", "checks"))).alias("_slots"))
    counted = F.transform("bands", lambda b: F.struct(b["points"].alias("points"), b["need"].alias("need"), F.transform(F.filter(
        "levels", lambda s: s["level"].isNull() | (s["level"] == b["points"])), lambda s: s["at"]).alias("at")))
    book = slots.groupBy("rubric", "criterion").agg(F.collect_list(F.struct("at", "level")).alias("levels")) \
        .join(bands.groupBy("rubric", "criterion").agg(F.collect_list(F.struct("points", "need")).alias("bands")), ["rubric", "criterion"]) \
        .groupBy("rubric").agg(F.sort_array(F.collect_list(F.struct("criterion", counted.alias("bands")))).alias("_book"))
    most = bands.groupBy("rubric", "criterion").agg(F.max("points").alias("p")).groupBy("rubric").agg(F.sum("p").alias("_most"))
    paths = [r[0] for r in checks.select("path").union(checks.where("predicate = 'eq_path'").select("operand")).distinct().limit(MOST_BROADCAST + 1).collect()]  # a rubric's paths
    if len(paths) > MOST_BROADCAST:
        raise ValueError(f"more than {MOST_BROADCAST} paths in a check table")
    task = F.create_map(*[x for k, c in (task_cols or {}).items() for x in (F.lit(k), F.col(c).cast("string"))]) if task_cols else F.create_map().cast("map<string,string>")
    docs = configs.select(*keys, F.col(rubric_col).alias("rubric"), submission_col, reference_col, task.alias("_task"))
    docs = RB.node_maps(docs, {"s": submission_col, "t": reference_col}, sorted(p for p in paths if p and p != STATUS), keep_text=False)
    small = rules.count() <= MOST_BROADCAST
    met = docs.join(F.broadcast(tests) if small else tests, "rubric")
    held = met.select(*keys, "rubric", F.col("s_status").alias("status"), F.transform("_slots", lambda s: F.size(F.filter(s["checks"], lambda c: F.forall(c, _holds)))).alias("_held"))
    seen = held.groupBy(*keys, "rubric", "status").agg(F.collect_list("_held").alias("_seen"))
    both = F.reduce(F.slice("_seen", F.lit(2), F.size("_seen")), F.element_at("_seen", 1), lambda n, more: F.zip_with(n, more, lambda x, y: x + y))
    known = seen.select(*keys, "rubric", "status", both.alias("_n")).join(F.broadcast(book) if small else book, "rubric")

    def points(c: Column) -> Column:
        """The most points of the criterion's bands that are reached."""
        n = lambda b: F.reduce(b["at"], F.lit(0), lambda n, at: n + F.get("_n", at))
        best = F.reduce(c["bands"], F.lit(None).cast("int"), lambda p, b: F.when(n(b) >= b["need"], F.greatest(p, b["points"])).otherwise(p))
        return F.coalesce(F.when(F.col("status") != "unparseable", best), F.lit(FLOOR))

    # the joins keep the planner from working out flags and marks again wherever they are read
    marks = known.withColumn("_marks", F.transform("_book", lambda c: F.struct(c["criterion"].alias("criterion"), points(c).alias("points")))) \
        .select(*keys, "rubric", "status", F.map_from_entries("_marks").alias("criteria"), F.reduce("_marks", F.lit(0).cast("bigint"), lambda n, m: n + m["points"]).cast("int").alias("total"))
    out = marks.join(F.broadcast(most) if small else most, "rubric")
    return out.select(*keys, "rubric", "status", "criteria", "total", (F.col("total") * F.lit(100.0) / F.col("_most")).alias("score"))
