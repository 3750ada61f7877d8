"""Plans for rubric files, rubric joins and rule-based rubric scoring
(SURVEY 2.1 scan_rubrics, 2.4 join_rubrics / rubric_gaps, 2.9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from evalframe.fixtures import fixture
from evalframe.functions import scalars as S
from evalframe.operators import rubric as RB
from evalframe.operators import rubric_checks as RC
from evalframe.operators import samples as SM
from evalframe.plans.registry import plan
from evalframe.plans.sample_plans import rubric_values_sql
from evalframe.session import work_dir
from evalframe.sources import logs as LG


@plan("scan_rubrics", f"""
select rb.category_key, rb.rubric || chr(10) as rubric from {rubric_values_sql()}
where rb.category_key in (select replace(lower(category), ' ', '_') from fx_yaml_tasks)""", ("fx_yaml_tasks",))
def q_scan_rubrics(spark, sf):
    keys = fixture(spark, sf, "fx_yaml_tasks").select(S.normalise_category("category").alias("category_key")).distinct()
    path = LG.write_rubrics(RB.rubric_table(spark).join(keys, "category_key", "left_semi"), work_dir(spark, "rubrics"))
    return LG.scan_rubrics(spark, path)


@plan("join_rubrics", f"""
select t.sample_id, t.category, rb.category_key, rb.rubric from fx_yaml_tasks t
join {rubric_values_sql()} on rb.category_key = replace(lower(t.category), ' ', '_')""", ("fx_yaml_tasks",))
def q_join_rubrics(spark, sf):
    t = fixture(spark, sf, "fx_yaml_tasks")
    return SM.join_rubrics(t, RB.rubric_table(spark)).select("sample_id", "category", "category_key", "rubric")


@plan("rubric_gaps", """
select distinct category, replace(lower(category), ' ', '_') as category_key from fx_yaml_tasks
where replace(lower(category), ' ', '_') not in ('slice_deployment', 'amf_configuration')""", ("fx_yaml_tasks",))
def q_rubric_gaps(spark, sf):
    # a rubric folder that lacks the subscriber rubric
    rubrics = RB.rubric_table(spark).filter(F.col("category_key") != "ue_provisioning")
    return SM.rubric_gaps(fixture(spark, sf, "fx_yaml_tasks"), rubrics)


def _configs(spark, sf, name, truth):
    """Submissions with their references. Both sides are texts made from a few small columns, so the planner's sizes say nothing about them: a merge join,
    or all references meet in the driver to be broadcast, in a number of tasks that stays, or texts that pack well meet in a few tasks to be parsed."""
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    sub = fixture(spark, sf, name).repartition(tasks, "sample_id")
    ref = fixture(spark, sf, truth).select("sample_id", F.col("submission").alias("reference")).repartition(tasks, "sample_id")
    return sub.join(ref.hint("merge"), "sample_id")


# Oracle: the node rows of each fault's document, written out path by path.
_FLAT_ROWS = [
    ("''", "null", "'map'", "true"),
    ("'apiVersion'", "'v1'", "'str'", "true"),
    ("'kind'", "case when f = 6 then 'Slice' else 'NetworkSlice' end", "'str'", "true"),
    ("'metadata'", "null", "'map'", "true"),
    ("'metadata.name'", "req_name", "'str'", "true"),
    ("'metadata.labels'", "null", "'map'", "true"),
    ("'metadata.labels.region'", "case when f = 5 then 'dc-x' else req_region end", "'str'", "true"),
    ("'spec'", "null", "'map'", "true"),
    ("'spec.sst'", "cast(req_sst as varchar)", "'int'", "true"),
    ("'spec.sd'", "req_sd", "'str'", "f <> 1"),
    ("'spec.uplink_throughput'", "case when f = 3 then '50' else '50Mbps' end",
     "case when f = 3 then 'int' else 'str' end", "true"),
    ("'spec.downlink_throughput'", "'100Mbps'", "'str'", "true"),
    ("'spec.max_latency'", "case when f = 7 then '1s' else '10ms' end", "'str'", "true"),
    ("'spec.ue_density'", "case when f = 4 then 'HIGH' else 'high' end", "'str'", "true"),
]
_FLAT_SQL = "\nunion all\n".join(
    f"select sample_id, 'valid' as status, {p} as path, {v} as value, {t} as vtype from fx_slice_yaml "
    f"where f <> 2 and {cond}" for p, v, t, cond in _FLAT_ROWS) + """
union all
select sample_id, 'unparseable', null, null, null from fx_slice_yaml where f = 2"""


@plan("flatten_yaml", _FLAT_SQL, ("fx_slice_yaml",))
def q_flatten_yaml(spark, sf):
    return RB.flatten_yaml(fixture(spark, sf, "fx_slice_yaml"))


def _scored(key, configs, task_cols):
    """Status, every criterion in order, total and score."""
    out = RB.score_rubric(key, configs, task_cols)
    marks = F.concat_ws(" ", *[F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c, _ in RB.RUBRICS[key].criteria])
    return out.select("sample_id", "status", marks.alias("criteria"), "total", F.round("score", 9).alias("score"))


def _marks_sql(key, faults, floor=()):
    """The criteria text per fault id: 5 unless the fault names another mark; every mark 1 for the faults in ``floor``."""
    ids = [c for c, _ in RB.RUBRICS[key].criteria]
    cases = " ".join(f"when {f} then '" + " ".join(f"{c}={1 if f in floor else m.get(c, 5)}" for c in ids) + "'" for f, m in faults.items())
    return f"case f {cases} end as criteria"


# Worked out by hand from the rubrics: the marks that each fault changes.
_SLICE_MARKS = _marks_sql("slice_deployment", {
    0: {}, 1: {"S3": 3, "G2": 3, "T2": 1}, 2: {}, 3: {"S4": 3, "G3": 3, "F1": 3}, 4: {"G4": 3, "F3": 3}, 5: {"G5": 3, "T3": 3}, 6: {"G1": 3},
    7: {"G4": 3, "F2": 3}}, floor=(2,))
_AMF_MARKS = _marks_sql("amf_configuration", {
    0: {}, 1: {"G2": 3}, 2: {"S2": 3, "S3": 3, "G3": 1, "F2": 3}, 3: {"S4": 1, "F1": 3}, 4: {"G5": 3}, 5: {"S1": 3}})
_SUB_MARKS = _marks_sql("ue_provisioning", {
    0: {}, 1: {"G2": 3, "F1": 3}, 2: {"S4": 3, "F2": 3}, 3: {"S2": 3, "S3": 1, "G3": 1, "G5": 3}, 4: {"G1": 3, "G5": 3}})


# Oracle by fault id: each fault's criterion scores worked out by hand from the rubric.
@plan("score_slice_rubric", f"""
select sample_id, case when f = 2 then 'unparseable' else 'valid' end as status, {_SLICE_MARKS}, cast(tot as int) as total,
  round(tot * 100.0 / 80, 9) as score
from (select sample_id, f, case f when 0 then 80 when 1 then 72 when 2 then 16 when 3 then 74 when 4 then 76
  when 5 then 76 when 6 then 78 else 76 end as tot from fx_slice_yaml) t""", ("fx_slice_yaml",))
def q_score_slice_rubric(spark, sf):
    c = _configs(spark, sf, "fx_slice_yaml", "fx_slice_truth")
    return _scored("slice_deployment", c, {"sst": "req_sst", "sd": "req_sd", "region": "req_region"})


@plan("score_amf_rubric", f"""
select sample_id, case when f = 5 then 'minor' else 'valid' end as status, {_AMF_MARKS}, cast(tot as int) as total,
  round(tot * 100.0 / 55, 9) as score
from (select sample_id, f, case f when 0 then 55 when 1 then 53 when 2 then 45 when 3 then 49 when 4 then 53
  else 53 end as tot from fx_amf_yaml) t""", ("fx_amf_yaml",))
def q_score_amf_rubric(spark, sf):
    c = _configs(spark, sf, "fx_amf_yaml", "fx_amf_truth")
    return _scored("amf_configuration", c, {"tac": "req_tac", "mcc": "req_mcc", "mnc": "req_mnc"})


@plan("score_subscriber_rubric", f"""
select sample_id, 'valid' as status, {_SUB_MARKS}, cast(tot as int) as total, round(tot * 100.0 / 55, 9) as score
from (select sample_id, f, case f when 0 then 55 when 1 then 51 when 2 then 51 when 3 then 43 else 51 end as tot
  from fx_sub_yaml) t""", ("fx_sub_yaml",))
def q_score_subscriber_rubric(spark, sf):
    c = _configs(spark, sf, "fx_sub_yaml", "fx_sub_truth")
    return _scored("ue_provisioning", c, {"imsi": "req_imsi", "sd": "req_sd"})


_ALL_MARKS = {"slice_deployment": ("fx_slice_yaml", _SLICE_MARKS, 80, "when 2 then 'unparseable' else 'valid'"), "amf_configuration": ("fx_amf_yaml", _AMF_MARKS, 55, "when 5 then 'minor' else 'valid'"),
              "ue_provisioning": ("fx_sub_yaml", _SUB_MARKS, 55, "when 99 then '' else 'valid'")}
_BY_CHECKS = " union all ".join(f"""
select sample_id, rubric, status, criteria, cast(total as int) as total, round(total * 100.0 / {most}, 9) as score from (select *, list_sum(list_transform(string_split(criteria, ' '),
  lambda x: cast(string_split(x, '=')[2] as int))) as total from (select sample_id, '{key}' as rubric, case f {status} end as status, {marks} from {table}) a) b"""
                                for key, (table, marks, most, status) in _ALL_MARKS.items())


@plan("score_rubric_checks", _BY_CHECKS, ("fx_slice_yaml", "fx_amf_yaml", "fx_sub_yaml"))
def q_score_rubric_checks(spark, sf):
    """Submissions of all three kinds in one table, scored by the rubrics' check rows."""
    inputs = {"slice_deployment": ("fx_slice_yaml", "fx_slice_truth"), "amf_configuration": ("fx_amf_yaml", "fx_amf_truth"), "ue_provisioning": ("fx_sub_yaml", "fx_sub_truth")}
    names = ["sst", "sd", "region", "tac", "mcc", "mnc", "imsi"]
    parts = []
    for key, tables in inputs.items():
        c = _configs(spark, sf, *tables)
        parts.append(c.select("sample_id", F.lit(key).alias("rubric"), "submission", "reference", *[(F.col(f"req_{n}") if f"req_{n}" in c.columns else F.lit(None)).cast("string").alias(n) for n in names]))
    out = RC.score_by_checks(parts[0].unionByName(parts[1]).unionByName(parts[2]), *RC.suite_checks(spark), task_cols={n: n for n in names})
    order = {k: F.array(*[F.lit(c) for c, _ in r.criteria]) for k, r in RB.RUBRICS.items()}
    ids = F.coalesce(*[F.when(F.col("rubric") == k, a) for k, a in order.items()])
    marks = F.array_join(F.transform(ids, lambda c: F.concat(c, F.lit("="), F.try_element_at("criteria", c).cast("string"))), " ")
    return out.select("sample_id", "rubric", "status", marks.alias("criteria"), "total", F.round("score", 9).alias("score"))
