"""Evaluation-shaped tables derived from the driver's TPC-H-like parquet.

Each fixture is plain SQL accepted by Spark and by DuckDB (the oracle
swaps ``array(`` for ``list_value(``). Spark plans read them through
``fixture()``; oracle statements are wrapped by ``with_fixtures()``.
Every fixture is computed from the base tables, so its size follows the
scale factor.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

FIXTURE_SQL: dict[str, str] = {}

FIXTURE_SQL["fx_samples"] = """
select p_partkey as sample_id, cast(p_partkey as int) as ord,
  concat('Which label fits part ', p_name, '?') as question,
  array(p_brand, p_type, p_name, concat('size ', cast(p_size as string))) as choices,
  cast(p_partkey % 4 as int) as answer, cast(p_partkey % 4 as string) as index_str,
  case p_partkey % 5 when 0 then 'Research Overview' when 1 then 'Standards Overview'
    when 2 then 'Research Publications' when 3 then 'Standards Specification' end as subject
from part
"""

FIXTURE_SQL["fx_completions"] = """
select sample_id, model, cast(epoch as int) as epoch,
  case when r = 5 then 'I am not sure.'
    else concat('First guess ANSWER: D', chr(10), 'After checking, ANSWER:', case when r = 4 then ' ' else ' ' end,
      chr(cast(65 + case when r <= 2 then sample_id % 4 when r = 3 then (sample_id + 1) % 4 else s % 4 end as int)))
  end as completion
from (select l_partkey as sample_id, l_suppkey as s,
    concat('lab/model-', cast(l_suppkey % 2 as string)) as model,
    (l_linenumber + cast(l_quantity as int)) % 6 as r,
    row_number() over (partition by l_partkey, l_suppkey % 2
      order by l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_quantity) as epoch
  from lineitem) x
"""

FIXTURE_SQL["fx_math"] = """
select o_orderkey as sample_id, concat('Compute value for order ', cast(o_orderkey as string)) as question,
  cast(o_custkey as string) as answer, o_orderstatus as category,
  array(o_orderstatus, o_orderpriority) as tags,
  case o_orderpriority when '1-URGENT' then 'advanced' when '2-HIGH' then 'intermediate' else 'basic' end as difficulty,
  case o_orderkey % 7
    when 0 then concat('so $', chr(92), 'boxed{', cast(o_custkey as string), '}$')
    when 1 then concat(chr(92), 'boxed{0} then ', chr(92), 'boxed{', cast(o_custkey as string), '}')
    when 2 then concat(chr(92), 'boxed{:', cast(o_custkey as string), './}')
    when 3 then concat(chr(92), 'boxed{', chr(92), 'text{', cast(o_custkey as string), '}}')
    when 4 then concat(chr(92), 'boxed{ ', cast(o_custkey as string), chr(10), '  }')
    when 5 then concat('answer ', cast(o_custkey as string), ' not boxed')
    else concat(chr(92), 'boxed{', cast(o_custkey + 1 as string), '}') end as completion
from orders
"""

FIXTURE_SQL["fx_working_group"] = """
select c_custkey as sample_id,
  case c_nationkey % 5 when 0 then 'SA1' when 1 then 'RAN2' when 2 then 'CT3' when 3 then 'SA3-LI' else 'GERAN' end as target,
  case c_custkey % 5
    when 0 then 'The group is sa1.' when 1 then '  geran ' when 2 then 'Group RAN2, or CT3'
    when 3 then 'sa3-li' else '' end as completion
from customer
"""

FIXTURE_SQL["fx_judge"] = """
select o_orderkey as sample_id, judge_model,
  case when (o_orderkey + off) % 11 = 0 then 'No score given.'
    when (o_orderkey + off) % 11 = 2 then concat('$FINAL_SCORE: ', cast((o_custkey + off) % 90 as string))
    when (o_orderkey + off) % 11 = 3 then concat('$FINAL_SCORE : ', cast((o_custkey + off) % 80 as string), ' points')
    when (o_orderkey + off) % 11 = 1 then concat('$final_score : ', cast((o_custkey + off) % 101 as string))
    else concat('Step by step. $FINAL_SCORE: ', cast((o_custkey + off) % 100 as string), '.5') end as judge_output
from orders cross join (values ('judge-a', 0), ('judge-b', 7)) as j(judge_model, off)
"""

FIXTURE_SQL["fx_judge_json"] = """
select o_orderkey as sample_id,
  case o_orderkey % 9
    when 0 then concat('{"overall_score": ', cast(o_custkey % 10 + 1 as string), ', "confidence": 5, "is_safe": true, "reasoning": "ok"}')
    when 4 then concat('{"overall_score": 3, "overall_score": ', cast(o_custkey % 7 as string), ', "reasoning": "key given twice"}')
    when 5 then concat('{"confidence": NaN, "overall_score": ', cast(o_custkey % 8 as string), ', "reasoning": "not a number"}')
    when 6 then '{"overall_score": 5, "reasoning": "one"} and {"overall_score": 6}'
    when 7 then concat('{"overall_score": "', cast(o_custkey % 9 as string), '.5", "is_safe": false} and that is all.')
    when 1 then concat('Here it is:', chr(10), '{"overall_score": ', cast(o_custkey % 10 + 1 as string), ',', chr(10), '"reasoning": "two lines"}', chr(10), 'bye')
    when 2 then '{"reasoning": "no score key"}'
    when 3 then '{"overall_score": 7,'
    else 'plain text' end as judge_output
from orders
"""

FIXTURE_SQL["fx_yaml_tasks"] = """
select s_suppkey as sample_id, concat('Make a config for ', s_name) as Question,
  '5G core' as main_category,
  case s_suppkey % 3 when 0 then 'AMF Configuration' when 1 then 'Slice Deployment' else 'UE Provisioning' end as category,
  concat('nation ', cast(s_nationkey as string), ' {category}') as context
from supplier
"""

FIXTURE_SQL["fx_slice_yaml"] = """
select sample_id, f, req_sst, req_sd, req_region, concat('slice-embb-app', req_sd) as req_name,
  concat('apiVersion: v1', chr(10), 'kind: ', case when f = 6 then 'Slice' else 'NetworkSlice' end, chr(10),
    'metadata:', chr(10), '  name: slice-embb-app', req_sd, chr(10), '  labels:', chr(10),
    '    region: ', case when f = 5 then 'dc-x' else req_region end, chr(10),
    case when f = 2 then concat('spec: [unclosed', chr(10)) else concat('spec:', chr(10),
    '  sst: ', cast(req_sst as string), chr(10),
    case when f = 1 then '' else concat('  sd: "', req_sd, '"', chr(10)) end,
    '  uplink_throughput: ', case when f = 3 then '50' else '50Mbps' end, chr(10),
    '  downlink_throughput: 100Mbps', chr(10),
    '  max_latency: ', case when f = 7 then '1s' else '10ms' end, chr(10),
    '  ue_density: ', case when f = 4 then 'HIGH' else 'high' end, chr(10)) end) as submission
from (select c_custkey as sample_id, c_custkey % 8 as f, 1 as req_sst,
    concat('00000', cast(c_custkey % 9 + 1 as string)) as req_sd,
    concat('dc-', cast(c_nationkey as string)) as req_region from customer) x
"""

# AMF configs; f (0-5): 0 none; 1 ngap port 38413; 2 no nrf root key;
# 3 mcc unquoted in all three plmn ids; 4 wrong tac; 5 code fence around it.
FIXTURE_SQL["fx_amf_yaml"] = """
select sample_id, f, req_tac, req_mcc, req_mnc,
  concat(case when f = 5 then concat('```yaml', chr(10)) else '' end,
    'amf:', chr(10),
    '  sbi:', chr(10), '    server:', chr(10), '      - address: 127.0.0.6', chr(10), '        port: 7777', chr(10),
    '  ngap:', chr(10), '    server:', chr(10), '      - address: 192.168.', cast(sample_id % 200 as string), '.1', chr(10),
    '        port: ', case when f = 1 then '38413' else '38412' end, chr(10),
    '  guami:', chr(10), '    - plmn_id:', chr(10),
    '        mcc: ', case when f = 3 then req_mcc else concat('"', req_mcc, '"') end, chr(10),
    '        mnc: "', req_mnc, '"', chr(10),
    '  tai:', chr(10), '    - plmn_id:', chr(10),
    '        mcc: ', case when f = 3 then req_mcc else concat('"', req_mcc, '"') end, chr(10),
    '        mnc: "', req_mnc, '"', chr(10),
    '      tac: ', case when f = 4 then cast(req_tac + 1 as string) else cast(req_tac as string) end, chr(10),
    '  plmn_support:', chr(10), '    - plmn_id:', chr(10),
    '        mcc: ', case when f = 3 then req_mcc else concat('"', req_mcc, '"') end, chr(10),
    '        mnc: "', req_mnc, '"', chr(10),
    '  security:', chr(10), '    integrity_order: [NIA2, NIA1, NIA0]', chr(10),
    '    ciphering_order: [NEA2, NEA1, NEA0]', chr(10),
    case when f = 2 then '' else concat('nrf:', chr(10), '  sbi:', chr(10), '    server:', chr(10),
      '      - address: 192.168.', cast(sample_id % 200 as string), '.2', chr(10), '        port: 7777', chr(10)) end,
    case when f = 5 then concat('```', chr(10)) else '' end) as submission
from (select c_custkey as sample_id, c_custkey % 6 as f, cast(c_custkey % 90 + 1 as int) as req_tac,
    cast(200 + c_nationkey as string) as req_mcc, concat('0', cast(c_nationkey % 10 as string)) as req_mnc
  from customer) x
"""

# Subscriber profiles; f (0-4): 0 none; 1 k too short; 2 msisdn unquoted;
# 3 no slice list; 4 wrong imsi.
FIXTURE_SQL["fx_sub_yaml"] = """
select sample_id, f, req_imsi, req_sd,
  concat('imsi: "', case when f = 4 then concat(req_imsi, '9') else req_imsi end, '"', chr(10),
    'msisdn: ', case when f = 2 then msisdn else concat('"', msisdn, '"') end, chr(10),
    'security:', chr(10),
    '  k: ', case when f = 1 then '465B5CE8' else '465B5CE8B199B49FAA5F0A2EE238A6BC' end, chr(10),
    '  opc: E8ED289DEBA952E4283B54E88E6183CA', chr(10),
    '  amf: "8000"', chr(10),
    'subscribed_rau_tau_timer: 12', chr(10),
    'network_access_mode: 0', chr(10),
    'subscriber_status: 0', chr(10),
    'access_restriction_data: 32', chr(10),
    case when f = 3 then '' else concat('slice:', chr(10), '  - sst: 1', chr(10),
      '    sd: "', req_sd, '"', chr(10), '    default_indicator: true', chr(10)) end) as submission
from (select c_custkey as sample_id, c_custkey % 5 as f,
    concat('00101', lpad(cast(c_custkey as string), 10, '0')) as req_imsi,
    concat('8', lpad(cast(c_custkey as string), 10, '0')) as msisdn,
    concat('0000', cast(c_nationkey % 9 + 1 as string)) as req_sd
  from customer) x
"""

FIXTURE_SQL["fx_progress"] = """
select user_id as job_id, event_id as seq, ts, event_type, k,
  case event_type
    when 'signup' then concat('{"results":{"total_samples":100,"completed_samples":', cast(k as string), '}}')
    when 'purchase' then concat('{"progress":{"total":', cast(100 + k % 3 as string), ',"completed":', cast(k as string), '}}')
    when 'view' then concat('{"sample":{"index":', cast(k as string), ',"total":100}}')
    when 'click' then concat('{"event":"sample_complete","accuracy":', case when event_id % 3 = 0 then 'NaN' else '0.5' end, ',"completed":',
      case when event_id % 4 = 0 then '1,"completed":' else '' end, cast(k as string), '}', case when event_id % 10 = 0 then ' done' else '' end)
    else 'INFO not json' end as line
from (select user_id, event_id, ts, event_type,
    cast(replace(replace(props, '{"k": ', ''), '}', '') as int) as k from events) e
"""

FIXTURE_SQL["fx_jobs"] = """
select concat('run-', cast(user_id % 20 as string)) as run_id, user_id as job_id,
  concat('lab/model-', cast(user_id % 4 as string)) as model,
  case when user_id % 3 = 0 then '' else concat('Label ', cast(user_id % 4 as string)) end as label,
  case when user_id % 4 = 3 then null else concat('provider-', cast(user_id % 4 as string)) end as provider,
  case when user_id % 5 = 0 then 1 else 0 end as returncode,
  user_id % 7 = 0 as cancel_requested,
  case when user_id % 20 = 1 then 'complete' when user_id % 20 = 2 then 'queued'
    when user_id % 20 = 3 then 'cancelled' when user_id % 20 = 4 then 'cancelling'
    when user_id % 5 = 0 then 'failed' when user_id % 3 = 0 then 'running' else 'complete' end as status,
  min(ts) as started_at, max(ts) as last_update
from events group by user_id
"""

# Runs: 25 run ids over the same users, so runs 20-24 have no jobs.
FIXTURE_SQL["fx_runs"] = """
select concat('run-', cast(user_id % 25 as string)) as run_id,
  case user_id % 25 % 3 when 0 then 'telemath' when 1 then 'teleqna' else 'telelogs' end as task,
  min(ts) as created_at
from events group by user_id % 25
"""

# Requested task names (aliases included) per job.
FIXTURE_SQL["fx_task_requests"] = """
select user_id as job_id,
  case user_id % 6 when 0 then 'telemath' when 1 then 'teleqna' when 2 then 'telelogs'
    when 3 then 'teleqna_bench' when 4 then 'telelogs_bench' else 'telemath' end as requested_task
from events group by user_id
"""

# Submissions to the configuration tasks; a literal {Question} must survive rendering.
FIXTURE_SQL["fx_yaml_answers"] = """
select s_suppkey as sample_id, concat('Make a config for ', s_name) as question,
  case s_suppkey % 3 when 0 then 'AMF Configuration' when 1 then 'Slice Deployment' else 'UE Provisioning' end as category,
  concat('kind: NetworkSlice # for {Question} of ', s_name) as answer,
  concat('expected config ', cast(s_suppkey as string)) as target
from supplier
"""


# Reference configs: the same documents without a fault.
FIXTURE_SQL["fx_slice_truth"] = FIXTURE_SQL["fx_slice_yaml"].replace("c_custkey % 8 as f", "0 as f")
FIXTURE_SQL["fx_amf_truth"] = FIXTURE_SQL["fx_amf_yaml"].replace("c_custkey % 6 as f", "0 as f")
FIXTURE_SQL["fx_sub_truth"] = FIXTURE_SQL["fx_sub_yaml"].replace("c_custkey % 5 as f", "0 as f")


def spread(df, min_partitions: int | None = None):
    """Round-robin ``df`` over the cluster's cores when it arrives in fewer
    partitions (e.g. one large single-row-group file); a no-op for inputs that
    are already split, which is the normal case on a cluster."""
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(want) if df.rdd.getNumPartitions() < want else df


def register_tables(spark: SparkSession, sf_dir: str) -> None:
    """Register the driver's parquet tables as temp views (lazy scans)."""
    for t in TABLES:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table; single-split files are spread over the cores so row-wise
    work before the first shuffle is not serial."""
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The fixture as a DataFrame; its plan is bound to ``sf_dir`` at call time.
    Base tables are passed as DataFrame arguments, so no session-wide view
    is touched."""
    sql = FIXTURE_SQL[name].replace("{", "{{").replace("}", "}}")
    used = [t for t in TABLES if re.search(rf"\b(from|join)\s+{t}\b", sql)]
    for t in used:
        sql = re.sub(rf"\b(from|join)(\s+){t}\b", rf"\1\2{{{t}}}", sql)
    return spark.sql(sql, **{t: table(spark, sf_dir, t) for t in used})


def with_fixtures(sql: str, *names: str) -> str:
    """Prefix an oracle statement with the fixtures it reads, DuckDB dialect."""
    ctes = ",\n".join(f"{n} as ({FIXTURE_SQL[n].replace('array(', 'list_value(')})" for n in names)
    return f"with {ctes}\n{sql}"
