"""Every registered plan against its DuckDB oracle on the smallest scale."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from evalframe import plans
from evalframe.fixtures import TABLES

KEYS = sorted(plans.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 9)
    if hasattr(v, "isoformat"):
        return str(v)
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def rows(pdf):
    cols = sorted(pdf.columns)
    out = [tuple(norm(r[c]) for c in cols) for r in pdf.to_dict("records")]
    return cols, sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


SUITE_KEYS = {"eval_teleqna", "eval_telelogs", "eval_three_gpp", "eval_telemath", "eval_old_three_gpp",
              "eval_teleyaml", "eval_legacy_teleyaml", "eval_set", "run_report"}
MORE_KEYS = {"custom_batch_scorer", "limit_samples_many", "custom_aggregate_metric", "score_rubric_checks", "read_log_samples", "scan_raw_lines", "stream_raw_progress", "stream_late_progress", "stream_eval_results"}


def test_all_keys_registered():
    # the 74 survey operators plus one end-to-end plan per suite task, one eval set and one run report, every one with an oracle
    assert SUITE_KEYS | MORE_KEYS <= set(KEYS) and len(set(KEYS) - SUITE_KEYS - MORE_KEYS) == 74
    assert set(plans.oracle_sql()) == set(KEYS) and set(KEYS) <= set(E.queries())


def test_entry_runs(spark):
    assert E.entry(spark).count() >= 0


@pytest.mark.parametrize("key", KEYS)
def test_plan_matches_oracle(spark, con, key):
    got = E.queries()[key](spark, SF_SMALL).toPandas()
    sql = E.oracle_sql().get(key)
    if sql is None:
        assert len(got.columns) > 0
        return
    want = con.execute(sql).df()
    assert rows(got) == rows(want)
