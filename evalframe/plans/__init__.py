"""Registered plans: one per operator of the survey, each with its oracle."""

from evalframe.plans.registry import ORACLES, QUERIES
from evalframe.plans import scoring, metric_plans, status_plans, sample_plans, rubric_plans, live_plans, suite_plans  # noqa: F401


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
