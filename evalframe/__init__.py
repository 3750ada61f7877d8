"""evalframe: evaluation tables (samples, completions, grades, job logs) as Spark plans.

Parsing, scoring, voting and metrics are native Column expressions and
aggregates; Python runs only for the user's generation callable, YAML
flattening and per-job streaming state.
"""

import sys as _sys

from evalframe.session import get_spark, work_dir

# Functions run by Python workers (generation, YAML parsing, streaming state)
# ship by value, so executors need no installed copy of this package.
try:
    from pyspark import cloudpickle as _cp
    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001 - older cloudpickle: fall back to importing on workers
    pass

__all__ = ["get_spark", "work_dir"]
