"""Scalar helpers for samples and job status, as native expressions.

Times are ``timestamp`` columns read in UTC; durations are double seconds.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def index_to_letter(n) -> Column:
    """0 -> 'A', 1 -> 'B', ..."""
    return F.chr(F.lit(65) + _col(n))


def normalise_category(c) -> Column:
    """Rubric key of a category: lower case, spaces to underscores."""
    return F.replace(F.lower(_col(c)), F.lit(" "), F.lit("_"))


def display_name(label, model) -> Column:
    """The label, or the last ``/`` segment of the model name."""
    return F.coalesce(F.nullif(_col(label), F.lit("")), F.element_at(F.split(_col(model), "/"), -1))


def epoch_seconds(ts) -> Column:
    return F.unix_micros(_col(ts).cast("timestamp")) / F.lit(1e6)


def iso_timestamp(ts) -> Column:
    """ISO-8601 in UTC with ``+00:00``; fraction only when non-zero; NULL or
    the epoch itself gives NULL."""
    t = _col(ts).cast("timestamp")
    micros = F.unix_micros(t)
    base = F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.when(micros % 1000000 != 0, F.concat(F.lit("."), F.date_format(t, "SSSSSS"))).otherwise(F.lit(""))
    return F.when(t.isNotNull() & (micros != 0), F.concat(base, frac, F.lit("+00:00")))


def format_duration(seconds) -> Column:
    """``1h 2m 3s``: zero parts dropped, seconds dropped from two hours up,
    negative counts as 0, whole seconds; NULL stays NULL."""
    s = _col(seconds)
    total = F.floor(F.greatest(F.lit(0.0), s.cast("double"))).cast("bigint")
    h = F.floor(total / 3600).cast("bigint")
    m = F.floor((total % 3600) / 60).cast("bigint")
    sec = total % 60
    text = F.concat_ws(" ",
                       F.when(h > 0, F.concat(h.cast("string"), F.lit("h"))),
                       F.when(m > 0, F.concat(m.cast("string"), F.lit("m"))),
                       F.when(((h == 0) & (m == 0)) | ((sec > 0) & (h < 2)),
                              F.concat(sec.cast("string"), F.lit("s"))))
    return F.when(s.isNotNull(), text)


def progress_ratio(completed, total) -> Column:
    """completed / total clamped to [0, 1]; NULL when total is NULL or 0."""
    t = _col(total)
    r = F.coalesce(_col(completed), F.lit(0)) / F.nullif(t, F.lit(0))
    return F.when(r.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), r)))


def progress_percent(completed, total) -> Column:
    """Ratio x 100 rounded to 2 places (HALF_UP; Python rounds ties to even)."""
    return F.round(progress_ratio(completed, total) * 100, 2)


def end_point(finished_at, now) -> Column:
    return F.coalesce(_col(finished_at).cast("timestamp"), _col(now).cast("timestamp"))


def elapsed_seconds(started_at, finished_at, now) -> Column:
    """(finished or now) - started, NULL when never started."""
    start = _col(started_at).cast("timestamp")
    micros = F.unix_micros(end_point(finished_at, now)) - F.unix_micros(start)
    return F.when(start.isNotNull(), micros / F.lit(1e6))


def estimate_remaining(completed, total, started_at, finished_at, now) -> Column:
    """remaining x elapsed / completed; NULL when undefined, 0 when done."""
    c = F.coalesce(_col(completed), F.lit(0))
    t = _col(total)
    elapsed = elapsed_seconds(started_at, finished_at, now)
    remaining = t - c
    return (F.when((c == 0) | t.isNull() | (t == 0) | elapsed.isNull() | (elapsed <= 0), F.lit(None).cast("double"))
            .when(remaining <= 0, F.lit(0.0))
            .otherwise(remaining * (elapsed / c)))


def job_outcome(cancel_requested, returncode, exception) -> dict[str, Column]:
    """Final status and error text of a finished job: an exception fails it,
    else a cancel request wins, else the return code decides."""
    exc = _col(exception)
    rc = _col(returncode)
    cancelled = F.coalesce(_col(cancel_requested), F.lit(False))
    status = (F.when(exc.isNotNull(), F.lit("failed"))
              .when(cancelled, F.lit("cancelled"))
              .when(rc == 0, F.lit("complete"))
              .otherwise(F.lit("failed")))
    error = (F.when(exc.isNotNull(), exc)
             .when(cancelled | (rc == 0), F.lit(None).cast("string"))
             .otherwise(F.concat(F.lit("Exited with code "), rc.cast("string"))))
    return {"status": status, "error": error}
