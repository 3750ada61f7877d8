"""Single-pass prompt templates.

``{name}`` takes the value of a column (NULL -> ''), ``{{`` and ``}}`` are
literal braces, unknown names stay as written. The template is split once
on the driver into literal pieces and column references; the row work is one
``concat`` in codegen, so a value that itself holds ``{name}`` is never
expanded again.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_TOKEN = re.compile(r"\{\{|\}\}|\{([^{}]*)\}")


def split_template(template: str, fields: dict[str, str]) -> list[tuple[str, str]]:
    """[('lit', text) | ('col', column_name)] for a template and a mapping
    from placeholder names to column names."""
    out: list[tuple[str, str]] = []
    buf: list[str] = []
    pos = 0
    for m in _TOKEN.finditer(template):
        buf.append(template[pos:m.start()])
        tok = m.group(0)
        if tok == "{{":
            buf.append("{")
        elif tok == "}}":
            buf.append("}")
        elif m.group(1) in fields:
            out.append(("lit", "".join(buf)))
            buf = []
            out.append(("col", fields[m.group(1)]))
        else:
            buf.append(tok)
        pos = m.end()
    buf.append(template[pos:])
    out.append(("lit", "".join(buf)))
    return [p for p in out if not (p[0] == "lit" and p[1] == "")]


def render(template: str, fields: dict[str, str | Column]) -> Column:
    """Column holding the template filled from ``fields`` (placeholder -> column)."""
    names = {k: k for k in fields}
    parts = []
    for kind, val in split_template(template, names):
        if kind == "lit":
            parts.append(F.lit(val))
        else:
            c = fields[val]
            c = F.col(c) if isinstance(c, str) else c
            parts.append(F.coalesce(c.cast("string"), F.lit("")))
    return F.concat(*parts) if parts else F.lit("")
