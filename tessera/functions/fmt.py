"""Fill ``{name}`` slots of a fixed message format with Columns (Spark) or SQL
expressions (DuckDB oracle), so each format is written once, as plain text."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_SLOT = re.compile(r"\{(\w+)\}")


def fmt(template: str, **values) -> Column:
    """``fmt("Missing: {f}", f=col)`` -> concat('Missing: ', col)."""
    parts = _SLOT.split(template)
    cols = []
    for i, p in enumerate(parts):
        if i % 2 == 0:
            if p:
                cols.append(F.lit(p))
        else:
            v = values[p]
            cols.append(v if isinstance(v, Column) else F.lit(str(v)))
    return F.concat(*cols) if len(cols) > 1 else cols[0]


def sql_fmt(template: str, **values: str) -> str:
    """The same as SQL text: literal pieces quoted, slots replaced by expressions."""
    parts = _SLOT.split(template)
    out = []
    for i, p in enumerate(parts):
        if i % 2 == 0:
            if p:
                out.append("'" + p.replace("'", "''") + "'")
        else:
            out.append(f"({values[p]})")
    return " || ".join(out)
