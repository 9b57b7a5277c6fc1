"""Turn one line holding a Python dict literal into a line of JSON."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# What is replaced by what, anywhere in the line, in this order.
REPLACEMENTS = (
    ("False", "false"),
    ("True", "true"),
    ("None", "null"),
    ("u'", "'"),
    ('u"', '"'),
    ("\\x", "\\u00"),
)

# The same, but only where a value can start or end. Lookbehinds need a bound in
# Java, hence at most one blank. Text such as "well, None, thanks" still changes.
_BEFORE_VALUE = r"(?<=[\[{,:] ?)"
_AFTER_VALUE = r"(?= ?[,}\]])"
TOKEN_PATTERNS = (
    (f"{_BEFORE_VALUE}False{_AFTER_VALUE}", "false"),
    (f"{_BEFORE_VALUE}True{_AFTER_VALUE}", "true"),
    (f"{_BEFORE_VALUE}None{_AFTER_VALUE}", "null"),
    (f"{_BEFORE_VALUE}u(?=['\"])", ""),
    # An escaped byte, unless its backslash is itself escaped.
    (r"(?<!\\)((?:\\\\)*)\\x(?=[0-9a-fA-F]{2})", r"$1\\u00"),
)


def repair_python_literal(line: Column, mode: str = "blind") -> Column:
    """Repair a line in one projection.

    ``blind`` replaces fixed texts wherever they occur, also inside values (a review
    saying "you're" loses its u). ``token`` looks at value positions only.
    """
    if mode == "blind":
        return reduce(lambda c, r: F.replace(c, F.lit(r[0]), F.lit(r[1])), REPLACEMENTS, line)
    if mode == "token":
        return reduce(lambda c, r: F.regexp_replace(c, r[0], r[1]), TOKEN_PATTERNS, line)
    raise ValueError(f"unknown repair mode: {mode}")
