"""Filter conditions written as text, such as ``'>0.5'`` or ``'<= 0.8'``."""

from __future__ import annotations

import operator
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_COMPARE = {
    ">": operator.gt,
    ">=": operator.ge,
    "<": operator.lt,
    "<=": operator.le,
    "==": operator.eq,
    "!=": operator.ne,
}
_SPEC = re.compile(r"(?P<sign>[<>]=?|[=!]=)?\s*(?P<number>\d+(?:\.\d+)?)")


def threshold(c: Column | str, spec: str | float, default: str | None = None) -> Column:
    """The condition ``c <op> number``. A bare number needs a ``default`` operator; anything that is
    not an operator and a plain non-negative decimal raises. Null rows never satisfy it."""
    text = str(spec).strip().strip("\"'").strip()
    found = _SPEC.fullmatch(text)
    if not found:
        raise ValueError(f"{spec!r} is no threshold: expected one of {', '.join(_COMPARE)} before a plain decimal, as in '>=12.5' ")
    sign = found["sign"] or default
    if sign is None:
        raise ValueError(f"threshold {spec!r} has no operator")
    column = F.col(c) if isinstance(c, str) else c
    return _COMPARE[sign](column, F.lit(float(found["number"])))


def in_range(c: Column | str, low: str | float | None = None, high: str | float | None = None) -> Column:
    """Both slots of a range filter; bare numbers are inclusive, a missing slot is open."""
    condition = F.lit(True)
    if low is not None:
        condition = threshold(c, low, ">=")
    if high is not None:
        upper = threshold(c, high, "<=")
        condition = upper if low is None else condition & upper
    return condition
