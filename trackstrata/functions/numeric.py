"""Rounding, order-free means and durations.

A floating-point sum depends on the order of its rows, so a rounded mean could differ between two
runs of one job. Sums here are taken over three integer parts of each value (whole part, and the
fraction in units of 1e-12 split at 2**20), which makes them exact, independent of partitioning and
task retries, and cheap: the buffers are longs, so Spark keeps its hash aggregate and map-side combine.
Casting each row to a wide decimal gives the same result at about twenty times the cost.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNIT = "1e12D"
_SPLIT = 20

def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c: Column | str, digits: int) -> Column:
    """``floor(x * 10**d + 0.5) / 10**d``: one explicit rule, the same in every engine."""
    scale = F.lit(float(10**digits))
    return F.floor(_col(c) * scale + F.lit(0.5)) / scale


def finite(c: Column | str) -> Column:
    """The value as double, with NaN and infinities read as missing."""
    value = _col(c).cast("double")
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def clip(c: Column | str, low: float, high: float) -> Column:
    """Null stays null (``greatest``/``least`` alone would skip it)."""
    value = _col(c)
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def sum_parts(column: str) -> list[str]:
    """SQL texts of the integer parts of a numeric column, NaN and infinities read as missing. Sum each of them, then
    use :func:`mean_from_parts`. Texts, because one parsed expression costs the driver a fraction of
    the calls that building it piece by piece would."""
    value = present(column)
    whole = f"floor({value})"
    units = f"floor(({value} - cast({whole} as double)) * {_UNIT} + 0.5D)"
    return [whole, f"shiftright({units}, {_SPLIT})", f"{units} & {(1 << _SPLIT) - 1}"]


def present(column: str) -> str:
    value = f"cast(`{column}` as double)"
    return f"if(abs({value}) < double('Infinity'), {value}, null)"


def _total(parts: Sequence[str]) -> str:
    """The sum in units of 1e-12 as one integer, converted to double once, so that decimal ties such as
    0.57 + 1.00 = 1.57 stay ties."""
    whole, high, low = (f"cast({part} as decimal(20,0))" for part in parts)
    units = f"{whole} * 1000000000000 + ({high} * {1 << _SPLIT} + {low})"
    return f"(cast({units} as double) / {_UNIT})"


def mean_from_parts(parts: Sequence[str], count: str) -> Column:
    """Mean from the SQL texts of summed parts and of the count of present values; null for no value."""
    return F.expr(f"case when {count} > 0 then {_total(parts)} / {count} end")


def exact_sum(column: str) -> Column:
    return F.expr(_total([f"sum({part})" for part in sum_parts(column)]))


def exact_mean(column: str) -> Column:
    """Aggregate: the mean of a numeric column, independent of row order."""
    return mean_from_parts([f"sum({part})" for part in sum_parts(column)], f"count({present(column)})")


def whole_seconds(start: Column | str, end: Column | str) -> Column:
    """Seconds from ``start`` to ``end``, truncated; independent of the session time zone."""
    return (_col(end) - _col(start)).cast("interval second").cast("bigint")


def vote_weight(mean: Column | str, votes: Column | str, images: Column | str) -> Column:
    """Rounded mean probability times the share of the track's images that voted for the class."""
    return round_half_up(_col(mean) * (_col(votes) / _col(images)), 2)
