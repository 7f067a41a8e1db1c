"""Label columns made from numbers or memberships."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def membership_label(c: Column | str, values: Sequence[str], yes: str, no: str) -> Column:
    """``yes`` if the value is listed, else ``no`` (null is not listed)."""
    return F.when(_col(c).isin(list(values)), F.lit(yes)).otherwise(F.lit(no))


def prob_class(c: Column | str, cut: float = 0.5, low: str = "low_prob", high: str = "high_prob") -> Column:
    """``low`` up to and including the cut, else ``high`` (null is high)."""
    return F.when(_col(c) <= F.lit(cut), F.lit(low)).otherwise(F.lit(high))


def median_half(c: Column | str, median: Column | str, low: str = "low_prob", high: str = "high_prob") -> Column:
    """``low`` strictly below the median, else ``high`` (null is high)."""
    return F.when(_col(c) < _col(median), F.lit(low)).otherwise(F.lit(high))


def cut_labels(
    c: Column | str,
    cuts: Sequence[tuple[float, str]],
    above: str | None = None,
    other: str | None = None,
    zero: str | None = None,
) -> Column:
    """Right-closed bins over positive numbers.

    ``cuts`` is ``[(upper, label), ...]`` ascending; ``above`` labels values past the last cut,
    ``zero`` labels exact zeros, ``other`` whatever is left (negative or null).
    """
    value = _col(c)
    label = F.when(value == 0, F.lit(zero)) if zero is not None else F.when(F.lit(False), F.lit(None))
    for upper, name in cuts:
        label = label.when((value > 0) & (value <= F.lit(upper)), F.lit(name))
    if above is not None:
        label = label.when(value > F.lit(cuts[-1][0]), F.lit(above))
    return label.otherwise(F.lit(other).cast("string"))


def decile_labels() -> list[str]:
    return [f"{i / 10:.1f}-{(i + 1) / 10:.1f}" for i in range(10)]


def decile_bin(c: Column | str, exact_edges: bool = False) -> Column:
    """Ten left-closed probability bins; values from the last edge up, and null, are ``1.0-1.0``.

    The default edges are the doubles ``i * 0.1``, three of which lie just above 0.3, 0.6 and 0.7, so
    those values fall one bin lower. ``exact_edges`` uses the decimal edges and closes the last bin.
    """
    value = _col(c)
    edges = [i / 10 if exact_edges else i * 0.1 for i in range(1, 11)]
    label = None
    for edge, name in zip(edges, decile_labels()):
        below = value < F.lit(edge)
        if exact_edges and edge == 1.0:
            below = value <= F.lit(edge)
        label = F.when(below, F.lit(name)) if label is None else label.when(below, F.lit(name))
    return label.otherwise(F.lit("1.0-1.0"))
