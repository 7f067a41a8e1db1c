"""Threshold filters and counts of what they remove."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import in_range


def filter_range(df: DataFrame, column: str, low: str | float | None = None, high: str | float | None = None) -> DataFrame:
    """Keep rows within both slots; no slot given means no filter (nulls stay)."""
    return df if low is None and high is None else df.where(in_range(column, low, high))


def with_thresholds(df: DataFrame, column: str, thresholds: Sequence[float], alias: str = "threshold") -> DataFrame:
    """One copy of each row per threshold it exceeds, in a single pass."""
    passed = F.filter(
        F.array(*[F.lit(float(t)) for t in sorted(set(thresholds))]), lambda t: F.col(column) > t
    )
    return df.withColumn(alias, F.explode(passed))


def removal_counts(df: DataFrame, steps: Sequence[tuple[str, Column]]) -> DataFrame:
    """(step, removed) for a chain of filters, in one aggregate: each step counts the rows that pass
    all earlier conditions and fail its own (null fails)."""
    counts, alive = [], F.lit(True)
    for name, condition in steps:
        ok = F.coalesce(condition, F.lit(False))
        counts.append(F.count_if(alive & ~ok).alias(name))
        alive = alive & ok
    row = df.agg(*counts)
    pairs = F.array(*[F.struct(F.lit(name).alias("step"), F.col(name).alias("removed")) for name, _ in steps])
    return row.select(F.explode(pairs).alias("_pair")).select("_pair.*")
