"""Checks on inputs before any work is planned on them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def require_columns(df: DataFrame, columns: Iterable[str], what: str = "table") -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks required columns: {', '.join(missing)}")
    return df


def require_rows(df: DataFrame, what: str = "table") -> DataFrame:
    """Raise if there is no row; stops at the first one found."""
    if df.isEmpty():
        raise ValueError(f"{what} has no rows")
    return df
