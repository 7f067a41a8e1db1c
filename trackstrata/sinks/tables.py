"""Tables, partitioned samples, run manifests and row totals."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def new_run_id(prefix: str = "run") -> str:
    return f"{prefix}_{datetime.now(timezone.utc):%Y-%m-%d_%H-%M-%S}"


def _target(path: str, run_id: str | None) -> str:
    return f"{path.rstrip('/')}/{run_id}" if run_id else path


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "errorifexists",
    run_id: str | None = None,
    order_by: Sequence[str] = (),
) -> str:
    """Write a table, under a run folder if ``run_id`` is given; returns where it went.

    With ``order_by`` the rows are in that order (nulls first) from file to file, by name, and within each: they are dealt by ranges of
    the columns and sorted in each task, never gathered in one."""
    target = _target(path, run_id)
    if order_by:
        order = [F.asc_nulls_first(c) for c in order_by]
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(target)
    return target


def write_strata(
    df: DataFrame,
    path: str,
    by: Sequence[str] = ("family", "stratum"),
    fmt: str = "parquet",
    mode: str = "errorifexists",
    run_id: str | None = None,
) -> str:
    """One folder per value of ``by`` (sample family, stratum, threshold, chunk or species).

    Rows are brought together by those columns first, so each folder gets one file instead of one
    per task; samples hold a fixed number of rows per stratum, so no task grows with the input.
    """
    target = _target(path, run_id)
    writer = df.repartition(*by).write.mode(mode).partitionBy(*by)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(target)
    return target


def run_manifest(spark: SparkSession, parameters: Mapping[str, Any], run_id: str | None = None) -> DataFrame:
    """One row: the run and its parameters as JSON text."""
    text = json.dumps(dict(parameters), sort_keys=True, default=str)
    return spark.range(1).select(
        F.lit(run_id).cast("string").alias("run_id"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("written_at"),
        F.lit(text).alias("parameters"),
    )


def write_manifest(spark: SparkSession, parameters: Mapping[str, Any], path: str, run_id: str | None = None) -> str:
    return write_table(run_manifest(spark, parameters, run_id), f"{_target(path, run_id)}/manifest", fmt="json")


def observed(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """Count rows as they pass; ``observation.get['rows']`` after the action. No extra scan."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation
