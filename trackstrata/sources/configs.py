"""Session configuration files: one nested JSON document per recording session."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import json_fields, json_first, wall_clock
from ..model import CAMERA_PATHS, CONFIG_NAME, CONFIG_NUMBERS, CONFIG_STAMP, SETTING_PATHS

UNKNOWN = "unknown"


def _documents(spark: SparkSession, directory: str, name_regex: str) -> DataFrame:
    files = spark.read.text(
        directory, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.json"
    ).select("value", F.col("_metadata.file_name").alias("filename"), F.col("_metadata.file_path").alias("source"))
    stamp = F.regexp_extract("filename", name_regex, 1)
    return files.where(F.col("filename").rlike(name_regex)).withColumn("date_time", stamp)


def parse_configs(
    documents: DataFrame,
    camera_paths: Sequence[str] = CAMERA_PATHS,
    setting_paths: Sequence[str] = SETTING_PATHS,
    numbers: Mapping[str, str] = CONFIG_NUMBERS,
    stamp_format: str = CONFIG_STAMP,
) -> DataFrame:
    """Flatten ``(value, filename, date_time, ...)`` rows. ``parse_ok`` and ``missing`` tell what a
    document lacked; ``start`` is null where the stamp is not a date."""
    camera = json_first("value", camera_paths)
    setting = json_first("value", setting_paths)
    parse_ok = F.try_parse_json("value").isNotNull()
    missing = F.filter(
        F.array(
            F.when(parse_ok & camera.isNull(), F.lit("cam_ID")),
            F.when(parse_ok & setting.isNull(), F.lit("deployment_setting")),
            F.when(~parse_ok, F.lit("JSON parsing failed")),
        ),
        lambda x: x.isNotNull(),
    )
    return documents.select(
        "filename",
        "date_time",
        F.coalesce(camera, F.lit(UNKNOWN)).alias("cam_ID"),
        F.coalesce(setting, F.lit(UNKNOWN)).alias("deployment_setting"),
        *json_fields("value", numbers),
        wall_clock("date_time", stamp_format).alias("start"),
        parse_ok.alias("parse_ok"),
        missing.alias("missing"),
        "source",
    )


def read_configs(spark: SparkSession, directory: str, name_regex: str = CONFIG_NAME, **fields) -> DataFrame:
    """Every config file below ``directory`` whose name matches and carries a real date."""
    return parse_configs(_documents(spark, directory, name_regex), **fields).where(F.col("start").isNotNull())


def rejected_configs(spark: SparkSession, directory: str, name_regex: str = CONFIG_NAME) -> DataFrame:
    """Files whose name matches but whose stamp is not a date."""
    parsed = parse_configs(_documents(spark, directory, name_regex))
    return parsed.where(F.col("start").isNull()).select("filename", "date_time", "source")


def config_quality(configs: DataFrame) -> DataFrame:
    """One row per file with something missing or unparsable."""
    return configs.where(F.size("missing") > 0).select("filename", "parse_ok", "missing")


def merged_config_columns(numbers: Mapping[str, str] = CONFIG_NUMBERS) -> list[str]:
    return ["filename", "date_time", "cam_ID", "deployment_setting", *numbers]
