"""Configs and detection files to one detection table with the plant in front of the camera."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..model import CLASS, CLASS_PROB, PLANT, SCORE, config_name
from ..operators import session_join
from ..operators.tracks import ts_or_null
from ..session import hold
from ..sources import read_configs, read_detections, require_columns, require_rows


def sessions_from_configs(configs: DataFrame, plant: str = PLANT) -> DataFrame:
    """(cam_ID, start, plant, filename): the session table of the as-of join."""
    require_columns(configs, ["cam_ID", "start", "deployment_setting", "filename"], "configs")
    return configs.select("cam_ID", "start", F.col("deployment_setting").alias(plant), "filename")


def merge_detections(
    spark: SparkSession,
    raw_dir: str,
    processed_dir: str,
    plant: str = PLANT,
    strategy: str = "auto",
    by_name: bool = False,
    with_source: bool = False,
    schema: str | None = None,
    strict: bool = False,
    device: str | None = None,
    observation: Observation | None = None,
) -> DataFrame:
    """Read both folders and attach the plant of the session in force. The sessions, a small table, are
    held so that the config files are read once. Rows whose timestamp does not parse stay, without a
    plant, and keep their text. No config or no detection at all is an error.

    Files of the plain classifier format need ``schema=PLAIN_DETECTION_DDL`` or ``by_name``, which also keeps
    columns the library does not know. Detections of neither format are an error.

    ``strict`` ends the job at a timestamp that does not parse. ``device`` takes only configs of that device tag. An ``observation``
    counts the rows of the result as they pass to a sink: ``rows``, and those with ``unparsed_timestamps``, ``without_camera`` and
    ``without_plant``; read it after the write."""
    detections = read_detections(spark, processed_dir, schema=schema, by_name=by_name, with_source=with_source)
    require_columns(detections, ["cam_ID", "timestamp"], "detections")
    if SCORE not in detections.columns:
        require_columns(detections, [CLASS, CLASS_PROB], "detections")
    require_rows(detections, "detections")
    configs = read_configs(spark, raw_dir, config_name(device))
    sessions = require_rows(hold(sessions_from_configs(configs, plant)), "session configs")
    parsed = ts_or_null("timestamp")
    unparsed = F.col("timestamp").isNotNull() & F.col("_ts").isNull()
    if strict:
        wrong = F.raise_error(F.concat(F.lit("timestamp does not parse: "), F.col("timestamp"))).cast("timestamp_ntz")
        parsed = F.coalesce(parsed, F.when(F.col("timestamp").isNotNull(), wrong))
    joined = session_join(
        detections.withColumn("_ts", parsed), sessions, "cam_ID", "_ts", "start", [plant], tie=["filename"], strategy=strategy
    )
    if observation is not None:
        joined = joined.observe(
            observation,
            F.count(F.lit(1)).alias("rows"),
            F.count_if(unparsed).alias("unparsed_timestamps"),
            F.count_if(F.col("cam_ID").isNull()).alias("without_camera"),
            F.count_if(F.col(plant).isNull()).alias("without_plant"),
        )
    return joined.drop("_ts")
