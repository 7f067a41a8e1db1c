"""Files written from the driver's tables, for the queries that go through sources and sinks.

All of them lie in the folder of held tables and are deleted with it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackstrata.model import DETECTION_DDL
from trackstrata.session import _files, held_in

from .fixtures import detections, table

SUFFIX = "metadata_merged_crops_classified.csv"
#: one config per camera and day: from the first event on
STARTS = (
    "select cam_ID, date_trunc('second', min(ts)) as start, min(setting) as setting from "
    "(select concat('cam', cast(user_id % 10 as string)) as cam_ID, ts, event_type as setting from events) group by cam_ID, cast(ts as date)"
)


def scratch(spark: SparkSession, name: str) -> str:
    return f"{held_in(spark)}/{name}-{uuid.uuid4().hex}"


def _named(spark: SparkSession, folder: str, name) -> None:
    """Give the files below ``folder`` (one level of folders) the names that ``name`` makes of their folder and number."""
    root, files = _files(spark, folder)
    for directory in files.listStatus(root):
        if directory.isDirectory():
            parts = [f.getPath() for f in files.listStatus(directory.getPath()) if f.getPath().getName().startswith("part-")]
            for number, part in enumerate(sorted(parts, key=lambda p: p.getName())):
                target = part.getParent().suffix("/" + name(directory.getPath().getName(), number))
                files.rename(part, target)


def as_text(spark: SparkSession, sf_dir: str, broken: bool = False) -> DataFrame:
    """The detections as the classifier writes them, timestamps as text; of ``error`` events no time, if ``broken``."""
    rows = detections(spark, sf_dir, plant=False).withColumn("bioclip_class", F.lit("Insecta"))
    time = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    if broken:
        time = F.when(F.col("crop_path").contains("/error/"), F.lit("not a time")).otherwise(time)
    names = [c.split()[0] for c in DETECTION_DDL.split(", ")]
    return rows.withColumn("timestamp", time).withColumn("track_ID", F.col("track_ID").cast("string")).select(*names)


def detection_files(spark: SparkSession, sf_dir: str, broken: bool = False, mixed: bool = False) -> str:
    """One folder per kind of event. ``mixed``: the columns of ``view`` events are in reverse order, with one more."""
    folder = scratch(spark, "detections")
    rows = as_text(spark, sf_dir, broken).withColumn("kind", F.element_at(F.split("crop_path", "/"), 2))
    parts = [rows]
    if mixed:
        view = rows.where("kind = 'view'").withColumn("note", F.concat(F.lit("n "), "crop_path"))
        parts = [rows.where("kind <> 'view'"), view.select(*reversed(view.columns))]
    for part in parts:
        part.repartition("kind").write.mode("append").partitionBy("kind").option("header", True).csv(folder)
    _named(spark, folder, lambda _, number: f"{number}_{SUFFIX}")
    return folder


def config_files(spark: SparkSession, sf_dir: str) -> str:
    """One JSON document per camera and day, named by its time and device."""
    starts = spark.sql(STARTS.replace("from events", "from {events}"), events=table(spark, sf_dir, "events"))
    stamp = F.date_format("start", "yyyy-MM-dd_HH-mm-ss")
    text = F.to_json(
        F.struct(
            F.struct(F.struct(F.lit("").alias("ssid")).alias("hotspot")).alias("network"),
            F.struct(F.col("cam_ID").alias("id")).alias("device"),
            F.struct(F.col("setting"), F.struct(F.dayofyear("start").alias("latitude")).alias("location")).alias("deployment"),
        )
    )
    folder = scratch(spark, "configs")
    kind = F.when(F.dayofyear("start") % 2 == 0, "flower").otherwise("platform")
    named = starts.select(F.concat_ws("_", stamp, F.lit("config"), "cam_ID", kind).alias("document"), text.alias("value"))
    # a few documents a task, each a file of its own
    named.write.partitionBy("document").text(folder)
    _named(spark, folder, lambda directory, _: directory.split("=", 1)[1] + ".json")
    return folder
