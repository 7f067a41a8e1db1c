"""Detections to reviewed-ready tracks: normalise, filter, aggregate, vote, filter again."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import in_range
from ..model import TRACK_KEYS
from ..operators import (
    bbox_metrics,
    filter_range,
    normalize_classes,
    parse_ts,
    removal_counts,
    track_parts,
    track_top1,
    track_votes,
    tracks_from_parts,
    votes_from_parts,
)
from ..operators.tracks import ts_or_null
from ..sinks import write_table

Slot = str | float | None


def prepare_detections(
    detections: DataFrame,
    ts: str = "timestamp",
    confidence: str = "confidence",
    min_conf: Slot = None,
    max_conf: Slot = None,
    width: float = 1.0,
    height: float = 1.0,
) -> DataFrame:
    """Class columns, real timestamps, the confidence filter and the box sides."""
    timed = parse_ts(normalize_classes(detections), ts)
    return bbox_metrics(filter_range(timed, confidence, min_conf, max_conf), width, height)


def aggregate_tracks(
    prepared: DataFrame,
    keys: Sequence[str] = TRACK_KEYS,
    ts: str = "timestamp",
    min_duration: Slot = None,
    max_duration: Slot = None,
    min_prob: Slot = None,
    max_prob: Slot = None,
    **columns: Any,
) -> DataFrame:
    """Best class and statistics per track, then the duration and probability filters."""
    tracks = track_top1(prepared, keys, ts=ts, **columns)
    tracks = filter_range(tracks, "duration_s", min_duration, max_duration)
    return filter_range(tracks, "top1_prob_weighted", min_prob, max_prob)


def process_detections(
    detections: DataFrame,
    keys: Sequence[str] = TRACK_KEYS,
    ts: str = "timestamp",
    confidence: str = "confidence",
    min_conf: Slot = None,
    max_conf: Slot = None,
    min_duration: Slot = None,
    max_duration: Slot = None,
    min_prob: Slot = None,
    max_prob: Slot = None,
    width: float = 1.0,
    height: float = 1.0,
) -> tuple[DataFrame, DataFrame]:
    """(all votes, final tracks). Duration and probability filters touch only the final tracks."""
    prepared = prepare_detections(detections, ts, confidence, min_conf, max_conf, width, height)
    votes = track_votes(prepared, keys, ts=ts)
    tracks = aggregate_tracks(
        prepared, keys, ts, min_duration, max_duration, min_prob, max_prob, confidence=confidence
    )
    return votes, tracks


def _slot(column: str, low: Slot, high: Slot) -> Column:
    return F.lit(True) if low is None and high is None else in_range(column, low, high)


def _early_steps(
    detections: DataFrame, keys: Sequence[str], ts: str, confidence: str, min_conf: Slot, max_conf: Slot
) -> list[tuple[str, Column]]:
    """What a detection must pass, in order."""
    is_text = detections.schema[ts].dataType.typeName() == "string"
    keyed = F.lit(True)
    for key in keys:
        keyed = keyed & F.col(key).isNotNull()
    return [
        ("invalid_timestamps", ts_or_null(ts).isNotNull() if is_text else F.lit(True)),
        ("detections_removed", _slot(confidence, min_conf, max_conf)),
        ("detections_without_track", keyed),
    ]


def process_once(
    detections: DataFrame,
    path: str,
    keys: Sequence[str] = TRACK_KEYS,
    ts: str = "timestamp",
    confidence: str = "confidence",
    min_conf: Slot = None,
    max_conf: Slot = None,
    min_duration: Slot = None,
    max_duration: Slot = None,
    min_prob: Slot = None,
    max_prob: Slot = None,
    width: float = 1.0,
    height: float = 1.0,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(all votes, final tracks, removal counts), the results of :func:`process_detections` and :func:`track_steps`, from
    one pass over the detections: the parts of each (track, class) are written to ``path``, and all three read them.
    Removed detections are counted in the same aggregate, so a repeated task does not count them twice."""
    steps = _early_steps(detections, keys, ts, confidence, min_conf, max_conf)
    failed = F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in steps])
    classed = normalize_classes(detections).withColumn("_step", failed)
    if detections.schema[ts].dataType.typeName() == "string":
        classed = classed.withColumn(ts, ts_or_null(ts))
    parts = track_parts(bbox_metrics(classed, width, height), keys, ts=ts, confidence=confidence, step="_step")
    stored = detections.sparkSession.read.schema(parts.schema).parquet(write_table(parts, path))
    kept = stored.where(F.col("_step").isNull()).drop("_step")
    every = tracks_from_parts(kept, keys)
    late = [
        ("tracks_removed", _slot("duration_s", min_duration, max_duration)),
        ("classifications_removed", _slot("top1_prob_weighted", min_prob, max_prob)),
    ]
    counts = [F.sum(F.when(F.col("_step") == name, F.col("top1_imgs"))).alias(name) for name, _ in steps]
    row = stored.where(F.col("_step").isNotNull()).agg(*counts)
    removed = F.explode(
        F.array(*[F.struct(F.lit(name).alias("step"), F.coalesce(name, F.lit(0).cast("bigint")).alias("removed")) for name, _ in steps])
    )
    early = row.select(removed.alias("_pair")).select("_pair.*")
    tracks = every
    for _, condition in late:
        tracks = tracks.where(condition)
    return votes_from_parts(kept, keys), tracks, early.unionByName(removal_counts(every, late))


def track_steps(
    detections: DataFrame,
    keys: Sequence[str] = TRACK_KEYS,
    ts: str = "timestamp",
    confidence: str = "confidence",
    min_conf: Slot = None,
    max_conf: Slot = None,
    min_duration: Slot = None,
    max_duration: Slot = None,
    min_prob: Slot = None,
    max_prob: Slot = None,
) -> DataFrame:
    """(step, removed): rows lost to bad timestamps, missing track keys and the three filters."""
    early = removal_counts(detections, _early_steps(detections, keys, ts, confidence, min_conf, max_conf))
    prepared = prepare_detections(detections, ts, confidence, min_conf, max_conf)
    late = removal_counts(
        track_top1(prepared, keys, ts=ts, confidence=confidence),
        [
            ("tracks_removed", _slot("duration_s", min_duration, max_duration)),
            ("classifications_removed", _slot("top1_prob_weighted", min_prob, max_prob)),
        ],
    )
    return early.unionByName(late)
