"""Whole jobs composed from the operators: merge, tracks, sample families."""

from .merge import merge_detections, sessions_from_configs
from .strata import (
    FAMILIES,
    expert_samples,
    label_tracks,
    sample_all,
    sample_families,
    strata1,
    strata2,
    strata3,
    strata4,
    strata5,
    strata6,
    strata7,
    strata8,
    strata_genus,
    strata_thresholds,
)
from .tracks import aggregate_tracks, prepare_detections, process_detections, process_once, track_steps

__all__ = [
    "FAMILIES",
    "aggregate_tracks",
    "expert_samples",
    "label_tracks",
    "merge_detections",
    "prepare_detections",
    "process_detections",
    "process_once",
    "sample_all",
    "sample_families",
    "sessions_from_configs",
    "strata1",
    "strata2",
    "strata3",
    "strata4",
    "strata5",
    "strata6",
    "strata7",
    "strata8",
    "strata_genus",
    "strata_thresholds",
    "track_steps",
]
