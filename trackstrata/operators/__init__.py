"""DataFrame operators: sessions, tracks, medians, sampling, reports, review."""

from .filters import filter_range, removal_counts, with_thresholds
from .medians import group_median, group_median_refined, median_split
from .reports import composition, count_by, duration_report, histogram_by
from .review import (
    attach_best,
    attach_expert_labels,
    attach_labels,
    check_domain,
    checklist_match,
    checklist_search,
    label_column,
    label_domain,
    missing_files,
    missing_identification,
    predicted_value,
    resolve_files,
    validation_metrics,
)
from .sampling import chunk, sample_n, stratified_sample, top_values
from .sessions import dedupe_sessions, session_intervals, session_join
from .tracks import (
    bbox_metrics,
    best_per_key,
    first_per_key,
    normalize_classes,
    parse_ts,
    track_parts,
    track_stats,
    track_top1,
    track_votes,
    tracks_from_parts,
    vote_cells,
    votes_from_parts,
)

__all__ = [
    "attach_best",
    "attach_expert_labels",
    "attach_labels",
    "bbox_metrics",
    "best_per_key",
    "check_domain",
    "checklist_match",
    "checklist_search",
    "chunk",
    "composition",
    "count_by",
    "dedupe_sessions",
    "duration_report",
    "filter_range",
    "first_per_key",
    "group_median",
    "group_median_refined",
    "histogram_by",
    "label_column",
    "label_domain",
    "median_split",
    "missing_files",
    "missing_identification",
    "normalize_classes",
    "parse_ts",
    "predicted_value",
    "removal_counts",
    "resolve_files",
    "sample_n",
    "session_intervals",
    "session_join",
    "stratified_sample",
    "top_values",
    "track_parts",
    "track_stats",
    "track_top1",
    "track_votes",
    "tracks_from_parts",
    "validation_metrics",
    "vote_cells",
    "votes_from_parts",
    "with_thresholds",
]
