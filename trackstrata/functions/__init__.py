"""Column expressions: all built-in, no Python UDF."""

from .jsonfields import json_fields, json_first, json_path, json_truthy
from .labels import cut_labels, decile_bin, decile_labels, median_half, membership_label, prob_class
from .numeric import (
    clip,
    exact_mean,
    exact_sum,
    finite,
    mean_from_parts,
    present,
    round_half_up,
    sum_parts,
    vote_weight,
    whole_seconds,
)
from .priority import sample_priority
from .text import basename, empty_to_null, name_slug, normal_name, wall_clock
from .thresholds import in_range, threshold

__all__ = [
    "basename",
    "clip",
    "cut_labels",
    "decile_bin",
    "decile_labels",
    "empty_to_null",
    "exact_mean",
    "exact_sum",
    "finite",
    "in_range",
    "json_fields",
    "json_first",
    "json_path",
    "json_truthy",
    "mean_from_parts",
    "median_half",
    "membership_label",
    "name_slug",
    "normal_name",
    "present",
    "prob_class",
    "round_half_up",
    "sample_priority",
    "sum_parts",
    "threshold",
    "vote_weight",
    "whole_seconds",
    "wall_clock",
]
