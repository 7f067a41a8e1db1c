"""Readers for session configs, detection files, tables, checklists and file listings."""

from .checks import require_columns, require_rows
from .configs import config_quality, merged_config_columns, parse_configs, read_configs, rejected_configs
from .detections import read_detections, read_table
from .files import file_index, index_paths, read_checklist, stratum_number, with_stratum_number
from .listing import list_files

__all__ = [
    "config_quality",
    "file_index",
    "index_paths",
    "list_files",
    "merged_config_columns",
    "parse_configs",
    "read_checklist",
    "read_configs",
    "read_detections",
    "read_table",
    "rejected_configs",
    "require_columns",
    "require_rows",
    "stratum_number",
    "with_stratum_number",
]
