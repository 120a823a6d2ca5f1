from scfsweep.sources.folders import parse_folders, run_folders
from scfsweep.sources.inputs import cell_items, input_files, param_settings
from scfsweep.sources.logs import log_lines, tag_lines
from scfsweep.sources.quarantine import quarantine, sort_lines
from scfsweep.sources.results import (
    append_parts,
    conform,
    read_results,
    read_run_parts,
    read_run_results,
)

__all__ = [
    "append_parts",
    "cell_items",
    "conform",
    "input_files",
    "log_lines",
    "param_settings",
    "parse_folders",
    "quarantine",
    "read_results",
    "read_run_parts",
    "read_run_results",
    "run_folders",
    "sort_lines",
    "tag_lines",
]
