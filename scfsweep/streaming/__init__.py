from scfsweep.streaming.logs import log_picks_so_far, read_log_stream, running_log_picks, snapshot_log_picks
from scfsweep.streaming.means import means_so_far, running_mean_differences, snapshot_means
from scfsweep.streaming.results import (
    append_stream,
    latest,
    read_result_stream,
    running_rows,
    running_spin_sums,
    running_spins,
    take_snapshot,
)

__all__ = [
    "append_stream",
    "latest",
    "log_picks_so_far",
    "means_so_far",
    "read_log_stream",
    "read_result_stream",
    "running_log_picks",
    "running_mean_differences",
    "running_rows",
    "running_spin_sums",
    "running_spins",
    "snapshot_log_picks",
    "snapshot_means",
    "take_snapshot",
]
