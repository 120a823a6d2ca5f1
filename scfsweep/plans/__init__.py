from scfsweep.plans.analyze import Analysis, analyze, analyze_folders, analyze_pairs, analyze_single, perturbation_values
from scfsweep.plans.export import (
    append_results,
    export_analysis,
    reset_results,
    write_channel_views,
    write_means,
    write_total_view,
)

__all__ = [
    "Analysis",
    "analyze",
    "analyze_folders",
    "analyze_pairs",
    "analyze_single",
    "append_results",
    "export_analysis",
    "perturbation_values",
    "reset_results",
    "write_channel_views",
    "write_means",
    "write_total_view",
]
