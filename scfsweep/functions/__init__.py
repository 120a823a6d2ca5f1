from scfsweep.functions.jobs import (
    all_slashes,
    file_stem,
    is_perturbed,
    job_folder,
    job_path,
    job_step,
    job_u,
    normalise_job,
    seed_of,
)
from scfsweep.functions.numbers import (
    default_if_blank,
    fixed_text,
    is_integer_text,
    is_number_text,
    is_signed_decimal_text,
    reciprocal,
    scientific_text,
    short_text,
    steps_count,
    steps_list,
)

__all__ = [
    "all_slashes",
    "default_if_blank",
    "file_stem",
    "fixed_text",
    "is_integer_text",
    "is_number_text",
    "is_perturbed",
    "is_signed_decimal_text",
    "job_folder",
    "job_path",
    "job_step",
    "job_u",
    "normalise_job",
    "reciprocal",
    "scientific_text",
    "seed_of",
    "short_text",
    "steps_count",
    "steps_list",
]
