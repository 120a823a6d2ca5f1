"""Column expressions for arithmetic, number text and inclusive sequences."""

from __future__ import annotations


from pyspark.sql import Column
from pyspark.sql import functions as F

from scfsweep.schema import SWEEP_DECIMAL

# What the sweep's arguments may look like.
INTEGER_PATTERN = r"^[0-9]+$"
SIGNED_DECIMAL_PATTERN = r"^[+-]?[0-9]+\.?[0-9]*$"
NUMBER_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def reciprocal(value: Column) -> Column:
    """``1 / value`` with floating-point rules: infinity at zero, whatever the session's ANSI mode."""
    return F.when(value == 0, F.lit(float("inf"))).otherwise(F.lit(1.0) / value)


def is_integer_text(text: Column) -> Column:
    return text.rlike(INTEGER_PATTERN)


def is_signed_decimal_text(text: Column) -> Column:
    return text.rlike(SIGNED_DECIMAL_PATTERN)


def is_number_text(text: Column) -> Column:
    """Plain or exponent notation; refuses the suffixes (``2d``) a bare cast would take."""
    return text.rlike(NUMBER_PATTERN)


def default_if_blank(text: Column, default: str) -> Column:
    """The text, or ``default`` where it is NULL or empty."""
    return F.coalesce(F.nullif(F.trim(text), F.lit("")), F.lit(default))


def fixed_text(value: Column) -> Column:
    """A set-point as input files hold it: 14 decimals and one more zero."""
    return F.concat(_decimal_text(value, "0.00000000000000"), F.lit("0"))


def short_text(value: Column) -> Column:
    """A decimal without trailing zeros: 2, 0.5, -1."""
    return _decimal_text(value, "#0.##############")


def _decimal_text(value: Column, form: str) -> Column:
    # A cast to string would turn small decimals to exponent notation in sessions without ANSI mode.
    return F.call_function("format_number", value.cast(SWEEP_DECIMAL), F.lit(form))


def scientific_text(value: Column) -> Column:
    """Exponent notation with six decimals."""
    return F.format_string("%e", value.cast("double"))


def steps_list(start: Column, step: Column, end: Column) -> Column:
    """Inclusive arithmetic sequence as ``array<decimal>``, rising or falling.

    Each member is ``start + i * step`` in exact decimals, so 0.05..0.25 by 0.05 has five members.
    A zero step, or one that leads away from ``end``, gives an empty array; a NULL gives NULL.
    """
    start, step, end = (c.cast(SWEEP_DECIMAL) for c in (start, step, end))
    runs = ((step > 0) & (end >= start)) | ((step < 0) & (end <= start))
    # A long quotient may have been rounded up to a whole number: check its member against `end`.
    quotient = F.floor((end - start) / F.nullif(step, F.lit(0).cast(SWEEP_DECIMAL))).cast("int")
    reached = start + quotient.cast("decimal(9,0)") * step
    beyond = F.when(step > 0, reached > end).otherwise(reached < end)
    last = quotient - F.when(beyond, 1).otherwise(0)
    members = F.transform(
        F.sequence(F.lit(0), F.when(runs, last).otherwise(0)),
        lambda i: (start + i.cast("decimal(9,0)") * step).cast(SWEEP_DECIMAL),
    )
    empty = F.array().cast("array<decimal(24,14)>")
    return (
        F.when(start.isNull() | step.isNull() | end.isNull(), F.lit(None))
        .when(runs, members)
        .otherwise(empty)
    )


def steps_count(start: Column, step: Column, end: Column) -> Column:
    """Number of members of :func:`steps_list`."""
    return F.size(steps_list(start, step, end))
