"""Column expressions shared by the operators; all stay inside Catalyst."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fill_missing(column: str | Column, value: float) -> Column:
    """Replace NULL and NaN by ``value``."""
    return F.nanvl(F.coalesce(column, F.lit(value)), F.lit(value))


def to_number(column: str) -> Column:
    """The column as double; text that is not a number becomes NULL."""
    return F.col(column).try_cast("double")


def bought_later(position: str | Column, trigger_position: str | Column) -> Column:
    """1 where ``position`` exists and comes after the trigger's, else 0."""
    later = F.col(position) > F.col(trigger_position)
    return F.coalesce(later, F.lit(False)).cast("int")


def yes_no(label: str) -> Column:
    """The label as ``Yes`` or ``No``."""
    return F.when(F.col(label) == 1, "Yes").otherwise("No")


def row_hash(*parts: Column | str | int) -> Column:
    """A hash that depends on the values only, never on how rows are partitioned."""
    texts = [part if isinstance(part, Column) else F.lit(str(part)) for part in parts]
    return F.md5(F.concat_ws(":", *[text.cast("string") for text in texts]))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator``, and 0 where the denominator is 0."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))
