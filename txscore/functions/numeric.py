"""Small numeric helpers."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_even(value: Column, places: int) -> Column:
    """Scale, round half to even, unscale."""
    scale = float(10 ** places)
    return F.rint(value * scale) / scale


def percent(part: Column, whole: Column) -> Column:
    """`part` of `whole` in percent; null when there is no whole."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * 100.0


def missing(name: str, dtype: str) -> Column:
    """True for null, and for NaN in floating-point columns."""
    column = F.col(f"`{name}`")
    if dtype in ("double", "float"):
        return column.isNull() | F.isnan(column)
    return column.isNull()
