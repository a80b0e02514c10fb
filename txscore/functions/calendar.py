"""Time features. Bad text gives null, never an error."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from txscore.constants import DAY_NAMES, DAYS_PER_YEAR

MICROS_PER_DAY = 86_400_000_000


def parse_ts(text: Column) -> Column:
    return F.try_to_timestamp(text)


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts)


def dow_sunday1(ts: Column) -> Column:
    """1 = Sunday: the model feature."""
    return F.dayofweek(ts)


def dow_monday0(ts: Column) -> Column:
    """0 = Monday: exploration."""
    return F.weekday(ts)


def dow_sunday0(ts: Column) -> Column:
    """0 = Sunday: serving reports."""
    return F.dayofweek(ts) - 1


def day_name(sunday0: Column) -> Column:
    return F.try_element_at(F.array(*[F.lit(name) for name in DAY_NAMES]), sunday0 + 1)


def month_of_year(ts: Column) -> Column:
    return F.month(ts)


def age_by_year(ts: Column, birth: Column) -> Column:
    """Difference of the calendar years, as the model sees it."""
    return (F.year(ts) - F.year(birth)).cast("double")


def age_fractional(ts: Column, birth: Column) -> Column:
    """Whole days over 365.25, not below zero; null stays null."""
    days = F.floor((F.unix_micros(ts) - F.unix_micros(birth)) / F.lit(MICROS_PER_DAY))
    years = days.cast("double") / F.lit(DAYS_PER_YEAR)
    return F.when(years < 0, F.lit(0.0)).otherwise(years)


def hour_start(ts: Column) -> Column:
    return F.date_trunc("hour", ts)
