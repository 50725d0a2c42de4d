"""Hour-of-day features. Departure times are text, since service days run past 24:00."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from timelegs.functions.text import col

# Inclusive hour ranges.
PEAK_HOURS = [(7, 9), (16, 18)]
DAY_PERIODS = {"Morning": (5, 11), "Afternoon": (12, 16), "Evening": (17, 21)}
REMAINING_PERIOD = "Night"


def departure_hour(departure_time: Column | str) -> Column:
    """Hour 0-23 of ``H:MM…`` text (``25:10`` is 1); NULL where no hour leads it."""
    leading = F.regexp_extract(col(departure_time), r"^(\d{1,2}):", 1)
    return F.pmod(leading.try_cast("int"), F.lit(24))


def is_peak(hour: Column | str) -> Column:
    hour = col(hour)
    (a, b), (c, d) = PEAK_HOURS
    return F.when(hour.between(a, b) | hour.between(c, d), 1).otherwise(0)


def time_of_day(hour: Column | str) -> Column:
    """Period name; an unknown hour falls in the remaining period."""
    hour = col(hour)
    named = F
    for label, (first, last) in DAY_PERIODS.items():
        named = named.when(hour.between(first, last), F.lit(label))
    return named.otherwise(F.lit(REMAINING_PERIOD))


def period_rank(period: Column | str) -> Column:
    """Position of a period in the day, for ordering reports."""
    period = col(period)
    ranked = F
    for position, label in enumerate(DAY_PERIODS, start=1):
        ranked = ranked.when(period == label, F.lit(position))
    return ranked.otherwise(F.lit(len(DAY_PERIODS) + 1))
