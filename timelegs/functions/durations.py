"""ISO-8601 durations as used by timetable run times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from timelegs.functions.text import col, is_blank

# Fixed value: hours, minutes and seconds only, each optional, in this order.
RUN_TIME = r"^PT(?:(\d+)H)?(?:(\d+)M)?(?:(\d+)S)?$"


def duration_seconds(text: Column | str) -> Column:
    """Seconds in a run time such as ``PT2M30S``; NULL unless the whole text matches.

    ``try_`` arithmetic: a digit run too long for a bigint gives NULL, not an error.
    """
    trimmed = F.trim(col(text))

    def part(group: int, unit: int) -> Column:
        digits = F.regexp_extract(trimmed, RUN_TIME, group)
        number = F.when(digits == "", F.lit(0).cast("bigint")).otherwise(digits.try_cast("bigint"))
        return F.try_multiply(number, F.lit(unit).cast("bigint"))

    total = F.try_add(F.try_add(part(1, 3600), part(2, 60)), part(3, 1))
    return F.when(trimmed.rlike(RUN_TIME), total.try_cast("int"))


def seconds_to_minutes(seconds: Column | str) -> Column:
    return F.round(col(seconds) / F.lit(60.0), 3)


def runtime_class(text: Column | str) -> Column:
    """``missing``, ``invalid``, ``zero`` or ``positive``."""
    seconds = duration_seconds(text)
    return (
        F.when(is_blank(text), "missing")
        .when(seconds.isNull(), "invalid")
        .when(seconds == 0, "zero")
        .otherwise("positive")
    )
