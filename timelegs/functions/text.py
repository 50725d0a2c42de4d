"""Text cleaning, keys, literals and display formats."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


# The characters that count as white space around a value.
WHITESPACE = "".join(
    map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def non_blank(c: Column | str) -> Column:
    """The trimmed text, NULL where nothing is left."""
    return F.nullif(F.trim(col(c)), F.lit(""))


def is_blank(c: Column | str) -> Column:
    """True for NULL and for text that is empty once trimmed; works on any type."""
    c = col(c)
    return c.isNull() | (F.trim(c.cast("string")) == "")


def all_present(columns: list[str]) -> Column:
    """True when every listed column holds non-blank text."""
    return reduce(lambda a, b: a & b, [~is_blank(c) for c in columns])


def stripped(c: Column | str) -> Column:
    """The text without white space of any kind around it; ``non_blank`` knows spaces only."""
    return F.btrim(col(c), F.lit(WHITESPACE))


def first_non_blank(*columns: Column | str, default: str | None = None) -> Column:
    """The first listed value that is not blank, without white space around it."""
    candidates = [F.nullif(stripped(c), F.lit("")) for c in columns]
    if default is not None:
        candidates.append(F.lit(default))
    return F.coalesce(*candidates)


def text_or_blank(c: Column | str) -> Column:
    return F.coalesce(stripped(c), F.lit(""))


def segment_key(from_ref: Column | str, to_ref: Column | str) -> Column:
    return F.concat_ws("_", col(from_ref), col(to_ref))


def area_code(stop_ref: Column | str) -> Column:
    """The three leading digits of a stop reference, blank where it has none."""
    return F.regexp_extract(col(stop_ref), r"^(\d{3})", 1)


def completeness(columns: list[str]) -> Column:
    """How many of the columns hold text; 0 is a value, not a gap."""
    return reduce(lambda a, b: a + b, [(~is_blank(c)).cast("int") for c in columns])


def text_is_true(c: Column | str) -> Column:
    return F.coalesce(F.lower(F.trim(col(c).cast("string"))) == "true", F.lit(False))


def sql_literal(c: Column | str, data_type: str) -> Column:
    """The value as it is written in an INSERT statement."""
    c = col(c)
    if data_type == "boolean":
        shown = F.when(c, F.lit("1")).otherwise(F.lit("0"))
    elif data_type in ("tinyint", "smallint", "int", "bigint", "float", "double") or data_type.startswith(
        "decimal"
    ):
        shown = c.cast("string")
    else:
        shown = F.concat(F.lit("'"), F.replace(c.cast("string"), F.lit("'"), F.lit("''")), F.lit("'"))
    return F.when(c.isNull(), F.lit("NULL")).otherwise(shown)


def minutes_label(c: Column | str) -> Column:
    """``1.250 min``, or ``N/A`` where there is no value."""
    c = col(c).cast("double")
    return F.when(c.isNull(), F.lit("N/A")).otherwise(F.format_string("%.3f min", c))
