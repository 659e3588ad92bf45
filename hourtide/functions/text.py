"""Text normalisation and the wording of hours and numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hourtide import fixed_values as fv


# Fixed value: what counts as white space at the ends of a text.
WHITE = r"[\s\x0B\x1C-\x1F\x85\u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]+"
# A character that no letter text holds marks where words begin.
MARK = "\u0001"


def stripped(column: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(column, f"^{WHITE}|{WHITE}$", "")


def title_text(column: Column) -> Column:
    """Strip, then title case: a word begins after anything that is not a letter."""
    words = F.split(F.regexp_replace(F.lower(stripped(column)), r"(\P{L})(?=\p{L})", f"$1{MARK}"), MARK)
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 2**31 - 1))), "")


def lower_text(column: Column) -> Column:
    return F.lower(stripped(column))


def is_blank(column: Column) -> Column:
    return column.isNull() | (column == "")


def hour_label(hour: Column) -> Column:
    """12-hour clock, e.g. 0 -> 12:00 AM, 13 -> 1:00 PM."""
    twelve = F.when(hour % 12 == 0, F.lit(12)).otherwise(hour % 12)
    return F.concat(twelve.cast("string"), F.lit(":00 "), F.when(hour < 12, F.lit("AM")).otherwise(F.lit("PM")))


def hour_range_label(hour: Column) -> Column:
    return F.concat(hour_label(hour), F.lit(fv.HOUR_RANGE_SEPARATOR), hour_label((hour + 1) % 24))


def whole_number(value: Column) -> Column:
    """Thousands separators, no decimals."""
    return F.format_number(value, 0)
