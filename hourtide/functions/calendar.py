"""Calendar expressions and range predicates that reach the scan."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from hourtide import fixed_values as fv


def day_of_week(ts: Column) -> Column:
    """Monday is 0."""
    return F.weekday(ts)


def is_weekend(dow: Column) -> Column:
    return (dow >= 5).cast("int")


def day_type(weekend: Column) -> Column:
    return F.when(weekend >= 1, F.lit("weekend")).when(weekend.isNotNull(), F.lit("weekday"))


def day_part(hour: Column) -> Column:
    expr = None
    for name, first, last in fv.DAY_PARTS:
        hit = (hour >= first) & (hour < last)
        expr = F.when(hit, F.lit(name)) if expr is None else expr.when(hit, F.lit(name))
    return expr.otherwise(F.lit(fv.DEFAULT_DAY_PART))


def month_name(ts: Column) -> Column:
    return F.get(F.array(*[F.lit(name) for name in fv.MONTH_NAMES]), F.month(ts) - 1)


def cyclic(value: Column, period: int) -> tuple[Column, Column]:
    """(sin, cos) of the angle of ``value`` in its period."""
    angle = F.lit(2 * math.pi) * value / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def _stamp(moment: dt.datetime) -> Column:
    """A zone-less literal; going through text keeps the session's time zone out of it."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def years_between(ts: Column, first: int, last: int) -> Column:
    """Whole years as a half-open range on the raw column, so that the scan can skip row groups.
    ``year(ts) BETWEEN ...`` says the same but hides the column from the file statistics."""
    return (ts >= _stamp(dt.datetime(first, 1, 1))) & (ts < _stamp(dt.datetime(last + 1, 1, 1)))


def through_year(ts: Column, last: int) -> Column:
    return ts < _stamp(dt.datetime(last + 1, 1, 1))


def on_day(ts: Column, day: str) -> Column:
    """All moments of one calendar day; a text that is not a date is the caller's error."""
    try:
        start = dt.datetime.combine(dt.date.fromisoformat(day), dt.time())
    except ValueError as bad:
        raise ValueError(f"not a date (YYYY-MM-DD): {day!r}") from bad
    return (ts >= _stamp(start)) & (ts < _stamp(start + dt.timedelta(days=1)))
