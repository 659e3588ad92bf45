"""Dictionary look-ups and category expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hourtide import fixed_values as fv


def lookup(key: Column, mapping: dict, default) -> Column:
    """``mapping[key]`` with a default for keys that are unknown or null."""
    entries = ", ".join(sql_literal(x) for pair in mapping.items() for x in pair)
    return F.coalesce(F.expr(f"map({entries})")[key], F.lit(default))


def sql_literal(value) -> str:
    """A text or number as SQL."""
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def weather_severity(weather: Column) -> Column:
    return lookup(weather, fv.WEATHER_SEVERITY, fv.DEFAULT_SEVERITY)


def weather_group(weather: Column) -> Column:
    return lookup(weather, fv.WEATHER_GROUPS, fv.DEFAULT_WEATHER_GROUP)


def weather_bucket(weather: Column) -> Column:
    """Coarse bucket of the basket items, whatever the case of the input."""
    flat = {name: bucket for bucket, names in fv.WEATHER_BUCKETS.items() for name in names}
    return lookup(F.lower(weather), flat, fv.DEFAULT_WEATHER_BUCKET)


def banded(value: Column, edges: list, labels: list[str]) -> Column:
    """Right-closed bands: value <= edges[0] is labels[0], and so on; the last label is open."""
    expr = F.when(value <= edges[0], F.lit(labels[0]))
    for edge, label in zip(edges[1:], labels[1:]):
        expr = expr.when(value <= edge, F.lit(label))
    return expr.when(value.isNotNull(), F.lit(labels[len(edges)]))


def volume_band(volume: Column) -> Column:
    """Low / Medium / High; values outside the binned range (below zero) have no band."""
    return F.when(volume > -1, banded(volume, fv.VOLUME_BAND_EDGES, fv.VOLUME_BAND_LABELS))


def quartile_category(volume: Column, quartiles: list, labels: list[str] | None = None, default: str = "Medium") -> Column:
    """Category by three cut points; a null volume falls to ``default``."""
    return F.coalesce(banded(volume, quartiles, labels or fv.QUARTILE_LABELS), F.lit(default))


def low_visibility(weather: Column, clouds: Column) -> Column:
    """1 where the sky is covered and the category limits sight. Training and serving share it."""
    hit = (clouds > fv.LOW_VISIBILITY_CLOUDS) & weather.isin(fv.LOW_VISIBILITY_WEATHER)
    return F.coalesce(hit, F.lit(False)).cast("int")


def member_flag(column: Column, values: list[str]) -> Column:
    return F.coalesce(column.isin(values), F.lit(False)).cast("int")
