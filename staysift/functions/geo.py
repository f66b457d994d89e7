"""Coordinate expressions: ``lat|lon`` text to two DOUBLE columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from staysift.functions.text import ColumnOrName, _col, strip_ws, to_number


def in_range(c: ColumnOrName, low: float, high: float) -> Column:
    """Range-validity predicate, both ends inclusive (NULL is not valid)."""
    return F.coalesce(_col(c).between(low, high), F.lit(False))


def lat_lon(c: ColumnOrName) -> tuple[Column, Column]:
    """Split ``lat|lon`` at the first ``|`` and validate both parts together.

    Either part unparsable or out of range (lat -90..90, lon -180..180) makes
    *both* NULL. ``1|2|3`` has second part ``2|3`` and so is invalid.
    """
    s = strip_ws(F.coalesce(_col(c), F.lit("")))
    parts = F.split(s, r"\|", 2)
    lat = to_number(F.get(parts, 0))
    lon = to_number(F.get(parts, 1))
    ok = in_range(lat, -90.0, 90.0) & in_range(lon, -180.0, 180.0)
    return F.when(ok, lat), F.when(ok, lon)


def lat_lon_loose(c: ColumnOrName) -> tuple[Column, Column]:
    """Split on every ``|`` and coerce the first two parts, without a range check."""
    parts = F.split(_col(c), r"\|")
    return to_number(F.get(parts, 0)), to_number(F.get(parts, 1))
