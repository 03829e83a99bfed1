"""Solar time and position from a time in UTC and a place, by the usual Fourier series."""

from __future__ import annotations

from math import pi

from pyspark.sql import Column
from pyspark.sql import functions as F


def year_angle(time: Column) -> Column:
    """The fraction of the year that has passed, in radians, by whole hours."""
    first = F.make_date(F.year(time), F.lit(1), F.lit(1))
    days = F.datediff(F.add_months(first, 12), first)
    return 2 * pi / days * (F.dayofyear(time) - 1 + (F.hour(time) - 12) / 24)


def series(angle: Column, terms: tuple[tuple[float, float], ...], constant: float) -> Column:
    return sum((a * F.cos(k * angle) + b * F.sin(k * angle) for k, (a, b) in enumerate(terms, 1)), F.lit(constant))


def equation_of_time(time: Column) -> Column:
    """Minutes by which a sundial is ahead of a clock."""
    return 229.18 * series(year_angle(time), ((0.001868, -0.032077), (-0.014615, -0.040849)), 0.000075)


def declination(time: Column) -> Column:
    """Of the sun, in radians."""
    return series(year_angle(time), ((-0.399912, 0.070257), (-0.006758, 0.000907), (-0.002697, 0.00148)), 0.006918)


def local_solar_time(time: Column, longitude: Column) -> Column:
    """A time in UTC as a sundial at a longitude (degrees, east positive) shows it."""
    ahead = F.round(longitude / 360 * 24 * 3.6e9) + F.round(equation_of_time(time) * 6e7)
    return F.timestamp_micros(F.unix_micros(time) + ahead.cast("bigint"))


def position(time: Column, longitude: Column, latitude: Column) -> tuple[Column, Column]:
    """Azimuth (degrees from north by east) and elevation (degrees over the horizon, without refraction) of the sun."""
    local = F.unix_micros(local_solar_time(time, longitude))
    hour = F.radians(F.pmod(local, F.lit(86_400_000_000)) / 86_400_000_000 * 360 - 180)
    d, p = declination(time), F.radians(latitude)
    up = F.sin(p) * F.sin(d) + F.cos(p) * F.cos(d) * F.cos(hour)
    east, north = -F.cos(d) * F.sin(hour), F.cos(p) * F.sin(d) - F.sin(p) * F.cos(d) * F.cos(hour)
    return F.pmod(F.degrees(F.atan2(east, north)), F.lit(360.0)), F.degrees(F.asin(F.least(F.greatest(up, F.lit(-1.0)), F.lit(1.0))))


def direction(azimuth: Column, elevation: Column) -> tuple[Column, Column, Column]:
    """The unit vector to the sun: to the east, to the north, up."""
    a, e = F.radians(azimuth), F.radians(elevation)
    return F.cos(e) * F.sin(a), F.cos(e) * F.cos(a), F.sin(e)
