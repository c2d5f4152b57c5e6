"""Row-wise expressions. All are built-in Column expressions, so they stay inside codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F, types as T

EARTH_RADIUS_KM = 6371


def blank_to_null(c: Column) -> Column:
    """The empty string counts as missing; blanks are not trimmed."""
    return F.when(c != "", c)


def finite(c: Column) -> Column:
    """NaN and infinities to NULL, with few evaluations of ``c``: repeated expressions outgrow the compiled method.

    Zero times an infinity is NaN. One infinite value would make means and deviations of its whole column useless.
    """
    return F.nanvl(c * 0 + c, F.lit(None).cast("double"))


def to_double(c: Column) -> Column:
    """Lenient number parse: anything unreadable, NaN and infinities become NULL.

    Java reads a trailing type letter (``1d``) and hexadecimal floats as numbers; those texts are
    not numbers here.
    """
    text = c.cast("string")
    return finite(F.when(~text.rlike(r"[0-9.][dDfF]\s*$|0[xX]"), text.try_cast("double")))


def to_long(c: Column) -> Column:
    """Lenient integer parse, truncating toward zero; infinities and overflow become NULL."""
    return to_double(c).try_cast("bigint")


def as_double(c: Column, dtype: T.DataType) -> Column:
    """``to_double`` for text; numeric columns only lose what is not finite."""
    if isinstance(dtype, T.StringType):
        return to_double(c)
    return finite(c.cast("double"))


def to_event_timestamp(c: Column, dtype: T.DataType | None = None) -> Column:
    """Lenient timestamp parse in the session zone (UTC); bad text becomes NULL."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return c.cast("timestamp")
    return F.try_to_timestamp(c)


def event_time(text: Column, epoch_seconds: Column) -> Column:
    """Parsed text, else whole epoch seconds."""
    return F.coalesce(F.try_to_timestamp(text),
                      F.timestamp_seconds(epoch_seconds.try_cast("bigint")))


def clipped_log1p(c: Column, null_as_zero: bool = False) -> Column:
    """``log1p(max(x, 0))``. ``greatest`` skips NULL, so NULL is guarded explicitly."""
    logged = F.log1p(F.greatest(c, F.lit(0.0)))
    return logged if null_as_zero else F.when(c.isNotNull(), logged)


def planar_distance(lat1: Column, lon1: Column, lat2: Column, lon2: Column,
                    null_as_zero: bool = False) -> Column:
    """Euclidean distance in degrees."""
    if null_as_zero:
        lat1, lon1, lat2, lon2 = (F.coalesce(c, F.lit(0.0)) for c in (lat1, lon1, lat2, lon2))
    d_lat, d_lon = lat1 - lat2, lon1 - lon2
    return F.sqrt(d_lat * d_lat + d_lon * d_lon)


def haversine_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle distance."""
    half_lat = F.sin((F.radians(lat2) - F.radians(lat1)) / 2)
    half_lon = F.sin((F.radians(lon2) - F.radians(lon1)) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.asin(F.sqrt(chord)) * (2 * EARTH_RADIUS_KM)


def is_night(hour: Column) -> Column:
    return ((hour >= 22) | (hour < 5)).cast("int")


def is_weekend(day_of_week: Column) -> Column:
    """Monday is 0."""
    return (F.coalesce(day_of_week, F.lit(0)) >= 5).cast("int")


def is_member(c: Column, values: Sequence[str], null_as: int | None = None) -> Column:
    """1 when ``c`` is in a short literal list; a NULL stays NULL unless ``null_as`` is given."""
    flag = c.isin(list(values)).cast("int")
    return flag if null_as is None else F.coalesce(flag, F.lit(null_as))
