"""Timestamps, dates and times of day, independent of the session's time zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: microseconds of 0001-01-01T00:00:00Z, the zero timestamp.
ZERO_TIMESTAMP_MICROS = -62135596800000000
# Fixed value: the shape of a time of day kept as text.
TIME_PATTERN = r"^([01]\d|2[0-3]):[0-5]\d:[0-5]\d(\.\d{1,6})?$"


def utc_wall_clock(ts: Column) -> Column:
    """The UTC wall clock of an instant as TIMESTAMP_NTZ.

    Counting from the epoch never passes through the session's zone, so the value
    survives that zone's daylight saving changes.
    """
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), epoch)


def local_wall_clock(ts: Column, zone: Column | str) -> Column:
    """The wall clock of an instant in ``zone`` as TIMESTAMP_NTZ."""
    return utc_wall_clock(_moved(ts, zone))


def to_date(ts: Column, zone: Column | str) -> Column:
    return _day(_moved(ts, zone))


def to_datetime(ts: Column, zone: Column | str) -> Column:
    return local_wall_clock(ts, zone)


def utc_hour_text(ts: Column) -> Column:
    """``yyyy-MM-ddTHH``: text that sorts like the hours it names."""
    hour = _digits(_whole(_micros_of_day(ts), 3600 * _SECOND), 2)
    return F.concat(_day(ts).cast("string"), F.lit("T"), hour)


def to_time(ts: Column, zone: Column | str) -> Column:
    """``HH:mm:ss`` with six fractional digits when there are any."""
    micros = _micros_of_day(_moved(ts, zone))
    fraction = micros % _SECOND
    return F.when(fraction == 0, _clock(micros)).otherwise(F.concat(_clock(micros), F.lit("."), _digits(fraction, 6)))


def time_of(wall: Column) -> Column:
    """The time of day in the text of a wall clock."""
    text = F.substring(wall.cast("string"), 12, 15)
    return F.when(F.length(text) > 8, F.rpad(text, 15, "0")).otherwise(text)


def rfc3339(ts: Column) -> Column:
    """RFC 3339 text in UTC, trailing zeros of the fraction dropped."""
    micros = _micros_of_day(ts)
    fraction = micros % _SECOND
    whole = F.concat(_day(ts).cast("string"), F.lit("T"), _clock(micros))
    digits = F.rtrim(_digits(fraction, 6), F.lit("0"))
    return F.when(fraction == 0, F.concat(whole, F.lit("Z"))).otherwise(F.concat(whole, F.lit("."), digits, F.lit("Z")))


def civil_datetime_text(wall: Column) -> Column:
    """ISO text without a zone; a fraction always has nine digits."""
    text = F.replace(wall.cast("string"), F.lit(" "), F.lit("T"))
    return _nine_digits(text, 19)


def civil_time_text(time: Column) -> Column:
    return _nine_digits(time, 8)


_SECOND = 1_000_000
_DAY = 86_400 * _SECOND


def _moved(ts: Column, zone: Column | str) -> Column:
    """The instant moved by the zone's offset, so that its UTC wall clock is the local one.

    A literal zone is resolved once per task rather than once per row.
    """
    if isinstance(zone, str) and zone.upper() == "UTC":
        return ts
    return F.from_utc_timestamp(ts, zone if isinstance(zone, Column) else F.lit(zone))


def _micros_of_day(ts: Column) -> Column:
    return F.pmod(F.unix_micros(ts), F.lit(_DAY))


def _day(ts: Column) -> Column:
    """The UTC date."""
    micros = F.unix_micros(ts)
    return F.date_from_unix_date(_whole(micros - F.pmod(micros, F.lit(_DAY)), _DAY).cast("int"))


def _whole(number: Column, by: int) -> Column:
    return F.call_function("div", number, F.lit(by))


def _clock(micros: Column) -> Column:
    """``HH:mm:ss`` by arithmetic, faster than a formatter and free of the session's zone."""
    seconds = _whole(micros, _SECOND)
    hours, minutes = _whole(seconds, 3600), _whole(seconds, 60) % 60
    return F.concat(_digits(hours, 2), F.lit(":"), _digits(minutes, 2), F.lit(":"), _digits(seconds % 60, 2))


def _digits(number: Column, width: int) -> Column:
    """A number below 10^width with its leading zeros."""
    return F.substring((number + 10**width).cast("string"), 2, width)


def _nine_digits(text: Column, whole: int) -> Column:
    return F.when(F.length(text) > whole, F.rpad(text, whole + 10, "0")).otherwise(text)
