"""Hour arithmetic, parsing and calendars on zone-free timestamps.

Hours are handled as the number of whole hours since 1970-01-01 (``hour_index``): a plain long that
does not depend on the session time zone, divides into slices and needs no interval arithmetic.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from segment_hours.config import DATE_KEYS

_EPOCH_DATE = "date'1970-01-01'"
_EPOCH_NTZ = "timestamp_ntz'1970-01-01 00:00:00'"


def as_datetime(value):
    """Driver-side coercion of a date, datetime or ISO string."""
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, dt.date):
        return dt.datetime(value.year, value.month, value.day)
    if isinstance(value, str):
        return dt.datetime.fromisoformat(value)
    raise TypeError(f"expected a date, datetime or ISO string, got {type(value).__name__}")


def as_range(start, end):
    """Both ends coerced; a start after the end is an error."""
    start, end = as_datetime(start), as_datetime(end)
    if start > end:
        raise ValueError("start must be <= end")
    return start, end


def ntz(value):
    """Zone-free timestamp literal of a date, datetime or ISO string."""
    return F.lit(as_datetime(value).isoformat(sep=" ")).cast("timestamp_ntz")


def hour_index(ts):
    """Whole hours since 1970-01-01."""
    return F.datediff(ts, F.expr(_EPOCH_DATE)).cast("bigint") * 24 + F.hour(ts)


def index_hour(index):
    """Inverse of :func:`hour_index`."""
    return F.expr(_EPOCH_NTZ) + F.make_dt_interval(hours=index.cast("int"))


def hour_index_literal(value):
    """``hour_index`` of a driver-side value."""
    return (as_datetime(value) - dt.datetime(1970, 1, 1)) // dt.timedelta(hours=1)


def hour_floor(ts):
    return index_hour(hour_index(ts))


def rounded_hour_index(ts):
    """Nearest hour with ties to the even hour: 00:30 goes to 0, 01:30 to 2."""
    seconds = F.minute(ts) * 60 + F.extract(F.lit("SECOND"), ts)
    hours = hour_index(ts)
    up = (seconds > 1800) | ((seconds == 1800) & (F.hour(ts) % 2 == 1))
    return hours + F.when(up, 1).otherwise(0)


def round_hour(ts):
    return index_hour(rounded_hour_index(ts))


_PARTS = {
    "year": F.year,
    "month": F.month,
    "day": F.dayofmonth,
    "hour": F.hour,
    "minute": F.minute,
    "second": F.second,
    "weekday": F.weekday,
}


def with_date_parts(df, ts, parts=tuple(DATE_KEYS)):
    """Adds calendar parts of ``ts`` (weekday: Monday is 0); None adds all of them."""
    parts = list(_PARTS) if parts is None else list(parts)
    unknown = [p for p in parts if p not in _PARTS]
    if unknown:
        raise ValueError(f"unsupported date parts {unknown}; supported: {list(_PARTS)}")
    return df.withColumns(date_columns(F.col(ts), parts))


def hour_of_parts(year="year", month="month", day="day", hour="hour"):
    """Timestamp of the four stored date columns."""
    zero = F.lit(0)
    return F.make_timestamp_ntz(F.col(year), F.col(month), F.col(day), F.col(hour), zero, zero)


def _parsed_minutes(text, pattern):
    """Minutes since 1970 of a text read as UTC, so that no session zone skips or shifts an hour."""
    instant = F.try_to_timestamp(F.concat(text, F.lit(" Z")), F.lit(pattern + " X"))
    return F.floor(F.unix_seconds(instant) / 60).cast("int")


def yymmdd(col):
    """Date of a YYMMDD text, null where it does not parse."""
    days = F.floor(_parsed_minutes(F.trim(col), "yyMMdd") / 1440).cast("int")
    return F.date_add(F.expr(_EPOCH_DATE), days)


def parse_dayfirst(col):
    """Day-first date time with ``-`` or ``/`` and a numeric or named month; null if neither fits."""
    text = F.replace(F.trim(col), F.lit("-"), F.lit("/"))
    named = _parsed_minutes(text, "dd/MMM/yyyy HH:mm")
    numeric = _parsed_minutes(text, "dd/MM/yyyy HH:mm")
    return F.expr(_EPOCH_NTZ) + F.make_dt_interval(mins=F.coalesce(named, numeric))


def _year_pair(year):
    return F.concat(year.cast("string"), F.lpad(((year + 1) % 100).cast("string"), 2, "0"))


# The business year starts on 1 April and is cut into periods of 28 days.
_YEAR_START = (4, 1)
_PERIOD_DAYS = 28


def business_year_start(day):
    """Python date of the 1 April on or before ``day``."""
    year = day.year if (day.month, day.day) >= _YEAR_START else day.year - 1
    return dt.date(year, *_YEAR_START)


def business_period(ts):
    """Period code such as ``202425_P01``; the 14th period holds the last one or two days."""
    day = F.to_date(ts)
    year = F.when(F.month(day) >= _YEAR_START[0], F.year(day)).otherwise(F.year(day) - 1)
    start = F.make_date(year, F.lit(_YEAR_START[0]), F.lit(_YEAR_START[1]))
    number = F.floor(F.datediff(day, start) / _PERIOD_DAYS) + 1
    return F.concat(_year_pair(year), F.lit("_P"), F.lpad(number.cast("string"), 2, "0"))


def timetable_season(ts):
    """Season code: May to November is ``_MAY``, December to April ``_DEC`` of the year before."""
    year = F.when(F.month(ts) >= 5, F.year(ts)).otherwise(F.year(ts) - 1)
    part = F.when(F.month(ts).between(5, 11), "_MAY").otherwise("_DEC")
    return F.concat(_year_pair(year), part)


def timetable_seasons(start, end):
    """Season codes that a driver-side window touches, in time order."""
    start, end = as_range(start, end)
    codes = []
    year, month = start.year, start.month
    while (year, month) <= (end.year, end.month):
        first = year if month >= 5 else year - 1
        code = f"{first}{(first + 1) % 100:02d}_{'MAY' if 5 <= month <= 11 else 'DEC'}"
        if code not in codes:
            codes.append(code)
        year, month = (year, month + 1) if month < 12 else (year + 1, 1)
    return codes


def period_calendar(spark, start, end):
    """Business periods that meet the window: season, period, code, first_day, last_day."""
    start, end = as_range(start, end)
    first = business_year_start(start.date())
    years = end.year - first.year + 1
    starts = spark.range(years).select(
        F.make_date((F.lit(first.year) + F.col("id")).cast("int"), F.lit(4), F.lit(1)).alias("year_start")
    )
    periods = starts.select(
        "year_start",
        F.add_months("year_start", 12).alias("next_start"),
        F.explode(F.sequence(F.lit(0), F.lit(13))).alias("n"),
    )
    first_day = F.date_add("year_start", F.col("n") * _PERIOD_DAYS)
    last_day = F.least(F.date_add(first_day, _PERIOD_DAYS - 1), F.date_sub("next_start", 1))
    period = F.concat(F.lit("P"), F.lpad((F.col("n") + 1).cast("string"), 2, "0"))
    return (
        periods.select(
            _year_pair(F.year("year_start")).alias("season"),
            period.alias("period"),
            first_day.alias("first_day"),
            last_day.alias("last_day"),
        )
        .withColumn("code", F.concat_ws("_", "season", "period"))
        .where((F.col("first_day") <= F.lit(end.date())) & (F.col("last_day") >= F.lit(start.date())))
    )


def seasonal_features(ts):
    """Encodings of the day of year and the day of week (Sunday is 0), by column name; the same at all hours of a day."""
    year_angle = 2 * F.pi() * F.dayofyear(ts) / 365.25
    return {
        "sin_doy": F.sin(year_angle),
        "cos_doy": F.cos(year_angle),
        "day_of_week": (F.dayofweek(ts) - 1).cast("bigint"),
    }


def daily_features(hour):
    """Encodings of the hour of day, by column name."""
    day_angle = 2 * F.pi() * hour / 24
    return {"sin_hod": F.sin(day_angle), "cos_hod": F.cos(day_angle)}


def date_columns(ts, parts=tuple(DATE_KEYS)):
    """Calendar parts of ``ts`` by name."""
    return {p: _PARTS[p](ts) for p in parts}


def utc_ntz(column):
    """Zone-free UTC time of a stamp: an offset in the text is applied, text without one is taken as it is, bad text is null.

    Independent of the session time zone.
    """
    text = F.trim(column.cast("string"))
    zoned = text.rlike(r"\d:\d{2}.*?(Z|[+-]\d{1,2}(:?\d{2})?)$")
    instant = F.regexp_replace(text, r"([+-]\d{2})(\d{2})$", "$1:$2").try_cast("timestamp")
    seconds = F.unix_micros(instant).cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(7,0)")
    moved = ntz(dt.datetime(1970, 1, 1)) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))
    return F.when(zoned, moved).otherwise(text.try_cast("timestamp_ntz"))
