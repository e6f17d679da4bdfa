"""Dates, times and timestamps."""

from __future__ import annotations

import re
from typing import Any

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from .core import as_column, as_value

#: Fixed format tokens and the Java pattern letters of the same meaning; longer tokens first.
TOKENS = {
    "TZH:TZM": "XXX", "TZHTZM": "XX", "TZH": "X", "TZD": "zzz",
    "YYYY": "yyyy", "YY": "yy", "MMMM": "MMMM", "MON": "MMM", "MM": "MM", "DD": "dd", "DY": "EEE",
    "HH24": "HH", "HH12": "hh", "AM": "a", "PM": "a", "MI": "mm", "SS": "ss",
    **{f"FF{n}": "S" * (n or 1) for n in range(10)}, "FF": "SSSSSS",
}
_TOKEN = re.compile("|".join(TOKENS), re.I)
#: Letters up to the next token.
_LETTERS = re.compile("(?:(?!" + "|".join(TOKENS) + ")[A-Za-z])+", re.I)


def java_pattern(fmt: str) -> str:
    """'YYYY-MM-DD HH24:MI:SS' to 'yyyy-MM-dd HH:mm:ss'; other letters are literal, text in double quotes too."""
    out, at = [], 0
    while at < len(fmt):
        if fmt[at] == '"' and (end := fmt.find('"', at + 1)) > 0:
            out.append("'" + fmt[at + 1 : end].replace("'", "''") + "'")
            at = end + 1
        elif m := _TOKEN.match(fmt, at):
            out.append(TOKENS[m[0].upper()])
            at = m.end()
        else:
            m = _LETTERS.match(fmt, at)
            out.append(f"'{m[0]}'" if m else fmt[at])
            at = m.end() if m else at + 1
    return "".join(out)


def add_months(start: Any, months: Any) -> Column:
    """The last day of a month stays a last day."""
    d = as_column(start).cast("date")
    moved = F.add_months(d, as_value(months))
    return F.when(d == F.last_day(d), F.last_day(moved)).otherwise(moved)


def current_date() -> Column:
    return F.current_date()


def current_timestamp() -> Column:
    return F.current_timestamp()


def current_time() -> Column:
    """Needs spark.sql.timeType.enabled."""
    return F.current_time()


def sysdate() -> Column:
    """The current time in UTC, without a zone."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.localtimestamp())


def convert_timezone(*args: Any) -> Column:
    """(source zone, target zone, local time), or (target zone, time) with the session's zone as source."""
    if len(args) == 2:
        return F.convert_timezone(None, as_value(args[0]), as_column(args[1]))
    return F.convert_timezone(as_value(args[0]), as_value(args[1]), as_column(args[2]))


def year(e: Any) -> Column:
    return F.year(as_column(e))


def quarter(e: Any) -> Column:
    return F.quarter(as_column(e))


def month(e: Any) -> Column:
    return F.month(as_column(e))


def dayofweek(e: Any) -> Column:
    """0 for Sunday to 6 for Saturday."""
    return F.dayofweek(as_column(e)) - 1


def dayofmonth(e: Any) -> Column:
    return F.dayofmonth(as_column(e))


def dayofyear(e: Any) -> Column:
    return F.dayofyear(as_column(e))


def hour(e: Any) -> Column:
    return F.hour(as_column(e))


def minute(e: Any) -> Column:
    return F.minute(as_column(e))


def second(e: Any) -> Column:
    return F.second(as_column(e))


def weekofyear(e: Any) -> Column:
    return F.weekofyear(as_column(e))


def last_day(e: Any) -> Column:
    return F.last_day(as_column(e))


def next_day(e: Any, day: Any) -> Column:
    return F.call_function("next_day", as_column(e), as_value(day))


def previous_day(e: Any, day: Any) -> Column:
    """The last such weekday strictly before the date."""
    return F.call_function("next_day", F.date_sub(as_column(e), 8), as_value(day))


def _parse(f, e: Any, fmt: str | None) -> Column:
    return f(as_column(e)) if fmt is None else f(as_column(e), java_pattern(fmt)) if f is F.to_date else f(as_column(e), F.lit(java_pattern(fmt)))


def to_timestamp(e: Any, fmt: str | None = None) -> Column:
    return F.to_timestamp(as_column(e)) if fmt is None else F.to_timestamp(as_column(e), java_pattern(fmt))


def try_to_timestamp(e: Any, fmt: str | None = None) -> Column:
    return _parse(F.try_to_timestamp, e, fmt)


def to_date(e: Any, fmt: str | None = None) -> Column:
    return _parse(F.to_date, e, fmt)


def try_to_date(e: Any, fmt: str | None = None) -> Column:
    return F.try_to_timestamp(as_column(e), F.lit(java_pattern(fmt))).cast("date") if fmt else as_column(e).try_cast("date")


def date_from_parts(y: Any, m: Any, d: Any) -> Column:
    """Months and days outside their range roll over."""
    months = F.add_months(F.make_date(as_value(y), F.lit(1), F.lit(1)), as_value(m).cast("int") - 1)
    return F.date_add(months, as_value(d).cast("int") - 1)


def time_from_parts(h: Any, m: Any, s: Any, nanoseconds: Any = None) -> Column:
    """Needs spark.sql.timeType.enabled; nanoseconds are cut to microseconds."""
    sec = as_value(s).cast("decimal(16,6)")
    if nanoseconds is not None:
        sec = sec + F.floor(as_value(nanoseconds) / 1000).cast("decimal(16,6)") / F.lit(1_000_000).cast("decimal(16,6)")
    return F.make_time(as_value(h), as_value(m), sec.cast("decimal(16,6)"))


def timestamp_ntz_from_parts(*parts: Any) -> Column:
    """(date, time) or (year, month, day, hour, minute, second[, nanosecond]); parts out of range roll over."""
    if len(parts) == 2:
        day, time = as_column(parts[0]), as_column(parts[1])
        return F.to_timestamp_ntz(F.concat_ws(" ", day.cast("date").cast("string"), time.cast("string")))
    y, mo, d, h, mi, s, *nano = parts
    base = date_from_parts(y, mo, d).cast("timestamp_ntz")
    seconds = (as_value(h) * 3600 + as_value(mi) * 60 + as_value(s)).cast("long")
    micros = seconds * 1_000_000 + (F.floor(as_value(nano[0]) / 1000).cast("long") if nano else F.lit(0))
    return F.timestamp_add("MICROSECOND", micros, base)


timestamp_from_parts = timestamp_ntz_from_parts


def timestamp_ltz_from_parts(*parts: Any) -> Column:
    return timestamp_ntz_from_parts(*parts).cast("timestamp")


def timestamp_tz_from_parts(*parts: Any) -> Column:
    """As above with an optional last argument, the zone; the value is an instant."""
    *rest, zone = parts if isinstance(parts[-1], str) or len(parts) == 8 else (*parts, None)
    local = timestamp_ntz_from_parts(*rest)
    return local.cast("timestamp") if zone is None else F.convert_timezone(as_value(zone), F.current_timezone(), local).cast("timestamp")


def dayname(e: Any) -> Column:
    return F.dayname(as_column(e))


def monthname(e: Any) -> Column:
    return F.monthname(as_column(e))


_DATE_PARTS = {"year": ("years", 1), "quarter": ("months", 3), "month": ("months", 1), "week": ("weeks", 1), "day": ("days", 1)}
_PART_NAMES = {"years": "year", "y": "year", "yy": "year", "yyyy": "year", "yr": "year", "quarters": "quarter", "q": "quarter", "qtr": "quarter", "months": "month", "mm": "month", "mon": "month", "weeks": "week", "w": "week", "wk": "week", "days": "day", "d": "day", "dd": "day", "hours": "hour", "h": "hour", "hh": "hour", "hr": "hour", "minutes": "minute", "m": "minute", "mi": "minute", "min": "minute", "seconds": "second", "s": "second", "sec": "second", "milliseconds": "millisecond", "ms": "millisecond", "microseconds": "microsecond", "us": "microsecond"}


def _part(name: str) -> str:
    return _PART_NAMES.get(name.lower(), name.lower())


def dateadd(part: str, value: Any, e: Any) -> Column:
    """Adds parts; dates stay dates for days and longer parts."""
    p, v = _part(part), as_value(value).cast("int")
    if p in _DATE_PARTS:
        name, by = _DATE_PARTS[p]
        return as_column(e) + F.make_interval(**{name: v * by})
    return F.timestamp_add(p.upper(), v, as_column(e))


def datediff(part: str, a: Any, b: Any) -> Column:
    """How many boundaries of the part lie between a and b (weeks start on Monday)."""
    p = _part(part)
    x, y = (F.date_trunc(p, as_column(c).cast("timestamp_ntz")) for c in (a, b))
    return F.timestamp_diff(p.upper(), x, y).cast("int" if p in _DATE_PARTS else "long")


def date_trunc(part: str, e: Any) -> Column:
    return F.date_trunc(_part(part), as_column(e))


def unix_timestamp(e: Any) -> Column:
    return F.unix_timestamp(as_column(e))


def date_add(a: Any, b: Any) -> Column:
    """(days, start) or (start, days), days being the plain integer."""
    days, start = (a, b) if isinstance(a, int) else (b, a)
    return F.date_add(as_column(start), as_value(days))


def from_unixtime(e: Any, fmt: str | None = None) -> Column:
    """Seconds since 1970 as text, with milliseconds unless a format says otherwise."""
    return F.date_format(F.timestamp_seconds(as_column(e).cast("double")), java_pattern(fmt) if fmt else "yyyy-MM-dd HH:mm:ss.SSS")


def months_between(end: Any, start: Any) -> Column:
    return F.months_between(as_column(end), as_column(start))


def from_utc_timestamp(e: Any) -> Column:
    return as_column(e).cast("timestamp")


def to_utc_timestamp(e: Any) -> Column:
    return as_column(e).cast("timestamp")


def date_format(e: Any, fmt: str) -> Column:
    """`mm` after hours means minutes, as in the reference formats; other tokens as in to_timestamp."""
    return F.date_format(as_column(e), java_pattern(re.sub("mm", "MI", fmt)))
