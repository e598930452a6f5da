"""Dates and times. All are wall-clock times without a zone (TIMESTAMP_NTZ); offsets are dropped, never converted."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, filled

OFFSET = "-07:00"
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")
_MONTH = "(" + "|".join(MONTHS) + ")"
_WEEKDAY = "(?:Monday|Tuesday|Wednesday|Thursday|Friday|Saturday|Sunday)"
_SHAPE = r"^\d{4}-\d{2}-\d{2}([T ]|$)"


def parse_iso(c: Column | str) -> Column:
    """[N1, N2] The wall-clock time of an ISO text; null for an empty or other text."""
    return F.when(F.rlike(col(c), F.lit(_SHAPE)), _try_ntz(col(c)))


def _try_ntz(c: Column) -> Column:
    return c.try_cast("timestamp_ntz")


def is_bad_date(c: Column | str) -> Column:
    """A text is there but is no time: the record is dropped."""
    return (F.coalesce(F.trim(col(c)), F.lit("")) != "") & parse_iso(c).isNull()


def iso_text(c: Column | str) -> Column:
    """[N11] ISO text with the fixed offset; microseconds only if there are any; empty for null."""
    base = F.date_format(col(c), "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(col(c), "SSSSSS")
    return F.coalesce(F.concat(base, F.when(fraction != "000000", F.concat(F.lit("."), fraction)).otherwise(""), F.lit(OFFSET)), F.lit(""))


def local_day(c: Column | str) -> Column:
    """[N12] The day that a text begins with, as written."""
    return F.when(F.rlike(col(c), F.lit(r"^\d{4}-\d{2}-\d{2}")), F.substring(col(c), 1, 10).try_cast("date"))


def effective_day(start: Column | str, end: Column | str) -> Column:
    """[N16]"""
    return F.to_date(F.coalesce(col(end), col(start)))


def is_weekend(c: Column | str) -> Column:
    """[N13]"""
    return F.coalesce(F.dayofweek(local_day(c)).isin(1, 7), F.lit(False))


def format_day(c: Column | str) -> Column:
    """[N13, N19] Like "Sat, August 15, 2026"; "Ongoing" without a day."""
    return F.coalesce(F.date_format(local_day(c), "EEE, MMMM d, y"), F.lit("Ongoing"))


def format_range(start: Column | str, end: Column | str) -> Column:
    """[N13]"""
    a, b = format_day(start), format_day(end)
    return F.when(filled(start).isNull(), "Ongoing").when(filled(end).isNull() | (a == b), a).otherwise(F.concat(a, F.lit(" – "), b))


def has_no_time(c: Column | str) -> Column:
    """[N14] Midnight stands for no time of day."""
    return F.coalesce(F.rlike(col(c), F.lit(r"T00:00:00(Z|[+-]\d{2}:\d{2})?$")), F.lit(False))


def is_fresh(fetched: Column | str, now: Column, days: float) -> Column:
    """[N17] Fetched less than so many days ago."""
    return (F.unix_micros(now.cast("timestamp")) - F.unix_micros(col(fetched).cast("timestamp"))) < int(days * 86_400_000_000)


def _day(year: Column | str, month: Column, day: Column) -> Column:
    number = F.array_position(F.array(*[F.lit(m.lower()) for m in MONTHS]), F.lower(month))
    return F.concat_ws("-", F.lit(year) if isinstance(year, str) else year, F.lpad(number.cast("string"), 2, "0"), F.lpad(day, 2, "0")).try_cast("date")


def parse_date_text(c: Column | str, year: str = "2026") -> Column:
    """[T13] struct<start, end> (ISO days or empty) from prose, by eight patterns in order; a pattern whose day doesn't exist is
    passed over. Days without a year get the given one."""
    text = F.trim(col(c))
    got = lambda p, i: F.regexp_extract(text, p, i)
    iso = lambda d: F.date_format(d, "yyyy-MM-dd")
    # The eight patterns and their order.
    out = lambda a, b=None: F.when(a.isNotNull() & (F.lit(True) if b is None else b.isNotNull()), F.struct(a.alias("start"), (F.lit("") if b is None else b).alias("end")))
    full, weekday, at, alone, month = (
        rf"(?iu){_MONTH}\s+(\d{{1,2}}),?\s+(\d{{4}})",
        rf"(?iu){_WEEKDAY}s?,?\s+{_MONTH}\s+(\d{{1,2}})",
        rf"(?iu){_MONTH}\s+(\d{{1,2}})\s*@",
        rf"(?iu)^{_MONTH}\s+(\d{{1,2}})\s*,?\s*$",
        rf"(?iu){_MONTH}\s+(\d{{4}})",
    )
    range2, range1 = rf"(?iu){_MONTH}\s+(\d{{1,2}})\s*[-–]\s*{_MONTH}\s+(\d{{1,2}})", rf"(?iu){_MONTH}\s+(\d{{1,2}})\s*[-–]\s*(\d{{1,2}})"
    plain = r"(\d{4}-\d{2}-\d{2})"
    return F.coalesce(
        out(iso(_day(filled(got(full, 3)), got(full, 1), got(full, 2)))),
        *[out(iso(_day(year, filled(got(p, 1)), got(p, 2)))) for p in (weekday, at, alone)],
        F.when(got(month, 2).try_cast("int").between(2020, 2030), out(iso(_day(filled(got(month, 2)), got(month, 1), F.lit("1"))))),
        out(filled(got(plain, 1))),
        out(iso(_day(year, filled(got(range2, 1)), got(range2, 2))), iso(_day(year, got(range2, 3), got(range2, 4)))),
        out(iso(_day(year, filled(got(range1, 1)), got(range1, 2))), iso(_day(year, got(range1, 1), got(range1, 3)))),
        F.struct(F.lit("").alias("start"), F.lit("").alias("end")),
    )


def clock_time(c: Column | str) -> Column:
    """[S21] The first time of day in a text, like "3:00 pm"; empty without one."""
    return F.coalesce(F.regexp_extract(col(c), r"(?i)(\d{1,2}:\d{2}\s*[ap]m)", 1), F.lit(""))


def clock_to_iso(day: Column | str, clock: Column | str) -> Column:
    """[N18] A day and a 12-hour clock time as ISO text; noon without a time."""
    hour, minute = F.regexp_extract(col(clock), r"(\d{1,2}):(\d{2})", 1).try_cast("int"), F.regexp_extract(col(clock), r"(\d{1,2}):(\d{2})", 2)
    pm = F.rlike(F.lower(col(clock)), F.lit("pm"))
    h24 = F.when(pm & (hour < 12), hour + 12).when(~pm & (hour == 12), 0).otherwise(hour)
    time = F.when(hour.isNotNull(), F.concat(F.lpad(h24.cast("string"), 2, "0"), F.lit(":"), minute)).otherwise("12:00")
    return F.when(filled(day).isNull(), "").otherwise(F.concat(col(day), F.lit("T"), time, F.lit(":00" + OFFSET)))
