"""[A12, A13] iCalendar bodies: events and the occurrences of recurring ones."""

from __future__ import annotations

import re
from collections.abc import Iterator
from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import as_events

DAYS, OCCURRENCES = 180, 52
FIELDS = "source_id string, page_seq bigint, at bigint, uid string, title string, description string, location string, link string, first timestamp_ntz, last timestamp_ntz, whole boolean"


def unfold(body: str) -> list[str]:
    """Content lines; a line that starts with a blank goes on the one before."""
    return re.sub(r"\r?\n[ \t]", "", body).splitlines()


def _plain(text: str) -> str:
    return re.sub(r"\\([nN,;\\])", lambda m: "\n" if m[1] in "nN" else m[1], text).strip()


def _time(value: str) -> tuple[datetime, bool] | None:
    """(wall-clock time, whether it is a day alone); a Z or zone is dropped."""
    m = re.fullmatch(r"(\d{4})(\d{2})(\d{2})(?:T(\d{2})(\d{2})(\d{2})?Z?)?", value.strip())
    try:
        return (datetime(*(int(x or 0) for x in m.groups())), m[4] is None) if m else None
    except ValueError:
        return None


def occurrences(first: datetime, rule: str) -> list[datetime]:
    """Starts by a recurrence rule, for at most DAYS from the first and OCCURRENCES in all; the first alone if it can't be read."""
    from dateutil.rrule import rrulestr

    try:
        rule = re.sub(r"(UNTIL=\d{8}(?:T\d{6})?)Z", r"\1", rule)
        end, out = first + timedelta(days=DAYS), []
        for t in rrulestr(rule, dtstart=first):
            if t > end or len(out) == OCCURRENCES:
                break
            out.append(t)
        return out
    except (ValueError, TypeError):
        return [first]


def parse_events(body: str) -> Iterator[tuple]:
    """(uid, title, description, location, link, start, end, all day) of each occurrence; events without a title or start give none."""
    fields: dict[str, str] | None = None
    for line in unfold(body or ""):
        name, _, value = line.partition(":")
        name = name.partition(";")[0].upper()
        if (name, value.strip().upper()) == ("BEGIN", "VEVENT"):
            fields = {}
        elif (name, value.strip().upper()) == ("END", "VEVENT") and fields is not None:
            start, end = _time(fields.get("DTSTART", "")), _time(fields.get("DTEND", ""))
            title, uid = _plain(fields.get("SUMMARY", "")), fields.get("UID", "").strip()
            if start and title:
                length, rule = (end[0] - start[0] if end else None), fields.get("RRULE")
                for t in occurrences(start[0], rule) if rule else [start[0]]:
                    key = (f"{uid}::{t.isoformat()}" if rule else uid) if uid else ""
                    yield key, title, _plain(fields.get("DESCRIPTION", "")), _plain(fields.get("LOCATION", "")), fields.get("URL", "").strip(), t, t + length if length is not None else None, start[1]
            fields = None
        elif fields is not None:
            fields.setdefault(name, value)


def ical(pages: DataFrame) -> DataFrame:
    """Canonical events of calendar bodies; each page is parsed for itself, in place."""

    def f(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(s, p, n, *e) for s, p, body in zip(b["source_id"], b["page_seq"], b["body"]) for n, e in enumerate(parse_events(body))]
            yield pd.DataFrame(rows, columns=[x.split()[0] for x in FIELDS.split(", ")])

    r = pages.filter("status = 200").select("source_id", "page_seq", "body").mapInPandas(f, FIELDS)
    return as_events(
        r, 1.0, seq=F.col("page_seq") * 1_000_000 + F.col("at"), source_id="source_id", external_id="uid", url="link", title="title", description="description", location="location",
        start="first", end="last", all_day="whole",
    )


def daily_occurrences(rows: DataFrame, start: str = "start", step_days: int = 1) -> DataFrame:
    """[A13] The same bounds for a rule of every so many days, with built-in functions alone: adds `occurrence`."""
    times = F.expr(f"sequence({start}, {start} + interval {DAYS} days, interval {step_days} days)")
    return rows.withColumn("occurrence", F.explode(F.slice(times, 1, OCCURRENCES)))


