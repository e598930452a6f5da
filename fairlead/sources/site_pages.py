"""[H8, H9, G-records] Event pages of mirrored sites by platform: which elements hold a field is a table, and which table a page
goes by, the day where the page has none, and what counts as a record are column expressions."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import taxonomy
from ..functions.dates import MONTHS, parse_date_text
from ..functions.text import filled, present
from ..operators.legacy import is_valid

_DAY = re.compile(rf"({'|'.join(MONTHS)})\s+\d{{1,2}},?\s*\d{{0,4}}")
SIGN_UP = ("register", "sign up", "rsvp", "tickets", "book now", "reserve", "enroll")
#: For each kind of page: field -> places in order of trust. m: a meta property, c: an element with such a class, h1, title; a day
#: is looked for in the named place's text or, with "day", in the body.
PLACES = {
    "tribe": {"title": ("c:entry-title", "m:og:title", "h1"), "date_text": ("c:crf-event-details", "c:tribe-events-schedule", "day"), "venue": ("c:tribe-venue",), "description": ("c:tribe-events-content", "c:entry-content", "m:og:description")},
    "wordpress": {"title": ("m:og:title", "h1", "title"), "date_text": ("day",), "venue": (), "description": ("c:entry-content", "c:post-content", "c:article-content", "c:field-content", "c:page-content", "m:og:description")},
    "wix": {"title": ("m:og:title", "title"), "date_text": ("day",), "venue": (), "description": ("m:og:description", "m:description")},
    "drupal": {"title": ("h1", "m:og:title"), "date_text": ("c:date-display", "c:field-date", "c:event-date", "day"), "venue": ("c:field-location", "c:event-location"), "description": ("c:field-body", "c:body", "m:og:description")},
    "library": {"title": ("h1", "m:og:title"), "date_text": ("c:event-date", "c:date", "day"), "venue": ("c:event-location", "c:location"), "description": ("c:event-description", "c:description", "m:og:description")},
    "title_date": {"title": ("h1", "title"), "date_text": ("in:title", "day"), "venue": (), "description": ("m:og:description", "m:description")},
    "generic": {"title": ("m:og:title", "h1", "title"), "date_text": ("c:date", "day"), "venue": ("c:venue", "c:location"), "description": ("m:og:description", "m:description", "c:content")},
}
#: Fixed value: the header that names a site's events API.
API_HEADER = "x-tec-api-root"
FIELDS = ("title", "date_text", "venue", "description", "image_url", "registration_url", "modified_time")


class _Blocks(HTMLParser):
    """Texts of elements with a class, of headings and of anchors, and meta tags; unclosed elements end with the page."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.meta: dict[str, str] = {}
        self.blocks: list[list] = []  # tag, class, link, text
        self._open: list[list] = []
        self._hidden = False
        self.text: list[str] = []
        try:
            self.feed(html)
            self.close()
        except (AssertionError, ValueError):
            pass

    def handle_starttag(self, tag: str, attrs: list) -> None:
        a = {k: v or "" for k, v in attrs}
        self._hidden = tag in ("script", "style")
        if tag == "meta" and (name := a.get("property") or a.get("name")):
            self.meta.setdefault(name, a.get("content", "").strip())
        if tag in ("br", "img", "hr", "meta", "link", "input"):
            return
        block = [tag, a.get("class", ""), a.get("href", ""), []]
        self._open.append(block)
        self.blocks.append(block)

    def handle_endtag(self, tag: str) -> None:
        self._hidden = False
        for n in range(len(self._open) - 1, -1, -1):
            if self._open[n][0] == tag:
                del self._open[n:]
                break

    def handle_data(self, data: str) -> None:
        if not self._hidden:
            self.text.append(data)
            for b in self._open[-24:]:
                b[3].append(data)

    def of(self, test) -> str:
        return next((t for b in self.blocks if test(b) and (t := " ".join("".join(b[3]).split()))), "")


def page_record(html: str, kind: str) -> dict[str, str]:
    """The fields of a page by its kind's places; texts are cut at 1,000 characters, days and venues at 200."""
    p = _Blocks(html or "")

    def at(place: str) -> str:
        how, _, what = place.partition(":")
        if how == "m":
            return p.meta.get(what, "").split(" - ")[0].strip() if what == "og:title" else p.meta.get(what, "")
        if how == "c":
            return p.of(lambda b: what in b[1])
        if how == "day" or how == "in":
            m = _DAY.search(p.of(lambda b: b[0] == "title") if how == "in" else " ".join("".join(p.text).split()))
            return m[0] if m else ""
        got = p.of(lambda b: b[0] == how)
        return got.split(" - ")[0].strip() if how == "title" else got

    places = PLACES.get(kind, PLACES["generic"])
    out = {f: next(filter(None, map(at, places[f])), "") for f in ("title", "date_text", "venue", "description")}
    link = next((b[2] for b in p.blocks if b[0] == "a" and any(k in "".join(b[3]).lower() for k in SIGN_UP)), "")
    cut = {"date_text": 200, "venue": 200, "description": 1000}
    return {f: v[: cut.get(f, 500)] for f, v in (out | {"image_url": p.meta.get("og:image", ""), "registration_url": link, "modified_time": p.meta.get("article:modified_time", "")}).items()}


def page_kind(url: Column, domain: Column, platform: Column, plugin: Column, library: tuple[str, ...] = (), title_date: tuple[str, ...] = ()) -> Column:
    """[H9]"""
    return (
        F.when(F.contains(url, F.lit("bibliocommons.com")) | domain.isin(*library), "library")
        .when(domain.isin(*title_date), "title_date")
        .when((platform == "drupal") & F.contains(F.lower(url), F.lit("/event")), "drupal")
        .when(F.contains(plugin, F.lit("tribe_events")), "tribe")
        .when(platform == "wix", "wix")
        .when(platform == "wordpress", "wordpress")
        .otherwise("generic")
    )


def extract_pages(pages: DataFrame, library: tuple[str, ...] = (), title_date: tuple[str, ...] = ()) -> DataFrame:
    """[H8, H9] Records of pages(organization, domain, platform, plugin, url, html, source_method, and headers where they are kept): the fields, the address of an
    API that the headers name, a start from the text, else from the address, else from the time of change (then date_text says so), the kind of event and a confidence; valid ones only."""
    kinds = pages.withColumn("kind", page_kind(F.col("url"), F.col("domain"), F.col("platform"), F.col("plugin"), library, title_date))
    names = F.filter(F.map_entries("headers"), lambda e: F.lower(e["key"]) == API_HEADER) if "headers" in pages.columns else None
    api = F.coalesce(F.get(names, F.lit(0))["value"], F.lit("")) if names is not None else F.lit("")
    keep = kinds.select("organization", "domain", "url", "source_method", "kind", api.alias("api_url"), "html")

    def f(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = pd.DataFrame([page_record(h, k) for h, k in zip(b["html"], b["kind"])], columns=FIELDS)
            yield pd.concat([b.drop(columns="html").reset_index(drop=True), got], axis=1)

    texts = "organization string, domain string, url string, source_method string, kind string, api_url string, " + ", ".join(f"{c} string" for c in FIELDS)
    r = keep.mapInPandas(f, texts).withColumn("said", parse_date_text("date_text"))
    dashed = filled(F.regexp_extract("url", r"/(\d{4}-\d{2}-\d{2})", 1))
    slashed = F.nullif(F.regexp_replace(F.regexp_extract("url", r"/(\d{4}/\d{2}/\d{2})/", 1), "/", "-"), F.lit(""))
    changed = filled(F.regexp_extract("modified_time", r"(\d{4}-\d{2}-\d{2})", 1))
    known = F.coalesce(filled("said.start"), dashed, slashed)
    r = r.withColumn("start_date", F.coalesce(known, changed, F.lit(""))).withColumn("end_date", F.col("said.end"))
    r = r.withColumn("date_text", F.when(known.isNull() & changed.isNotNull() & ~present("date_text"), F.concat(F.lit("modified:"), changed)).otherwise(F.col("date_text")))
    r = r.withColumn("event_type", taxonomy.event_kind("url", "title"))
    r = r.withColumn("confidence", taxonomy.record_confidence(F.col("title"), F.col("date_text"), F.col("description"), F.col("registration_url"), F.col("api_url"), F.col("source_method")))
    return r.filter(is_valid("url", "title")).drop("said", "kind", "modified_time")
