"""Web pages: a tolerant parse gives what each rung of the extraction ladder found; which rung supplies a field is decided in SQL."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from datetime import datetime
from html.parser import HTMLParser
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import MONTHS
from ..schema import as_events

SCAN = 20_000
_DAY = re.compile(r"(\d{4})-(\d{2})-(\d{2})")
#: A day in prose, whatever stands before the month.
_BODY = re.compile(rf"({'|'.join(MONTHS)})\s+(\d{{1,2}})(?:st|nd|rd|th)?,?\s*(\d{{4}})", re.I)
_VOID = {"br", "img", "hr", "meta", "link", "input", "source", "area", "base", "col", "embed", "track", "wbr"}


class Page(HTMLParser):
    """What a page holds: linked-data scripts, times, meta tags, headings, visible text and anchors. Never fails on broken markup."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.scripts: list[str] = []
        self.times: list[str] = []
        self.meta: dict[str, str] = {}
        self.headings: list[str] = []
        self.title = ""
        self.text: list[str] = []
        self.anchors: list[tuple[str, str, str]] = []  # link, its text, the text of the block around it
        self._hidden, self._into, self._anchor, self._block = "", {}, None, [""]
        try:
            self.feed(html or "")
            self.close()
        except (AssertionError, ValueError):
            pass
        for name in list(self._into):
            self.handle_endtag(name)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        a = {k: v or "" for k, v in attrs}
        if tag in ("script", "style"):
            self._hidden = "ld" if tag == "script" and "ld+json" in a.get("type", "") else tag
            if self._hidden == "ld":
                self.scripts.append("")
            self.text.append(" ")
        elif tag == "time" and "datetime" in a:
            self.times.append(a["datetime"].strip())
        elif tag == "meta":
            name = a.get("property") or a.get("name")
            if name and a.get("content", "").strip():
                self.meta.setdefault(name.lower(), a["content"].strip())
        if tag in ("h1", "title"):
            self._into[tag] = ""
        if tag == "a" and a.get("href", "").strip():
            self._end_anchor()
            self._anchor = [a["href"].strip(), ""]
        if tag in ("p", "li", "div", "td", "article", "section"):
            self._block = [""]
        if tag not in _VOID:
            self.text.append("")

    def handle_endtag(self, tag: str) -> None:
        if tag in ("script", "style"):
            self._hidden = ""
        elif tag in self._into:
            got = " ".join(self._into.pop(tag).split())
            if tag == "h1":
                self.headings.append(got)
            elif not self.title:
                self.title = got
        elif tag == "a":
            self._end_anchor()

    def _end_anchor(self) -> None:
        if self._anchor:
            self.anchors.append((self._anchor[0], " ".join(self._anchor[1].split()), self._block))
            self._anchor = None

    def handle_data(self, data: str) -> None:
        if self._hidden == "ld":
            self.scripts[-1] += data
        if self._hidden:
            return
        self.text.append(data)
        self._block[0] += data
        for tag in self._into:
            self._into[tag] += data
        if self._anchor:
            self._anchor[1] += data

    def handle_comment(self, data: str) -> None:
        self.text.append(" ")

    @property
    def visible(self) -> str:
        return "".join(self.text)


def _iso(value: Any) -> datetime | None:
    try:
        return datetime.fromisoformat(value.strip()).replace(tzinfo=None) if isinstance(value, str) and value.strip() else None
    except ValueError:
        return None


def _day(year: str, month: int, day: str) -> datetime | None:
    try:
        return datetime(int(year), month, int(day))
    except ValueError:
        return None


def _events_in(data: Any) -> Iterator[dict]:
    for x in data if isinstance(data, list) else [data]:
        if isinstance(x, dict):
            if x.get("@type") == "Event":
                yield x
            elif isinstance(x.get("@graph"), list):
                yield from (g for g in x["@graph"] if isinstance(g, dict) and g.get("@type") == "Event")


def _said(x: Any) -> str:
    return x.strip() if isinstance(x, str) else ""


def linked_data(page: Page) -> dict[str, Any]:
    """[H1] The first Event among the linked-data scripts."""
    for script in page.scripts:
        try:
            event = next(_events_in(json.loads(script)), None)
        except ValueError:
            continue
        if event:
            break
    else:
        return {}
    place, offers, image = event.get("location"), event.get("offers"), event.get("image")
    if isinstance(place, dict):
        address = place.get("address")
        parts = [place.get("name"), *([address.get("streetAddress"), address.get("addressLocality")] if isinstance(address, dict) else [address])]
        place = ", ".join(filter(None, map(_said, parts)))
    offers = offers[0] if isinstance(offers, list) and offers else offers
    price = offers.get("price") if isinstance(offers, dict) else None
    image = image[0] if isinstance(image, list) and image else image
    image = image.get("url") if isinstance(image, dict) else image
    return {"title": _said(event.get("name")), "description": _said(event.get("description")), "start": _iso(event.get("startDate")), "end": _iso(event.get("endDate")), "location": _said(place), "cost": "" if price is None else str(price).strip(), "image_url": _said(image)}


#: [H1-H6] Rungs with their confidence, best first.
RUNGS = (
    ("linked_data", 1.0, lambda p, url: linked_data(p)),
    ("time_tags", 0.8, lambda p, url: dict(zip(("start", "end"), [_iso(t) for t in p.times if _DAY.match(t)][:2]))),
    ("meta", 0.6, lambda p, url: {"title": p.meta.get("og:title", ""), "description": p.meta.get("og:description") or p.meta.get("description", ""), "image_url": p.meta.get("og:image", "")}),
    ("heading", 0.5, lambda p, url: {"title": next(filter(None, p.headings), "") or p.title}),
    ("url_day", 0.4, lambda p, url: {"start": _day(m[1], int(m[2]), m[3]) if (m := _DAY.search(url or "")) else None}),
    ("body_day", 0.2, lambda p, url: {"start": _day(m[3], [x.lower() for x in MONTHS].index(m[1].lower()) + 1, m[2]) if (m := _BODY.search(" ".join(p.visible.split())[:SCAN])) else None}),
)
_TEXTS, _TIMES = ("title", "description", "location", "cost", "image_url"), ("start", "end")
_RUNG = "struct<" + ",".join([*(f"{f}:string" for f in _TEXTS), *(f"`{f}`:timestamp_ntz" for f in _TIMES)]) + ">"


def page_fields(pages: DataFrame) -> DataFrame:
    """pages with a struct for each rung; each page is parsed once, in place."""
    extra = ", ".join(f"{name} {_RUNG}" for name, _, _ in RUNGS)
    keep = pages.select("source_id", "page_seq", "url", "status", "body")

    def f(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for url, body in zip(b["url"], b["body"]):
                page = Page(body or "")
                rows.append([{k: (g.get(k) or (None if k in _TIMES else "")) for k in (*_TEXTS, *_TIMES)} for g in (rule(page, url) for _, _, rule in RUNGS)])
            yield pd.concat([b.drop(columns="body").reset_index(drop=True), pd.DataFrame(rows, columns=[n for n, _, _ in RUNGS])], axis=1)

    return keep.mapInPandas(f, f"source_id string, page_seq bigint, url string, status int, {extra}")


def ladder(pages: DataFrame) -> DataFrame:
    """[H7, A23] At most one event a page: each field from the first rung that has it, with that rung's confidence; no title, no row."""
    r = page_fields(pages.filter("status = 200"))

    def pick(field: str) -> tuple[Column, Column]:
        values = [F.col(f"{n}.{field}") if field in _TIMES else F.nullif(F.col(f"{n}.{field}"), F.lit("")) for n, _, _ in RUNGS]
        return F.coalesce(*values), F.coalesce(*[F.when(v.isNotNull(), F.lit(c)) for v, (_, c, _) in zip(values, RUNGS)])

    fields = {f: pick(f) for f in (*_TEXTS, *_TIMES)}
    notes = [F.when(c.isNotNull(), F.struct(F.lit(f).alias("key"), F.struct(F.col("source_id").alias("source"), c.alias("confidence")).alias("value"))) for f, (_, c) in fields.items()]
    r = r.withColumn("notes", F.map_from_entries(F.array_compact(F.array(*notes)))).select("*", *[v.alias(f"f_{f}") for f, (v, _) in fields.items()]).filter("f_title is not null")
    out = as_events(r, None, seq=F.col("page_seq") * 1_000_000, source_id="source_id", external_id="url", url="url", field_provenance=F.col("notes"), **{f: F.col(f"f_{f}") for f in fields})
    return out


def anchors(pages: DataFrame) -> DataFrame:
    """(source_id, page_seq, url, at, href, text, block): the links of each page in order."""

    def f(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(s, q, u, n, h, t, " ".join(k[0].split())) for s, q, u, body in zip(b["source_id"], b["page_seq"], b["url"], b["body"]) for n, (h, t, k) in enumerate(Page(body or "").anchors)]
            yield pd.DataFrame(rows, columns=["source_id", "page_seq", "url", "at", "href", "text", "block"])

    return pages.select("source_id", "page_seq", "url", "body").mapInPandas(f, "source_id string, page_seq bigint, url string, at int, href string, text string, block string")


def stripped(html: Column | str) -> Column:
    """[X12] Without scripts and styles."""
    c = F.col(html) if isinstance(html, str) else html
    return F.regexp_replace(c, r"(?is)<(script|style)\b[^>]*>.*?</\1>", "")


