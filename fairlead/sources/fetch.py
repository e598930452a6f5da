"""Fetching: what answers requests (V4: HTTP, a browser given by the caller, a table in memory), the rules of politeness, and
`fetched`, which asks over the cluster, one task for each domain."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Any, Protocol
from urllib.error import HTTPError
from urllib.parse import urlsplit
from urllib.request import Request, urlopen
from urllib.robotparser import RobotFileParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.identity import url_key
from ..functions.text import domain_of

AGENT = "fairlead"
FETCHED = "source_id string, page_seq bigint, url string, status int, body string, etag string, last_modified string, headers map<string,string>, fetched_at timestamp_ntz"


@dataclass(frozen=True)
class Response:
    status: int
    body: str = ""
    headers: dict[str, str] = field(default_factory=dict)


class Fetcher(Protocol):
    def get(self, url: str, headers: dict[str, str] | None = None) -> Response: ...


@dataclass(frozen=True)
class Limits:
    """[Z2] Of a crawl: seconds between requests to a domain and for an answer, bytes of a body, links from the start, and how often
    which answers are asked for again. Fixed values."""

    delay: float = 1.0
    timeout: float = 30.0
    most_bytes: int = 10 * 1024 * 1024
    depth: int = 20
    retries: int = 2
    retried: tuple[int, ...] = (500, 502, 503, 504, 408, 429)


@dataclass
class UrlFetcher:
    """[A29] Over HTTP. Every status is an answer, whatever it is; bodies are UTF-8, bad bytes replaced, and one that is too large is
    empty. No connection is an OSError."""

    agent: str = AGENT
    limits: Limits = field(default_factory=Limits)

    def get(self, url: str, headers: dict[str, str] | None = None) -> Response:
        request = Request(url, headers={"User-Agent": self.agent} | (headers or {}))
        try:
            answer = urlopen(request, timeout=self.limits.timeout)  # noqa: S310  addresses are the caller's
        except HTTPError as e:
            answer = e
        with answer:
            body = answer.read(self.limits.most_bytes + 1)
            return Response(answer.status, "" if len(body) > self.limits.most_bytes else body.decode("utf-8", "replace"), dict(answer.headers.items()))


class BrowserFetcher:
    """[A30] Pages as a browser shows them once the network is idle, or after so many seconds. `open_page` starts the browser and
    gives a page with goto, wait_for_load_state and content; it is called on the first use."""

    def __init__(self, open_page: Callable[[], Any], idle: float = 15.0):
        self.open_page, self.idle, self._page = open_page, idle, None

    def get(self, url: str, headers: dict[str, str] | None = None) -> Response:
        self._page = self._page or self.open_page()
        if headers:
            self._page.set_extra_http_headers(headers)
        answer = self._page.goto(url)
        try:
            self._page.wait_for_load_state("networkidle", timeout=self.idle * 1000)
        except Exception as e:  # noqa: BLE001  each browser has its own; a page that never rests is read as it is
            if "timeout" not in type(e).__name__.lower():
                raise
        return Response(answer.status if answer else 200, self._page.content(), dict(answer.headers) if answer else {})


@dataclass
class MemoryFetcher:
    """[A29, A30] Answers from a table, for tests and for bodies landed before; 404 for what isn't there."""

    answers: dict[str, Response]
    asked: list[str] = field(default_factory=list)

    def get(self, url: str, headers: dict[str, str] | None = None) -> Response:
        self.asked.append(url)
        return self.answers.get(url, Response(404))


def header(headers: dict[str, str], name: str) -> str:
    """[M8]"""
    return next((v for k, v in headers.items() if k.lower() == name.lower()), "")


def robots_of(url: str, fetcher: Fetcher) -> RobotFileParser:
    """[A31] The rules of the site's robots.txt; without one that can be read everything is allowed."""
    parts, rules = urlsplit(url), RobotFileParser()
    try:
        got = fetcher.get(f"{parts.scheme}://{parts.netloc}/robots.txt")
    except (OSError, ValueError):
        got = Response(0)
    rules.parse(got.body.splitlines() if got.status == 200 else [])
    return rules


def is_allowed(url: str, fetcher: Fetcher, agent: str) -> bool:
    """[A31]"""
    return robots_of(url, fetcher).can_fetch(agent, url)


@dataclass
class Throttle:
    """[A32] Time between requests to a domain. Deal rows by domain, so that one task owns each."""

    clock: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep
    last: dict[str, float] = field(default_factory=dict)

    def wait(self, domain: str, seconds: float = 1.0) -> None:
        left = self.last.get(domain, -1e18) + seconds - self.clock()
        if left > 0:
            self.sleep(left)
        self.last[domain] = self.clock()


def conditional_headers(pages: DataFrame, cache: DataFrame) -> DataFrame:
    """[A33, K7] pages(url) with the etag and last_modified of the cache, to be sent along."""
    known = cache.select("key", "etag", "last_modified")
    return pages.withColumn("key", url_key("url")).join(known, "key", "left")


def resolved(fetched: DataFrame, cache: DataFrame) -> DataFrame:
    """[A33, K7] The cache after a fetch: a 304 keeps the body and renews its time, a 200 replaces it, anything else changes nothing."""
    new = fetched.withColumn("key", url_key("url")).select("key", "url", "status", "body", "etag", "last_modified", "fetched_at")
    old = cache.select("key", *[F.col(c).alias(f"old_{c}") for c in ("url", "body", "etag", "last_modified", "fetched_at")])
    j = old.join(new, "key", "full")

    def pick(name: str) -> Column:
        return F.when(F.col("status") == 200, F.col(name)).otherwise(F.col(f"old_{name}")).alias(name)

    when = F.when(F.col("status").isin(200, 304), F.col("fetched_at")).otherwise(F.col("old_fetched_at")).alias("fetched_at")
    return j.select("key", *map(pick, ("url", "body", "etag", "last_modified")), when).filter("body is not null")


def persistent(fetcher: Fetcher, url: str, headers: dict[str, str], limits: Limits, pause: Callable[[], None]) -> Response:
    """[Z2] Asks again, after a pause, for answers that may pass; what can't be reached has the status 0."""
    for left in range(limits.retries, -1, -1):
        pause()
        try:
            got = fetcher.get(url, headers)
        except (OSError, ValueError):
            got = Response(0)
        if left == 0 or (got.status and got.status not in limits.retried):
            break
    return got


def fetched(refs: DataFrame, make_fetcher: Callable[[], Fetcher] = UrlFetcher, limits: Limits = Limits(), agent: str = AGENT, make_throttle: Callable[[], Throttle] = Throttle) -> DataFrame:
    """[A29-A33, M8] Landed pages of refs(source_id, page_seq, url, and where there are such: headers, etag, last_modified). Rows are
    dealt by domain, so that one task owns its robots file and its pace; what robots forbid has the status 0. A task that runs again
    asks again, so write the result before it is read twice."""
    rows = refs.select(
        "source_id", F.col("page_seq").cast("long").alias("page_seq"), "url", domain_of("url").alias("domain"),
        *[F.col(c) if c in refs.columns else F.lit(None).cast("string").alias(c) for c in ("etag", "last_modified")],
        F.map_entries("headers").alias("headers") if "headers" in refs.columns else F.array().cast("array<struct<key:string,value:string>>").alias("headers"),
    )

    def f(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fetcher, throttle, allowed = make_fetcher(), make_throttle(), {}
        for b in batches:
            out = []
            for r in b.itertuples(index=False):
                site = urlsplit(r.url)[:2]
                if site not in allowed:
                    allowed[site] = robots_of(r.url, fetcher)
                got = Response(0)
                if allowed[site].can_fetch(agent, r.url):
                    sent = {e["key"]: e["value"] for e in (r.headers if r.headers is not None else ())}
                    sent |= {k: v for k, v in (("If-None-Match", r.etag), ("If-Modified-Since", r.last_modified)) if v}
                    got = persistent(fetcher, r.url, sent, limits, lambda d=r.domain: throttle.wait(d, limits.delay))
                out.append((r.source_id, r.page_seq, r.url, got.status, got.body, header(got.headers, "ETag"), header(got.headers, "Last-Modified"), got.headers, datetime.now(timezone.utc).replace(tzinfo=None)))
            yield pd.DataFrame(out, columns=["source_id", "page_seq", "url", "status", "body", "etag", "last_modified", "headers", "fetched_at"])

    return rows.repartition("domain").sortWithinPartitions("page_seq", "source_id", "url").mapInPandas(f, FETCHED)


def land(spark: SparkSession, refs: DataFrame, fetcher: Fetcher) -> DataFrame:
    """Landed pages of refs(source_id, page_seq, url), fetched on the driver one by one: for tests and small runs."""
    rows = [(r["source_id"], r["page_seq"], r["url"], (got := fetcher.get(r["url"])).status, got.body) for r in refs.orderBy("source_id", "page_seq").toLocalIterator()]
    return spark.createDataFrame(rows, "source_id string, page_seq bigint, url string, status int, body string")
