"""[A35, A43, X12, A38, A39] Mirrors of whole sites: a crawl level by level, each level landed before the next is planned, so a crawl
that is broken off goes on where it was; reading mirrors kept as files; feeds whose length is known only from their pages."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import is_fresh
from ..functions.identity import mirror_path
from ..functions.text import domain_of, strip_html, url_join
from ..operators.state import Versions
from . import discovery
from .feeds import names_of
from .fetch import FETCHED, Fetcher, Limits, Throttle, UrlFetcher, fetched, persistent
from .html import anchors, stripped

#: What is asked of every site besides its start, and folders that hold events.
PROBES = ("/robots.txt", "/sitemap.xml")
EVENT_FOLDERS = (
    "event", "events", "public-event", "science-event", "program", "programs", "course", "courses", "camp", "camps", "workshop", "workshops",
    "class", "classes", "training", "calendar", "series", "sessions", "lessons",
)


def starts(sites: DataFrame) -> DataFrame:
    """(source_id, url) to begin with, of sites(source_id, url): the address, with https where it names no scheme, and the probes."""
    url = F.when(F.rlike("url", F.lit("(?i)^https?://")), F.col("url")).otherwise(F.concat(F.lit("https://"), "url"))
    root = F.regexp_extract(url, r"^(https?://[^/?#]+)", 1)
    return sites.select("source_id", F.explode(F.array(url, *[F.concat(root, F.lit(p)) for p in PROBES])).alias("url")).distinct()


def onward(pages: DataFrame) -> DataFrame:
    """[A35, A42, A43] (source_id, url): what landed pages lead to within their domain: links of pages, sitemap lines of robots files,
    and of sitemaps, in any namespace, both pages and further sitemaps."""
    good = pages.filter("status = 200")
    base = good.groupBy("source_id", "page_seq").agg(F.first("url").alias("base"))
    robots = F.endswith("url", F.lit("/robots.txt"))
    linked = anchors(good.filter(~robots & discovery.is_page("url"))).select("source_id", F.col("url").alias("base"), F.regexp_replace(url_join("url", "href"), "#.*$", "").alias("url")).filter(discovery.is_page("url"))
    listed = discovery.sitemap_entries(good.filter(~robots)).join(base, ["source_id", "page_seq"]).select("source_id", "base", F.col("loc").alias("url"))
    found = linked.unionByName(listed).filter(F.rlike("url", F.lit("(?i)^https?://")) & discovery.same_domain("url", domain_of("base"))).select("source_id", "url")
    return found.unionByName(discovery.robots_sitemaps(good.filter(robots)).select("source_id", F.col("loc").alias("url"))).distinct()


def crawl(
    sites: DataFrame, folder: str, make_fetcher: Callable[[], Fetcher] = UrlFetcher, limits: Limits = Limits(), *,
    known: DataFrame | None = None, now: Column | None = None, days: float = 1.0, make_throttle: Callable[[], Throttle] = Throttle,
) -> DataFrame:
    """[A35, N17] All landed pages (and their level) of sites(source_id, url), under the folder. Each address is asked once a source.
    Pages of an earlier crawl (known) that are younger than so many days at `now` are taken from there instead."""
    spark, at = sites.sparkSession, Versions(sites.sparkSession, folder)
    frontier = starts(sites)
    for level in range(limits.depth + 1):
        path = f"{at.path}/level={level}"
        if not at.exists(f"level={level}/_SUCCESS"):
            refs = frontier.withColumn("page_seq", F.xxhash64("source_id", "url"))
            old = None
            if known is not None:
                fresh = known.filter(is_fresh("fetched_at", now if now is not None else F.localtimestamp(), days) & (F.col("status") == 200)).dropDuplicates(["source_id", "url"])
                old = fresh.drop("page_seq").join(refs, ["source_id", "url"]).select(*[c.split()[0] for c in FETCHED.split(", ")])
                refs = refs.join(fresh.select("source_id", "url"), ["source_id", "url"], "left_anti")
            got = fetched(refs, make_fetcher, limits, make_throttle=make_throttle)
            (got if old is None else got.unionByName(old)).write.mode("overwrite").parquet(path)
        landed = spark.read.parquet(path)
        if landed.isEmpty():
            break
        seen = spark.read.parquet(*[f"{at.path}/level={n}" for n in range(level + 1)]).select("source_id", "url")
        frontier = onward(landed).join(seen, ["source_id", "url"], "left_anti")
    return spark.read.option("basePath", at.path).parquet(*[f"{at.path}/level={n}" for n in range(level + 1)])


def mirrored(pages: DataFrame) -> DataFrame:
    """[X12, A40] (domain, path, html, meta) of landed pages: without scripts and styles; meta is JSON with the address, the status,
    the headers and the time."""
    meta = F.to_json(F.struct("url", "status", "headers", F.col("fetched_at").cast("string").alias("timestamp")))
    return pages.filter("status = 200").select(domain_of("url").alias("domain"), mirror_path("url").alias("path"), stripped("body").alias("html"), meta.alias("meta"))


def read_mirror(spark: SparkSession, folder: str, events_only: bool = True) -> DataFrame:
    """[A38] (domain, path, url, headers, html) of a mirror kept as files: folder/domain/path/content.html with meta.json beside it;
    by default only what lies in a top folder named for events. A page without readable meta data has no address."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(folder)
    prefix = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(root).toString().rstrip("/") + "/"
    place = F.substring(F.regexp_replace("path", "/[^/]+$", ""), len(prefix) + 1, 1 << 30).alias("place")

    def files(name: str, text: str) -> DataFrame:
        return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", name).load(folder).select(place, F.decode("content", "UTF-8").alias(text))

    pages = files("content.html", "html").withColumn("parts", F.split("place", "/"))
    if events_only:
        pages = pages.filter(F.lower(F.get("parts", F.lit(1))).isin(*EVENT_FOLDERS))
    told = F.from_json("meta", "url string, headers map<string,string>")
    j = pages.join(files("meta.json", "meta").withColumn("m", told), "place", "left")
    return j.select(F.col("parts")[0].alias("domain"), F.array_join(F.slice("parts", 2, 1 << 20), "/").alias("path"), "m.url", "m.headers", "html")


def pages_in_turn(sites: DataFrame, make_fetcher: Callable[[], Fetcher] = UrlFetcher, limits: Limits = Limits(), make_throttle: Callable[[], Throttle] = Throttle, per_page: int = 50) -> DataFrame:
    """[A39] Landed pages of sites(source_id, api_base), asked for one after the other until one fails, is empty or is the last that
    it names; many sites at once over the cluster."""

    def f(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fetcher, throttle = make_fetcher(), make_throttle()
        for b in batches:
            for source, base in zip(b["source_id"], b["api_base"]):
                page = last = 1
                while page <= last:
                    url = f"{base}?per_page={per_page}&page={page}&status=publish"
                    got = persistent(fetcher, url, {}, limits, lambda u=base: throttle.wait(u, limits.delay))
                    try:
                        answer = json.loads(got.body) if got.status == 200 else {}
                    except ValueError:
                        answer = {}
                    if not isinstance(answer, dict) or not answer.get("events"):
                        break
                    yield pd.DataFrame([(source, page, url, got.status, got.body, "", "", got.headers, datetime.now())], columns=[c.split()[0] for c in FETCHED.split(", ")])
                    last, page = int(answer.get("total_pages") or 1), page + 1

    return sites.select("source_id", "api_base").repartition("api_base").mapInPandas(f, FETCHED)


_DETAILS = "map<string,string>"
_VENUE = "struct<venue:string,address:string,city:string,state:string,zip:string>"
_OLDER = (
    "title string, description string, excerpt string, start_date string, end_date string, start_date_details " + _DETAILS + ", end_date_details " + _DETAILS + ", all_day boolean, timezone string, cost string, "
    "cost_details string, url string, website string, image struct<url:string>, venue " + _VENUE + ", organizer array<struct<organizer:string,email:string,phone:string,website:string>>, "
    "categories array<struct<name:string>>, tags array<struct<name:string>>, id string, modified_date string"
)


def older_records(pages: DataFrame, sites: DataFrame) -> DataFrame:
    """[A39] Records of landed pages of sites(source_id, organization, domain), as the older export keeps them: markup stripped, names
    of categories and tags, texts empty where a field is missing. Without a title or an address they stay."""
    shape = "struct<events:array<struct<" + _OLDER.replace(", ", ",").replace(" ", ":") + ">>>"
    r = pages.filter("status = 200").select("source_id", "page_seq", F.posexplode(F.from_json("body", shape)["events"]).alias("at", "r")).join(sites.select("source_id", "organization", "domain"), "source_id")
    text = lambda n: F.coalesce(F.col(f"r.{n}"), F.lit("")).alias(n)
    return r.select(
        "organization", "domain", text("title"), strip_html(text("description")).alias("description"), strip_html(text("excerpt")).alias("excerpt"), *map(text, ("start_date", "end_date")), "r.start_date_details", "r.end_date_details",
        F.coalesce("r.all_day", F.lit(False)).alias("all_day"), *map(text, ("timezone", "cost")), "r.cost_details", *map(text, ("url", "website")), F.coalesce("r.image.url", F.lit("")).alias("image_url"), "r.venue", "r.organizer",
        names_of("r.categories").alias("categories"), names_of("r.tags").alias("tags"), F.coalesce("r.id", F.lit("")).alias("api_id"), text("modified_date"), F.lit("tec_api").alias("source"), (F.col("page_seq") * 1_000_000 + F.col("at")).alias("seq"),
    )
