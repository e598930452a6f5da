"""Discovery: pages to fetch from sitemaps, listings and robots files, and new organisations from hub pages."""

from __future__ import annotations


from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.taxonomy import EVENT_PATH, sitemap_kind
from ..functions.text import domain_of, normalize_org_name, url_join
from .html import anchors

ENTRY = "source_id string, page_seq bigint, root string, at int, loc string, lastmod string"
#: [F14] Fixed values: files that are no pages.
NOT_PAGES = ("jpg", "jpeg", "png", "gif", "svg", "webp", "ico", "pdf", "zip", "gz", "mp3", "mp4", "mov", "avi", "css", "js", "json", "xml", "doc", "docx", "xls", "xlsx", "ppt", "pptx", "woff", "woff2", "ttf", "eot")


def is_event_path(url: Column | str) -> Column:
    """[F5]"""
    c = F.col(url) if isinstance(url, str) else url
    return F.coalesce(F.rlike(c, F.lit(f"(?iu){EVENT_PATH}")), F.lit(False))


def is_page(url: Column | str) -> Column:
    """[F14]"""
    path = F.coalesce(F.try_parse_url(F.col(url) if isinstance(url, str) else url, F.lit("PATH")), F.lit(""))
    return ~F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1)).isin(*NOT_PAGES)


def same_domain(url: Column | str, domain: Column | str) -> Column:
    """www. doesn't matter."""
    bare = lambda c: F.regexp_replace(c, r"^www\.", "")
    return bare(domain_of(url)) == bare(F.lower(F.col(domain) if isinstance(domain, str) else domain))


def sitemap_entries(pages: DataFrame) -> DataFrame:
    """[A25, A37] (source_id, page_seq, root, at, loc, lastmod) of landed sitemap bodies; root is urlset or sitemapindex, in any
    namespace. Bodies that aren't well-formed XML with such a root give nothing."""

    def f(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        local = lambda e: e.tag.rpartition("}")[2]
        for b in batches:
            rows = []
            for source, seq, body in zip(b["source_id"], b["page_seq"], b["body"]):
                try:
                    root = ElementTree.fromstring(body or "")
                except (ElementTree.ParseError, ValueError):
                    continue
                if local(root) not in ("urlset", "sitemapindex"):
                    continue
                for at, item in enumerate(root):
                    got = {local(x): (x.text or "").strip() for x in item}
                    if got.get("loc"):
                        rows.append((source, seq, local(root), at, got["loc"], got.get("lastmod", "")))
            yield pd.DataFrame(rows, columns=["source_id", "page_seq", "root", "at", "loc", "lastmod"])

    return pages.filter("status = 200").select("source_id", "page_seq", "body").mapInPandas(f, ENTRY)


def first_sitemap(entries: DataFrame) -> DataFrame:
    """[A25] Of a source's candidate addresses (page_seq in order), the first that is a sitemap."""
    first = Window.partitionBy("source_id")
    return entries.withColumn("__f", F.min("page_seq").over(first)).filter("page_seq = __f").drop("__f")


def child_sitemaps(entries: DataFrame) -> DataFrame:
    """[A26] Children of an index to be read: those named for events or programs, whole; without any, all, filtered by path."""
    index = entries.filter("root = 'sitemapindex'").withColumn("named", sitemap_kind(F.regexp_extract("loc", r"([^/]*)/?$", 1)).isin("event", "program"))
    index = index.withColumn("any_named", F.max("named").over(Window.partitionBy("source_id", "page_seq")))
    return index.filter("named or not any_named").select("source_id", "page_seq", "at", "loc", (~F.col("any_named")).alias("path_filter"))


def sitemap_urls(entries: DataFrame, path_filter: Column | bool = True) -> DataFrame:
    """[A25, A26] (source_id, url, lastmod): pages of url sets; a later entry of an address replaces an earlier one."""
    flag = F.lit(path_filter) if isinstance(path_filter, bool) else path_filter
    found = entries.filter("root = 'urlset'").filter(~flag | is_event_path("loc"))
    last = found.groupBy("source_id", F.col("loc").alias("url")).agg(F.max_by("lastmod", F.struct("page_seq", "at")).alias("lastmod"))
    return last


def changed_urls(current: DataFrame, previous: DataFrame, changed_only: bool = True) -> DataFrame:
    """[J7, K8] Addresses that are new or whose lastmod is another; all of them unless changed_only. Each row of current is judged
    by itself and given at most once; an address that previous repeats is known with each of its lastmods. Nulls equal nulls."""
    if not changed_only:
        return current
    known = previous.select(*(F.col(c).alias(f"__{c}") for c in ("source_id", "url", "lastmod")))
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in ("source_id", "url", "lastmod")]
    return current.join(known, same, "left_anti")


def robots_sitemaps(pages: DataFrame) -> DataFrame:
    """[A42] Sitemap lines of robots files, of the same domain."""
    lines = pages.select("source_id", "url", F.explode(F.split("body", r"\r?\n")).alias("line"))
    found = lines.select("source_id", "url", F.trim(F.regexp_extract("line", r"(?iu)^\s*sitemap:\s*(.*)", 1)).alias("loc"))
    return found.filter((F.col("loc") != "") & same_domain("loc", domain_of("url"))).select("source_id", "loc").distinct()


def listing_links(pages: DataFrame) -> DataFrame:
    """[A24, A27] (source_id, page_seq, link, at): event links of listing pages, each once a page, in order."""
    found = anchors(pages.filter("status = 200")).withColumn("link", url_join("url", "href")).filter(is_event_path("link"))
    return found.groupBy("source_id", "page_seq", "link").agg(F.min("at").alias("at"))


def hub_candidates(hubs: DataFrame) -> DataFrame:
    """[A28] (hub_id, url, org_name, block, at) of hub pages (source_id: the hub): named http links to other domains, the first of
    each address."""
    a = anchors(hubs.filter("status = 200")).withColumn("link", url_join("url", "href"))
    a = a.filter(F.rlike("link", F.lit("(?i)^https?://")) & (F.trim("text") != "") & ~same_domain("link", domain_of("url")))
    w = Window.partitionBy("source_id", "link").orderBy("page_seq", "at")
    first = a.withColumn("__n", F.row_number().over(w)).filter("__n = 1")
    return first.select(F.col("source_id").alias("hub_id"), F.col("link").alias("url"), F.trim("text").alias("org_name"), "block", "at")


def new_candidates(candidates: DataFrame, known: DataFrame, queued: DataFrame | None = None) -> DataFrame:
    """[J4, X9] Candidates whose domain and name are both unknown to the registry (known: org_name, site_url), and whose address and
    name aren't queued. Null keys match nothing."""
    c = candidates.withColumn("domain", domain_of("url")).withColumn("name_norm", normalize_org_name("org_name"))
    domains = known.select(domain_of("site_url").alias("domain")).filter("domain <> 'unknown'").distinct()
    names = known.select(normalize_org_name("org_name").alias("name_norm")).distinct()
    out = c.join(domains, "domain", "left_anti").join(names, "name_norm", "left_anti")
    if queued is not None:
        out = out.join(queued.select("url").distinct(), "url", "left_anti").join(queued.select(normalize_org_name("org_name").alias("name_norm")).distinct(), "name_norm", "left_anti")
    return out


def unvisited(links: DataFrame, visited: DataFrame, domain: str, depth: int, most_depth: int = 20) -> DataFrame:
    """[A35] The next frontier of a crawl: pages of the domain that weren't visited."""
    if depth >= most_depth:
        return links.select("url").limit(0)
    return links.select("url").distinct().filter(same_domain("url", F.lit(domain)) & is_page("url")).join(visited.select("url"), "url", "left_anti")


def choose_pages(urls: DataFrame) -> DataFrame:
    """[F13, J14] (domain, url, phase, at, tier): each address once, from the earliest phase; the filtered phase (2) counts without
    a page from event sitemaps (1) or in tier 2, the directory phase (3) without any page so far or in tier 3."""
    by = Window.partitionBy("domain")
    n = lambda p: F.count(F.when(F.col("phase") <= p, 1)).over(by)
    kept = urls.withColumn("n1", n(1)).withColumn("n2", n(2))
    kept = kept.filter("phase = 1 or (phase = 2 and (n1 = 0 or tier = '2')) or (phase = 3 and (tier = '3' or (n1 = 0 and n2 = 0)))")
    first = Window.partitionBy("domain", "url").orderBy("phase", "at")
    return kept.withColumn("__n", F.row_number().over(first)).filter("__n = 1").drop("__n", "n1", "n2")


