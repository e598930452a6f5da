"""[2.15] python -m fairlead run | discover-candidates | fetch-remote | mirror | export-older: the chain over pages that have been
landed as Parquet, and the commands that land them."""

from __future__ import annotations

import argparse
import logging
from collections.abc import Callable
from datetime import date
from urllib.parse import urlsplit

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from . import config
from .operators import export, legacy, observe
from .operators.state import Versions
from .plans import pipeline
from .sources import crawl, feeds, registry
from .sources.fetch import Fetcher, UrlFetcher, fetched


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="fairlead")
    sub = p.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="collect, merge and publish")
    run.add_argument("--partners", required=True)
    run.add_argument("--site-dir", default=config.site_dir())
    run.add_argument("--dry-run", action="store_true")
    run.add_argument("--limit", type=int)
    run.add_argument("--source")
    run.add_argument("--yield-history", default=f"{config.cache_dir()}/yield")
    run.add_argument("--no-report", action="store_true")
    run.add_argument("--today", type=date.fromisoformat, default=date.today())
    found = sub.add_parser("discover-candidates", help="queue organisations that hub pages name")
    found.add_argument("--candidates-dir", required=True)
    found.add_argument("--hubs-dir", help="registry of hubs; pages of others are left out")
    remote = sub.add_parser("fetch-remote", help="land the answers of the remote database")
    remote.add_argument("--registry-dir", required=True)
    remote.add_argument("--output-dir", required=True)
    copy = sub.add_parser("mirror", help="land whole sites of partners")
    copy.add_argument("--csv", help="partners: name, website")
    copy.add_argument("--url", help="one site instead")
    copy.add_argument("--output-dir", required=True, help="a folder for each site")
    copy.add_argument("--limit", type=int)
    copy.add_argument("--resume", action="store_true", help="leave out sites that have a folder")
    older = sub.add_parser("export-older", help="publish records of the older chain")
    older.add_argument("--records", required=True, help="Parquet of flat records, as legacy.build_opportunities takes them")
    older.add_argument("--partners", required=True)
    older.add_argument("--site-dir", default=config.site_dir())
    older.add_argument("--dry-run", action="store_true")
    older.add_argument("--today", type=date.fromisoformat, default=date.today())
    for s in (remote, copy, older):
        s.add_argument("-v", "--verbose", action="store_true")
    for s in (run, found):
        s.add_argument("--pages", required=True, help="landed pages: source_id, page_seq, url, status, body")
        s.add_argument("--registry-dir", required=True)
        s.add_argument("--no-enrich", action="store_true", help="without the enrichment cache")
        s.add_argument("--cache", help="replies of the enrichment client: identity, content_hash, reply")
        s.add_argument("-v", "--verbose", action="store_true")
    return p


def mirror(spark: SparkSession, a: argparse.Namespace, make_fetcher: Callable[[], Fetcher]) -> int:
    """Sites one after the other, each over the cluster, each in a folder of its own that a broken run is continued in."""
    if not a.csv and not a.url:
        raise SystemExit("mirror needs --csv or --url")
    rows = [{"website": a.url}] if a.url else registry.read_partner_csv(spark, a.csv, a.limit).select("website").toLocalIterator()
    done = Versions(spark, a.output_dir)
    for r in rows:
        site = urlsplit(r["website"] if "//" in r["website"] else f"https://{r['website']}").netloc
        if a.resume and done.exists(site):
            continue
        landed = crawl.crawl(spark.createDataFrame([(site, r["website"])], "source_id string, url string"), f"{a.output_dir}/{site}", make_fetcher)
        print(f"{site}: {landed.filter('status = 200').count()} pages")
    return 0


def main(argv: list[str] | None = None, client: Callable[[dict], str] | None = None, make_fetcher: Callable[[], Fetcher] = UrlFetcher) -> int:
    """A program that has a model or a way of fetching of its own gives them here."""
    a = parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO if a.verbose else logging.WARNING)
    spark = SparkSession.builder.appName("fairlead").getOrCreate()
    if a.command == "mirror":
        return mirror(spark, a, make_fetcher)
    if a.command == "export-older":
        rows = legacy.build_opportunities(spark.read.parquet(a.records), registry.read_partners(spark, a.partners))
        print(f"{export.export_older(rows, a.site_dir, a.today, a.dry_run)} opportunities")
        return 0
    sources = registry.load_sources(spark, a.registry_dir)
    if a.command == "fetch-remote":
        refs = feeds.remote_refs(registry.active_sources(sources), config.remote_url(), config.remote_key())
        fetched(refs, make_fetcher).select("source_id", "page_seq", F.lit("").alias("url"), "status", "body").write.mode("overwrite").parquet(a.output_dir)
        return 0
    pages = spark.read.parquet(a.pages)
    if a.command == "discover-candidates":
        if a.hubs_dir:
            pages = pages.join(registry.load_hubs(spark, a.hubs_dir).select(F.col("hub_id").alias("source_id")), "source_id", "left_semi")
        stubs = pipeline.discover_candidates(pages, sources, registry.load_candidates(spark, a.candidates_dir))
        print(f"{export.write_candidates(stubs, a.candidates_dir)} new candidates")
        return 0
    history, reporter = Versions(spark, a.yield_history), observe.YieldReporter()
    cache = spark.read.parquet(a.cache) if a.cache and not a.no_enrich else None
    got = pipeline.run(pages, registry.active_sources(sources, a.source, a.limit), registry.read_partners(spark, a.partners), a.today, client=None if a.no_enrich else client, cache=cache, reporter=reporter)
    meta = export.export_opportunities(got.opportunities, a.site_dir, a.today, dry_run=a.dry_run)
    print(f"{meta['count']} opportunities")
    report = reporter.report(history.latest())
    if not a.no_report:
        print(observe.render_text(report))
    if not a.dry_run and a.source is None and a.limit is None:
        history.write(report.select("source_id", "found", "slugs"))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
